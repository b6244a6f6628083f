"""The business questions over transactions, customers and products."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from purchaseflow.operators import history, journeys, quality, ranking, sequence, sets, standardise
from purchaseflow.operators.enrich import with_dimension
from purchaseflow.operators.hot import Split, split

# Fixed values from here to TOP_PRODUCTS: raw product names and the names the
# transactions use, the items and the number of the reports.
PRODUCT_NAMES = {
    "iPhone SE": "iPhone",
    "AirPods Pro": "AirPods",
    "MacBook Air": "MacBook",
    "iPad Mini": "iPad",
}
FIRST_ITEM = "iPhone"
NEXT_ITEM = "AirPods"
TOP_PRODUCTS = 3

_KEY = ["customer_id"]
_HISTORY = ["transaction_date", "transaction_id"]


@dataclass(frozen=True)
class Inputs:
    transactions: DataFrame
    customers: DataFrame
    products: DataFrame
    work_dir: str | None = None
    # what the copy of the raw transactions has counted, by check
    counted: Mapping[str, int] | None = None
    # several analyses read one history, dealt by customer and written
    shared: bool = False

    @cached_property
    def history(self) -> Split:
        """The transactions split for sequences, searched for hot keys once, on first use."""
        columns = [*_KEY, *_HISTORY, "product_name"]
        slim = self.transactions.select(*columns)
        return split(slim, _KEY, _HISTORY, base=self.work_dir)

    @cached_property
    def dealt(self) -> history.History:
        """The same, dealt by customer and written on first use."""
        return history.deal(self.history, _KEY, _HISTORY, "product_name", base=self.work_dir)


def prepared_products(raw: DataFrame) -> DataFrame:
    """Products under the transactions' names, the raw name kept beside them."""
    named = standardise.map_values(raw, "product_name", PRODUCT_NAMES, "source_product_name")
    return named.select("product_id", "product_name", "source_product_name", "category", "price")


def next_purchases(transactions: DataFrame) -> DataFrame:
    """Every transaction with the customer's very next one."""
    upcoming = {
        "next_product": "product_name",
        "next_purchase_date": "transaction_date",
        "next_transaction_id": "transaction_id",
    }
    return sequence.with_next(transactions, _KEY, _HISTORY, upcoming)


def followed_up(
    inputs: Inputs, first: str = FIRST_ITEM, then: str = NEXT_ITEM
) -> DataFrame:
    """Customers whose very next purchase after ``first`` was ``then``."""
    found = (
        inputs.dealt.followed_by(first, then)
        if inputs.shared
        else sequence.followed_by(inputs.history, _KEY, _HISTORY, "product_name", first, then)
    ).withColumnsRenamed(
        {
            "first_transaction_id": "iphone_transaction_id",
            "then_transaction_id": "airpods_transaction_id",
            "first_transaction_date": "iphone_purchase_date",
            "then_transaction_date": "airpods_purchase_date",
        }
    )
    people = inputs.customers.select("customer_id", "customer_name", "location")
    # fixed values: the output's columns
    return with_dimension(found, people, "customer_id").select(
        "customer_id",
        "customer_name",
        "location",
        "iphone_transaction_id",
        "airpods_transaction_id",
        "iphone_purchase_date",
        "airpods_purchase_date",
        "days_between",
    )


def only_these(inputs: Inputs, items: tuple[str, ...] = (FIRST_ITEM, NEXT_ITEM)) -> DataFrame:
    """Customers whose complete product set is exactly ``items``."""
    found = (
        inputs.dealt.exactly(items, name="products")
        if inputs.shared
        else sets.exactly(inputs.transactions, _KEY, "product_name", items, name="products")
    )
    people = inputs.customers.select("customer_id", "customer_name", "location")
    # fixed values: the output's columns
    return with_dimension(found, people, "customer_id").select(
        "customer_id", "customer_name", "location", "products"
    )


def later_purchases(inputs: Inputs) -> DataFrame:
    """Each customer's first purchase and the ordered later ones.

    ``segment`` is 0 but for the further rows of a customer with more than
    ``journeys.PAGE_ITEMS`` later purchases.
    """
    people = inputs.customers.select("customer_id", "customer_name")
    found = (
        with_dimension(inputs.dealt.first_and_rest(), people, "customer_id")
        if inputs.shared
        else journeys.first_and_rest(
            inputs.history, _KEY, _HISTORY, "product_name", attributes=people
        )
    )
    return found.select(
        "customer_id",
        "customer_name",
        F.col("first_item").alias("first_product"),
        F.col("first_transaction_date").alias("first_purchase_date"),
        F.col("later_items").alias("subsequent_products"),
        journeys.SEGMENT,
    )


def average_delay(follow_ups: DataFrame) -> DataFrame:
    """Mean days between the two purchases over all follow-ups."""
    return sequence.mean_gap(
        follow_ups, "days_between", "average_days_iphone_to_airpods", "qualifying_sequences"
    )


def top_products(inputs: Inputs, k: int = TOP_PRODUCTS) -> DataFrame:
    """The ``k`` products with the highest revenue; units, then name, break ties."""
    sales = ranking.totals(
        inputs.transactions,
        inputs.products,
        on="product_name",
        group=["product_id", "product_name", "source_product_name", "category", "price"],
        counted="transaction_id",
        price="price",
        units_name="units_sold",
    )
    order = ["-revenue", "-units_sold", "product_name"]
    return ranking.top_k(sales, order, k, "revenue_rank")


# Results by output name, and results computed from another output.
ANALYSES: dict[str, Callable[[Inputs], DataFrame]] = {
    "iphone_then_airpods": followed_up,
    "only_iphone_airpods": only_these,
    "subsequent_purchases": later_purchases,
    "top_products": top_products,
}
DERIVED: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "average_purchase_delay": ("iphone_then_airpods", average_delay),
}


NAMES = (*ANALYSES, *DERIVED)
BY_CUSTOMER = {"iphone_then_airpods", "only_iphone_airpods", "subsequent_purchases"}

# The columns that order an output where order is asked for.
SORT_BY: dict[str, tuple[str, ...]] = {
    "iphone_then_airpods": ("customer_id", "iphone_transaction_id"),
    "only_iphone_airpods": ("customer_id",),
    "subsequent_purchases": ("customer_id", journeys.SEGMENT),
    "top_products": ("revenue_rank", "product_id"),
}


def analyses(inputs: Inputs, names: Sequence[str] = NAMES) -> dict[str, DataFrame]:
    """The results asked for as lazy DataFrames, by output name; no other is built.

    With a work folder, and where more than one of BY_CUSTOMER is asked for, these read
    one history that is dealt by customer in one shuffle and written to that folder.
    """
    unknown = sorted(set(names) - set(NAMES))
    if unknown:
        raise ValueError(f"unknown analyses {unknown}, known: {', '.join(NAMES)}")
    wanted = {DERIVED[name][0] if name in DERIVED else name for name in names}
    if inputs.work_dir is not None and len(wanted & BY_CUSTOMER) > 1:
        inputs = replace(inputs, shared=True)
    results = {name: build(inputs) for name, build in ANALYSES.items() if name in names}
    for name, (origin, build) in DERIVED.items():
        if name in names:
            found = results.get(origin)
            results[name] = build(ANALYSES[origin](inputs) if found is None else found)
    return results


# Checks that stop a run.
CRITICAL = (
    "transaction_null_rows",
    "customer_null_rows",
    "product_null_rows",
    "duplicate_transaction_ids",
    "duplicate_customer_ids",
    "duplicate_product_names",
    "unmatched_customers",
    "unmatched_products",
    "non_positive_prices",
)


def _size_and_nulls(subject: str, columns: list[str]) -> dict[str, Column]:
    return {
        f"{subject}_rows": quality.row_count(),
        f"{subject}_null_rows": quality.null_rows(columns),
    }


def transaction_checks() -> dict[str, Column]:
    """The checks of the transactions that need one pass over them and nothing else."""
    return _size_and_nulls(
        "transaction", ["transaction_id", "customer_id", "product_name", "transaction_date"]
    )


def quality_report(inputs: Inputs) -> DataFrame:
    """All twelve checks as one lazy report (check, value, critical).

    What the copy of the raw transactions has counted is not counted again.
    """
    tx, people, goods = inputs.transactions, inputs.customers, inputs.products
    return quality.suite(
        [
            quality.profile(tx, transaction_checks())
            if inputs.counted is None
            else quality.counted(tx.sparkSession, inputs.counted),
            quality.profile(
                people,
                _size_and_nulls(
                    "customer", ["customer_id", "customer_name", "join_date", "location"]
                ),
            ),
            quality.profile(
                goods,
                _size_and_nulls("product", ["product_id", "product_name", "category", "price"])
                | {"non_positive_prices": quality.violations(F.col("price") <= 0)},
            ),
            quality.duplicate_keys(tx, ["transaction_id"], "duplicate_transaction_ids"),
            quality.duplicate_keys(people, ["customer_id"], "duplicate_customer_ids"),
            quality.duplicate_keys(goods, ["product_name"], "duplicate_product_names"),
            quality.unmatched_keys(tx, people, "customer_id", "unmatched_customers"),
            quality.unmatched_keys(tx, goods, "product_name", "unmatched_products"),
        ],
        CRITICAL,
    )
