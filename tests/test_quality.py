from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from purchaseflow.operators import quality
from purchaseflow.plans import purchases
from purchaseflow.plans.purchases import Inputs


def one(df):
    (row,) = df.collect()
    return row["check"], row["value"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0), (1, None, None), (2, "b", 0.0), (2, "b", -3.0), (None, None, 5.0),
         (None, "z", 5.0), (3, "c", 1.0)],
        "id int, name string, price double",
    )


def test_profile_in_one_pass(rows, plan):
    df = quality.profile(
        rows,
        {
            "rows": quality.row_count(),
            "nulls": quality.null_rows(["id", "name"]),
            "bad": quality.violations(F.col("price") <= 0),
        },
    )
    assert plan(df, "simple").count("Scan") == 1
    assert {r["check"]: r["value"] for r in df.collect()} == {"rows": 7, "nulls": 3, "bad": 2}


def test_duplicates_count_distinct_keys_and_null_is_one(rows):
    assert one(quality.duplicate_keys(rows, ["id"], "dup")) == ("dup", 3)
    assert one(quality.duplicate_keys(rows, ["id", "name"], "dup")) == ("dup", 1)


def test_unmatched_counts_distinct_values_and_null_is_one(rows, spark):
    dim = spark.createDataFrame([(1,), (1,), (9,), (None,)], "id int")
    assert one(quality.unmatched_keys(rows, dim, "id", "lost")) == ("lost", 3)
    other = dim.withColumnRenamed("id", "key")
    assert one(quality.unmatched_keys(rows, other, "id", "lost", "key")) == ("lost", 3)


def test_null_check_needs_columns():
    with pytest.raises(ValueError):
        quality.null_rows([])


def inputs(spark, transactions=(), customers=(), products=()):
    tx = [(1, 1, "p", "2024-01-01"), *transactions]
    people = [(1, "Ann", "2024-01-01", "Ohio"), *customers]
    goods = [(1, "p", "p", "c", 1.0), *products]
    return Inputs(
        spark.createDataFrame(
            tx, "transaction_id int, customer_id int, product_name string, transaction_date string"
        ).withColumn("transaction_date", F.to_date("transaction_date")),
        spark.createDataFrame(
            people, "customer_id int, customer_name string, join_date string, location string"
        ).withColumn("join_date", F.to_date("join_date")),
        spark.createDataFrame(
            goods,
            "product_id int, product_name string, source_product_name string, category string, "
            "price double",
        ),
    )


def test_clean_inputs_pass(spark):
    report = quality.enforce(purchases.quality_report(inputs(spark)))
    assert len(report) == 12
    assert {k: v for k, v in report.items() if v} == {
        "transaction_rows": 1,
        "customer_rows": 1,
        "product_rows": 1,
    }


@pytest.mark.parametrize(
    "bad, named",
    [
        ({"transactions": [(2, 1, "p", None)]}, "transaction_null_rows=1"),
        ({"customers": [(2, None, "2024-01-01", "x")]}, "customer_null_rows=1"),
        ({"products": [(2, "q", "q", None, 1.0)]}, "product_null_rows=1"),
        ({"transactions": [(1, 1, "p", "2024-01-02")]}, "duplicate_transaction_ids=1"),
        ({"customers": [(1, "Bob", "2024-01-01", "x")] * 2}, "duplicate_customer_ids=1"),
        ({"products": [(2, "p", "p", "c", 1.0)]}, "duplicate_product_names=1"),
        ({"transactions": [(2, 9, "p", "2024-01-02")]}, "unmatched_customers=1"),
        ({"transactions": [(2, 1, "q", "2024-01-02")]}, "unmatched_products=1"),
        (
            {"products": [(2, "q", "q", "c", 0.0), (3, "r", "r", "c", -1.0)]},
            "non_positive_prices=2",
        ),
    ],
)
def test_each_failure_is_named(spark, bad, named):
    with pytest.raises(quality.DataQualityError) as caught:
        quality.enforce(purchases.quality_report(inputs(spark, **bad)))
    assert str(caught.value) == f"critical checks failed: {named}"


def test_source_name_may_be_null(spark):
    bad = inputs(spark, products=[(2, "q", None, "c", 1.0)])
    assert quality.enforce(purchases.quality_report(bad))["product_null_rows"] == 0


def test_several_failures_are_all_named(spark):
    bad = inputs(spark, transactions=[(1, 9, "q", None)])
    with pytest.raises(quality.DataQualityError) as caught:
        quality.enforce(purchases.quality_report(bad))
    for name in ("transaction_null_rows", "duplicate_transaction_ids", "unmatched_customers"):
        assert f"{name}=1" in str(caught.value)
