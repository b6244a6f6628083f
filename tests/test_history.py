"""One dealt history gives what the operators give that deal the table themselves."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from purchaseflow.operators import history, hot, journeys, quality, sequence, sets
from purchaseflow.plans import jobs, purchases
from purchaseflow.sources import read, write

KEY, ORDER = ["key"], ["d", "id"]
DAY = dt.date(2024, 1, 1)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def shuffles(text):
    """Shuffles in a plan that are not fed by an aggregate."""
    lines = [x.strip(" +-:*()0123456789") for x in text.splitlines()]
    at = [i for i, x in enumerate(lines) if x.startswith("Exchange hashpartitioning")]
    return sum("Aggregate(" not in " ".join(lines[i + 1 : i + 3]) for i in at)


@pytest.fixture(scope="module")
def table(spark):
    """Keys of a few rows, one of a third of all, a null key, null items, equal days."""
    h = F.abs(F.xxhash64("id"))
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None)
    item = F.when(h % 31 != 0, F.substring(F.lit("ABBA"), (h % 4 + 1).cast("int"), F.lit(1)))
    rows = spark.range(1, 3001).select(
        F.col("id"),
        key.otherwise((h % 600 + 1).cast("int")).alias("key"),
        F.when(F.col("id") % 7 == 0, "C").otherwise(item).alias("item"),
        F.date_add(F.lit(DAY), (h % 40).cast("int")).alias("d"),
    )
    return spark.createDataFrame(rows.toArrow())


@pytest.mark.parametrize("limit, page", [(100_000, 10_000), (100_000, 3), (40, 7), (300, 10_000)])
def test_analyses_of_a_dealt_history(table, limit, page):
    dealt = history.deal(table, KEY, ORDER, "item", limit, page)
    assert dealt.cut == (limit < 3000)
    assert rows_of(dealt.followed_by("A", "B")) == rows_of(
        sequence.followed_by(table, KEY, ORDER, "item", "A", "B", chunk_rows=None)
    )
    for allowed in (["A", "B"], ["B"], ["A", "B", "C"]):
        assert rows_of(dealt.exactly(allowed)) == rows_of(sets.exactly(table, KEY, "item", allowed))
    plain = journeys.first_and_rest(table, KEY, ORDER, "item", chunk_rows=None, page_items=page)
    assert rows_of(dealt.first_and_rest().select(plain.columns)) == rows_of(plain)


def test_a_history_is_shuffled_once_and_read_without_a_shuffle(table, plan):
    for limit, expected in ((100_000, 1), (40, 2)):
        parts = hot.split(table, KEY, ORDER, limit)
        # ordinary and hot rows are two branches, each row in one of them
        assert shuffles(plan(history.pages(parts, KEY, ORDER, "item", 100), "simple")) == expected
    dealt = history.deal(table, KEY, ORDER, "item")
    for found in (dealt.followed_by("A", "B"), dealt.first_and_rest()):
        assert "Exchange" not in plan(found, "simple")
    assert shuffles(plan(dealt.exactly(["A", "B"]), "simple")) == 0


def test_empty_history(table):
    dealt = history.deal(table.limit(0), KEY, ORDER, "item")
    assert dealt.followed_by("A", "B").isEmpty()
    assert dealt.exactly(["A"]).isEmpty() and dealt.first_and_rest().isEmpty()
    with pytest.raises(ValueError):
        dealt.exactly([])


def inputs_of(spark, work_dir):
    tx = spark.range(1, 400).select(
        F.col("id").cast("int").alias("transaction_id"),
        (F.col("id") * 7 % 60).cast("int").alias("customer_id"),
        F.element_at(
            F.array(*map(F.lit, ("iPhone", "AirPods", "MacBook"))), (F.col("id") * 5 % 11 % 3 + 1).cast("int")
        ).alias("product_name"),
        F.date_add(F.lit(DAY), (F.col("id") % 90).cast("int")).alias("transaction_date"),
    )
    people = spark.range(60).select(
        F.col("id").cast("int").alias("customer_id"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_name"),
        F.lit(DAY).alias("join_date"),
        F.lit("x").alias("location"),
    )
    goods = spark.createDataFrame(
        [(1, "iPhone", "iPhone SE", "d", 1.0)],
        "product_id int, product_name string, source_product_name string, category string, price double",
    )
    return purchases.Inputs(tx, people, goods, work_dir)


def test_the_job_shares_one_history(spark, tmp_path, monkeypatch):
    made = []
    real = history.deal
    monkeypatch.setattr(history, "deal", lambda *a, **b: made.append(1) or real(*a, **b))
    apart = purchases.analyses(inputs_of(spark, None))
    assert not made
    shared = purchases.analyses(inputs_of(spark, str(tmp_path)))
    assert len(made) == 1
    for name, df in apart.items():
        assert shared[name].columns == df.columns
        assert rows_of(shared[name]) == rows_of(df)
    assert apart["iphone_then_airpods"].count() > 5
    purchases.analyses(inputs_of(spark, str(tmp_path)), ["iphone_then_airpods", "top_products"])
    assert len(made) == 1


def test_the_gate_reads_nothing_that_the_copy_has_counted(spark, tmp_path, plan):
    whole = inputs_of(spark, None)
    dirty = whole.transactions.withColumn(
        "customer_id", F.when(F.col("transaction_id") % 5 != 0, F.col("customer_id"))
    )
    path = str(tmp_path / "copy")
    counted = write(dirty, path, checks=purchases.transaction_checks())
    assert counted == {"transaction_rows": 399, "transaction_null_rows": 79}
    copy = spark.read.parquet(path)
    fresh = purchases.Inputs(copy, whole.customers, whole.products)
    known = purchases.Inputs(copy, whole.customers, whole.products, counted=counted)
    report = purchases.quality_report(known)
    assert rows_of(report) == rows_of(purchases.quality_report(fresh))
    # what is left to read: ids, customers and products, one column each
    text = plan(purchases.quality_report(known), "simple")
    scans = [x for x in text.splitlines() if "FileScan" in x]
    assert len(scans) == 3 and all(x.split("ReadSchema:")[1].count(":") == 1 for x in scans)
    with pytest.raises(quality.DataQualityError, match="transaction_null_rows=79"):
        quality.enforce(report)


def test_staging_hands_its_counts_to_the_gate(spark, tmp_path):
    raw, work = str(tmp_path / "raw"), str(tmp_path / "work")
    inputs = inputs_of(spark, None)
    for name, df in (
        (jobs.RAW_TRANSACTIONS, inputs.transactions),
        (jobs.RAW_CUSTOMERS, inputs.customers),
        (jobs.RAW_PRODUCTS, inputs.products.drop("source_product_name")),
    ):
        df.write.option("header", True).csv(f"{raw}/{name}")
    sources = jobs.prepare(spark, raw, work)
    staged = jobs.extract(spark, sources, f"{work}/staged")
    assert staged.counted == {"transaction_rows": 399, "transaction_null_rows": 0}
    assert jobs.extract(spark, sources).counted is None
    assert read(spark, sources["transactions"]).count() == 399
