"""Hot keys: the split path must give what the plain path gives, in bounded chunks."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import Window, functions as F

from purchaseflow.operators import hot, journeys, sequence

KEY, ORDER = ["key"], ["d", "id"]
DAY = dt.date(2024, 1, 1)


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """4,000 rows; key 0 holds a third, most of them on one day; key null is hot too."""
    h = F.abs(F.xxhash64("id"))
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None)
    day = F.when(h % 10 < 8, 100).when(h % 97 == 5, None).otherwise(h % 365)
    rows = spark.range(1, 4001).select(
        F.col("id"),
        key.otherwise((h % 300 + 1).cast("int")).alias("key"),
        F.substring(F.lit("ABCDE"), (h % 5 + 1).cast("int"), F.lit(1)).alias("item"),
        F.date_add(F.lit(DAY), day.cast("int")).alias("d"),
    )
    return spark.createDataFrame(rows.toArrow())


def test_small_tables_are_not_searched(skewed):
    assert hot.split(skewed, KEY, ORDER, chunk_rows=4000).hot is None


def test_no_hot_key_in_an_even_table(histories):
    df = histories({k: "ABC" for k in range(10)})
    assert hot.split(df, KEY, ORDER, chunk_rows=5).hot is None


@pytest.mark.parametrize("limit", [10, 150])
def test_split_keeps_every_row_once_in_bounded_ordered_chunks(skewed, limit):
    parts = hot.split(skewed, KEY, ORDER, limit)
    ordinary, cut = parts.ordinary, parts.hot
    assert rows_of(ordinary.unionByName(cut.drop(hot.CHUNK))) == rows_of(skewed)
    assert largest(cut) <= limit * 1.5
    assert ordinary.groupBy("key").count().agg(F.max("count")).first()[0] <= limit

    history = {}
    for r in cut.collect():
        history.setdefault(r.key, []).append(((r.d or dt.date.min, r.id), r[hot.CHUNK]))
    assert {0, None} <= set(history)
    for events in history.values():
        chunks = [chunk for _, chunk in sorted(events)]
        assert chunks == sorted(chunks)
        assert sorted(set(chunks)) == list(range(chunks[0], chunks[-1] + 1))


def largest(cut):
    return cut.groupBy("key", hot.CHUNK).count().agg(F.max("count")).first()[0]


#: One busy day and a tie-breaker of any type; the sample rate is below 1.
BUSY = {
    "bigint": (["d", "id"], {}),
    "md5 text": (["d", "m"], {"m": "md5(cast(id as string))"}),
    "decimal": (["v", "id"], {"v": "cast(id % 7 / 4 as decimal(12,2))"}),
    "double": (["v"], {"v": "id / 3"}),
    "text first": (["m", "id"], {"m": "md5(cast(id % 50 as string))"}),
    "outlier": (["d", "v"], {"v": "if(id = 5, 1L << 62, id)"}),
    "three": (["d", "item", "id"], {}),
}


@pytest.mark.parametrize("kind", list(BUSY))
def test_no_hot_key_is_left_whole(spark, kind):
    order, extra = BUSY[kind]
    rows = spark.range(100_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise((F.col("id") % 5000).cast("int")).alias("key"),
        F.substring(F.lit("ABCDE"), (F.col("id") % 5 + 1).cast("int"), F.lit(1)).alias("item"),
        F.lit(DAY).alias("d"),
    ).withColumns({name: F.expr(sql) for name, sql in extra.items()})
    parts = hot.split(rows, KEY, order, chunk_rows=1500)
    assert parts.hot.count() > 33_000
    assert largest(parts.hot) <= 1.5 * 1500
    plain = sequence.with_next(rows, KEY, order, {"after": "id"}, chunk_rows=None)
    cut = sequence.with_next(parts, KEY, order, {"after": "id"})
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


@pytest.mark.parametrize("limit", [5, 60, 500])
def test_next_across_chunks(skewed, limit):
    columns = {"after": "item", "after_id": "id"}
    plain = sequence.with_next(skewed, KEY, ORDER, columns, chunk_rows=None)
    split = sequence.with_next(skewed, KEY, ORDER, columns, chunk_rows=limit)
    assert split.columns == plain.columns
    assert rows_of(split) == rows_of(plain)


@pytest.mark.parametrize("limit", [5, 500])
def test_follow_ups_across_chunks(skewed, limit):
    args = (skewed, KEY, ORDER, "item", "A", "B")
    plain = sequence.followed_by(*args, chunk_rows=None)
    assert rows_of(sequence.followed_by(*args, chunk_rows=limit)) == rows_of(plain)


@pytest.mark.parametrize("limit", [5, 500])
def test_journeys_do_not_show_their_chunks(skewed, limit):
    args = (skewed, KEY, ORDER, "item")
    plain = journeys.first_and_rest(*args, chunk_rows=None, page_items=40)
    cut = journeys.first_and_rest(*args, chunk_rows=limit, page_items=40)
    assert cut.columns == plain.columns
    assert rows_of(cut) == rows_of(plain)
    assert cut.filter("key = 0").count() > 30
    assert rows_of(journeys.later_items(*args, chunk_rows=limit)) == rows_of(
        journeys.later_items(*args, chunk_rows=None)
    )


def test_other_rows_do_not_change_a_journey(spark):
    def journey(others, limit):
        own = spark.range(300).selectExpr("id", "1 as key", "'A' as item", "current_date() as d")
        more = spark.range(1000, 1000 + others).selectExpr(
            "id", "cast(id % 9000 + 2 as int)", "'B'", "current_date()"
        )
        found = journeys.first_and_rest(own.union(more), KEY, ORDER, "item", None, limit, 100)
        return rows_of(found.filter("key = 1"))

    assert journey(1000, 100) == journey(60_000, 100) == journey(1000, 1_000_000)


def test_long_journeys_take_their_attributes_along(spark, skewed):
    people = spark.createDataFrame(
        [(0, "Zoe"), (1, "Ann"), (7, "Gus"), (None, "nobody")], "key int, name string"
    )
    args = (skewed, KEY, ORDER, "item", people)
    plain = journeys.first_and_rest(*args, chunk_rows=None, page_items=50)
    cut = journeys.first_and_rest(*args, chunk_rows=60, page_items=50)
    assert cut.columns == plain.columns
    assert rows_of(cut) == rows_of(plain)
    assert cut.filter("key = 0").count() > 1


@pytest.mark.parametrize("limit", [500, 30_000])
def test_payloads_of_any_type_at_any_size(skewed, limit):
    df = skewed.withColumn("m", F.create_map(F.col("item"), F.col("id")))
    got = sequence.with_next(df, KEY, ORDER, {"after": "m"}, limit)
    plain = sequence.with_next(df, KEY, ORDER, {"after": "m"}, None)
    assert rows_of(got) == rows_of(plain)


@pytest.mark.parametrize("limit", [500, 30_000])
def test_what_has_no_order_is_refused_at_any_size(skewed, limit):
    df = skewed.withColumn("m", F.create_map(F.col("item"), F.col("id")))
    with pytest.raises(AnalysisException):
        sequence.with_next(df, KEY, ["m"], {"after": "id"}, limit)


@pytest.mark.parametrize(
    "cast", ["timestamp", "timestamp_ntz", "int", "bigint", "decimal(12,2)", "smallint"]
)
def test_every_positioned_type_splits(skewed, cast):
    numeric = F.unix_date("d").cast("int") - F.lit(19700)
    value = F.col("d").cast(cast) if cast.startswith("timestamp") else numeric.cast(cast)
    df = skewed.withColumn("d", value)
    plain = sequence.with_next(df, KEY, ORDER, {"after": "id"}, chunk_rows=None)
    split = sequence.with_next(df, KEY, ORDER, {"after": "id"}, chunk_rows=50)
    assert rows_of(split) == rows_of(plain)
    assert largest(hot.split(df, KEY, ORDER, 50).hot) <= 75


def test_huge_numbers_keep_their_order(skewed):
    df = skewed.withColumn("d", F.lit(2**62).cast("long") + F.unix_date("d"))
    plain = sequence.with_next(df, KEY, ORDER, {"after": "id"}, chunk_rows=None)
    split = sequence.with_next(df, KEY, ORDER, {"after": "id"}, chunk_rows=50)
    assert rows_of(split) == rows_of(plain)


def test_times_of_day_and_text_tie_breakers(skewed):
    df = skewed.withColumn("d", F.timestamp_millis(F.col("id") * 61_007 % 99_999_999)).withColumn(
        "id", F.col("id").cast("string")
    )
    plain = sequence.with_next(df, KEY, ORDER, {"after": "id"}, chunk_rows=None)
    split = sequence.with_next(df, KEY, ORDER, {"after": "id"}, chunk_rows=50)
    assert rows_of(split) == rows_of(plain)


def test_composite_keys(skewed):
    df = skewed.withColumn("shop", F.lit("x"))
    keys = ["shop", "key"]
    plain = sequence.with_next(df, keys, ORDER, {"after": "id"}, chunk_rows=None)
    assert rows_of(sequence.with_next(df, keys, ORDER, {"after": "id"}, 50)) == rows_of(plain)


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from([1, 1, 1, 2, 3]), st.sampled_from("ABC"), st.integers(0, 4)),
        min_size=8,
        max_size=40,
    )
)
def test_next_matches_brute_force(spark, drawn):
    rows = [(i, k, item, DAY + dt.timedelta(days=d)) for i, (k, item, d) in enumerate(drawn)]
    df = spark.createDataFrame(rows, "id int, key int, item string, d date")
    expected = {}
    for key in {r[1] for r in rows}:
        ids = [r[0] for r in sorted((r for r in rows if r[1] == key), key=lambda r: (r[3], r[0]))]
        expected |= dict(zip(ids, [*ids[1:], None]))
    got = sequence.with_next(df, KEY, ORDER, {"after": "id"}, chunk_rows=4)
    assert {r.id: r.after for r in got.collect()} == expected


def test_the_window_of_a_hot_key_is_spread_by_chunk(skewed, plan):
    df = sequence.with_next(skewed, KEY, ORDER, {"after": "id"}, chunk_rows=50)
    assert "hashpartitioning(key" in plan(df, "simple")
    assert hot.CHUNK in plan(df, "simple")
    assert "CartesianProduct" not in plan(df, "simple")
    assert "BroadcastNestedLoopJoin" not in plan(df, "simple")


def test_one_search_one_window_and_few_scans(spark, skewed, plan, tmp_path):
    skewed.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    parts = hot.split(fact, KEY, ORDER, 50)
    text = plan(sequence.with_next(parts, KEY, ORDER, {"after": "id"}), "simple")
    assert text.count("Window [") == 1
    assert text.count("/fact") <= 2


def exchanges(text):
    """Shuffles of rows in a plan: those not fed by an aggregate, which has a row a chunk."""
    lines = [x.strip(" +-:*()0123456789") for x in text.splitlines()]
    shuffles = [i for i, x in enumerate(lines) if x.startswith("Exchange hashpartitioning")]
    return sum("Aggregate(" not in " ".join(lines[i + 1 : i + 3]) for i in shuffles)


def test_hot_rows_move_once(skewed, plan):
    parts = hot.split(skewed, KEY, ORDER, 50)
    follow = sequence.with_next(parts, KEY, ORDER, {"after": "id"})
    assert exchanges(plan(follow, "simple")) == 1
    later = journeys.later_items(parts, KEY, ORDER, "item")
    # ordinary and hot rows are two branches with a shuffle each
    assert exchanges(plan(later, "simple")) == 2


def test_chunks_are_neither_tasks_nor_files(spark, skewed, tmp_path):
    def work(limit):
        base = str(tmp_path / f"at{limit}")
        parts = hot.split(skewed, KEY, ORDER, limit, base)
        chunks = parts.hot.select("key", hot.CHUNK).distinct().count()
        after = sequence.with_next(parts, KEY, ORDER, {"after": "id"})
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            tasks = after.rdd.getNumPartitions()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        return chunks, tasks, len(list(tmp_path.glob(f"at{limit}/*/*.parquet")))

    few, many = work(400), work(10)
    assert many[0] > 20 * few[0]
    assert many[1] == few[1] == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert many[2] <= int(spark.conf.get("spark.sql.shuffle.partitions")) >= few[2]


@pytest.mark.parametrize("limit", [10, 150, 100_000])
def test_running_sums_cross_chunks(skewed, limit):
    sums = {"n": F.lit(1).cast("long"), "total": F.col("id")}
    own = Window.partitionBy(*KEY).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumns({name: F.sum(value).over(own) for name, value in sums.items()})
    ordinary, cut = hot.running(skewed, KEY, ORDER, sums, limit)
    assert (cut is None) == (limit == 100_000)
    found = ordinary if cut is None else ordinary.unionByName(cut.drop(hot.CHUNK))
    assert rows_of(found.select(plain.columns)) == rows_of(plain)


def test_the_number_of_hot_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(hot, "MAX_HOT", 5)
    rows = spark.range(5000).select("id", (F.col("id") % 50).alias("key"), F.lit(DAY).alias("d"))
    assert not hot.split(rows, KEY, ORDER, 10).cut  # 100 rows a key, of 5,000: all ordinary
    rows = rows.withColumn("key", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("key")))
    parts = hot.split(rows, KEY, ORDER, 10)
    assert [r.key for r in parts.hot.select("key").distinct().collect()] == [0]
