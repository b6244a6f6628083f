"""Sets, journeys, rankings, standardising and enriching on hand-built rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from purchaseflow.operators import journeys, ranking, sets, standardise
from purchaseflow.operators.enrich import with_dimension

KEY, ORDER = ["key"], ["d", "id"]


def test_exact_set_ignores_order_and_repeats(histories):
    df = histories({1: "AB", 2: "BAAB", 3: "ABC", 4: "A", 5: ["A", "B", None], 6: "CD"})
    got = {r.key: r["items"] for r in sets.exactly(df, KEY, "item", ["B", "A"]).collect()}
    assert got == {1: ["A", "B"], 2: ["A", "B"]}


def test_exact_set_of_one_and_of_none(histories):
    df = histories({1: "AA", 2: "AB"})
    assert [r.key for r in sets.exactly(df, KEY, "item", ["A"]).collect()] == [1]
    with pytest.raises(ValueError):
        sets.exactly(df, KEY, "item", [])


def test_exact_set_combines_before_the_shuffle_and_collects_nothing(histories, plan):
    text = plan(sets.exactly(histories({1: "AB"}), KEY, "item", ["A", "B"]), "simple")
    assert "collect_set" not in text
    assert text.count("HashAggregate") == 2 and "ObjectHashAggregate" not in text


def test_journey_first_and_ordered_rest(histories):
    df = histories({1: "ABC", 2: "C"})
    got = {r.key: r.asDict() for r in journeys.first_and_rest(df, KEY, ORDER, "item").collect()}
    assert got[1]["first_item"] == "A" and got[1]["later_items"] == ["B", "C"]
    assert got[2]["first_item"] == "C" and got[2]["later_items"] == []
    assert got[2]["first_d"] == dt.date(2024, 1, 1) and got[2]["segment"] == 0


def test_journey_same_day_tie_follows_the_id(spark):
    day = dt.date(2024, 1, 1)
    rows = [(2, 1, "A", day), (1, 1, "B", day)]
    df = spark.createDataFrame(rows, "id int, key int, item string, d date")
    (row,) = journeys.first_and_rest(df, KEY, ORDER, "item").collect()
    assert (row.first_item, row.later_items) == ("B", ["A"])


def test_journey_of_an_order_column(histories):
    (row,) = journeys.first_and_rest(histories({1: "AB"}), KEY, ORDER, "id").collect()
    assert (row.first_item, row.later_items) == (1, [2])


def test_journey_needs_both_sides_of_the_dimension(histories, spark):
    people = spark.createDataFrame([(1, "Ann"), (3, "Cid")], "key int, name string")
    df = histories({1: "AB", 2: "AB"})
    got = journeys.first_and_rest(df, KEY, ORDER, "item", attributes=people).collect()
    assert [(r.key, r.name) for r in got] == [(1, "Ann")]


def test_journey_takes_one_exchange(histories, plan, spark):
    text = plan(journeys.first_and_rest(histories({1: "AB"}), KEY, ORDER, "item"), "simple")
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Window [") == 1


def test_journey_pages_follow_the_position(histories):
    df = histories({1: "ABCDEFG", 2: "A"})
    got = journeys.first_and_rest(df, KEY, ORDER, "item", page_items=3).collect()
    assert {(r.key, r.segment): r.later_items for r in got} == {
        (1, 0): ["B", "C", "D"],
        (1, 1): ["E", "F", "G"],
        (2, 0): [],
    }
    assert {(r.first_item, r.first_d) for r in got} == {("A", dt.date(2024, 1, 1))}


def test_null_items_keep_their_place(histories):
    df = histories({1: ["A", None, "C", None]})
    (row,) = journeys.first_and_rest(df, KEY, ORDER, "item").collect()
    assert row.later_items == [None, "C", None]


def test_journey_joins_a_large_dimension_without_a_second_exchange(histories, plan, spark):
    people = spark.range(10).select(F.col("id").cast("int").alias("key"), F.lit("n").alias("name"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        text = plan(
            journeys.first_and_rest(histories({1: "AB"}), KEY, ORDER, "item", attributes=people),
            "simple",
        )
    finally:
        spark.conf.set(threshold, before)
    # one exchange for the history, one for the dimension
    assert "SortMergeJoin" in text
    assert text.count("Exchange hashpartitioning") == 2


@pytest.fixture(scope="module")
def shop(spark):
    fact = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "c"), (None, "c"), (7, "unknown")],
        "id int, name string",
    )
    dim = spark.createDataFrame(
        [(1, "a", 5.0), (2, "b", 5.0), (3, "c", 2.0), (4, "unsold", 9.0)],
        "pid int, name string, price double",
    )
    return fact, dim


def totals(fact, dim):
    return ranking.totals(fact, dim, "name", ["pid", "name", "price"], "id", "price")


def test_totals(shop):
    got = {r.name: (r.units, r.revenue) for r in totals(*shop).collect()}
    assert got == {"a": (2, 10.0), "b": (2, 10.0), "c": (1, 4.0)}


def test_totals_give_every_dimension_row_of_a_name_its_sales(shop, spark):
    fact, dim = shop
    twice = dim.unionByName(spark.createDataFrame([(9, "a", 1.0)], dim.schema))
    got = {r.pid: r.revenue for r in totals(fact, twice).collect()}
    assert got == {1: 10.0, 9: 2.0, 2: 10.0, 3: 4.0}


def test_totals_count_before_the_join(shop, plan):
    text = plan(totals(*shop), "simple")
    assert text.index("Join") < text.index("HashAggregate(keys=[name")


def test_full_ties_share_a_rank_and_stay(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 2.0), ("d", 1.0), ("e", 0.5)],
                               "name string, revenue double")
    got = ranking.top_k(df, ["-revenue"], 3).collect()
    assert {r.name: r["rank"] for r in got} == {"a": 1, "b": 2, "c": 2, "d": 3}


def test_rank_uses_rounded_revenue_then_the_next_key(spark):
    fact = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "id int, name string")
    dim = spark.createDataFrame([(1, "x", 1.004), (2, "y", 0.5005)],
                                "pid int, name string, price double")
    ranked = ranking.top_k(totals(fact, dim), ["-revenue", "-units"], 2)
    assert {r.name: (r.revenue, r["rank"]) for r in ranked.collect()} == {
        "y": (1.0, 1),
        "x": (1.0, 2),
    }


@pytest.fixture
def most_read(spark):
    """The most shuffled rows that a task has read since the fixture was made."""
    store = spark.sparkContext._jsc.sc().statusStore()
    known = spark._jvm.java.util.ArrayList
    quantiles = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def stages():
        found = store.stageList(known(), False, False, quantiles, known())
        return {found.apply(i).stageId(): found.apply(i) for i in range(found.size())}

    before = set(stages())

    def rows() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        most = 0
        for number, stage in stages().items():
            if number not in before and stage.shuffleReadRecords():
                tasks = store.taskList(number, stage.attemptId(), 10_000)
                for i in range(tasks.size()):
                    read = tasks.apply(i).taskMetrics().get().shuffleReadMetrics()
                    most = max(most, read.recordsRead())
        return most

    return rows


@pytest.mark.parametrize("k, tasks", [(1001, 8), (20_000, 400), (1_000_000, 1_000)])
def test_large_top_k_gives_no_task_more_than_its_range(spark, most_read, k, tasks):
    df = spark.range(0, 3 * k, 1, tasks).select(
        (F.col("id") * 7919 % (3 * k)).alias("revenue"), F.lit("x").alias("payload")
    )
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "1m")  # so that the rows meet their ranks in a shuffle too
    try:
        got = ranking.top_k(df, ["-revenue"], k).agg(
            F.count("*"), F.min("revenue"), F.max("rank"), F.max(F.col("revenue") + F.col("rank"))
        )
        assert got.first() == (k, 2 * k, k, 3 * k)
    finally:
        spark.conf.set(threshold, before)
    # three shuffles: all rows by range or key, none by tasks times k
    assert most_read() <= 3 * (3 * k / shuffles)


def test_large_top_k_equals_a_sort(spark):
    rows = [
        (None if i % 17 == 0 else i % 211, None if i % 13 == 0 else f"n{i % 97}", float("nan") if i % 19 == 0 else i / 7)
        for i in range(6000)
    ]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    for order in (["a", "-b", "c"], ["-c", "a"], ["-a", "b", "-c"]):
        names = [o.removeprefix("-") for o in order]
        sorting = [F.desc(n) if o[0] == "-" else F.asc(n) for n, o in zip(names, order)]
        plain = df.withColumn("rank", F.dense_rank().over(Window.orderBy(*sorting)))
        got = ranking.top_k(df, order, 1500)
        expected = plain.filter("rank <= 1500")
        assert sorted(map(repr, got.select(expected.columns).collect())) == sorted(
            map(repr, expected.collect())
        )


def test_top_k_beyond_the_table_keeps_all(spark):
    df = spark.range(3000).select(F.struct("id").alias("s"), (F.col("id") % 2000).alias("v"))
    assert ranking.top_k(df, ["v"], 5000).agg(F.max("rank")).first()[0] == 2000
    assert ranking.top_k(df, ["-s"], 2500).count() == 2500
    assert ranking.top_k(df.limit(0), ["v"], 5000).isEmpty()


def test_a_mass_of_ties_stays_whole(spark):
    df = spark.range(100_010).select(F.when(F.col("id") < 10, F.col("id")).alias("v"))
    got = ranking.top_k(df, ["-v"], 11)
    assert got.count() == 100_010
    assert got.groupBy("rank").count().filter("rank = 11").first()["count"] == 100_000


def test_counts(histories):
    got = {r["item"]: r.units for r in ranking.counts(histories({1: "AAB"}), "item").collect()}
    assert got == {"A": 2, "B": 1}


def test_map_values_keeps_unknown_values_and_origin(spark):
    df = spark.createDataFrame([(1, "x", 9), (2, "y", 8), (3, None, 7)], "id int, v string, n int")
    got = standardise.map_values(df, "v", {"x": "long x"}, "raw")
    assert got.columns == ["id", "v", "raw", "n"]
    rows = {r.id: (r.v, r.raw) for r in got.collect()}
    assert rows == {1: ("long x", "x"), 2: ("y", "y"), 3: (None, None)}
    assert standardise.map_values(df, "v", {}, "raw").count() == 3
    table = spark.createDataFrame([("x", "long x"), ("z", "w")], "a string, b string")
    same = standardise.map_values(df, "v", table, "raw")
    assert same.columns == got.columns and sorted(same.collect()) == sorted(got.collect())


def test_dimension_is_broadcast_only_below_the_threshold(spark, plan, histories):
    people = spark.range(10).select(F.col("id").cast("int").alias("key"))
    df = histories({1: "AB", 77: "A"})
    small = with_dimension(df, people, "key")
    assert small.count() == 2
    assert "BroadcastHashJoin" in plan(small, "simple")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        assert "SortMergeJoin" in plan(with_dimension(df, people, "key"), "simple")
    finally:
        spark.conf.set(threshold, before)


def test_repartition_and_coalesce_shape_the_plan(histories, plan):
    df = histories({1: "ABAB"}).repartition(4, "key")
    assert "hashpartitioning(key" in plan(df, "simple")
    assert "Coalesce 2" in plan(df.coalesce(2), "simple")


@pytest.mark.parametrize("count", [1, 2, 62, 63, 5000])
def test_sets_of_any_number_of_items(spark, plan, count):
    """Key 0 has them all, 1 lacks one, 2 has one more, 3 a null besides, 4 all of them twice."""
    items = [f"i{n:05}" for n in range(count)]
    n = spark.range(count).select(F.format_string("i%05d", "id").alias("item"), "id")
    all_ = lambda key: n.select(F.lit(key).alias("key"), "item")
    extra = spark.createDataFrame([(2, "other"), (3, None), (1, "i00000" if count > 1 else "x")], "key int, item string")
    df = all_(0).union(n.filter("id > 0 and id < %d" % (count - 1)).select(F.lit(1), "item"))
    for part in (all_(2), all_(3), all_(4), all_(4), extra):
        df = df.union(part)
    found = sets.exactly(df, ["key"], "item", [*items, items[0]])
    rows = found.collect()
    assert sorted(r["key"] for r in rows) == [0, 4]
    assert all(r["items"] == items for r in rows)
    # the items are listed once, and no column stands for each
    assert len(plan(found.select("key"), "simple")) < 60 * count + 60_000
