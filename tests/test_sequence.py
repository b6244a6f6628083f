from __future__ import annotations

import datetime as dt

import pytest

from purchaseflow.operators import sequence

KEY, ORDER = ["key"], ["d", "id"]


def follow(df, first="A", then="B", **kw):
    return sequence.followed_by(df, KEY, ORDER, "item", first, then, **kw)


def test_same_day_ties_follow_the_id(spark):
    day = dt.date(2024, 1, 1)
    rows = [(2, 1, "B", day), (1, 1, "A", day)]
    df = spark.createDataFrame(rows, "id int, key int, item string, d date")
    (row,) = follow(df).collect()
    assert (row.first_id, row.then_id, row.days_between) == (1, 2, 0)


@pytest.mark.parametrize(
    "items, expected",
    [("ABAB", 2), ("ACB", 0), ("AAB", 1), ("BA", 0), ("A", 0), ("AB", 1)],
)
def test_one_row_per_immediate_sequence(histories, items, expected):
    assert follow(histories({1: items})).count() == expected


def test_the_anchor_is_the_last_of_repeated_firsts(histories):
    (row,) = follow(histories({1: "AAB"})).collect()
    assert (row.first_id, row.then_id, row.days_between) == (2, 3, 1)


def test_sequences_do_not_cross_keys(histories):
    assert follow(histories({1: "A", 2: "B"})).count() == 0


def test_null_items_interrupt(histories):
    assert follow(histories({1: ["A", None, "B"]})).count() == 0


def test_with_next_keeps_every_row_and_column(histories):
    df = sequence.with_next(histories({1: "ABC", 2: "A"}), KEY, ORDER, {"after": "item"})
    got = {(r.key, r.item): r.after for r in df.collect()}
    assert got == {(1, "A"): "B", (1, "B"): "C", (1, "C"): None, (2, "A"): None}
    assert df.columns == ["id", "key", "item", "d", "after"]


def test_mean_gap(histories):
    found = follow(histories({1: "AB", 2: "CAB"}))
    assert sequence.mean_gap(found).first().asDict() == {"mean_gap": 1.0, "sequences": 2}


def test_mean_gap_of_nothing(histories):
    found = follow(histories({1: "C"}))
    assert sequence.mean_gap(found).first().asDict() == {"mean_gap": None, "sequences": 0}


def test_one_window_and_one_exchange_for_ordinary_tables(histories, plan):
    text = plan(follow(histories({1: "ABAB"})), "simple")
    assert text.count("Window [") == 1
    assert text.count("Exchange hashpartitioning") == 1
