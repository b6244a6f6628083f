"""The conversation trie and tree contraction against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from purchaseflow.llm import conversation_trie as ct

SHAPE = "conv_id long, turn long, role string, text string, place int, id int, depth long"


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole = own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []

    def total(node):
        leaves = int(not children[node])
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for child in children[node]:
            a, b = total(child)
            leaves, saved = leaves + a, saved + b
        listed = ",".join(map(str, sorted(ends[node])))
        out.append(
            (
                min(members[node]),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(members[node]),
                len(children[node]),
                leaves,
                saved,
                hashlib.sha256(listed.encode()).hexdigest(),
            )
        )
        return leaves, saved

    if members:
        total(())
    return sorted(out, key=repr)


def built(df, **limits):
    chunk = limits.get("chunk_rows", ct.CHUNK_ROWS)
    turns, ids = ct.with_shared_openings(ct.staged(ct.numbered(df, chunk_rows=chunk), "turns"))
    return sorted((tuple(r) for r in ct.trie(turns, ids, **limits).collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SHAPE)


def conversations(rng):
    rows = []
    for c in [*range(-3, 40), *range(95, 130), 200, 205, 1000]:
        said = [(rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "😀 c"]))
                for _ in range(rng.randrange(1, 9))]
        rows += [(c, t if t else None, *s) for t, s in enumerate(said)]
    rows += [(201, t, "user", "same") for t in range(150)]  # a long one of equal turns
    rows += [(None, 1, "user", "lost"), (300, 7, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"chunk_rows": 20, "listed": 4}])
def test_trie_is_what_brute_force_finds(spark, limits):
    rows = conversations(random.Random(4))
    assert built(table(spark, rows), **limits) == brute(rows)


def test_empty_and_turnless(spark):
    assert built(table(spark, [])) == []
    assert built(table(spark, [(None, 1, "a", "b")])) == []
    # conversation 3 has h = 1 and no conversation 0 to take its first turn from
    assert zlib.crc32(b"3") % 6 == 1
    rows = [(3, 0, "user", "x")]
    assert built(table(spark, rows)) == brute(rows)
    assert brute(rows)[0][:7] == (3, 0, None, 1, 0, 1, 0)


def test_ties_and_repeated_rows_have_one_result(spark):
    rows = [(7, 1, "user", t) for t in ("b", "a", "a", "c")] + [(8, 1, "user", t) for t in ("c", "a", "b", "a")]
    once = built(table(spark, rows))
    assert built(table(spark, rows[::-1])) == once
    assert max(r[1] for r in once) == 4


@pytest.mark.parametrize("kind", ["chain", "star", "caterpillar", "forest"])
def test_contraction_sums_every_subtree(spark, kind):
    rng, n = random.Random(kind), 40
    above = {
        "chain": lambda i: i - 1,
        "star": lambda i: 0,
        "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2),
        "forest": lambda i: rng.randrange(i) if i % 10 else None,
    }[kind]
    parent = {0: None} | {i: above(i) for i in range(1, n)}
    value = {i: (rng.randrange(50), 1) for i in parent}
    expected = {i: list(v) for i, v in value.items()}
    for i in range(n - 1, 0, -1):
        if parent[i] is not None:
            expected[parent[i]] = [a + b for a, b in zip(expected[parent[i]], expected[i], strict=True)]
    rows = [(i, p, *value[i]) for i, p in parent.items()]
    nodes = spark.createDataFrame(rows, "id long, parent long, v long, w long")
    got = {r["id"]: [r["v"], r["w"]] for r in ct.subtree_totals(nodes, ["v", "w"]).collect()}
    assert got == expected


def test_chains_take_few_rounds(spark, monkeypatch):
    made = []
    real = ct.staged
    monkeypatch.setattr(ct, "staged", lambda df, purpose, *a: made.append(purpose) or real(df, purpose, *a))
    nodes = spark.range(100).select(
        "id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit(1).cast("long").alias("v")
    )
    assert ct.subtree_totals(nodes, ["v"]).agg(F.sum("v")).first()[0] == 100 * 101 // 2
    # raking alone would take a hundred
    assert made.count("rake") < 25


def test_no_plan_grows_with_the_rounds(spark, monkeypatch, plan):
    scans = []
    real = ct.staged

    def noting(df, purpose, *a):
        scans.append(plan(df, "simple").count("FileScan parquet"))
        return real(df, purpose, *a)

    monkeypatch.setattr(ct, "staged", noting)
    nodes = spark.range(60).select(
        "id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit(1).cast("long").alias("v")
    )
    totals = ct.subtree_totals(nodes, ["v"])
    scans.append(plan(totals, "simple").count("FileScan parquet"))
    assert {r["id"]: r["v"] for r in totals.collect()} == {i: 60 - i for i in range(60)}
    # one table a round, and a few to expand them all
    assert len(scans) < 25 and max(scans) < 7


def test_digest_of_many_ends_streams_in_chunks(spark):
    ends = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7 + 1).alias("id"),
        (F.col("id") * 7919 % 3001 - 50).alias("conv"),
    )
    expected = defaultdict(list)
    for r in ends.collect():
        expected[r["id"]].append(r["conv"])
    got = {r["id"]: r["sha"] for r in ct.ends_digest(ends, 100).collect()}
    assert got == {
        i: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for i, v in expected.items()
    }
