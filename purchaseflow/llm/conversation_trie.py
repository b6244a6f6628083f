"""The trie of conversation prefixes, its subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that begin with it. A node's key is an additive hash: each turn is hashed
together with its place into two 64-bit numbers, and these are summed, modulo 2^32 in each
half, along the conversation. Sums are carried from chunk to chunk (``hot.running``), so a
conversation of any length is no single task's work, texts do not move beyond the scan,
and two prefixes meet in a key exactly if they are equal, up to 128-bit hash collisions.

``subtree_totals`` adds up values over all subtrees without walking the tree level by
level. Rounds alternate: *rake* adds every leaf to its parent and takes it away; *compress*
takes away nodes that have a single child, no two of them adjacent (those whose number, a
hash drawn anew each round, is above both neighbours'), and leaves their values on the
child's edge. A chain thus shrinks by a third of its length each round, and a tree of n
nodes and any depth is gone after O(log n) rounds. Then the compressed nodes are expanded
again: a node's total is its child's plus what its compression noted, and as the child may
have gone in a later round, such pointers are followed by doubling, in O(log log n) steps.
Joins find each key once at most; what many children give one parent is summed before it
moves. Each round is written once to the shared folder, and no plan spans several rounds.

Defined results: null role or text is empty; turns are ordered by number, null first, and
turns of equal number by their hash; equal rows are turns of their own; rows without
conv_id belong to no conversation; without conversations there is no node, not even the
root; a conversation without turns is a member of the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from purchaseflow.operators.hot import CHUNK, CHUNK_ROWS, running, split
from purchaseflow.sources.scratch import scratch_dir, staged

SHARED = 6  # shared openings are shorter than this
GROUP = 100  # conversations of one hundred share an opening
LISTED = 100_000  # ids that are joined into one text in a task
_HALF = 0xFFFFFFFF
_SUMS = ("__a", "__b", "__c", "__d")


def numbered(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """One row per turn: ``conv``, ``place`` from 1, ``x`` and ``y`` (hashes of the turn),
    ``chars`` of its text."""
    said = [F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))]
    slim = df.select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("__turn"),
        F.xxhash64(*said).alias("x"),
        F.xxhash64(F.lit(1), *said).alias("y"),
        F.length(said[1]).cast("long").alias("chars"),
    ).filter(F.col("conv").isNotNull())
    parts = split(slim, ["conv"], ["__turn"], chunk_rows)
    count = {"place": F.lit(1).cast("long")}
    ordinary, long = running(parts, ["conv"], ["__turn", "x", "y"], count)
    whole = ordinary if long is None else ordinary.unionByName(long.drop(CHUNK))
    return whole.drop("__turn")


def with_shared_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that the ones of a hundred share their first turns.

    Of conversation c the first h turns, h = crc32(c) mod SHARED, are those of
    conversation c - c mod GROUP, or as many as it has; its own turns after the h-th
    follow. Returns the turns, and ``conv`` for every conversation, turnless ones included.
    """
    ids = turns.select("conv").distinct()
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(SHARED))
    openings = (
        turns.filter((F.col("conv") % GROUP == 0) & (F.col("place") < SHARED))
        .select(F.col("conv").alias("__base"), F.struct("place", "x", "y", "chars").alias("t"))
        .groupBy("__base")
        .agg(F.sort_array(F.collect_list("t")).alias("__opening"))
    )
    base = (F.col("conv") - F.col("conv") % GROUP).alias("__base")
    first = F.slice(F.coalesce("__opening", F.array()), F.lit(1), F.col("__h").cast("int"))
    plans = (
        ids.select("conv", base, h.alias("__h"))
        .join(openings, "__base", "left")
        .select("conv", "__h", first.alias("__first"))
    )
    plans = staged(plans, "openings")
    lent = plans.select("conv", F.inline("__first"))
    shift = plans.select("conv", "__h", F.size("__first").cast("long").alias("__lent"))
    own = (
        turns.join(shift, "conv")
        .filter(F.col("place") > F.col("__h"))
        .withColumn("place", F.col("place") - F.col("__h") + F.col("__lent"))
    )
    return lent.unionByName(own.select(lent.columns)), ids


def _key(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Four sums, each modulo 2^32, as a pair of 64-bit numbers."""

    def joined(high: Column, low: Column) -> Column:
        wide = F.shiftleft(high.bitwiseAND(F.lit(_HALF)), 32)
        return wide.bitwiseOR(low.bitwiseAND(F.lit(_HALF)))

    return F.struct(joined(a, b).alias("k"), joined(c, d).alias("l"))


def prefixes(turns: DataFrame, chunk_rows: int | None = CHUNK_ROWS) -> DataFrame:
    """Per turn: ``conv``, ``depth``, the ``id`` of the prefix it ends, ``parent``, ``chars``."""
    x, y = F.xxhash64("place", "x"), F.xxhash64("place", "y")
    halves = (F.shiftrightunsigned(x, 32), x, F.shiftrightunsigned(y, 32), y)
    own = {f"{n}own": v.bitwiseAND(F.lit(_HALF)) for n, v in zip(_SUMS, halves, strict=True)}
    slim = turns.select("conv", "place", "chars", *[v.alias(n) for n, v in own.items()])
    sums = {n: F.col(f"{n}own") for n in _SUMS}
    ordinary, long = running(slim, ["conv"], ["place"], sums, chunk_rows)
    whole = ordinary if long is None else ordinary.unionByName(long.drop(CHUNK))
    before = [F.col(n) - F.col(f"{n}own") for n in _SUMS]
    return whole.select(
        "conv",
        F.col("place").alias("depth"),
        _key(*map(F.col, _SUMS)).alias("id"),
        _key(*before).alias("parent"),
        "chars",
    )


def subtree_totals(
    nodes: DataFrame, values: Sequence[str], rounds: int = 200, children: str | None = None
) -> DataFrame:
    """``id`` and the sums of ``values`` over each node's subtree, itself included.

    ``nodes`` has ``id`` (unique), ``parent`` (null for roots), long ``values`` and, if it
    is known, a column ``children`` with the number of nodes whose parent a node is.
    """
    values = list(values)
    spark = nodes.sparkSession
    zero = F.lit(0).cast("long")
    if children is None:
        kids = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id"))
        nodes = nodes.join(kids.agg(F.count(F.lit(1)).alias("__kids")), "id", "left")
    # __out: what a node's edge adds on the way to its parent; __below: the same of the one
    # child of a node that goes. The round's number is a column, as a literal in it would
    # have each round's code compiled anew
    folder = scratch_dir(spark, "contraction")
    live = nodes.select(
        "id",
        "parent",
        F.coalesce(children or "__kids", zero).cast("long").alias("__kids"),
        *values,
        *[zero.alias(f"__out_{v}") for v in values],
        *[zero.alias(f"__below_{v}") for v in values],
        F.lit(None).cast(nodes.schema["id"].dataType).alias("__only"),
        F.lit(False).alias("__gone"),
        zero.alias("__round"),
    )
    state = staged(live, "rake", folder)
    shape = state.schema
    for number in range(rounds):
        if state.filter(~F.col("__gone") & (F.col("__kids") > 0)).isEmpty():
            break
        handed = state.filter("__gone").select(
            F.col("__only").alias("id"),
            F.col("parent").alias("__parent"),
            *[(F.col(v) + F.col(f"__out_{v}")).alias(f"__add_{v}") for v in values],
        )
        live = (
            state.filter(~F.col("__gone"))
            .join(handed, "id", "left")
            .select(
                "id",
                F.coalesce("__parent", "parent").alias("parent"),
                "__kids",
                *values,
                *[(F.col(f"__out_{v}") + F.coalesce(f"__add_{v}", zero)).alias(f"__out_{v}") for v in values],
                "__round",
            )
        )
        # rake: leaves are final, and their parents take what they give
        leaf = F.col("__kids") == 0
        given = (
            live.filter(F.col("parent").isNotNull())
            .groupBy(F.col("parent").alias("id"))
            .agg(
                F.count_if(leaf).alias("__leaves"),
                F.min(F.when(~leaf, F.col("id"))).alias("__child"),
                *[F.sum(F.when(leaf, F.col(v) + F.col(f"__out_{v}"))).alias(f"__given_{v}") for v in values],
                *[F.sum(F.when(~leaf, F.col(f"__out_{v}"))).alias(f"__under_{v}") for v in values],
            )
        )
        # compress: nodes with one child whose number of this round is above both neighbours'
        turn = F.col("__round") + 1
        own, above, below = (F.xxhash64(turn, c) for c in ("id", "parent", "__child"))
        left = F.col("__kids") - F.coalesce("__leaves", zero)
        gone = (left == 1) & F.col("parent").isNotNull() & (own > above) & (own > below)
        raked = live.filter(~leaf).join(given, "id", "left")
        state = staged(
            raked.select(
                "id",
                "parent",
                left.alias("__kids"),
                *[(F.col(v) + F.coalesce(f"__given_{v}", zero)).alias(v) for v in values],
                *[f"__out_{v}" for v in values],
                *[F.when(gone, F.col(f"__under_{v}")).alias(f"__below_{v}") for v in values],
                F.when(gone, F.col("__child")).alias("__only"),
                F.coalesce(gone, F.lit(False)).alias("__gone"),
                turn.alias("__round"),
            ),
            "rake",
            folder,
        )
    else:
        raise RuntimeError(f"the tree is not contracted after {rounds} rounds")
    # all rounds are read as one table, so that no plan grows with their number
    every = spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(folder)
    known = every.filter(~F.col("__gone") & (F.col("__kids") == 0)).select("id", *values)
    # a compressed node's total is its child's and more; the child may have been compressed
    # in a later round, and so on: each step doubles how far such pointers reach
    noted = every.filter("__gone").select(
        "id",
        F.col("__only").alias("__child"),
        *[(F.col(v) + F.col(f"__below_{v}")).alias(f"__more_{v}") for v in values],
    )
    for _ in range(max(0, number - 1).bit_length()):
        noted = staged(noted, "expand")
        next_ = noted.select(
            F.col("id").alias("__child"),
            F.col("__child").alias("__next"),
            *[F.col(f"__more_{v}").alias(f"__then_{v}") for v in values],
        )
        noted = noted.join(next_, "__child", "left").select(
            "id",
            F.coalesce("__next", "__child").alias("__child"),
            *[(F.col(f"__more_{v}") + F.coalesce(f"__then_{v}", zero)).alias(f"__more_{v}") for v in values],
        )
    expanded = noted.join(known.withColumnRenamed("id", "__child"), "__child").select(
        "id", *[(F.col(v) + F.col(f"__more_{v}")).alias(v) for v in values]
    )
    return known.unionByName(expanded)


def ends_digest(ends: DataFrame, chunk_rows: int = LISTED) -> DataFrame:
    """Per ``id``: SHA-256 of its ``conv`` numbers, ascending, in decimal, comma-joined.

    The hash is sequential by definition. For a node at which very many conversations
    end, their numbers are sorted and joined in chunks by many tasks, and one task
    takes the chunks as a stream, one at a time.
    """

    def listed(frame: DataFrame, *by: str) -> DataFrame:
        numbers = F.sort_array(F.collect_list("conv"))
        return frame.groupBy("id", *by).agg(F.array_join(numbers.cast("array<string>"), ",").alias("part"))

    parts = split(ends, ["id"], ["conv"], chunk_rows)
    ordinary = listed(parts.ordinary).select("id", F.sha2("part", 256).alias("sha"))
    if not parts.cut:
        return ordinary

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()

        def out() -> pa.RecordBatch:
            ids = pa.array([now], schema[0])
            return pa.RecordBatch.from_arrays([ids, pa.array([state.hexdigest()])], ["id", "sha"])

        schema = [None]
        for batch in batches:
            schema[0] = batch.schema.field(0).type
            for i in range(batch.num_rows):
                node, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if node == now:
                    state.update(b",")
                else:
                    if now is not None:
                        yield out()
                    now, state = node, hashlib.sha256()
                state.update(text.encode())
        if now is not None:
            yield out()

    shape = T.StructType([ends.schema["id"], T.StructField("sha", T.StringType())])
    sorted_ = listed(parts.hot, CHUNK).repartition("id").sortWithinPartitions("id", CHUNK)
    return ordinary.unionByName(sorted_.select("id", "part").mapInArrow(hashed, shape))


def trie(
    turns: DataFrame, ids: DataFrame, chunk_rows: int | None = CHUNK_ROWS, listed: int = LISTED
) -> DataFrame:
    """One row per node of the trie of ``turns``, members being the conversations ``ids``.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (code points of its last text that a cache would save, summed over the
    subtree), ends_sha256 (of the members that end here).
    """
    rows = staged(prefixes(turns, chunk_rows), "prefixes")
    inner = rows.groupBy("id").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.first("chars").alias("chars"),
        F.min("conv").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
    )
    zero = F.lit(0).cast("long")
    nothing = F.struct(zero.alias("k"), zero.alias("l"))
    root = (
        ids.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
        .filter(F.col("n_convs") > 0)
        .select(
            nothing.alias("id"),
            F.lit(None).cast(rows.schema["parent"].dataType).alias("parent"),
            zero.alias("depth"),
            zero.alias("chars"),
            "conv_id",
            "n_convs",
        )
    )
    alone = staged(inner.unionByName(root), "nodes")
    kids = alone.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id"))
    children = kids.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(
        alone.join(children, "id", "left").withColumns(
            {
                "n_children": F.coalesce("n_children", zero),
                "n_leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
                "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
            }
        ),
        "nodes",
    )
    totals = subtree_totals(nodes, ["n_leaves", "saved_tokens"], children="n_children")
    last = rows.groupBy("conv").agg(F.max_by("id", "depth").alias("id"))
    ends = ids.join(last, "conv", "left").select(F.coalesce("id", nothing).alias("id"), "conv")
    digests = ends_digest(staged(ends, "ends"), listed)
    above = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.drop("n_leaves", "saved_tokens")
        .join(totals, "id")
        .join(digests, "id", "left")
        # children of one parent may be a third of all nodes: Spark splits this join
        .join(above, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
