"""Similarity join on word n-grams: MinHash with Bayesian candidate pruning.

Two texts are linked if the Jaccard similarity of their sets of WIDTH-word runs (lower
case, words between white space; a shorter text is one run) is THRESHOLD or more.

1. One pass over the texts gives each its set's 128-bit key, MinHash bands and a separate
   MinHash signature. Texts with equal sets become one class, so copies cost nothing more.
2. Classes that share a band meet in a bucket. There pairs are compared STEP signature
   values at a time; a pair goes once the posterior probability that its similarity
   reaches THRESHOLD (uniform prior, so a Beta posterior) falls below TOLERANCE. A bucket
   gives away a spanning forest of the pairs that survive, never the pairs themselves.
3. Within each connected component of survivors all pairs are compared in the same way,
   the remaining ones verified on the exact sets, and counted.

Buckets and components above BLOCK and VERIFY members are split into blocks, and every
pair of blocks is a task of its own, so a group of any size is spread over the cluster
and no task holds more than two blocks. Work grows with the square of the number of
*different* near copies only, as counting their links must; rows do not.

A pair at similarity s shares none of the bands with probability (1 - s^5)^25, 5e-5 at
0.8 and 2e-8 at 0.88, and is pruned wrongly with probability of about TOLERANCE; within a
component neither the bands nor, for the verified pairs, chance plays a part.

Defined results: null and empty texts and texts of white space have no run, are linked to
nothing and are classes of their own; rows equal in doc_id and text are one document read
twice, each counts as a copy; the class id is the lowest doc_id of the connected component
(null if none has one).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from purchaseflow.llm.components import components
from purchaseflow.llm.hashing import mixed, shingles
from purchaseflow.sources.scratch import staged

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
SIGNATURE, STEP = 64, 16
TOLERANCE = 1e-4
BLOCK = 4096  # classes of a bucket compared in one task
VERIFY = 256  # texts of a component verified in one task


# --- sketches ---------------------------------------------------------------------


class Sketcher:
    """Key, bands and signature of a set of hashes."""

    def __init__(self):
        rng = np.random.default_rng(20240229)
        count = BANDS * ROWS + SIGNATURE
        self._times = rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
        self._plus = rng.integers(0, 1 << 32, count, dtype=np.uint32)
        self._band = rng.integers(0, 1 << 64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)

    def minima(self, values: np.ndarray) -> np.ndarray:
        low = values.astype(np.uint32)[:, None]
        found = np.full(self._times.size, 0xFFFFFFFF, dtype=np.uint32)
        for start in range(0, len(low), 256):
            hashed = low[start : start + 256] * self._times + self._plus
            np.minimum(found, hashed.min(axis=0), out=found)
        return found

    def __call__(self, values: np.ndarray) -> tuple[int, int, np.ndarray, bytes]:
        low = self.minima(values)
        rows = low[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
        bands = mixed((rows * self._band).sum(axis=1, dtype=np.uint64) + np.arange(BANDS).astype(np.uint64))
        signature = (low[BANDS * ROWS :] * np.uint32(0x9E3779B1)) >> np.uint32(16)
        sizes = np.uint64(len(values))
        keys = (mixed(values).sum(dtype=np.uint64) + sizes, mixed(~values).sum(dtype=np.uint64))
        a, b = np.array(keys, dtype=np.uint64).view(np.int64).tolist()
        return a, b, bands.view(np.int64), signature.astype("<u2").tobytes()


def _rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, a key without nulls (``kd``, ``kh``) and the text."""
    ident, whole = F.col(doc_id), F.coalesce(F.col(text), F.lit(""))
    return df.select(
        ident.alias("doc_id"),
        F.coalesce(ident, F.lit(0)).alias("kd"),
        F.xxhash64(whole, ident.isNull()).alias("kh"),
        whole.alias("text"),
    )


def sketches(rows: DataFrame) -> DataFrame:
    """doc_id, kd, kh and, for texts with a run, a, b (the set's key), bands, signature."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher()
        for batch in batches:
            found = []
            for start in range(0, batch.num_rows, 256):
                for text in batch.column("text").slice(start, 256).to_pylist():
                    runs = shingles(text, WIDTH)
                    found.append(sketch(runs) if runs.size else (None, None, None, None))
            a, b, bands, signature = zip(*found, strict=True) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(signature, pa.binary()),
                ],
                names=["doc_id", "kd", "kh", "a", "b", "bands", "signature"],
            )

    schema = T.StructType(
        [
            *[rows.schema[c] for c in ("doc_id", "kd", "kh")],
            T.StructField("a", T.LongType()),
            T.StructField("b", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("signature", T.BinaryType()),
        ]
    )
    return rows.select("doc_id", "kd", "kh", "text").mapInArrow(sketched, schema)


# --- comparing pairs inside a task --------------------------------------------------


def fewest_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """After each STEP values: how many must match for a pair to stay.

    With a uniform prior, P(similarity >= t | m of n match) is the probability that a
    binomial of n + 1 trials at t gives at most m.
    """
    found = []
    for n in range(STEP, SIGNATURE + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found.append(m)
    return found


_FEWEST = fewest_matches()


def surviving(signatures: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) of rows are still possible after all values."""
    alive, matches = np.arange(i.size), np.zeros(i.size, dtype=np.int32)
    for step, fewest in enumerate(_FEWEST):
        part = signatures[:, step * STEP : (step + 1) * STEP]
        matches += (part[i[alive]] == part[j[alive]]).sum(axis=1, dtype=np.int32)
        stay = matches >= fewest
        alive, matches = alive[stay], matches[stay]
    return alive


class Forest:
    """Union-find over the rows of a group."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(self.parent.size)])


def candidate_forest(signatures: np.ndarray, pairs: int = 1 << 19) -> np.ndarray:
    """Roots of the components that surviving pairs make of the rows.

    First each row that is in no component yet is compared with all others; then only
    pairs between different components are left to compare.
    """
    size = len(signatures)
    forest, everyone, free = Forest(size), np.arange(size), np.ones(size, dtype=bool)
    for x in range(size):
        if not free[x]:
            continue
        near = everyone[surviving(signatures, np.full(size, x), everyone)]
        forest.join(np.full(near.size, x), near)
        free[near] = False
    roots = forest.roots()
    group = {r: np.flatnonzero(roots == r) for r in np.unique(roots).tolist()}
    starts = list(group)
    if len(starts) == size:  # nothing joined: all pairs were compared
        return roots
    for n, r in enumerate(starts):
        rest = np.concatenate([group[s] for s in starts[n + 1 :]] or [everyone[:0]])
        own = group[r]
        if own.size == 1:  # was compared with everyone
            continue
        for start in range(0, rest.size, max(1, pairs // own.size)):
            part = rest[start : start + max(1, pairs // own.size)]
            i, j = np.repeat(own, part.size), np.tile(part, own.size)
            alive = surviving(signatures, i, j)
            forest.join(i[alive], j[alive])
    return forest.roots()


def linked_pairs(
    signatures: np.ndarray, sets: Callable[[int], np.ndarray], i: np.ndarray, j: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) whose sets have the similarity, pruned first and then exact."""
    alive = surviving(signatures, i, j)
    i, j = i[alive], j[alive]
    used = np.unique(np.concatenate([i, j]))
    held = {x: sets(x) for x in used.tolist()}
    size = np.zeros(len(signatures), dtype=np.int64)
    size[used] = [held[x].size for x in used.tolist()]
    if i.size <= 48:
        common = np.array(
            [
                np.intersect1d(held[x], held[y], assume_unique=True).size
                for x, y in zip(i.tolist(), j.tolist(), strict=True)
            ],
            dtype=np.int64,
        )
    else:
        common = _common(held, used)[np.searchsorted(used, i), np.searchsorted(used, j)]
    linked = common + 1e-9 >= THRESHOLD * (size[i] + size[j] - common)
    return i[linked], j[linked]


def _common(held: dict[int, np.ndarray], used: np.ndarray, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all used sets, ``width`` elements at a time."""
    every = np.concatenate([held[x] for x in used.tolist()])
    owner = np.repeat(np.arange(used.size), [held[x].size for x in used.tolist()])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    element = np.cumsum(np.concatenate([[0], every[1:] != every[:-1]]))
    found = np.zeros((used.size, used.size), dtype=np.float64)
    for low in range(0, int(element[-1]) + 1, width):
        a, b = np.searchsorted(element, [low, low + width])
        part = np.zeros((used.size, width), dtype=np.float32)
        part[owner[a:b], element[a:b] - low] = 1
        found += part @ part.T
    return np.rint(found).astype(np.int64)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each run of equal keys, in input sorted by them."""
    tail = None
    for batch in batches:
        columns = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            if name == "signature":
                flat = np.frombuffer(b"".join(column.to_pylist()), dtype="<u2")
                columns[name] = flat.reshape(-1, SIGNATURE)
            elif name == "text":
                columns[name] = np.array(column.to_pylist() + [None], dtype=object)[:-1]
            else:
                columns[name] = column.to_numpy(zero_copy_only=False)
        if tail is not None:
            columns = {n: np.concatenate([tail[n], c]) for n, c in columns.items()}
        size = len(columns[keys[0]])
        if not size:
            continue
        change = np.zeros(size, dtype=bool)
        for key in keys:
            change[1:] |= columns[key][1:] != columns[key][:-1]
        starts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield {n: c[a:b] for n, c in columns.items()}
        tail = {n: c[starts[-1] :] for n, c in columns.items()}
    if tail is not None:
        yield tail


def _dealt(df: DataFrame, group: list[str], block: int) -> DataFrame:
    """Rows of groups of ``n`` with ``own``, ``p`` and ``q``, once for each pair of blocks.

    They are dealt out and sorted by group, p and q.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("a", "b"), blocks).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(F.least(own, other).alias("p"), F.greatest(own, other).alias("q")),
    )
    spread = df.withColumn("own", own).select("*", F.inline(pairs)).drop("n")
    return spread.repartition(*group, "p", "q").sortWithinPartitions(*group, "p", "q")


# --- the join -----------------------------------------------------------------------


def _candidates(classes: DataFrame) -> DataFrame:
    """Edges (u, v) of a spanning forest of the surviving pairs; nodes are (a, b)."""
    banded = classes.select("a", "b", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    members = banded.join(buckets, "band").join(classes.select("a", "b", "signature"), ["a", "b"])

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []

        def out() -> pa.RecordBatch:
            parts = [np.concatenate(c) for c in zip(*found, strict=True)] or [[]] * 4
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in parts], names=["a", "b", "ra", "rb"]
            )

        for group in _groups(batches, ["band", "p", "q"]):
            if len(group["a"]) < 2:
                continue
            roots = candidate_forest(group["signature"])
            other = np.flatnonzero(roots != np.arange(roots.size))
            if other.size:
                top = roots[other]
                a, b = group["a"], group["b"]
                found.append((a[other], b[other], a[top], b[top]))
            if len(found) >= 1000:
                yield out()
        yield out()

    edges = _dealt(members, ["band"], BLOCK).mapInArrow(
        forests, "a long, b long, ra long, rb long"
    )
    return edges.distinct().select(
        F.struct("a", "b").alias("u"),
        F.struct(F.col("ra").alias("a"), F.col("rb").alias("b")).alias("v"),
    )


def _verified(members: DataFrame) -> DataFrame:
    """Per class with a link in its group: a, b, links, similar, and its root (ra, rb).

    ``members``: a, b, ra, rb (root of the candidates), n (its members), copies, signature,
    text.
    """

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["ra", "rb", "p", "q"]):
            own, p, q = group["own"], group["p"][0], group["q"][0]
            size = len(own)
            if p == q:
                i, j = np.triu_indices(size, 1)
            else:
                left, right = np.flatnonzero(own == p), np.flatnonzero(own == q)
                i, j = np.repeat(left, right.size), np.tile(right, left.size)
            texts = group["text"]
            i, j = linked_pairs(group["signature"], lambda x: shingles(texts[x], WIDTH), i, j)
            links = np.bincount(i, minlength=size) + np.bincount(j, minlength=size)
            copies = group["copies"]
            similar = np.bincount(i, copies[j], size) + np.bincount(j, copies[i], size)
            forest = Forest(size)
            forest.join(i, j)
            roots, any_ = forest.roots(), links > 0
            top = roots[any_]
            columns = [group["a"][any_], group["b"][any_], links[any_]]
            columns += [similar[any_].astype(np.int64), group["a"][top], group["b"][top]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["a", "b", "links", "similar", "ra", "rb"],
            )

    return _dealt(members, ["ra", "rb"], VERIFY).mapInArrow(
        verified, "a long, b long, links long, similar long, ra long, rb long"
    )


def similar(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, kd, kh, class_id, n_links, n_similar, representative.

    ``n_links`` counts the other sets of word runs it is linked to, ``n_similar`` the other
    documents, copies included; ``representative`` is true for the first document of each
    class, and for documents without words.
    """
    rows = _rows(df, doc_id, text)
    own = staged(sketches(rows), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "kd", "kh"))
    classes = staged(
        own.filter(F.col("a").isNotNull())
        .groupBy("a", "b")
        .agg(
            first.alias("first"),
            F.count(F.lit(1)).alias("copies"),
            F.first("bands").alias("bands"),
            F.first("signature").alias("signature"),
        ),
        "classes",
    )
    parts = components(_candidates(classes)).select(
        "node.a", "node.b", F.col("root.a").alias("ra"), F.col("root.b").alias("rb")
    )
    sizes = parts.groupBy("ra", "rb").agg(F.count(F.lit(1)).alias("n"))
    wanted = (
        parts.join(sizes, ["ra", "rb"])
        .join(classes.drop("bands"), ["a", "b"])
        .select("a", "b", "ra", "rb", "n", "copies", "signature", "first.kd", "first.kh")
    )
    texts = rows.select("kd", "kh", "text").join(wanted, ["kd", "kh"]).drop("kd", "kh")
    found = staged(_verified(texts.dropDuplicates(["a", "b"])), "links")
    node, root = F.struct("a", "b"), F.struct(F.col("ra").alias("a"), F.col("rb").alias("b"))
    joined = components(found.select(node.alias("u"), root.alias("v")))
    counts = found.groupBy("a", "b").agg(F.sum("links").alias("links"), F.sum("similar").alias("similar"))
    grouped = joined.select("node.a", "node.b", F.col("root").alias("root")).join(counts, ["a", "b"])
    labelled = classes.select("a", "b", "first", "copies").join(grouped, ["a", "b"], "left").select(
        "a", "b", "first", "copies", "links", "similar",
        F.coalesce("root", F.struct("a", "b")).alias("root"),
    )
    heads = labelled.groupBy("root").agg(F.min("first").alias("head"))
    final = labelled.join(heads, "root").select("a", "b", "copies", "links", "similar", "head")
    # copies of one text may be a third of all rows: a join that Spark splits when skewed
    return own.select("doc_id", "kd", "kh", "a", "b").join(final, ["a", "b"], "left").select(
        "doc_id",
        "kd",
        "kh",
        F.when(F.col("a").isNull(), F.col("doc_id"))
        .otherwise(F.col("head.doc_id"))
        .alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("similar", F.lit(0))).alias("n_similar"),
        (
            F.col("a").isNull()
            | ((F.col("kd") == F.col("head.kd")) & (F.col("kh") == F.col("head.kh")))
        ).alias("representative"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each class stays, and one of rows read twice."""
    staying = similar(docs).filter("representative").select("kd", "kh").distinct()
    ident, whole = F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns(
        {
            "__kd": F.coalesce(ident, F.lit(0)),
            "__kh": F.xxhash64(whole, ident.isNull()),
        }
    )
    renamed = staying.withColumnsRenamed({"kd": "__kd", "kh": "__kh"})
    return keyed.join(renamed, ["__kd", "__kh"], "left_semi").dropDuplicates(
        ["__kd", "__kh"]
    ).select(*docs.columns)
