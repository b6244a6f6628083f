"""Histories too long for one task, cut into chunks that follow their order.

A window needs all rows of a key in one task. That is right for ordinary keys and wrong
for a key that holds a large share of the table. ``split`` marks the rows of such hot keys
with a CHUNK number that rises with the order, so (keys, CHUNK) is a group of bounded size
and the chunks of a key follow one another. Chunks are groups of the one shuffle that a
window needs anyway, not partitions: any number of them is dealt to the session's usual
number of tasks, and nothing is written but the places of the cuts. Chunks are a matter of
execution: what operators return never depends on where they end, nor on which keys are hot.

A key is hot above ``chunk_rows`` rows, or above one row in MAX_HOT of a table so large
that this is more. So there are at most MAX_HOT hot keys and some 2 * MAX_HOT chunks
whatever the size of the table, and the table of cuts is broadcast with that bound. Both
come from one sample of SAMPLE rows a limit, two million rows at most, without a second
pass and without the driver: a key is hot if its share of the sample says so, and its cuts
are every so many sampled rows in order. Any type that can be ordered will do and all
order columns count; only rows equal in all of them cannot be told apart.

``running`` carries sums along whole histories: within a chunk by a window, from chunk to
chunk by prefix sums over one row a chunk. Positions are running counts.

Finding hot keys runs short jobs when the operator is built. So pass a table, or a light
projection of one, rather than an expensive plan, and where several operators share a
table, split it once and pass the Split to each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from purchaseflow.sources.layout import place_in
from purchaseflow.sources.scratch import staged

CHUNK = "__chunk"
CHUNK_ROWS = 1_000_000
MAX_HOT = 10_000  # hot keys at most
SAMPLE = 200  # rows sampled, on average, of a key at the limit
FILL = 0.75  # of the limit that a chunk holds on average
_CUTS = "__cuts"


@dataclass(frozen=True)
class Split:
    """A table whose rows of hot keys carry the number of their chunk.

    ``rows`` has CHUNK, null in rows of ordinary keys, if ``cut``; else no key is hot and
    there is no such column.
    """

    rows: DataFrame
    cut: bool = False

    @property
    def ordinary(self) -> DataFrame:
        """Rows of keys that fit one task, as they were."""
        return self.rows.filter(F.col(CHUNK).isNull()).drop(CHUNK) if self.cut else self.rows

    @property
    def hot(self) -> DataFrame | None:
        """Rows of the other keys with CHUNK, or None if there are none."""
        return self.rows.filter(F.col(CHUNK).isNotNull()) if self.cut else None

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c != CHUNK]

    def select(self, *columns) -> Split:
        """The rows with these columns, which must include the keys and the order."""
        return Split(self.rows.select(*columns, *[CHUNK] * self.cut), self.cut)


def split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk_rows: int | None = CHUNK_ROWS,
    base: str | None = None,
) -> Split:
    """``df`` with its hot keys in chunks; ``base`` is a shared folder (see scratch_dir)."""
    keys, order = list(keys), list(order)
    df.sort(*keys, *order)  # only analysed: what has no order fails here at every size
    if chunk_rows is None:
        return Split(df)
    rows = df.count()
    limit = max(chunk_rows, rows // MAX_HOT)
    if rows <= limit:
        return Split(df)
    cuts = staged(_cuts(df, keys, order, limit), "cuts", base)
    most = cuts.agg(F.max(F.size(_CUTS))).first()[0]
    if most is None:
        return Split(df)
    marked = match(df, F.broadcast(cuts), keys, "left")
    chunk = F.when(F.col(_CUTS).isNotNull(), place_in(F.col(_CUTS), F.struct(*order), most))
    return Split(marked.withColumn(CHUNK, chunk.cast("long")).drop(_CUTS), True)


def _cuts(df: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """Hot keys, and the sorted places (structs of the order) where their chunks begin.

    A key at the limit has some SAMPLE rows in the sample, so it may be taken for hot or
    not by a twelfth of its size; above that it is hot for certain.
    """
    rate = min(1.0, SAMPLE / limit)
    seen = df.select(*dict.fromkeys([*keys, *order]))
    seen = seen.sample(rate, seed=1) if rate < 1 else seen
    step = max(1, int(rate * limit * FILL))
    own = Window.partitionBy(*keys)
    numbered = seen.withColumns(
        {
            "__seen": F.count(F.lit(1)).over(own),
            "__nth": F.row_number().over(own.orderBy(*order)) - 1,
        }
    )
    chosen = numbered.filter(
        (F.col("__seen") > rate * limit) & (F.col("__nth") > 0) & (F.col("__nth") % step == 0)
    )
    places = F.sort_array(F.array_distinct(F.collect_list(F.struct(*order))))
    return chosen.groupBy(*keys).agg(places.alias(_CUTS))


def match(df: DataFrame, other: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Joins ``df`` to ``other`` on equal keys, null being a key of its own."""
    names = {k: f"__on_{i}" for i, k in enumerate(on)}
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    )
    return df.join(other.withColumnsRenamed(names), same, how).drop(*names.values())


def running(
    df: DataFrame | Split,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    chunk_rows: int | None = CHUNK_ROWS,
    opening: Column | None = None,
    following: Column | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Adds, for each ``new name -> value``, the sum of it over the key's rows up to this one.

    Returns ordinary rows, and hot rows (with CHUNK) or None. With ``opening`` the
    column ``__opening`` has that value of the key's first row, with ``following`` the
    column ``__following`` that of the very next row (never null but at the end, so give
    a struct). ``order`` must break ties. Rows move once; what joins them is a row for each chunk, which is broadcast
    within the bound that ``split`` keeps.
    """
    keys, order = list(keys), list(order)
    parts = df if isinstance(df, Split) else split(df, keys, order, chunk_rows)

    def along(frame: DataFrame, by: list[str], suffix: str = "") -> DataFrame:
        own = Window.partitionBy(*by).orderBy(*order)
        upto = own.rowsBetween(Window.unboundedPreceding, 0)
        found = {name + suffix: F.sum(value).over(upto) for name, value in sums.items()}
        if opening is not None and not suffix:
            found["__opening"] = F.first(opening).over(own)
        if following is not None:
            found["__following" + suffix] = F.lead(following).over(own)
        return frame.withColumns(found)

    ordinary = along(parts.ordinary, keys)
    if not parts.cut:
        return ordinary, None
    head = {} if opening is None else {"__opening": F.min_by(opening, F.struct(*order))}
    lent = {} if following is None else {"__following": F.min_by(following, F.struct(*order))}
    totals = {name: F.sum(value) for name, value in sums.items()} | head | lent
    chunks = parts.hot.groupBy(*keys, CHUNK).agg(*[v.alias(n) for n, v in totals.items()])
    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(
        *keys,
        CHUNK,
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}__before") for n in sums],
        *[F.first(n).over(by_chunk).alias(n) for n in head],
        *[F.lead(n).over(by_chunk).alias(f"{n}__before") for n in lent],
    )
    inside = along(parts.hot, [*keys, CHUNK], "__inside")
    hot = match(inside, F.broadcast(offsets), [*keys, CHUNK], "inner")
    whole = {n: F.col(f"{n}__before") + F.col(f"{n}__inside") for n in sums}
    whole |= {n: F.coalesce(f"{n}__inside", f"{n}__before") for n in lent}
    parts_of = [f"{n}__{part}" for n in whole for part in ("before", "inside")]
    return ordinary, hot.withColumns(whole).drop(*parts_of)
