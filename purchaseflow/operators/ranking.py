"""Counts, totals and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F
from pyspark.sql.types import AtomicType

from purchaseflow.sources.scratch import staged

GATHER = 1_000  # values that a single task may take from each other one
POINTS = 500  # sampled rows, on average, before the k-th
_PLACE_BITS = 33  # of monotonically_increasing_id: the place of a row in its partition


def counts(df: DataFrame, item: str, name: str = "units") -> DataFrame:
    """Rows per item."""
    return df.groupBy(item).agg(F.count(F.lit(1)).alias(name))


def totals(
    fact: DataFrame,
    dimension: DataFrame,
    on: str,
    group: Sequence[str],
    counted: str,
    price: str,
    units_name: str = "units",
    revenue_name: str = "revenue",
) -> DataFrame:
    """Units (``counted`` not null) and revenue (``price`` once per fact row) per group.

    ``group`` and ``price`` are dimension columns. Fact rows without a dimension row
    drop out. The fact is counted per join key first, so the join sees one row per
    key instead of every sale, and a key with a third of all sales is one counter.
    """
    per_key = fact.groupBy(on).agg(
        F.count(F.lit(1)).alias("__sales"), F.count(counted).alias("__units")
    )
    return (
        per_key.join(dimension, on, "inner")
        .groupBy(*group)
        .agg(
            F.sum("__units").alias(units_name),
            F.round(F.sum(F.col("__sales") * F.col(price)), 2).alias(revenue_name),
        )
    )


def top_k(df: DataFrame, order: Sequence[str], k: int, rank: str = "rank") -> DataFrame:
    """Rows of the first ``k`` dense ranks by ``order``; full ties share a rank and all stay.

    Names with a leading minus are descending; nulls come first ascending and last
    descending. Different order values are numbered and rows find their rank by a join on
    them, so a mass of ties collects no rows of ``df`` in one task. Up to GATHER values
    are brought together by Spark's own top-k, which sends that many from each task. More
    are selected by ranges instead (``_selected``), so that no task gets more than its
    range of them; this runs short jobs when the operator is built.
    """
    names = [name.removeprefix("-") for name in order]
    sorting = [F.desc(n) if o.startswith("-") else F.asc(n) for n, o in zip(names, order)]
    if k <= GATHER:
        best = df.select(*names).distinct().orderBy(*sorting).limit(k)
        numbered = best.withColumn(rank, F.row_number().over(Window.orderBy(*sorting)))
    else:
        numbered = _selected(df.select(*names), order, sorting, k, rank)
    joined = {name: f"__by_{i}" for i, name in enumerate(names)}
    numbered = numbered.withColumnsRenamed(joined)
    same = reduce(
        lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(j)) for n, j in joined.items()]
    )
    return df.join(numbered, same).drop(*joined.values())


def _selected(
    values: DataFrame, order: Sequence[str], sorting: list[Column], k: int, rank: str
) -> DataFrame:
    """The first ``k`` different rows of ``values``, numbered in ``rank``.

    A sample gives a value that is probably a little beyond the k-th; if an exact count
    finds at least ``k`` different ones up to it, the rest is left out where it is read,
    else the next try goes further. What remains is dealt out and sorted by ranges and
    written; a row's number is its place in its range plus the rows of the ranges before.
    """
    upto = _bound(values, order, sorting, k)
    near = (values if upto is None else values.filter(upto)).distinct()
    ranged = near.repartitionByRange(*sorting).sortWithinPartitions(*sorting)
    placed = staged(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftrightunsigned("__at", _PLACE_BITS).alias("__part")
    # one row for each task of the sort
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("__rows"))
    before = parts.select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__n"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    place = F.col("__n") + inside + 1
    found = placed.withColumn("__part", part).join(F.broadcast(before), "__part")
    return found.filter(place <= k).withColumn(rank, place.cast("int")).drop("__at", "__part", "__n")


def _bound(
    values: DataFrame, order: Sequence[str], sorting: list[Column], k: int
) -> Column | None:
    """A condition that at least ``k`` different ``values`` meet, and not many more.

    None where all of them may be needed or a type has no literal.
    """
    rate = min(1.0, POINTS / k)
    names = values.columns
    if not all(isinstance(values.schema[n].dataType, AtomicType) for n in names):
        return None
    wanted = int(k * rate * 1.25) + 1
    for _ in range(3):
        first = values.sample(rate, seed=1).orderBy(*sorting).limit(wanted).collect()
        if len(first) < wanted:
            return None
        upto = _not_after(values, order, first[-1])
        if values.filter(upto).distinct().count() >= k:
            return upto
        wanted *= 4
    return None


def _not_after(values: DataFrame, order: Sequence[str], last: Row) -> Column:
    """Whether a row of ``values`` comes before ``last`` by ``order``, or with it."""
    found = F.lit(True)
    for name in reversed(order):
        own = name.removeprefix("-")
        col = F.col(own)
        bound = F.lit(last[own]).cast(values.schema[own].dataType)
        if name.startswith("-"):  # nulls are last
            before = col.isNotNull() if last[own] is None else F.coalesce(col > bound, F.lit(False))
        else:  # nulls are first
            before = F.lit(False) if last[own] is None else col.isNull() | (col < bound)
        found = before | (col.eqNullSafe(bound) & found)
    return found
