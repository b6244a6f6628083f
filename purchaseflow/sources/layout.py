"""Row order that lets readers skip: ranges of one column, or a Z-order of several.

A reader leaves out the row groups whose lowest and highest values rule a filter out. That
helps only where neighbouring rows have neighbouring values. One column is dealt by
ranges and sorted. Several are turned into numbers of some bits, each by the quantiles of
a bounded sample, and these are interleaved, so every one of them has few values in a row
group. Equality on a column that is in no order is what Parquet's Bloom filters are for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 50_000  # rows from which quantiles are taken
BITS = 8  # of a column in a Z-order


def clustered(df: DataFrame, columns: Sequence[str], num_files: int | None = None) -> DataFrame:
    """``df`` in the row order of ``columns``, for writing; nulls come first."""
    names = list(dict.fromkeys(columns))
    if len(names) * BITS > 62:
        raise ValueError(f"a Z-order takes {62 // BITS} columns at most, not {len(names)}")
    order = [F.col(names[0])] if len(names) == 1 else [_z_value(df, names).alias("__z")]
    if len(names) > 1:
        df, order = df.withColumn("__z", order[0]), [F.col("__z")]
    dealt = df.repartitionByRange(*([num_files] if num_files else []), *order)
    # within a file equal numbers are sorted out further, which narrows the row groups
    return dealt.sortWithinPartitions(*order, *names).drop("__z")


def place_in(cuts: Column, value: Column, most: int) -> Column:
    """How many of the sorted ``cuts``, ``most`` at most, are not above ``value``."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(most.bit_length()))])

    def on(low: Column, step: Column) -> Column:
        far = low + step
        return F.when((far <= F.size(cuts)) & (F.get(cuts, far - 1) <= value), far).otherwise(low)

    return F.aggregate(steps, F.lit(0), on)


def _z_value(df: DataFrame, names: list[str]) -> Column:
    """The interleaved bits of the columns' quantile numbers."""
    rows = df.count()
    sample = df.select(*names)
    sample = sample.sample(min(1.0, SAMPLE / rows), seed=1) if rows > SAMPLE else sample
    cuts = sample.agg(*[_quantiles(name).alias(name) for name in names]).first()
    total = F.lit(0).cast("long")
    for place, name in enumerate(names):
        listed = cuts[name]  # some hundred values
        array = F.array(*[F.lit(c).cast(df.schema[name].dataType) for c in listed])
        number = place_in(array, F.col(name), len(listed)) if listed else F.lit(0)
        number = F.when(F.col(name).isNull(), 0).otherwise(number)
        total = total.bitwiseOR(_spread(number, place, len(names)))
    return total


def _quantiles(name: str) -> Column:
    """Aggregate: different values that cut the sorted ones into 1 << BITS parts."""
    parts, values = 1 << BITS, F.sort_array(F.collect_list(name))  # nulls are left out

    def nth(i: Column) -> Column:
        return F.get(values, F.floor(i * F.size(values) / parts).cast("int"))

    cuts = F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), nth)
    return F.filter(F.array_distinct(cuts), lambda x: x.isNotNull())


def _spread(number: Column, place: int, columns: int) -> Column:
    """The bits of ``number``, ``columns`` places apart, from bit ``place`` on."""

    def spread(bits: Column) -> Column:
        found = F.lit(0).cast("long")
        for bit in range(BITS):
            one = F.shiftright(bits, bit).bitwiseAND(F.lit(1)).cast("long")
            found = found.bitwiseOR(F.shiftleft(one, bit * columns + place))
        return found

    # the array makes the number once
    return F.get(F.transform(F.array(number), spread), F.lit(0))
