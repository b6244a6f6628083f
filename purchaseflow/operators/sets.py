"""Keys by the complete set of their items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

MASKED = 62  # items that one number has bits for


def exactly(
    df: DataFrame, keys: Sequence[str], item: str, allowed: Sequence[str], name: str = "items"
) -> DataFrame:
    """Keys whose distinct items are exactly ``allowed``, order and repeats aside.

    A null item disqualifies its key. The set itself is never collected: up to MASKED
    items a key keeps one number with a bit for each of them and one for anything else,
    which combine before the shuffle, so a key of any length costs a few bytes per map
    task. For more items each different one of a key is a row of its own before the
    shuffle, and these are counted; a plan does not grow with their number.
    """
    wanted = sorted(set(allowed))
    if not wanted:
        raise ValueError("allowed must name at least one item")
    col = F.col(item)
    if len(wanted) <= MASKED:
        other = F.lit(1 << len(wanted)).cast("long")
        bit = F.lit(None)
        for i, w in reversed(list(enumerate(wanted))):
            bit = F.when(col == w, F.lit(1 << i).cast("long")).otherwise(other if i + 1 == len(wanted) else bit)
        seen = df.groupBy(*keys).agg(F.bit_or(bit).alias("__seen"))
        complete = seen.filter(F.col("__seen") == (1 << len(wanted)) - 1)
    else:
        known = F.when(col.isin(wanted), col).alias("__item")
        once = df.select(*keys, known).distinct()
        seen = once.groupBy(*keys).agg(
            F.count("__item").alias("__seen"), F.count(F.lit(1)).alias("__all")
        )
        both = (F.col("__seen") == len(wanted)) & (F.col("__all") == len(wanted))
        complete = seen.filter(both)
    return complete.select(*keys, F.array(*[F.lit(w) for w in wanted]).alias(name))
