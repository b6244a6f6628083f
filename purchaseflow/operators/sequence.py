"""What comes next in a key's history, and how long it took."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from purchaseflow.operators.hot import CHUNK, CHUNK_ROWS, Split, split

_GUEST = "__guest"


def with_next(
    df: DataFrame | Split,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str],
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """Adds, for each ``new name -> column``, the value in the key's very next row.

    ``order`` must break ties, for example (date, id). One window serves all rows: an
    ordinary key is one group, each chunk of a hot key another, and a chunk is lent the
    first row of the next one, so the window over it already sees across its end. Rows
    move once, and the lent ones are found before that, in the map tasks.
    """
    keys, order = list(keys), list(order)
    parts = df if isinstance(df, Split) else split(df, keys, order, chunk_rows)

    def lead(frame: DataFrame, by: list[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return frame.withColumns(
            {new: F.lead(old).over(window) for new, old in columns.items()}
        )

    if not parts.cut:
        return lead(parts.rows, keys)
    carried = [c for c in dict.fromkeys([*order, *columns.values()]) if c not in keys]
    heads = parts.hot.groupBy(*keys, CHUNK).agg(
        F.min_by(F.struct(*carried), F.struct(*order)).alias("__head")
    )
    guests = heads.select(
        *keys, (F.col(CHUNK) - 1).alias(CHUNK), "__head.*", F.lit(True).alias(_GUEST)
    )
    lent = parts.rows.withColumn(_GUEST, F.lit(False)).unionByName(
        guests, allowMissingColumns=True
    )
    return lead(lent, [*keys, CHUNK]).filter(~F.col(_GUEST)).drop(_GUEST, CHUNK)


def followed_by(
    df: DataFrame | Split,
    keys: Sequence[str],
    order: Sequence[str],
    item: str,
    first: str,
    then: str,
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """One row per place where ``then`` is the very next item after ``first``.

    Returns the keys, ``first_<c>`` and ``then_<c>`` for every order column, and
    ``days_between`` on the first of them. Items travel through the shuffle as two
    flags rather than as text.
    """
    slim = df.select(
        *keys,
        *order,
        (F.col(item) == first).alias("__first"),
        (F.col(item) == then).alias("__then"),
    )
    upcoming = {f"then_{c}": c for c in order} | {"__next": "__then"}
    date = order[0]
    return (
        with_next(slim, keys, order, upcoming, chunk_rows)
        .filter(F.col("__first") & F.col("__next"))
        .select(
            *keys,
            *[F.col(c).alias(f"first_{c}") for c in order],
            *[f"then_{c}" for c in order],
            F.datediff(f"then_{date}", date).alias("days_between"),
        )
    )


def mean_gap(
    sequences: DataFrame,
    gap: str = "days_between",
    mean_name: str = "mean_gap",
    count_name: str = "sequences",
) -> DataFrame:
    """Mean of ``gap`` to two digits and the number of sequences; (null, 0) if none."""
    return sequences.agg(
        F.round(F.avg(gap), 2).alias(mean_name), F.count(F.lit(1)).alias(count_name)
    )
