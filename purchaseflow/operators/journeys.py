"""The first item of a history and the ordered rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from purchaseflow.operators.hot import CHUNK, CHUNK_ROWS, Split, running, split

SEGMENT = "segment"
PAGE_ITEMS = 10_000
POSITION = "position"


def _placed(
    parts: Split, keys: list[str], order: list[str], first: Column
) -> tuple[DataFrame, DataFrame | None]:
    """Both parts with POSITION, exact and from 1, and ``__opening``, ``first`` of row 1."""
    count = {POSITION: F.lit(1).cast("long")}
    return running(parts, keys, order, count, opening=first)


def later_items(
    df: DataFrame | Split,
    keys: Sequence[str],
    order: Sequence[str],
    item: str,
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """One row per row after a key's first: keys, first_item, first_<order[0]>, position, item.

    The position counts the later rows from 1.
    """
    keys, order = list(keys), list(order)
    parts = df if isinstance(df, Split) else split(df, keys, order, chunk_rows)
    ordinary, hot = _placed(parts, keys, order, _opening(item, order))
    rows = ordinary if hot is None else ordinary.unionByName(hot.drop(CHUNK))
    return rows.filter(F.col(POSITION) > 1).select(
        *keys,
        F.col("__opening.item").alias("first_item"),
        F.col("__opening.date").alias(f"first_{order[0]}"),
        (F.col(POSITION) - 1).alias(POSITION),
        F.col(item).alias("item"),
    )


def _opening(item: str, order: list[str]) -> Column:
    return F.struct(F.col(item).alias("item"), F.col(order[0]).alias("date"))


def first_and_rest(
    df: DataFrame | Split,
    keys: Sequence[str],
    order: Sequence[str],
    item: str,
    attributes: DataFrame | None = None,
    chunk_rows: int | None = CHUNK_ROWS,
    page_items: int = PAGE_ITEMS,
) -> DataFrame:
    """Per key: ``first_item``, ``first_<order[0]>``, ``later_items`` and ``segment``.

    ``later_items`` holds the items in their order, ``page_items`` to a row: item n after
    the first stands in segment (n - 1) div ``page_items``. So a key has one row with
    segment 0, with an empty list where nothing followed, and more rows only if it has
    more than ``page_items`` later items. The rule depends on the key's own rows alone,
    not on the table's size or on ``chunk_rows``, and no list grows with the table.

    ``attributes`` holds one row per key and is joined (inner) after the lists are made.
    """
    keys, order = list(keys), list(order)
    fields = list(dict.fromkeys([*keys, *order, item]))
    parts = df if isinstance(df, Split) else split(df.select(*fields), keys, order, chunk_rows)
    ordinary, hot = _placed(parts.select(*fields), keys, order, _opening(item, order))

    later = F.col(POSITION) - 2
    event = F.when(later >= 0, F.struct(POSITION, F.col(item).alias("item")))
    page = F.floor(F.greatest(later, F.lit(0)) / page_items).cast("long").alias(SEGMENT)

    def pages(frame: DataFrame, *chunk: str) -> DataFrame:
        return (
            frame.select(*keys, *chunk, "__opening", page, event.alias("__event"))
            .groupBy(*keys, *chunk, SEGMENT)
            .agg(
                F.first("__opening").alias("__opening"),
                F.sort_array(F.collect_list("__event")).alias("__events"),
            )
        )

    def shown(listed: DataFrame) -> DataFrame:
        found = listed.select(
            *keys,
            F.col("__opening.item").alias("first_item"),
            F.col("__opening.date").alias(f"first_{order[0]}"),
            F.col("__events.item").alias("later_items"),
            SEGMENT,
        )
        return found if attributes is None else found.join(attributes, keys, "inner")

    if hot is None:
        return shown(pages(ordinary))
    # parts of a page in different chunks meet again, as lists
    whole = (
        pages(hot, CHUNK)
        .groupBy(*keys, SEGMENT)
        .agg(
            F.first("__opening").alias("__opening"),
            F.sort_array(F.flatten(F.collect_list("__events"))).alias("__events"),
        )
    )
    return shown(pages(ordinary)).unionByName(shown(whole))
