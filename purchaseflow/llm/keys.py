"""What several operators need: a row's key, whole text and names that cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ID, HASH, TEXT = "__id", "__hash", "__text"


def text_hash(text: str | Column) -> Column:
    """64 bits of a text; with the id it names a row. A null text counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key (ID, HASH) and the whole TEXT, whatever else ``df`` has.

    Rows that agree in id and text agree in the key: they are one document read twice
    and get one and the same result.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(doc_id).alias(ID), text_hash(text).alias(HASH), whole.alias(TEXT))


def same_key(left: DataFrame, right: DataFrame, names=(ID, HASH)) -> Column:
    """Equality on ``names`` under which a null id is an id like any other."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
