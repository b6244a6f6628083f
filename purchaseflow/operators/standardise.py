"""Value standardisation that keeps the original."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def map_values(
    df: DataFrame, column: str, mapping: Mapping[str, str] | DataFrame, source_column: str
) -> DataFrame:
    """Replaces known values of ``column``; the original moves to ``source_column``.

    Values outside ``mapping`` and nulls stay as they are. ``source_column`` is placed
    right after ``column``. A mapping too large for a plan is a table of two columns, the
    old value (each once) and the new one, and is joined; Spark chooses how by its size.
    """
    after = df.columns.index(column) + 1
    names = [*df.columns[:after], source_column, *df.columns[after:]]
    kept = df.withColumn(source_column, F.col(column)).select(*names)
    if isinstance(mapping, DataFrame):
        table = mapping.toDF("__old", "__new")
        joined = kept.join(table, F.col(column) == F.col("__old"), "left")
        mapped = F.when(F.col("__old").isNull(), F.col(column)).otherwise(F.col("__new"))
        return joined.withColumn(column, mapped).select(*names)
    return kept.replace(dict(mapping), subset=[column]) if mapping else kept
