"""Fact rows with their dimension attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def with_dimension(
    fact: DataFrame, dimension: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """``fact`` joined to ``dimension``.

    No broadcast is forced. Spark broadcasts the dimension while its size is under
    ``spark.sql.autoBroadcastJoinThreshold``, checked again at run time, and
    otherwise shuffles both sides and splits skewed partitions.
    """
    return fact.join(dimension, on if isinstance(on, str) else list(on), how)
