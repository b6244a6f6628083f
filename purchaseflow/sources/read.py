"""Reading CSV, Parquet and Delta."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SOURCE_FORMATS = ("csv", "delta", "parquet")

# How the raw files are read.
_CSV_DEFAULTS = {"header": True, "mode": "FAILFAST", "dateFormat": "yyyy-MM-dd"}


@dataclass(frozen=True)
class Source:
    """Where a table is and how to read it."""

    fmt: str
    path: str
    schema: StructType | None = None
    options: Mapping[str, Any] = field(default_factory=dict)
    infer: bool = False


def read(spark: SparkSession, source: Source) -> DataFrame:
    """The source as a lazy DataFrame. Options given in ``source`` win over defaults.

    CSV takes the schema of ``source``, checks the header against it and fails on a
    malformed row; without a schema every column is text unless ``infer`` is set.
    Parquet and Delta carry their own schema. Delta needs its package on the cluster;
    without it Spark reports that the data source was not found.
    """
    fmt = source.fmt.lower()
    if fmt not in SOURCE_FORMATS:
        raise ValueError(
            f"unknown source format '{source.fmt}', supported: {', '.join(SOURCE_FORMATS)}"
        )
    reader = spark.read.format(fmt)
    options: dict[str, Any] = {}
    if fmt == "csv":
        options = dict(_CSV_DEFAULTS)
        if source.schema is not None:
            reader = reader.schema(source.schema)
            options["enforceSchema"] = False
        elif source.infer:
            options["inferSchema"] = True
    return reader.options(**{**options, **source.options}).load(source.path)
