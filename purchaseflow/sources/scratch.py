"""Folders for intermediate tables that every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "purchaseflow.shared.dir"
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_dir(spark: SparkSession, purpose: str, base: str | None = None) -> str:
    """A fresh path in a folder that the driver and all executors share.

    The folder is ``base``, or else the session's ``spark.checkpoint.dir``, or else its
    SETTING, which unlike the former can be set on a running session. Without any of
    them this fails: a folder of one machine would work until a second one reads it.
    """
    base = base or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SETTING, None)
    if not base:
        raise ValueError(
            f"set spark.checkpoint.dir or {SETTING} to a folder all executors share"
        )
    path = f"{base.rstrip('/')}/purchaseflow-{purpose}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def staged(df: DataFrame, purpose: str, base: str | None = None) -> DataFrame:
    """``df`` written to a fresh shared folder and read again.

    Ends a lineage: what follows reads files, so a lost executor costs no more than
    reading its part again, and every reader sees the same rows. The table stays until a
    ``scope`` around this call ends or someone removes it.
    """
    path = scratch_dir(df.sparkSession, purpose, base)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession, keep_last: bool = False) -> Iterator[list[str]]:
    """Removes at its end every scratch folder that was made inside it.

    So write what is wanted before: tables staged inside cannot be read afterwards. With
    ``keep_last`` the one made last stays, for the caller to remove; the list that is
    handed out then holds it alone.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        kept = [made.pop()] if keep_last and made else []
        remove(spark, *made)
        made[:] = kept


def remove(spark: SparkSession, *paths: str) -> None:
    """Removes folders on any file system Spark knows; those that are gone do not matter."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
