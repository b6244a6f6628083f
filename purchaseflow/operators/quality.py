"""Data quality checks as a report (check, value), and a gate on it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from purchaseflow.functions import any_null


class DataQualityError(ValueError):
    """A critical check found something."""


def row_count() -> Column:
    """Aggregate: number of rows."""
    return F.count(F.lit(1))


def null_rows(columns: Sequence[str]) -> Column:
    """Aggregate: rows with a null in any of ``columns``, each counted once."""
    return F.count_if(any_null(columns))


def violations(predicate: Column) -> Column:
    """Aggregate: rows where ``predicate`` is true; unknown does not count."""
    return F.count_if(predicate)


def profile(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Any number of aggregate checks in one pass over ``df``, as (check, value).

    Counting rows together with a null check over all columns also makes a strict
    CSV reader parse every field, which a bare count does not.
    """
    names = list(checks)
    wide = df.agg(*[checks[n].cast("long").alias(n) for n in names])
    return wide.unpivot([], names, "check", "value")


def counted(spark: SparkSession, values: Mapping[str, int]) -> DataFrame:
    """Counts that are known already, as (check, value)."""
    return spark.createDataFrame(list(values.items()), "check string, value long")


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many distinct key values occur more than once; null is one value."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    return _named(repeated, name)


def unmatched_keys(
    fact: DataFrame, dimension: DataFrame, on: str, name: str, dimension_on: str | None = None
) -> DataFrame:
    """How many distinct values of ``fact.on`` have no row in ``dimension``.

    A null value matches nothing and counts as one. Both sides shrink to distinct
    keys before they are shuffled, so neither a hot fact key nor a hot key of a
    "dimension" that is itself a large table weighs on the join.
    """
    known = dimension.select(F.col(dimension_on or on).alias(on)).distinct()
    return _named(fact.select(on).distinct().join(known, on, "left_anti"), name)


def _named(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("check"), "value")


def suite(parts: Iterable[DataFrame], critical: Iterable[str]) -> DataFrame:
    """All parts as one lazy report (check, value, critical)."""
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("critical", F.col("check").isin(*critical))


def enforce(report: DataFrame) -> dict[str, int]:
    """Runs the report once; raises if a critical check is not zero, else returns it."""
    rows = report.collect()  # one row per check
    failed = [f"{r['check']}={r['value']}" for r in rows if r["critical"] and r["value"]]
    if failed:
        raise DataQualityError("critical checks failed: " + ", ".join(failed))
    return {r["check"]: r["value"] for r in rows}
