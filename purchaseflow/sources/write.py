"""Writing Parquet and Delta."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from purchaseflow.sources.layout import clustered

SINK_FORMATS = ("delta", "parquet")


def write(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    num_files: int | None = None,
    sort_by: Sequence[str] = (),
    checks: Mapping[str, Column] | None = None,
    cluster_by: Sequence[str] = (),
    bloom: Mapping[str, int] | None = None,
    row_group_bytes: int | None = None,
) -> int | dict[str, int]:
    """Writes ``df`` and returns its row count, observed during the write itself.

    With ``checks`` (aggregates by name) it returns their values instead, observed by the
    same write, so what is checked is not read for it.

    ``cluster_by`` puts the rows of an unpartitioned table in an order by which filters on
    any of these columns skip row groups (see ``layout``). ``bloom`` names columns for
    equality filters and how many different values a row group has of each; Parquet then
    keeps a Bloom filter of them. ``row_group_bytes`` is the size of a row group.

    With ``partition_by`` the rows are first rebalanced on those columns: Spark then
    gives a small value one file and spreads a large one over several tasks, instead
    of one file per value and task. ``num_files`` merges output tasks without a
    shuffle, which also runs what comes right before in so few tasks; together with
    ``sort_by`` it deals the rows out by ranges instead. ``sort_by`` orders the whole output, or each file of a partitioned one;
    name a unique column last, so that a frequent value can span several files.
    """
    chosen = fmt.lower()
    if chosen not in SINK_FORMATS:
        raise ValueError(f"unknown sink format '{fmt}', supported: {', '.join(SINK_FORMATS)}")
    if cluster_by and (partition_by or sort_by):
        raise ValueError("cluster_by is an order of its own, without partition_by and sort_by")
    if cluster_by:
        df, num_files = clustered(df, cluster_by, num_files), None
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        if sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
    elif sort_by and num_files is not None:
        df = df.repartitionByRange(num_files, *sort_by).sortWithinPartitions(*sort_by)
    elif sort_by:
        df = df.orderBy(*sort_by)
    if num_files is not None and not (sort_by and not partition_by):
        df = df.coalesce(num_files)
    written = Observation()
    asked = {"rows": F.count(F.lit(1))} if checks is None else checks
    observed = df.observe(written, *[value.alias(name) for name, value in asked.items()])
    writer = observed.write.format(chosen).mode(mode)
    for column, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", values)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return written.get["rows"] if checks is None else {name: written.get[name] for name in asked}
