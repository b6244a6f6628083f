"""Prepare, run and publish: the batch jobs, callable with any SparkSession."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from purchaseflow.operators import quality
from purchaseflow.plans import purchases
from purchaseflow.plans.purchases import Inputs
from purchaseflow.sources import Source, read, schemas, write

# Names of the raw files.
RAW_TRANSACTIONS = "Transaction_Updated.csv"
RAW_CUSTOMERS = "Customer_Updated.csv"
RAW_PRODUCTS = "Products_Updated.csv"


def _raw(raw_dir: str, name: str, schema: StructType, wide_ids: bool) -> Source:
    chosen = schemas.with_wide_ids(schema) if wide_ids else schema
    return Source("csv", f"{raw_dir}/{name}", chosen)


def prepared_sources(
    raw_dir: str, work_dir: str, table_format: str = "parquet", wide_ids: bool = False
) -> dict[str, Source]:
    """Where the prepared inputs are: transactions in CSV, customers and products in tables.

    Ids are int as in the raw schemas; ``wide_ids`` makes them bigint.
    """
    return {
        "transactions": _raw(raw_dir, RAW_TRANSACTIONS, schemas.TRANSACTIONS, wide_ids),
        "customers": Source(table_format, f"{work_dir}/customers_{table_format}"),
        "products": Source("parquet", f"{work_dir}/products_parquet"),
    }


def prepare(
    spark: SparkSession,
    raw_dir: str,
    work_dir: str,
    table_format: str = "parquet",
    wide_ids: bool = False,
) -> dict[str, Source]:
    """Writes customers and standardised products as tables; returns all sources."""
    sources = prepared_sources(raw_dir, work_dir, table_format, wide_ids)
    customers = read(spark, _raw(raw_dir, RAW_CUSTOMERS, schemas.CUSTOMERS, wide_ids))
    raw = read(spark, _raw(raw_dir, RAW_PRODUCTS, schemas.RAW_PRODUCTS, wide_ids))
    write(customers, sources["customers"].path, sources["customers"].fmt)
    write(purchases.prepared_products(raw), sources["products"].path)
    return sources


def extract(
    spark: SparkSession, sources: Mapping[str, Source], staging_dir: str | None = None
) -> Inputs:
    """One DataFrame per source.

    With ``staging_dir`` the transactions are first copied to Parquet, which the next run
    writes over. A gate and five
    analyses then parse the text once instead of once each, read only the columns
    they need, and all see the same rows. What the gate counts in one pass over the
    transactions is observed by the copy itself.
    """
    frames = {name: read(spark, source) for name, source in sources.items()}
    counted = None
    if staging_dir is not None and sources["transactions"].fmt.lower() == "csv":
        path = f"{staging_dir}/transactions_parquet"
        counted = write(frames["transactions"], path, checks=purchases.transaction_checks())
        frames["transactions"] = read(spark, Source("parquet", path))
    return Inputs(**frames, work_dir=staging_dir, counted=counted)


def run(
    spark: SparkSession,
    sources: Mapping[str, Source],
    staging_dir: str | None = None,
    names: Sequence[str] = purchases.NAMES,
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Extract, gate, and the analyses ``names``.

    Raises before any result is built if the gate fails.
    """
    inputs = extract(spark, sources, staging_dir)
    report = quality.enforce(purchases.quality_report(inputs))
    return purchases.analyses(inputs, names), report


def publish(
    spark: SparkSession,
    results: Mapping[str, DataFrame],
    report: Mapping[str, int],
    output_dir: str,
    table_format: str = "parquet",
    ordered: bool = False,
) -> dict[str, dict[str, Any]]:
    """Writes every result, then the quality report and the manifest.

    Each run has a fresh folder below ``output_dir``. When all of its tables are written
    the run gets the next version number and a record of it (``manifests``); that one
    step makes it the latest, see ``latest``. The files ``quality_report.json`` and
    ``manifest.json`` in ``output_dir`` are copies for people and are replaced last. So
    a run that stops half-way leaves the one before it whole, as its tables are untouched. Each result is computed once: its row count is observed during the write,
    and a result derived from another reads that one's written table. ``ordered`` sorts
    each output by the columns in ``purchases.SORT_BY``.
    """
    formats = {name: "parquet" for name in results} | {"only_iphone_airpods": table_format}
    folder = f"{output_dir}/run-{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    manifest: dict[str, dict[str, Any]] = {}

    def put(name: str, df: DataFrame) -> None:
        path = f"{folder}/{name}"
        sort_by = purchases.SORT_BY.get(name, ()) if ordered else ()
        rows = write(df, path, formats[name], mode="errorifexists", sort_by=sort_by)
        manifest[name] = {"format": formats[name], "path": path, "row_count": rows}

    for name in results:
        if name not in purchases.DERIVED:
            put(name, results[name])
    for name in results:
        if name in purchases.DERIVED:
            origin, build = purchases.DERIVED[name]
            stored = manifest.get(origin)
            put(
                name,
                build(read(spark, Source(stored["format"], stored["path"])))
                if stored
                else results[name],
            )

    record = {"manifest": manifest, "report": dict(report)}
    _put_version(spark, record, f"{output_dir}/manifests")
    _put_json(spark, report, f"{output_dir}/quality_report.json")
    _put_json(spark, manifest, f"{output_dir}/manifest.json")
    return manifest


def latest(spark: SparkSession, output_dir: str) -> dict[str, dict[str, Any]]:
    """The manifest of the last run that was published whole.

    It follows the highest version whose record is complete, so it neither sees a run
    that is being published nor a moment without any.
    """
    versions = _versions(spark, f"{output_dir}/manifests")
    if not versions:
        raise FileNotFoundError(f"nothing is published in {output_dir}")
    text = spark.read.text(f"{output_dir}/manifests/{max(versions)}", wholetext=True).first()[0]
    return json.loads(text)["manifest"]


_NUMBER = 12  # digits of a version


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the complete records: others do not end in ``.json`` yet."""
    place, files = _folder(spark, folder)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return [n for n in names if n.endswith(".json") and n[:_NUMBER].isdigit()]


def _put_version(spark: SparkSession, record: Mapping[str, Any], folder: str) -> str:
    """Writes a record under the next free number, complete or not at all.

    The record is written under a name of its own and takes the number by a rename, which
    fails if another run has taken it meanwhile; then the next number is tried. Nothing
    is ever replaced or deleted, so readers always find a latest version.
    """
    place, files = _folder(spark, folder)
    files.mkdirs(place)
    mark = uuid.uuid4().hex
    beside = _folder(spark, f"{folder}/{mark}.new")[0]
    out = files.create(beside, False)
    try:
        out.write(bytearray(json.dumps(record, sort_keys=True), "utf-8"))
    finally:
        out.close()
    while True:
        taken = [int(n[:_NUMBER]) for n in _versions(spark, folder)]
        name = f"{max(taken, default=0) + 1:0{_NUMBER}d}.json"
        target = _folder(spark, f"{folder}/{name}")[0]
        if not files.exists(target) and files.rename(beside, target):
            return name
        if not files.exists(beside):
            raise OSError(f"the record {mark} of this run is gone from {folder}")


def _put_json(spark: SparkSession, document: Mapping[str, Any], path: str) -> None:
    """A small document as one file on any file system Spark knows.

    It is written beside its place first and then moved there, so a reader finds either
    the old document or the new one.
    """
    hadoop, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    target, beside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.new"))
    files = target.getFileSystem(hadoop)
    out = files.create(beside, True)
    try:
        out.write(bytearray(json.dumps(document, sort_keys=True), "utf-8"))
    finally:
        out.close()
    if not files.rename(beside, target):
        # file systems that don't rename onto a file
        files.delete(target, True)
        files.rename(beside, target)
