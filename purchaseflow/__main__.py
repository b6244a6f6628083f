"""Batch entry: ``spark-submit purchaseflow/__main__.py all --raw-dir ... --output-dir ...``"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from purchaseflow.plans import jobs, purchases
from purchaseflow.sources.scratch import SETTING, scope


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="purchaseflow", description="Purchase-journey batch job")
    # fixed values: stage names and the folders below, which are the command's interface
    parser.add_argument("stage", choices=["prepare", "run", "all"])
    parser.add_argument("--raw-dir", default="data/raw")
    parser.add_argument(
        "--work-dir",
        help="folder that all machines share; build, if the master is local",
    )
    parser.add_argument("--output-dir", default="outputs")
    parser.add_argument("--master", help="Spark master; left to spark-submit if absent")
    parser.add_argument(
        "--table-format",
        default="parquet",
        choices=["parquet", "delta"],
        help="format of the customer and exact-set tables",
    )
    parser.add_argument(
        "--no-staging",
        action="store_true",
        help="parse the raw transactions for every step instead of copying them once "
        "to Parquet below the work folder",
    )
    parser.add_argument(
        "--only", nargs="+", choices=purchases.NAMES, default=purchases.NAMES,
        help="build and publish these analyses only",
    )
    parser.add_argument("--ordered", action="store_true", help="sort every output")
    parser.add_argument("--wide-ids", action="store_true", help="read ids as bigint")
    args = parser.parse_args(argv)

    builder = SparkSession.builder.appName("purchaseflow").config(
        "spark.sql.session.timeZone", "UTC"
    )
    spark = (builder.master(args.master) if args.master else builder).getOrCreate()
    try:
        if args.work_dir is None:
            if spark.sparkContext.master.split("[")[0] != "local":
                parser.error("--work-dir is needed on a cluster: a folder that all machines share")
            args.work_dir = "build"
        layout = (args.raw_dir, args.work_dir, args.table_format, args.wide_ids)
        if args.stage == "run":
            sources = jobs.prepared_sources(*layout)
        else:
            sources = jobs.prepare(spark, *layout)
            _show("sources", {name: s.path for name, s in sources.items()})
        if args.stage != "prepare":
            staging = None if args.no_staging else f"{args.work_dir}/staged"
            if not spark.conf.get("spark.checkpoint.dir", None):
                spark.conf.set(SETTING, args.work_dir)
            with scope(spark):
                results, report = jobs.run(spark, sources, staging, args.only)
                manifest = jobs.publish(
                    spark, results, report, args.output_dir, args.table_format, args.ordered
                )
            _show("quality report", report)
            _show("manifest", manifest)
    finally:
        spark.stop()


def _show(title: str, document: dict) -> None:
    print(f"{title}:\n{json.dumps(document, indent=2, sort_keys=True)}")


if __name__ == "__main__":
    main()
