"""The batch job end to end on the ten-row fixture, against its published answers."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

import pytest

from purchaseflow.operators.quality import DataQualityError
from purchaseflow.operators import ranking
from purchaseflow.plans import jobs, purchases
from purchaseflow.sources import Source, read, schemas

# The sample inputs whose answers are known.
CUSTOMERS = """customer_id,customer_name,join_date,location
105,Eva,2022-01-01,Ohio
106,Frank,2022-02-01,Nevada
107,Grace,2022-03-01,Colorado
108,Henry,2022-04-01,Utah
"""
PRODUCTS = """product_id,product_name,category,price
5,iPhone SE,Smartphone,450
6,AirPods Pro,Accessory,250
7,MacBook Air,Laptop,1000
8,iPad Mini,Tablet,400
"""
TRANSACTIONS = """transaction_id,customer_id,product_name,transaction_date
11,105,iPhone,2022-02-01
12,106,iPhone,2022-02-02
13,107,AirPods,2022-02-03
14,105,AirPods,2022-02-04
15,108,iPhone,2022-02-05
16,106,MacBook,2022-02-06
17,107,iPhone,2022-02-07
18,105,MacBook,2022-02-08
19,108,AirPods,2022-02-09
20,106,AirPods,2022-02-10
"""


def write_raw(folder, transactions=TRANSACTIONS, products=PRODUCTS):
    folder.mkdir()
    (folder / jobs.RAW_TRANSACTIONS).write_text(transactions)
    (folder / jobs.RAW_CUSTOMERS).write_text(CUSTOMERS)
    (folder / jobs.RAW_PRODUCTS).write_text(products)
    return str(folder)


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    return jobs.prepare(spark, write_raw(root / "raw"), str(root / "work"))


@pytest.fixture(scope="module")
def outcome(spark, sources):
    return jobs.run(spark, sources)


def test_prepared_products_keep_the_raw_name(spark, sources):
    df = read(spark, sources["products"]).orderBy("product_id")
    assert df.columns == [
        "product_id",
        "product_name",
        "source_product_name",
        "category",
        "price",
    ]
    assert [r.product_name for r in df.collect()] == ["iPhone", "AirPods", "MacBook", "iPad"]
    assert df.first().source_product_name == "iPhone SE"


def test_prepared_customers(spark, sources):
    df = read(spark, sources["customers"]).orderBy("customer_id")
    assert df.schema.simpleString() == schemas.CUSTOMERS.simpleString()
    assert [r.customer_id for r in df.collect()] == [105, 106, 107, 108]


def test_quality_report(outcome):
    report = outcome[1]
    assert {k: v for k, v in report.items() if v} == {
        "transaction_rows": 10,
        "customer_rows": 4,
        "product_rows": 4,
    }
    assert len(report) == 12


def test_follow_ups(outcome):
    df = outcome[0]["iphone_then_airpods"].orderBy("customer_id")
    assert df.schema.simpleString() == (
        "struct<customer_id:int,customer_name:string,location:string,iphone_transaction_id:int,"
        "airpods_transaction_id:int,iphone_purchase_date:date,airpods_purchase_date:date,"
        "days_between:int>"
    )
    got = [tuple(map(str, r)) for r in df.collect()]
    assert got == [
        ("105", "Eva", "Ohio", "11", "14", "2022-02-01", "2022-02-04", "3"),
        ("108", "Henry", "Utah", "15", "19", "2022-02-05", "2022-02-09", "4"),
    ]


def test_exact_sets(outcome):
    df = outcome[0]["only_iphone_airpods"].orderBy("customer_id")
    assert df.schema.simpleString() == (
        "struct<customer_id:int,customer_name:string,location:string,products:array<string>>"
    )
    assert [(r.customer_id, r.products) for r in df.collect()] == [
        (107, ["AirPods", "iPhone"]),
        (108, ["AirPods", "iPhone"]),
    ]


def test_journeys(outcome):
    df = outcome[0]["subsequent_purchases"]
    assert df.drop("segment").schema.simpleString() == (
        "struct<customer_id:int,customer_name:string,first_product:string,"
        "first_purchase_date:date,subsequent_products:array<string>>"
    )
    got = {r.customer_id: (r.first_product, r.subsequent_products) for r in df.collect()}
    assert got == {
        105: ("iPhone", ["AirPods", "MacBook"]),
        106: ("iPhone", ["MacBook", "AirPods"]),
        107: ("AirPods", ["iPhone"]),
        108: ("iPhone", ["AirPods"]),
    }


def test_average_delay(outcome):
    df = outcome[0]["average_purchase_delay"]
    assert df.first().asDict() == {
        "average_days_iphone_to_airpods": 3.5,
        "qualifying_sequences": 2,
    }


def test_top_products(outcome):
    df = outcome[0]["top_products"].orderBy("revenue_rank")
    assert df.schema.simpleString() == (
        "struct<product_id:int,product_name:string,source_product_name:string,category:string,"
        "price:double,units_sold:bigint,revenue:double,revenue_rank:int>"
    )
    assert [(r.product_name, r.units_sold, r.revenue) for r in df.collect()] == [
        ("MacBook", 2, 2000.0),
        ("iPhone", 4, 1800.0),
        ("AirPods", 4, 1000.0),
    ]


def test_units_and_next_purchases(spark, sources):
    tx = read(spark, sources["transactions"])
    units = {r.product_name: r.units for r in ranking.counts(tx, "product_name").collect()}
    assert units == {"iPhone": 4, "AirPods": 4, "MacBook": 2}
    following = {r.transaction_id: r.next_transaction_id
                 for r in purchases.next_purchases(tx).collect()}
    assert following[11] == 14 and following[14] == 18 and following[18] is None


@pytest.mark.parametrize("staged", [False, True])
def test_publish(spark, sources, tmp_path, staged):
    staging = str(tmp_path / "staged") if staged else None
    results, report = jobs.run(spark, sources, staging)
    out = str(tmp_path / "out")
    manifest = jobs.publish(spark, results, report, out)
    assert {name: entry["row_count"] for name, entry in manifest.items()} == {
        "iphone_then_airpods": 2,
        "only_iphone_airpods": 2,
        "subsequent_purchases": 4,
        "average_purchase_delay": 1,
        "top_products": 3,
    }
    for name, entry in manifest.items():
        assert entry["format"] == "parquet"
        assert Path(entry["path"]).name == name and entry["path"].startswith(f"{out}/run-")
        stored = read(spark, Source("parquet", entry["path"]))
        assert stored.schema.simpleString() == results[name].schema.simpleString()
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, results[name].collect()))
    assert json.loads(Path(out, "manifest.json").read_text()) == manifest
    assert json.loads(Path(out, "quality_report.json").read_text()) == report


def test_a_failed_run_leaves_the_one_before(spark, sources, tmp_path):
    results, report = jobs.run(spark, sources)
    out = str(tmp_path / "out")
    first = jobs.publish(spark, results, report, out)
    broken = dict(results)
    third = list(broken)[2]
    broken[third] = broken[third].selectExpr("raise_error('lost') as x")
    with pytest.raises(Exception, match="lost"):
        jobs.publish(spark, broken, report, out)
    assert json.loads(Path(out, "manifest.json").read_text()) == first
    for entry in first.values():
        assert read(spark, Source("parquet", entry["path"])).count() == entry["row_count"]
    second = jobs.publish(spark, results, report, out)
    assert json.loads(Path(out, "manifest.json").read_text()) == second != first


def test_ordered_outputs(spark, sources, tmp_path):
    results, report = jobs.run(spark, sources, names=["subsequent_purchases"])
    manifest = jobs.publish(spark, results, report, str(tmp_path / "out"), ordered=True)
    assert list(manifest) == ["subsequent_purchases"]
    files = sorted(Path(manifest["subsequent_purchases"]["path"]).glob("*.parquet"))
    ids = [r.customer_id for f in files for r in spark.read.parquet(str(f)).collect()]
    assert ids == [105, 106, 107, 108]


def test_only_what_is_asked_for_is_built(spark, sources, monkeypatch):
    def never(*_, **__):
        raise AssertionError("searched for hot keys")

    monkeypatch.setattr(purchases, "split", never)
    results, _ = jobs.run(spark, sources, names=["top_products"])
    assert list(results) == ["top_products"] and results["top_products"].count() == 3
    with pytest.raises(ValueError, match="unknown analyses"):
        jobs.run(spark, sources, names=["bottom_products"])


def test_money_adds_up_in_decimals(spark):
    fact = spark.range(1000).selectExpr("id", "'x' as name")
    goods = spark.sql("select 1 as pid, 'x' as name, cast(0.10 as decimal(12, 2)) as price")
    found = ranking.totals(fact, goods, "name", ["pid", "name"], "id", "price")
    assert str(found.first().revenue) == "100.00"


def test_gate_stops_the_run(spark, tmp_path):
    raw = write_raw(tmp_path / "raw", TRANSACTIONS + "21,999,iPad,2022-03-01\n")
    sources = jobs.prepare(spark, raw, str(tmp_path / "work"))
    with pytest.raises(DataQualityError, match="unmatched_customers=1"):
        jobs.run(spark, sources)


def test_malformed_transactions_stop_the_run(spark, tmp_path):
    raw = write_raw(tmp_path / "raw", TRANSACTIONS + "21,105,iPad,yesterday\n")
    sources = jobs.prepare(spark, raw, str(tmp_path / "work"))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        jobs.run(spark, sources)


def test_no_follow_ups_at_all(spark, tmp_path):
    raw = write_raw(tmp_path / "raw", TRANSACTIONS.replace("iPhone,", "iPad,"))
    sources = jobs.prepare(spark, raw, str(tmp_path / "work"))
    results, report = jobs.run(spark, sources)
    manifest = jobs.publish(spark, results, report, str(tmp_path / "out"))
    assert manifest["iphone_then_airpods"]["row_count"] == 0
    stored = read(spark, Source("parquet", manifest["average_purchase_delay"]["path"]))
    assert tuple(stored.first()) == (None, 0)


def test_wide_ids_reach_the_outputs(spark, tmp_path):
    raw = write_raw(tmp_path / "raw", TRANSACTIONS.replace("\n11,", "\n11000000000,"))
    sources = jobs.prepare(spark, raw, str(tmp_path / "work"), wide_ids=True)
    results, _ = jobs.run(spark, sources)
    ids = [r.iphone_transaction_id for r in results["iphone_then_airpods"].collect()]
    assert sorted(ids) == [15, 11000000000]


def test_command_line(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    command = [sys.executable, "-m", "purchaseflow", "all", "--master", "local[2]"]
    folders = ["--raw-dir", raw, "--work-dir", f"{tmp_path}/w", "--output-dir", f"{tmp_path}/o"]
    done = subprocess.run(
        command + folders,
        cwd=Path(__file__).resolve().parents[1],
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert '"transaction_rows": 10' in done.stdout
    assert '"row_count": 4' in done.stdout
    manifest = json.loads((tmp_path / "o" / "manifest.json").read_text())
    top = Source("parquet", manifest["top_products"]["path"])
    assert read(spark, top).count() == 3
    assert read(spark, Source("parquet", f"{tmp_path}/w/staged/transactions_parquet")).count() == 10


def test_the_latest_version_is_whole_at_every_moment(spark, sources, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        jobs.latest(spark, out)
    results, report = jobs.run(spark, sources)
    first = jobs.publish(spark, {"top_products": results["top_products"]}, report, out)
    assert jobs.latest(spark, out) == first

    # a run that stops before its record, and one that stops between record and copies
    def stop(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(jobs, "_put_version", stop)
        jobs.publish(spark, {"top_products": results["top_products"]}, report, out)
    assert jobs.latest(spark, out) == first
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(jobs, "_put_json", stop)
        jobs.publish(spark, {"top_products": results["top_products"]}, report, out)
    second = jobs.latest(spark, out)
    assert second != first and json.loads((tmp_path / "out" / "manifest.json").read_text()) == first
    # both are there, and so are their tables
    assert len(list((tmp_path / "out" / "manifests").glob("*.json"))) == 2
    for manifest in (first, second):
        assert read(spark, Source("parquet", manifest["top_products"]["path"])).count() == 3
    # what a run left half-written is not seen
    (tmp_path / "out" / "manifests" / "000000000009.new").write_text("{")
    assert jobs.latest(spark, out) == second
    third = jobs.publish(spark, {"top_products": results["top_products"]}, report, out)
    assert jobs.latest(spark, out) == third
