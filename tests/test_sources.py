from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from purchaseflow.sources import Source, read, schemas, write
from purchaseflow.sources.scratch import remove, scope, scratch_dir, staged

HEADER = "transaction_id,customer_id,product_name,transaction_date\n"


@pytest.fixture
def csv_file(tmp_path):
    def build(body, header=HEADER):
        path = tmp_path / "rows.csv"
        path.write_text(header + body)
        return str(path)

    return build


def delta_available(spark) -> bool:
    try:
        spark.range(1).write.format("delta").mode("overwrite").save(scratch_dir(spark, "probe"))
        return True
    except Exception:
        return False


def test_csv_takes_the_schema(spark, csv_file):
    path = csv_file("1,2,pen,2024-01-31\n")
    df = read(spark, Source("csv", path, schemas.TRANSACTIONS))
    assert df.schema.simpleString() == schemas.TRANSACTIONS.simpleString()
    assert str(df.first().transaction_date) == "2024-01-31"


def test_csv_empty_field_is_null(spark, csv_file):
    df = read(spark, Source("csv", csv_file("1,,pen,2024-01-31\n"), schemas.TRANSACTIONS))
    assert df.first().customer_id is None


@pytest.mark.parametrize(
    "body",
    ["x,2,pen,2024-01-31\n", "1,2,pen,31.01.2024\n", "1,2\n", "1,2,pen,2024-01-31,more\n"],
)
def test_malformed_rows_fail_once_every_column_is_read(spark, csv_file, body):
    df = read(spark, Source("csv", csv_file(body), schemas.TRANSACTIONS))
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        df.agg(*[F.count_if(F.col(c).isNull()) for c in df.columns]).collect()


def test_swapped_header_fails(spark, csv_file):
    header = "customer_id,transaction_id,product_name,transaction_date\n"
    path = csv_file("1,2,pen,2024-01-31\n", header)
    with pytest.raises(Exception, match="header"):
        read(spark, Source("csv", path, schemas.TRANSACTIONS)).collect()


def test_caller_options_win(spark, csv_file):
    path = csv_file("x;2;pen;31.01.2024\n", HEADER.replace(",", ";"))
    options = {"sep": ";", "mode": "PERMISSIVE", "dateFormat": "dd.MM.yyyy"}
    row = read(spark, Source("csv", path, schemas.TRANSACTIONS, options)).first()
    assert row.transaction_id is None and str(row.transaction_date) == "2024-01-31"


def test_csv_without_schema_is_text_unless_inferred(spark, csv_file):
    path = csv_file("1,2,pen,2024-01-31\n")
    assert set(dict(read(spark, Source("csv", path)).dtypes).values()) == {"string"}
    inferred = dict(read(spark, Source("csv", path, infer=True)).dtypes)
    assert inferred["transaction_id"] == "int" and inferred["transaction_date"] == "date"


def test_wide_ids():
    wide = schemas.with_wide_ids(schemas.RAW_PRODUCTS)
    assert wide.simpleString() == (
        "struct<product_id:bigint,product_name:string,category:string,price:double>"
    )


def test_unknown_formats_name_the_known_ones(spark):
    with pytest.raises(ValueError, match="csv, delta, parquet"):
        read(spark, Source("excel", "x"))
    with pytest.raises(ValueError, match="delta, parquet"):
        write(spark.range(1), "x", "csv")


def test_format_names_ignore_case(spark, tmp_path):
    assert write(spark.range(3), str(tmp_path / "t"), "PARQUET") == 3
    assert read(spark, Source("Parquet", str(tmp_path / "t"))).count() == 3


def test_parquet_round_trip_with_partitions(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(100).select("id", (F.col("id") % 3).alias("part"))
    assert write(df, str(path), partition_by=["part"]) == 100
    assert sorted(p.name for p in path.glob("part=*")) == ["part=0", "part=1", "part=2"]
    back = read(spark, Source("parquet", str(path))).select("id", "part").orderBy("id")
    assert [tuple(r) for r in back.collect()] == [(i, i % 3) for i in range(100)]


def test_partitioned_write_makes_one_file_per_small_value(spark, tmp_path):
    df = spark.range(1000).repartition(8).select("id", (F.col("id") % 3).alias("part"))
    write(df, str(tmp_path / "t"), partition_by=["part"])
    assert len(list((tmp_path / "t").glob("part=*/*.parquet"))) == 3


def test_sorted_write(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("id"))
    write(df.repartition(4), str(tmp_path / "t"), sort_by=["id"], num_files=1)
    (file,) = (tmp_path / "t").glob("*.parquet")
    assert [r.id for r in spark.read.parquet(str(file)).collect()] == list(range(1000))


def test_sorted_partitioned_write(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("id"), F.lit("x").alias("part"))
    write(df.repartition(4), str(tmp_path / "t"), partition_by=["part"], sort_by=["id"])
    (file,) = (tmp_path / "t").glob("part=x/*.parquet")
    assert [r.id for r in spark.read.parquet(str(file)).collect()] == list(range(1000))


def test_num_files(spark, tmp_path):
    write(spark.range(1000).repartition(8), str(tmp_path / "t"), num_files=2)
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 2


def test_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    write(spark.range(3), path)
    assert write(spark.range(4), path, mode="append") == 4
    assert read(spark, Source("parquet", path)).count() == 7
    write(spark.range(2), path)
    assert read(spark, Source("parquet", path)).count() == 2
    with pytest.raises(AnalysisException):
        write(spark.range(2), path, mode="errorifexists")


def test_filter_and_columns_reach_the_parquet_scan(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    df = spark.range(10).select("id", F.lit("PROMO").alias("kind"), F.lit(1.0).alias("price"))
    write(df, path)
    text = plan(read(spark, Source("parquet", path)).filter("kind = 'PROMO'").select("id"))
    assert "EqualTo(kind,PROMO)" in text
    assert "ReadSchema: struct<id:bigint,kind:string>" in text


def test_missing_delta_package_is_reported_not_replaced(spark, tmp_path):
    if delta_available(spark):
        pytest.skip("the Delta package is present")
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        write(spark.range(1), str(tmp_path / "t"), "delta")
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        read(spark, Source("delta", str(tmp_path / "t"))).collect()
    assert not Path(tmp_path / "t").exists()


def test_delta_round_trip(spark, tmp_path):
    if not delta_available(spark):
        pytest.skip("the Delta package is not on this machine")
    path = str(tmp_path / "t")
    assert write(spark.range(3), path, "delta") == 3
    write(spark.range(5), path, "delta")
    assert read(spark, Source("delta", path)).count() == 5
    assert read(spark, Source("delta", path, options={"versionAsOf": 0})).count() == 3


def test_scratch_lies_below_the_shared_folder(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_scope_removes_what_was_staged_inside(spark, tmp_path):
    base = str(tmp_path)
    outside = staged(spark.range(3), "outside", base)
    with scope(spark) as made:
        inner = staged(spark.range(5), "inner", base)
        assert inner.count() == 5 and len(made) == 1 and len(list(tmp_path.iterdir())) == 2
    assert outside.count() == 3 and len(list(tmp_path.iterdir())) == 1
    with scope(spark, keep_last=True) as made:
        staged(spark.range(5), "first", base)
        last = staged(spark.range(7), "last", base)
    assert last.count() == 7 and len(made) == 1 and len(list(tmp_path.iterdir())) == 2
    remove(spark, *made, f"{base}/never-there")
    with pytest.raises(ZeroDivisionError), scope(spark):
        staged(spark.range(5), "lost", base)
        1 / 0  # noqa: B018
    assert len(list(tmp_path.iterdir())) == 1


def rows_read(df):
    """Rows that the scan of an unshuffled plan gives out, row groups left out aside."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def scattered(spark):
    h = F.xxhash64("id")
    return spark.range(60_000).select(
        F.md5(F.col("id").cast("string")).alias("code"),
        F.pmod(h, F.lit(10_000)).alias("a"),
        F.when(h % 41 != 0, F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id", h), F.lit(900)).cast("int"))).alias("b"),
        F.concat(F.lit("n"), F.pmod(F.xxhash64(h), F.lit(5000)).cast("string")).alias("c"),
    )


def test_clustered_tables_are_read_in_part(spark, scattered, tmp_path):
    small = {"row_group_bytes": 64 * 1024}
    filters = {"a": "a between 2000 and 2100", "b": "b between '2025-01-01' and '2025-01-20'", "c": "c = 'n77'"}
    plain, one, three = (str(tmp_path / n) for n in ("plain", "one", "three"))
    write(scattered, plain, num_files=4, **small)
    write(scattered, one, num_files=4, cluster_by=["a"], **small)
    write(scattered, three, num_files=8, cluster_by=["a", "b", "c"], **small)
    expected = {name: sorted(map(repr, scattered.filter(f).collect())) for name, f in filters.items()}
    for path in (plain, one, three):
        table = read(spark, Source("parquet", path))
        assert table.columns == scattered.columns and table.count() == 60_000
        for name, condition in filters.items():
            assert sorted(map(repr, table.filter(condition).collect())) == expected[name]
    whole = rows_read(read(spark, Source("parquet", plain)).filter(filters["a"]))
    assert whole > 50_000
    assert rows_read(read(spark, Source("parquet", one)).filter(filters["a"])) < whole / 8
    for name in ("a", "b"):
        assert rows_read(read(spark, Source("parquet", three)).filter(filters[name])) < whole / 2


def test_bloom_filters_skip_what_no_order_helps(spark, scattered, tmp_path):
    filters = {}
    for name, extra in (("without", {}), ("with", {"bloom": {"code": 20_000}})):
        path = str(tmp_path / name)
        write(scattered, path, num_files=1, row_group_bytes=256 * 1024, **extra)
        table = read(spark, Source("parquet", path))
        wanted = F.md5(F.lit("12345"))
        code = table.filter(F.col("code") == spark.range(1).select(wanted).first()[0])
        assert code.count() == 1
        filters[name] = rows_read(code)
    assert filters["with"] < filters["without"] / 2


def test_orders_that_cannot_be(spark, scattered, tmp_path):
    with pytest.raises(ValueError):
        write(scattered, str(tmp_path / "x"), cluster_by=["a"], sort_by=["b"])
    with pytest.raises(ValueError):
        write(scattered, str(tmp_path / "x"), cluster_by=[str(i) for i in range(9)])
    empty = str(tmp_path / "empty")
    assert write(scattered.limit(0), empty, cluster_by=["a", "b"]) == 0
    nulls = scattered.select(F.lit(None).cast("int").alias("a"), "c").limit(50)
    assert write(nulls, str(tmp_path / "nulls"), cluster_by=["a", "c"]) == 50
