"""

The orders table plays the purchase history (item = priority or status), customer and
nation play the customers, part and lineitem the products and their sales, events a
second history.
"""

from __future__ import annotations

import atexit
import functools
import importlib
import shutil
import tempfile
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from purchaseflow.operators import journeys, quality, ranking, sequence, sets, standardise
from purchaseflow.operators.enrich import with_dimension
from purchaseflow.plans import jobs, purchases
from purchaseflow.sources import Source, read, write
from purchaseflow.sources.scratch import SETTING, scratch_dir

KEY = ["cid"]
HISTORY = ["d", "tid"]
# A limit this low makes ordinary customers hot, so the split path runs on real data.
LOW_LIMIT = 12


def _optional(name: str) -> ModuleType | None:
    """Module ``name``, or None where it (or the package that holds it) was removed."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name is None or not f"{name}.".startswith(f"{missing.name}."):
            raise
        return None


_llm = _optional("purchaseflow.llm.queries")
_pipeline = _optional("corpus_pipeline") if _llm else None


def _with_folder(query: Callable[[SparkSession, str], DataFrame]):
    """``query`` with a folder for intermediate tables, chosen here for a local session."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        known = (spark.conf.get(name, None) for name in ("spark.checkpoint.dir", SETTING))
        if not any(known) and spark.sparkContext.master.split("[")[0] == "local":
            folder = tempfile.mkdtemp(prefix="purchaseflow-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            spark.conf.set(SETTING, folder)
        return query(spark, sf)

    return run


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read(spark, Source("parquet", f"{sf}/{name}.parquet"))


def _purchases(spark: SparkSession, sf: str, item: str = "o_orderpriority") -> DataFrame:
    return _table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("tid"),
        F.col("o_custkey").alias("cid"),
        F.col(item).alias("item"),
        F.to_date("o_orderdate").alias("d"),
    )


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    nation = _table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("location")
    )
    return with_dimension(_table(spark, sf, "customer"), nation, "c_nationkey").select(
        F.col("c_custkey").alias("cid"), F.col("c_name").alias("customer_name"), "location"
    )


# --- sequences -------------------------------------------------------------------


def seq_next(spark: SparkSession, sf: str) -> DataFrame:
    upcoming = {"next_item": "item", "next_d": "d", "next_tid": "tid"}
    return sequence.with_next(_purchases(spark, sf), KEY, HISTORY, upcoming)


def seq_next_hot(spark: SparkSession, sf: str) -> DataFrame:
    upcoming = {"next_item": "item", "next_d": "d", "next_tid": "tid"}
    return sequence.with_next(_purchases(spark, sf), KEY, HISTORY, upcoming, LOW_LIMIT)


def _follow_ups(spark: SparkSession, sf: str, **limit) -> DataFrame:
    found = sequence.followed_by(
        _purchases(spark, sf), KEY, HISTORY, "item", "1-URGENT", "2-HIGH", **limit
    )
    return with_dimension(found, _customers(spark, sf), "cid").select(
        "cid",
        "customer_name",
        "location",
        "first_tid",
        "then_tid",
        "first_d",
        "then_d",
        "days_between",
    )


def seq_followed_by(spark: SparkSession, sf: str) -> DataFrame:
    return _follow_ups(spark, sf)


def seq_followed_by_hot(spark: SparkSession, sf: str) -> DataFrame:
    return _follow_ups(spark, sf, chunk_rows=LOW_LIMIT)


def seq_mean_gap(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.mean_gap(_follow_ups(spark, sf))


def seq_events(spark: SparkSession, sf: str) -> DataFrame:
    events = _table(spark, sf, "events")
    return sequence.followed_by(
        events, ["user_id"], ["ts", "event_id"], "event_type", "view", "purchase"
    ).select("user_id", "first_event_id", "then_event_id", "days_between")


def seq_events_hot(spark: SparkSession, sf: str) -> DataFrame:
    events = _table(spark, sf, "events")
    return sequence.followed_by(
        events, ["user_id"], ["ts", "event_id"], "event_type", "view", "purchase", LOW_LIMIT
    ).select("user_id", "first_event_id", "then_event_id", "days_between")


# --- sets, journeys, rankings ----------------------------------------------------


def set_exactly(spark: SparkSession, sf: str) -> DataFrame:
    found = sets.exactly(_purchases(spark, sf, "o_orderstatus"), KEY, "item", ["O", "F"])
    return with_dimension(found, _customers(spark, sf), "cid").select(
        "cid", "customer_name", "location", F.array_join("items", ",").alias("items")
    )


def journey(spark: SparkSession, sf: str) -> DataFrame:
    people = _customers(spark, sf).select("cid", "customer_name")
    return journeys.first_and_rest(
        _purchases(spark, sf), KEY, HISTORY, "item", attributes=people
    ).select(
        "cid",
        "customer_name",
        "first_item",
        "first_d",
        F.array_join("later_items", ",").alias("later_items"),
    )


def _listed(pages: DataFrame) -> DataFrame:
    return pages.select(
        "cid",
        "first_item",
        "first_d",
        "segment",
        F.array_join("later_items", ",").alias("later_items"),
    )


def journey_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Journeys in pages of three items."""
    bought = _purchases(spark, sf)
    return _listed(journeys.first_and_rest(bought, KEY, HISTORY, "item", page_items=3))


def journey_hot(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages from chunks: where a history is cut never shows."""
    bought = _purchases(spark, sf)
    return _listed(
        journeys.first_and_rest(
            bought, KEY, HISTORY, "item", chunk_rows=LOW_LIMIT, page_items=3
        )
    )


def journey_long(spark: SparkSession, sf: str) -> DataFrame:
    """One row per later purchase with its exact position."""
    return journeys.later_items(_purchases(spark, sf), KEY, HISTORY, "item", LOW_LIMIT)


def topk_revenue(spark: SparkSession, sf: str) -> DataFrame:
    sold = _table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    parts = _table(spark, sf, "part")
    sales = ranking.totals(
        sold,
        parts,
        on="p_partkey",
        group=["p_partkey", "p_name", "p_brand", "p_retailprice"],
        counted="l_orderkey",
        price="p_retailprice",
    )
    return ranking.top_k(sales, ["-revenue", "-units", "p_partkey"], 3, "revenue_rank")


def topk_large(spark: SparkSession, sf: str) -> DataFrame:
    """The first 1,500 order values over all sales, ties included."""
    sold = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    priced = with_dimension(
        sold,
        _table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"),
        "l_partkey",
    )
    return ranking.top_k(priced, ["-p_retailprice", "l_partkey", "l_linenumber"], 1500, "place")


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.counts(_table(spark, sf, "events"), "event_type")


# --- standardising, enriching, scanning, laying out ------------------------------


def map_values(spark: SparkSession, sf: str) -> DataFrame:
    parts = _table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    names = {"PROMO": "Promotional", "ECONOMY": "Economy"}
    return standardise.map_values(parts, "p_type", names, "source_type")


def map_table(spark: SparkSession, sf: str) -> DataFrame:
    """Values mapped by a table: nation names instead of their keys."""
    keys = _table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("nation")
    )
    names = _table(spark, sf, "nation").filter(F.col("n_nationkey") < 20)
    table = names.select(F.col("n_nationkey").cast("string"), "n_name")
    return standardise.map_values(keys, "nation", table, "nation_key")


def enrich(spark: SparkSession, sf: str) -> DataFrame:
    return _customers(spark, sf)


def filtered_scan(spark: SparkSession, sf: str) -> DataFrame:
    parts = _table(spark, sf, "part").filter(F.col("p_type") == "PROMO")
    return parts.select("p_partkey", "p_name", "p_type", "p_retailprice")


def layout(spark: SparkSession, sf: str) -> DataFrame:
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _purchases(spark, sf).repartition(tasks, "tid")
    return rows.coalesce(max(1, tasks // 2))


# --- data quality ----------------------------------------------------------------


def dq_rows_nulls(spark: SparkSession, sf: str) -> DataFrame:
    checks = {
        "rows": quality.row_count(),
        "null_rows": quality.null_rows(["tid", "cid", "item", "d"]),
    }
    return quality.profile(_purchases(spark, sf), checks)


def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(_table(spark, sf, "part"), ["p_name"], "duplicate_names")


def dq_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unmatched_keys(
        _table(spark, sf, "customer"),
        _table(spark, sf, "events"),
        "c_custkey",
        "customers_without_events",
        dimension_on="user_id",
    )


def dq_range(spark: SparkSession, sf: str) -> DataFrame:
    checks = {"non_positive_balances": quality.violations(F.col("c_acctbal") <= 0)}
    return quality.profile(_table(spark, sf, "customer"), checks)


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    parts = [dq(spark, sf) for dq in (dq_rows_nulls, dq_duplicates, dq_unmatched, dq_range)]
    return quality.suite(parts, critical=["null_rows", "duplicate_names"])


# --- formats ---------------------------------------------------------------------

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderday"]


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders").withColumn("o_orderday", F.to_date("o_orderdate"))
    return orders.select(*ORDER_COLUMNS)


def roundtrip_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    write(_orders(spark, sf), path, partition_by=["o_orderstatus"])
    return read(spark, Source("parquet", path)).select(*ORDER_COLUMNS).orderBy("o_orderkey")


def _as_csv(df: DataFrame, path: str) -> StructType:
    df.write.option("header", True).csv(path)
    return df.schema


def roundtrip_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    schema = _as_csv(_orders(spark, sf), path)
    return read(spark, Source("csv", path, schema))


def roundtrip_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    _as_csv(_orders(spark, sf), path)
    return read(spark, Source("csv", path, infer=True)).select(
        F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), *ORDER_COLUMNS[2:]
    )


# --- the whole job ---------------------------------------------------------------


# which product stands for a value of an orders column, and for any other value
PRODUCTS = {
    "o_orderpriority": ({"1-URGENT": "iPhone", "2-HIGH": "AirPods", "3-MEDIUM": "MacBook"}, "iPad"),
    "o_orderstatus": ({"F": "iPhone", "O": "AirPods"}, "MacBook"),
}


def _raw_inputs(spark: SparkSession, sf: str, by: str) -> str:
    """The three raw CSV inputs of the job, derived from the given tables."""
    raw = scratch_dir(spark, "raw")
    names, other = PRODUCTS[by]
    item = F.lit(other)
    for value, product in names.items():
        item = F.when(F.col("item") == value, product).otherwise(item)
    bought = _purchases(spark, sf, by).select(
        F.col("tid").alias("transaction_id"),
        F.col("cid").alias("customer_id"),
        item.alias("product_name"),
        F.col("d").alias("transaction_date"),
    )
    people = _customers(spark, sf).select(
        F.col("cid").alias("customer_id"),
        "customer_name",
        F.lit("2020-01-01").cast("date").alias("join_date"),
        "location",
    )
    long_names = {short: raw_name for raw_name, short in purchases.PRODUCT_NAMES.items()}
    goods = (
        bought.groupBy("product_name")
        .agg(F.min("transaction_id").alias("product_id"))
        .select(
            "product_id",
            "product_name",
            F.lit("device").alias("category"),
            (F.length("product_name") * 100.5).cast("double").alias("price"),
        )
        .replace(long_names, subset=["product_name"])
    )
    _as_csv(bought, f"{raw}/{jobs.RAW_TRANSACTIONS}")
    _as_csv(people, f"{raw}/{jobs.RAW_CUSTOMERS}")
    _as_csv(goods, f"{raw}/{jobs.RAW_PRODUCTS}")
    return raw


def _run_job(spark: SparkSession, sf: str, names=purchases.NAMES, by: str = "o_orderpriority"):
    work = scratch_dir(spark, "work")
    sources = jobs.prepare(spark, _raw_inputs(spark, sf, by), work, wide_ids=True)
    results, report = jobs.run(spark, sources, f"{work}/staged", names)
    return results, report, f"{work}/out"


def job_manifest(spark: SparkSession, sf: str) -> DataFrame:
    results, report, out = _run_job(spark, sf)
    manifest = jobs.publish(spark, results, report, out)
    rows = [(name, entry["row_count"]) for name, entry in manifest.items()]
    return spark.createDataFrame(rows, "output string, row_count long")


def _published(spark: SparkSession, sf: str, name: str, **inputs) -> DataFrame:
    results, report, out = _run_job(spark, sf, [name], **inputs)
    manifest = jobs.publish(spark, results, report, out, ordered=True)
    return read(spark, Source("parquet", manifest[name]["path"]))


def job_top_products(spark: SparkSession, sf: str) -> DataFrame:
    return _published(spark, sf, "top_products")


def job_follow_ups(spark: SparkSession, sf: str) -> DataFrame:
    return _published(spark, sf, "iphone_then_airpods")


def job_exact_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by status, as few customers have orders of two priorities only."""
    found = _published(spark, sf, "only_iphone_airpods", by="o_orderstatus")
    return found.withColumn("products", F.array_join("products", ","))


def job_journeys(spark: SparkSession, sf: str) -> DataFrame:
    found = _published(spark, sf, "subsequent_purchases")
    return found.withColumn("subsequent_products", F.array_join("subsequent_products", ","))


def job_mean_delay(spark: SparkSession, sf: str) -> DataFrame:
    return _published(spark, sf, "average_purchase_delay")


def job_quality(spark: SparkSession, sf: str) -> DataFrame:
    report = _run_job(spark, sf, [])[1]
    return spark.createDataFrame(list(report.items()), "check string, value long")


def job_quality_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """The gate's report, not enforced, over inputs with faults of every kind."""
    bought, people, parts = (_table(spark, sf, t) for t in ("orders", "customer", "part"))
    tx = bought.select(
        (F.col("o_orderkey") - F.when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0)).alias(
            "transaction_id"
        ),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("p"), (F.col("o_orderkey") % 60).cast("string")).alias("product_name"),
        F.to_date("o_orderdate").alias("transaction_date"),
    )
    buyers = people.filter(F.col("c_custkey") % 5 != 0).select(
        F.floor(F.col("c_custkey") / 2).cast("long").alias("customer_id"),
        F.when(F.col("c_nationkey") != 3, F.col("c_name")).alias("customer_name"),
        F.lit("2020-01-01").cast("date").alias("join_date"),
        F.col("c_nationkey").cast("string").alias("location"),
    )
    goods = parts.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("p"), (F.col("p_partkey") % 50).cast("string")).alias("product_name"),
        F.when(F.col("p_size") != 9, F.col("p_type")).alias("category"),
        (F.col("p_retailprice") - 1200.0).alias("price"),
    )
    report = purchases.quality_report(purchases.Inputs(tx, buyers, goods))
    return report.select("check", "value")


# --- contract --------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Who placed a high order right after an urgent one, on sf0.001."""
    return seq_followed_by(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        seq_next,
        seq_next_hot,
        seq_followed_by,
        seq_followed_by_hot,
        seq_mean_gap,
        seq_events,
        seq_events_hot,
        set_exactly,
        journey,
        journey_pages,
        journey_hot,
        journey_long,
        topk_revenue,
        topk_large,
        counts,
        map_values,
        map_table,
        enrich,
        filtered_scan,
        layout,
        dq_rows_nulls,
        dq_duplicates,
        dq_unmatched,
        dq_range,
        dq_report,
        roundtrip_parquet,
        roundtrip_csv,
        roundtrip_csv_inferred,
        job_manifest,
        job_top_products,
        job_follow_ups,
        job_exact_sets,
        job_journeys,
        job_mean_delay,
        job_quality,
        job_quality_dirty,
    ]
    found = {query.__name__: query for query in listed}
    if _llm:
        found |= _llm.queries()
    if _pipeline:
        found["pipeline"] = _pipeline.run
    return {name: _with_folder(query) for name, query in found.items()}


_TX = """tx as (select o_orderkey as tid, o_custkey as cid, o_orderpriority as item,
  o_orderdate::date as d from orders)"""
_CU = """cu as (select c_custkey as cid, c_name as customer_name, n_name as location
  from customer join nation on c_nationkey = n_nationkey)"""
_NEXT = """nx as (select *, lead(item) over w as next_item, lead(d) over w as next_d,
  lead(tid) over w as next_tid from tx window w as (partition by cid order by d, tid))"""
_FOLLOW = f"""with {_TX}, {_CU}, {_NEXT}, fu as (
  select cid, customer_name, location, tid as first_tid, next_tid as then_tid, d as first_d,
    next_d as then_d, (next_d - d)::int as days_between
  from nx join cu using (cid) where item = '1-URGENT' and next_item = '2-HIGH')"""
_EVENTS = """with nx as (select user_id, event_id, ts, event_type,
    lead(event_type) over w as next_type, lead(event_id) over w as next_id,
    lead(ts) over w as next_ts
  from events window w as (partition by user_id order by ts, event_id))
select user_id, event_id as first_event_id, next_id as then_event_id,
  (next_ts::date - ts::date)::int as days_between
from nx where event_type = 'view' and next_type = 'purchase'"""
_LISTS = """ls as (select cid, list(item order by d, tid) as items, min(d) as first_d
  from tx group by cid)"""
_BOUGHT = """bought as (select o_orderkey as tid, o_custkey as cid, o_orderdate::date as d,
  case o_orderpriority when '1-URGENT' then 'iPhone' when '2-HIGH' then 'AirPods'
    when '3-MEDIUM' then 'MacBook' else 'iPad' end as item from orders)"""
_PAGES = f"""with {_TX}, r as (select *, row_number() over w as n,
    first_value(item) over w as first_item, first_value(d) over w as first_d
  from tx window w as (partition by cid order by d, tid))
select cid, first_item, first_d, (greatest(n - 2, 0) // 3)::bigint as segment,
  coalesce(string_agg(item, ',' order by n) filter (n > 1), '') as later_items
from r group by cid, first_item, first_d, (greatest(n - 2, 0) // 3)::bigint"""
_JOB_NEXT = f"""{_BOUGHT}, {_CU}, fu as (
  select cid as customer_id, customer_name, location, tid as iphone_transaction_id,
    next_tid as airpods_transaction_id, d as iphone_purchase_date,
    next_d as airpods_purchase_date, (next_d - d)::int as days_between
  from (select *, lead(item) over w as next_item, lead(tid) over w as next_tid,
      lead(d) over w as next_d
    from bought window w as (partition by cid order by d, tid)) join cu using (cid)
  where item = 'iPhone' and next_item = 'AirPods')"""
_ORDERS = """select o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
  o_orderdate::date as o_orderday from orders"""
_REPORT = """select 'transaction_rows' as "check", count(*) as value from tx union all
select 'transaction_null_rows', count(*) from tx where transaction_id is null
  or customer_id is null or product_name is null or transaction_date is null union all
select 'customer_rows', count(*) from people union all
select 'customer_null_rows', count(*) from people where customer_id is null
  or customer_name is null or join_date is null or location is null union all
select 'product_rows', count(*) from goods union all
select 'product_null_rows', count(*) from goods where product_id is null
  or product_name is null or category is null or price is null union all
select 'non_positive_prices', count(*) from goods where price <= 0 union all
select 'duplicate_transaction_ids', count(*) from (select transaction_id from tx
  group by transaction_id having count(*) > 1) union all
select 'duplicate_customer_ids', count(*) from (select customer_id from people
  group by customer_id having count(*) > 1) union all
select 'duplicate_product_names', count(*) from (select product_name from goods
  group by product_name having count(*) > 1) union all
select 'unmatched_customers', count(*) from (select distinct customer_id from tx) t
  where not exists (select 1 from people p where p.customer_id = t.customer_id) union all
select 'unmatched_products', count(*) from (select distinct product_name from tx) t
  where not exists (select 1 from goods g where g.product_name = t.product_name)"""
_DQ = {
    "dq_rows_nulls": """select 'rows' as "check", count(*) as value from orders union all
select 'null_rows', count(*) filter (where o_orderkey is null or o_custkey is null
  or o_orderpriority is null or o_orderdate is null) from orders""",
    "dq_duplicates": """select 'duplicate_names' as "check", count(*) as value
from (select p_name from part group by p_name having count(*) > 1)""",
    "dq_unmatched": """select 'customers_without_events' as "check", count(*) as value
from (select distinct c_custkey from customer
  where c_custkey not in (select user_id from events))""",
    "dq_range": """select 'non_positive_balances' as "check",
  count(*) filter (where c_acctbal <= 0) as value from customer""",
}


def oracle_sql() -> dict[str, str]:
    seq_next_sql = f"with {_TX}, {_NEXT} select * from nx"
    follow_sql = f"{_FOLLOW} select * from fu"
    union_of_checks = " union all ".join(f"({sql})" for sql in _DQ.values())
    found = {
        "seq_next": seq_next_sql,
        "seq_next_hot": seq_next_sql,
        "seq_followed_by": follow_sql,
        "seq_followed_by_hot": follow_sql,
        "seq_mean_gap": f"""{_FOLLOW} select round(avg(days_between), 2) as mean_gap,
  count(*) as sequences from fu""",
        "seq_events": _EVENTS,
        "seq_events_hot": _EVENTS,
        "set_exactly": f"""with {_CU}, st as (select o_custkey as cid,
  list_sort(list(distinct o_orderstatus)) as items from orders group by o_custkey)
select cid, customer_name, location, array_to_string(items, ',') as items
from st join cu using (cid) where items = ['F', 'O']""",
        "journey": f"""with {_TX}, {_CU}, {_LISTS} select cid, customer_name,
  items[1] as first_item, first_d,
  coalesce(array_to_string(items[2:], ','), '') as later_items from ls join cu using (cid)""",
        "journey_pages": _PAGES,
        "journey_hot": _PAGES,
        "journey_long": f"""with {_TX}, r as (select *, row_number() over w as n,
    first_value(item) over w as first_item, first_value(d) over w as first_d
  from tx window w as (partition by cid order by d, tid))
select cid, first_item, first_d, n - 1 as position, item from r where n > 1""",
        "topk_revenue": """with s as (select p_partkey, p_name, p_brand, p_retailprice,
    count(l_orderkey) as units, round(sum(p_retailprice), 2) as revenue
  from lineitem join part on l_partkey = p_partkey
  group by p_partkey, p_name, p_brand, p_retailprice),
r as (select *, dense_rank() over (order by revenue desc, units desc, p_partkey)::int
  as revenue_rank from s)
select * from r where revenue_rank <= 3""",
        "topk_large": """with s as (select l_partkey, l_orderkey, l_linenumber, p_retailprice,
    dense_rank() over (order by p_retailprice desc, l_partkey, l_linenumber)::int as place
  from lineitem join part on l_partkey = p_partkey)
select * from s where place <= 1500""",
        "counts": "select event_type, count(*) as units from events group by event_type",
        "map_values": """select p_partkey, p_name, case p_type when 'PROMO' then 'Promotional'
  when 'ECONOMY' then 'Economy' else p_type end as p_type, p_type as source_type,
  p_retailprice from part""",
        "map_table": """select c_custkey, coalesce(n_name, c_nationkey::varchar) as nation,
  c_nationkey::varchar as nation_key
from customer left join nation on c_nationkey = n_nationkey and n_nationkey < 20""",
        "enrich": f"with {_CU} select * from cu",
        "filtered_scan": """select p_partkey, p_name, p_type, p_retailprice from part
where p_type = 'PROMO'""",
        "layout": f"with {_TX} select * from tx",
        **_DQ,
        "dq_report": f"""select "check", value,
  "check" in ('null_rows', 'duplicate_names') as critical from ({union_of_checks})""",
        "roundtrip_parquet": _ORDERS,
        "roundtrip_csv": _ORDERS,
        "roundtrip_csv_inferred": _ORDERS,
        "job_manifest": f"""with {_BOUGHT}, nx as (
  select *, lead(item) over (partition by cid order by d, tid) as next_item from bought),
only_two as (select cid from bought group by cid
  having list_sort(list(distinct item)) = ['AirPods', 'iPhone'])
select 'iphone_then_airpods' as output, count(*) as row_count from nx
  where item = 'iPhone' and next_item = 'AirPods' union all
select 'only_iphone_airpods', count(*) from only_two union all
select 'subsequent_purchases', count(distinct cid) from bought union all
select 'average_purchase_delay', count(*) from (select avg(d - d) from bought) union all
select 'top_products', least(3, count(distinct item)) from bought""",
        "job_top_products": f"""with {_BOUGHT}, names as (select * from (values
  ('iPhone', 'iPhone SE'), ('AirPods', 'AirPods Pro'), ('MacBook', 'MacBook Air'),
  ('iPad', 'iPad Mini')) as v(item, source_product_name)),
s as (select min(tid) as product_id, item as product_name, source_product_name,
    'device' as category, length(item) * 100.5::double as price, count(*) as units_sold,
    round(sum(length(item) * 100.5::double), 2) as revenue
  from bought join names using (item) group by item, source_product_name),
r as (select *, dense_rank() over (order by revenue desc, units_sold desc, product_name)::int
  as revenue_rank from s)
select * from r where revenue_rank <= 3""",
        "job_follow_ups": f"with {_JOB_NEXT} select * from fu",
        "job_mean_delay": f"""with {_JOB_NEXT}
select round(avg(days_between), 2) as average_days_iphone_to_airpods,
  count(*) as qualifying_sequences from fu""",
        "job_exact_sets": f"""with bought as (select o_custkey as cid,
    case o_orderstatus when 'F' then 'iPhone' when 'O' then 'AirPods' else 'MacBook' end as item
  from orders), {_CU}, own as (select cid,
    list_sort(list(distinct item)) as items from bought group by cid)
select cid as customer_id, customer_name, location, array_to_string(items, ',') as products
from own join cu using (cid) where items = ['AirPods', 'iPhone']""",
        "job_journeys": f"""with {_BOUGHT}, {_CU}, ls as (select cid,
    list(item order by d, tid) as items, min(d) as first_d from bought group by cid)
select cid as customer_id, customer_name, items[1] as first_product,
  first_d as first_purchase_date, 0::bigint as segment,
  coalesce(array_to_string(items[2:], ','), '') as subsequent_products
from ls join cu using (cid)""",
        "job_quality": f"""with tx as (select o_orderkey as transaction_id,
    o_custkey as customer_id, case when o_orderpriority < '4' then o_orderpriority
      else 'iPad' end as product_name, o_orderdate as transaction_date from orders),
  people as (select c_custkey as customer_id, c_name as customer_name, 1 as join_date,
    n_name as location from customer join nation on c_nationkey = n_nationkey),
  goods as (select product_name, min(transaction_id) as product_id, 'device' as category,
    1 as price from tx group by product_name) {_REPORT}""",
        "job_quality_dirty": f"""with tx as (select
    o_orderkey - (case when o_orderkey % 7 = 0 then 1 else 0 end) as transaction_id,
    case when o_custkey % 11 <> 0 then o_custkey end as customer_id,
    'p' || (o_orderkey % 60) as product_name, o_orderdate as transaction_date from orders),
  people as (select c_custkey // 2 as customer_id,
    case when c_nationkey <> 3 then c_name end as customer_name, 1 as join_date,
    c_nationkey as location from customer where c_custkey % 5 <> 0),
  goods as (select p_partkey as product_id, 'p' || (p_partkey % 50) as product_name,
    case when p_size <> 9 then p_type end as category, p_retailprice - 1200.0 as price
  from part) {_REPORT}""",
    }
    if _llm:
        found |= _llm.oracle_sql()
    if _pipeline and _pipeline.ORACLE_SQL:
        found["pipeline"] = _pipeline.ORACLE_SQL
    return found
