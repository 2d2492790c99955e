"""Queries for the items the reference names as its next steps (SURVEY
2.15): quality metrics, quarantine, load metrics, incremental loads (batch,
streaming, cleaned-table refresh, refresh through all layers), upsert,
change-capture apply, validity ranges of versions, bucketed layout, re-runs.

Every query reads whole driver tables; where a load is split in two drops
(incremental loads) the split is the feature and the final table is whole.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.audit import INGESTION_TIME
from strata.operators.clean import clean, refresh_cleaned
from strata.operators.history import validity_ranges
from strata.operators.merge import apply_changes, upsert_table
from strata.operators.quality import REJECT_REASON, clean_with_rejects, column_metrics
from strata.operators.summarise import summarise
from strata.plans import catalogue as cat
from strata.plans.pipeline import append_run_log, run_clean_layer, run_pipeline, run_raw_layer
from strata.plans.queries import raw
from strata.plans.table_ops import (_scratch_table, all_contents, fixture_loads, layers_sql,
                                    workspace)
from strata.session import ensure_checkpoint_dir
from strata.sinks.tables import publish
from strata.sources.fixtures import raw_ctes, table
from strata.sources.incremental import incremental_load
from strata.streaming.incremental import stream_files_into_table

# second drop of the incremental loads: orders from this day on
SECOND_DROP_FROM = "1998-01-01"


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs and blanks per column of the raw customers, one scan."""
    return column_metrics(raw(spark, sf_dir, cat.CUSTOMERS))


def quarantine_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw order-detail row the cleaning drops, with the reason."""
    _, rejects = clean_with_rejects(raw(spark, sf_dir, cat.DETAILS), cat.CLEAN_SPECS[cat.DETAILS])
    return rejects


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written per raw table, observed by the write jobs, from the run log."""
    config = workspace("metrics")
    runs = run_raw_layer(spark, config, fixture_loads(sf_dir))
    log = append_run_log(spark, config, uuid.uuid4().hex, runs)
    return spark.table(log).select("table", F.col("rows").alias("n_rows"), "attempts")


def incremental_batch_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded in two drops by high-water mark on the order date."""
    config = workspace("hwm")
    target = _scratch_table(spark, config, "orders")
    orders = table(spark, sf_dir, "orders")
    first = orders.filter(F.col("o_orderdate") < F.lit(SECOND_DROP_FROM).cast("timestamp_ntz"))
    incremental_load(spark, first, target, "o_orderdate")
    incremental_load(spark, orders, target, "o_orderdate")   # the source has grown
    incremental_load(spark, orders, target, "o_orderdate")   # nothing new: a no-op
    return spark.table(target).drop(INGESTION_TIME)


def stream_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 (streaming): orders landing as files in two drops, each taken once by
    an available-now streaming query into the raw table."""
    config = workspace("stream")
    target = _scratch_table(spark, config, "orders")
    shared = ensure_checkpoint_dir(spark).rstrip("/")
    run = uuid.uuid4().hex[:10]
    landing, checkpoint = f"{shared}/strata-landing-{run}", f"{shared}/strata-stream-{run}"
    orders = table(spark, sf_dir, "orders")
    cut = F.coalesce(F.col("o_orderdate") < F.lit(SECOND_DROP_FROM).cast("timestamp_ntz"), F.lit(False))
    orders.filter(cut).write.mode("append").parquet(landing)
    stream_files_into_table(spark, landing, orders.schema, target, checkpoint)
    orders.filter(~cut).write.mode("append").parquet(landing)
    stream_files_into_table(spark, landing, orders.schema, target, checkpoint)
    stream_files_into_table(spark, landing, orders.schema, target, checkpoint)  # nothing new
    return spark.table(target).drop(INGESTION_TIME)


def incremental_clean_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 on the cleaned layer: order headers published cleaned from a first
    drop; a second drop brings new orders, lower amounts that win, customers
    for orders rejected before and copies that lose; only the touched keys are
    cleaned again."""
    from strata.sources.fixtures import r_headers_drops

    config = workspace("incclean")
    spec = cat.CLEAN_SPECS[cat.HEADERS]
    first, second = r_headers_drops(spark, sf_dir)
    target = _scratch_table(spark, config, "headers_clean")
    publish(clean(first, spec), target)
    refreshed = refresh_cleaned(spark.table(target), first.unionByName(second), second, spec)
    publish(refreshed, target, schema_policy="strict")
    return spark.table(target)


def stream_layers_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 streaming through all layers: the layers are built from the first
    drop of order headers; the second drop lands as files and a streaming
    query carries it through raw, cleaned and aggregated tables; rows and digest
    of all 14 tables, equal to a full run."""
    from strata.sources.fixtures import RAW_VIEWS, r_headers_drops
    from strata.specs import LoadSpec
    from strata.streaming.incremental import stream_files_into_layers

    config = workspace("streamlayers")
    first, second = r_headers_drops(spark, sf_dir)
    loads = [LoadSpec(target=t, reader=(lambda s, t=t: first if t == cat.HEADERS
                                        else RAW_VIEWS[t](s, sf_dir)))
             for t in cat.CLEAN_ORDER]
    run_pipeline(spark, config, loads)
    shared = ensure_checkpoint_dir(spark).rstrip("/")
    run = uuid.uuid4().hex[:10]
    landing, checkpoint = f"{shared}/strata-landing-{run}", f"{shared}/strata-stream-{run}"
    second.write.mode("append").parquet(landing)
    stream_files_into_layers(spark, config, cat.HEADERS, landing, second.schema, checkpoint)
    return all_contents(spark, config)


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled and open orders published; then open and pending orders arrive
    with a doubled price -> open ones replaced, pending ones inserted."""
    config = workspace("upsert")
    target = _scratch_table(spark, config, "orders")
    orders = table(spark, sf_dir, "orders")
    pending = F.col("o_orderstatus").eqNullSafe("P")
    publish(orders.filter(~pending), target)
    updates = (orders.filter(pending | F.col("o_orderstatus").eqNullSafe("O"))
               .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    upsert_table(target, updates, ["o_orderkey"])
    return spark.table(target)


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as a change feed on orders: the line number orders the
    changes, a returned line deletes the order, any other sets its price."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linenumber").alias("seq"),
        F.when(F.col("l_returnflag") == "R", F.lit("D")).otherwise(F.lit("U")).alias("op"),
        F.col("l_suppkey").alias("o_custkey"),
        F.col("l_extendedprice").alias("o_totalprice"))


def apply_order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last change per order applied to the orders table."""
    config = workspace("cdc")
    target = _scratch_table(spark, config, "orders")
    publish(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), target)
    new = apply_changes(spark.table(target), change_feed(spark, sf_dir), ["o_orderkey"], "seq")
    publish(new, target, schema_policy="strict")
    return spark.table(target)


def customer_order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders as versions with validity ranges (next order
    date of the same customer, NULL for the current one)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority")
    return validity_ranges(orders, ["o_custkey"], "o_orderdate", tie_break=["o_orderkey"])


def order_status_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X8 with hot keys cut into slices: the orders of each status, whose few keys hold
    nearly all rows, versioned by year, so that a version is common too."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.year("o_orderdate").alias("o_year"), "o_orderkey", "o_totalprice")
    return validity_ranges(orders, ["o_orderstatus"], "o_year", tie_break=["o_orderkey"], rows_per_slice=500)


def bucketed_sales_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned tables bucketed by key; sales by company read from them."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    config = replace(workspace("bucket"), cleaned_buckets=n)
    run_raw_layer(spark, config, [s for s in fixture_loads(sf_dir)
                                  if s.target in (cat.CUSTOMERS, cat.HEADERS)])
    run_clean_layer(spark, config, [cat.CUSTOMERS, cat.HEADERS])
    spec = cat.SUMMARY_SPECS[cat.SALES_BY_CUSTOMER]
    return summarise(spark.table(config.cleaned_table(spec.source)), spec,
                     resolve=lambda t: spark.table(config.cleaned_table(t)),
                     comparable=True, sort=False)


def layers_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain run twice into the same tables; rows and digest of all 14."""
    config = workspace("rerun")
    run_pipeline(spark, config, fixture_loads(sf_dir))
    run_pipeline(spark, config, fixture_loads(sf_dir))
    return all_contents(spark, config)


def layers_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 through all layers: built from the first drop of order headers, then
    the second drop carried through (raw append, touched keys re-cleaned,
    aggregates rebuilt); rows and digest of all 14 tables, equal to a full run."""
    from strata.plans.pipeline import refresh_layers
    from strata.sources.fixtures import RAW_VIEWS, r_headers_drops
    from strata.specs import LoadSpec

    config = workspace("refresh")
    first, second = r_headers_drops(spark, sf_dir)
    loads = [LoadSpec(target=t, reader=(lambda s, t=t: first if t == cat.HEADERS
                                        else RAW_VIEWS[t](s, sf_dir)))
             for t in cat.CLEAN_ORDER]
    run_pipeline(spark, config, loads)
    refresh_layers(spark, config, cat.HEADERS, second)
    return all_contents(spark, config)


QUERIES = {
    "quality_metrics": quality_metrics,
    "quarantine_order_details": quarantine_order_details,
    "load_metrics": load_metrics,
    "incremental_batch_load": incremental_batch_load,
    "stream_incremental_load": stream_incremental_load,
    "incremental_clean_headers": incremental_clean_headers,
    "upsert_orders": upsert_orders,
    "apply_order_changes": apply_order_changes,
    "customer_order_history": customer_order_history,
    "order_status_history": order_status_history,
    "bucketed_sales_by_customer": bucketed_sales_by_customer,
    "layers_rerun": layers_rerun,
    "layers_refresh": layers_refresh,
    "stream_layers_refresh": stream_layers_refresh,
}


def oracle_sql(cleaned_ctes, base: dict[str, str]) -> dict[str, str]:
    cust_cols = ("CustomerID", "EmailAddress", "CompanyName")
    metrics = "\nunion all\n".join(
        f"select '{c}' as \"column\", count(*) as n_rows, count(*) filter (where {c} is null) as n_null, "
        + (f"count(*) filter (where trim({c}) = '') as n_blank" if c != "CustomerID"
           else "cast(0 as bigint) as n_blank")
        + " from r_customers" for c in cust_cols)
    details_order = ("ProductID asc nulls last, OrderQty asc nulls last, ShipDate asc nulls last, "
                     "SupplierID asc nulls last, LineTotal asc nulls last")
    detail_cols = "SalesOrderID, SalesOrderDetailID, ProductID, OrderQty, ShipDate, SupplierID, LineTotal"
    return {
        "quality_metrics": raw_ctes("r_customers") + "\n" + metrics,
        "quarantine_order_details": raw_ctes("r_details") + f""",
surv as (select {detail_cols} from (select *, row_number() over (
    partition by SalesOrderID, SalesOrderDetailID order by {details_order}) rn from r_details) where rn = 1)
select *, 'duplicate' as {REJECT_REASON} from (
  select {detail_cols} from r_details except all select {detail_cols} from surv)
union all
select *, 'missing:ProductID' as {REJECT_REASON} from surv where ProductID is null""",
        "load_metrics": raw_ctes("r_customers", "r_addresses", "r_products", "r_headers", "r_details")
        + "\n" + "\nunion all\n".join(
            f"select '{t}' as \"table\", count(*) as n_rows, cast(1 as bigint) as attempts from {v}"
            for t, v in zip(cat.CLEAN_ORDER, ("r_customers", "r_addresses", "r_products", "r_headers",
                                              "r_details"))),
        "incremental_batch_load": "select * from orders",
        "stream_incremental_load": "select * from orders",
        "incremental_clean_headers": cleaned_ctes("s_headers_drops") + "\nselect * from s_headers_drops",
        "upsert_orders": """select o_orderkey, o_custkey, o_orderstatus,
  case when o_orderstatus in ('O', 'P') then o_totalprice * 2 else o_totalprice end as o_totalprice,
  o_orderdate, o_orderpriority
from orders""",
        "apply_order_changes": """with feed as (
  select l_orderkey as o_orderkey, l_linenumber as seq,
    case when l_returnflag = 'R' then 'D' else 'U' end as op,
    l_suppkey as o_custkey, l_extendedprice as o_totalprice from lineitem),
last as (select * from (select *, row_number() over (partition by o_orderkey
    order by seq desc nulls last, op asc nulls last, o_custkey asc nulls last,
             o_totalprice asc nulls last) rn from feed) where rn = 1)
select o_orderkey, o_custkey, o_totalprice from orders
where o_orderkey not in (select o_orderkey from last)
union all
select o_orderkey, o_custkey, o_totalprice from last where op <> 'D'""",
        "customer_order_history": """select o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_orderpriority,
  lead(o_orderdate) over w as valid_to, lead(o_orderdate) over w is null as is_current
from orders
window w as (partition by o_custkey order by o_orderdate asc nulls first, o_orderkey asc nulls first)""",
        "order_status_history": """select o_orderstatus, o_year, o_orderkey, o_totalprice,
  lead(o_year) over w as valid_to, lead(o_year) over w is null as is_current
from (select o_orderstatus, cast(year(o_orderdate) as int) as o_year, o_orderkey, o_totalprice from orders)
window w as (partition by o_orderstatus order by o_year asc nulls first, o_orderkey asc nulls first)""",
        "bucketed_sales_by_customer": base["summary_sales_by_customer"],
        "layers_rerun": base["layers_end_to_end"],
        "layers_refresh": layers_sql(cleaned_ctes, "headers_drops"),
        "stream_layers_refresh": layers_sql(cleaned_ctes, "headers_drops"),
    }
