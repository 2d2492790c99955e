"""Queries for tables kept up over many loads: replayed batches, aggregates
kept up by deltas, merges scoped to the touched partitions, histories that take
late versions, row contracts, accounting in the writing job, layouts, versions.

Every query reads whole driver tables and compares what is published in the
end with a full computation.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.history import fold_unchanged, has_hot_keys, merge_history_table, validity_ranges
from strata.operators.merge import apply_changes_table, upsert_table
from strata.plans import catalogue as cat
from strata.plans.extended import change_feed
from strata.operators.contracts import Reference, Rule, reference_report, rule_report, split_rows
from strata.plans.pipeline import (LayerConfig, append_clean_log, refresh_layers, run_clean_layer, run_pipeline,
                                   run_raw_layer)
from strata.plans.queries import cleaned, raw
from strata.plans.table_ops import _scratch_table, all_contents, fixture_loads, layers_sql, workspace
from strata.session import ensure_checkpoint_dir
from strata.operators.profiles import measure, store_profile, table_profile
from strata.sinks.compaction import compact_small_files
from strata.sinks.layout import publish_layout
from strata.sinks.tables import publish
from strata.sinks.versions import default_base, publish_version
from strata.sources.fixtures import RAW_VIEWS, r_customers_drops, r_headers_drops, raw_ctes, table
from strata.specs import LoadSpec

#: parts of cleaned tables and of aggregate states in the registered queries
PARTS = 16


def _first_drop(spark: SparkSession, sf_dir: str, config: LayerConfig) -> DataFrame:
    """The layers built from the first drop of order headers; returns the second."""
    first, second = r_headers_drops(spark, sf_dir)
    run_pipeline(spark, config, [
        LoadSpec(target=t, reader=(lambda s, t=t: first if t == cat.HEADERS else RAW_VIEWS[t](s, sf_dir)))
        for t in cat.CLEAN_ORDER])
    return second


def replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second drop of order headers delivered three times as one batch;
    rows and digest of all 14 tables, raw ones included, equal to one delivery."""
    config = replace(workspace("replay"), raw_batches=True)
    second = _first_drop(spark, sf_dir, config)
    for _ in range(3):
        refresh_layers(spark, config, cat.HEADERS, second, batch_id="second")
    return all_contents(spark, config)


def batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after the full loads and a batch delivered twice."""
    config = replace(workspace("ledger"), raw_batches=True)
    second = _first_drop(spark, sf_dir, config)
    for _ in range(2):
        refresh_layers(spark, config, cat.HEADERS, second, batch_id="second")
    return spark.table(config.ledger(spark).name).select("table", "batch_id", "phase", F.col("rows").alias("n_rows"))


def replayed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5/X10 streaming: the second drop lands as files and is carried through the
    layers, kept up by deltas, by a streaming query that runs twice, the second time
    without its checkpoint: the micro-batch comes again and changes nothing."""
    from strata.streaming.incremental import stream_files_into_layers

    config = replace(workspace("restream"), raw_batches=True, cleaned_parts=PARTS, state_parts=PARTS)
    second = _first_drop(spark, sf_dir, config)
    shared = ensure_checkpoint_dir(spark).rstrip("/")
    run = uuid.uuid4().hex[:10]
    landing = f"{shared}/strata-landing-{run}"
    second.write.mode("append").parquet(landing)
    for turn in (1, 2):
        stream_files_into_layers(spark, config, cat.HEADERS, landing, second.schema,
                                 f"{shared}/strata-stream-{run}-{turn}")
    return all_contents(spark, config)


def delta_kept_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1-G4 kept up by deltas: the second drop of order headers replaces the touched
    parts of the cleaned table only, the aggregates take its delta; all 14 tables."""
    config = replace(workspace("delta"), raw_batches=True, cleaned_parts=PARTS, state_parts=PARTS)
    refresh_layers(spark, config, cat.HEADERS, _first_drop(spark, sf_dir, config), batch_id="second")
    return all_contents(spark, config)


def delta_kept_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 kept up when the joined side changes: customers get a mail address or another
    company, their orders' subtotals move from group to group; sales by company."""
    config = replace(workspace("deltaside"), raw_batches=True, cleaned_parts=PARTS, state_parts=PARTS)
    first, second = r_customers_drops(spark, sf_dir)
    run_pipeline(spark, config, [LoadSpec(cat.CUSTOMERS, lambda s: first),
                                 LoadSpec(cat.HEADERS, lambda s: RAW_VIEWS[cat.HEADERS](s, sf_dir))],
                 summary_specs={n: cat.SUMMARY_SPECS[n] for n in (cat.SALES_BY_CUSTOMER, cat.BY_COMPANY)})
    refresh_layers(spark, config, cat.CUSTOMERS, second, batch_id="second",
                   summary_specs={n: cat.SUMMARY_SPECS[n] for n in (cat.SALES_BY_CUSTOMER, cat.BY_COMPANY)})
    sales = spark.table(config.aggregated_table(cat.SALES_BY_CUSTOMER))
    people = spark.table(config.aggregated_table(cat.BY_COMPANY)).withColumnRenamed("CompanyName", "c")
    return (sales.join(people, F.col("CompanyName").eqNullSafe(F.col("c")), "full")
            .select(F.coalesce("CompanyName", "c").alias("CompanyName"), "Total_Orders",
                    F.col("Total_Revenue").cast("double").alias("Total_Revenue"), "Total_Valid_Contacts"))


def upsert_orders_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 on a table partitioned by order year: orders of one year get a doubled price,
    others are new; only the years they lie in are rewritten."""
    config = workspace("upsertparts")
    target = _scratch_table(spark, config, "orders")
    orders = table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    pending = F.col("o_orderstatus").eqNullSafe("P")
    publish(orders.filter(~pending), target, partition_by=("o_year",))
    updates = (orders.filter(pending | (F.col("o_year") == 1996))
               .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    upsert_table(target, updates, ["o_orderkey"])
    return spark.table(target)


def _band(price):
    """Price band of an order, its partition."""
    return F.floor(price / 50000).cast("int")


def apply_order_changes_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7 on a table partitioned by price band: a changed price moves an order to
    another partition, deletes take it out of its own."""
    config = workspace("cdcparts")
    target = _scratch_table(spark, config, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    publish(orders.withColumn("band", _band(F.col("o_totalprice"))), target, partition_by=("band",))
    feed = change_feed(spark, sf_dir).withColumn("band", _band(F.col("o_totalprice")))
    apply_changes_table(target, feed, ["o_orderkey"], "seq")
    return spark.table(target)


HISTORY_KEYS, HISTORY_VERSION = ["o_custkey"], "o_orderdate"


def _histories(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Customers' order histories, whole and folded to changes of priority, published
    from two of three orders; the others come late, in two batches, one of them twice."""
    config = workspace("history")
    whole, changes = _scratch_table(spark, config, "orders"), _scratch_table(spark, config, "priorities")
    versions = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority",
        (F.pmod(F.xxhash64("o_custkey"), F.lit(PARTS))).cast("int").alias("part"))
    late = F.coalesce(F.col("o_orderkey") % 3 == 0, F.lit(True))
    first = versions.where(~late)
    hot = has_hot_keys(first, HISTORY_KEYS)
    publish(validity_ranges(first, HISTORY_KEYS, HISTORY_VERSION, ["o_orderkey"], hot=hot), whole, partition_by=("part",))
    folded = fold_unchanged(first, HISTORY_KEYS, HISTORY_VERSION, ["o_orderpriority"], ["o_orderkey"], hot=hot)
    publish(validity_ranges(folded, HISTORY_KEYS, HISTORY_VERSION, ["o_orderkey"], hot=hot), changes, partition_by=("part",))
    odd = F.coalesce(F.col("o_orderkey") % 2 == 1, F.lit(False))
    for batch in (versions.where(late & odd), versions.where(late & ~odd), versions.where(late & odd)):
        merge_history_table(whole, batch, HISTORY_KEYS, HISTORY_VERSION, ["o_orderkey"], changes, ["o_orderpriority"],
                            rows_per_slice=5000)
    return whole, changes


def merged_order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X8 kept up: late versions merged into stored ranges, equal to ranges over all."""
    return spark.table(_histories(spark, sf_dir)[0]).drop("part")


def merged_priority_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X8 folded: ranges in which a customer's order priority did not change, kept up too."""
    return spark.table(_histories(spark, sf_dir)[1]).drop("part")


def accounted_clean_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 in the writing job: input = duplicates + rejected + output per cleaned table,
    observed by the jobs that wrote them, from the run log."""
    config = replace(workspace("account"), accounting=True)
    run_raw_layer(spark, config, fixture_loads(sf_dir))
    runs = run_clean_layer(spark, config)
    return spark.table(append_clean_log(spark, config, uuid.uuid4().hex, runs)).drop("run_id")


#: what every order line and order must meet
DETAIL_RULES = (
    Rule("detail_product", "ProductID is not null"),
    Rule("detail_quantity", "OrderQty between 1 and 45"),
    Rule("detail_total", "LineTotal > 1000"),
    Rule("detail_shipped", "ShipDate >= timestamp_ntz'1996-01-01'"),
)
HEADER_RULES = (
    Rule("header_customer", "CustomerID is not null"),
    Rule("header_due", "TotalDue > 5000"),
    Rule("header_urgent_due", "trim(PurchaseOrderNumber) <> '1-URGENT' or TotalDue > 20000"),
)


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break each rule of the raw orders and order lines, all rules of a
    table in one pass, and references that the cleaned tables do not hold."""
    details, headers = raw(spark, sf_dir, cat.DETAILS), raw(spark, sf_dir, cat.HEADERS)
    reports = [
        rule_report(details, DETAIL_RULES), rule_report(headers, HEADER_RULES),
        reference_report(details, Reference("detail_order", ("SalesOrderID",), ("SalesOrderID",)),
                         cleaned(spark, sf_dir, cat.HEADERS)),
        reference_report(details, Reference("detail_product_known", ("ProductID",), ("ProductID",)),
                         cleaned(spark, sf_dir, cat.PRODUCTS)),
        reference_report(headers, Reference("header_customer_known", ("CustomerID",), ("CustomerID",)),
                         cleaned(spark, sf_dir, cat.CUSTOMERS))]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def contract_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders that break a rule, with the names of all they break."""
    _, bad = split_rows(raw(spark, sf_dir, cat.HEADERS), HEADER_RULES)
    return bad.select("SalesOrderID", "CustomerID", F.concat_ws(",", "broken_rules").alias("broken_rules"))


def _laid_out(spark: SparkSession, sf_dir: str, interleave: bool) -> DataFrame:
    config = workspace("layout")
    target = _scratch_table(spark, config, "orders")
    publish_layout(table(spark, sf_dir, "orders"), target, ["o_custkey", "o_orderdate"], PARTS, interleave)
    return spark.table(target)


def range_laid_out_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published in ranges of (customer, date), read back."""
    return _laid_out(spark, sf_dir, False)


def interleaved_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published in the order of the interleaved ranks of customer and date."""
    return _laid_out(spark, sf_dir, True)


def versioned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2/K3 published by versions: orders, then orders with a column more, computed
    from the table itself; one switch of the table's folder each."""
    config = workspace("versions")
    target = _scratch_table(spark, config, "orders")
    base = default_base(spark, target)
    publish_version(table(spark, sf_dir, "orders"), target, base)
    publish_version(spark.table(target).withColumn("o_year", F.year("o_orderdate")), target, base)
    publish_version(spark.table(target).withColumn("o_totalprice", F.col("o_totalprice") * 2), target, base, "strict")
    return spark.table(target)


def _compacted(spark: SparkSession, sf_dir: str, partitioned: bool) -> DataFrame:
    config = workspace("packs")
    target = _scratch_table(spark, config, "orders")
    orders = table(spark, sf_dir, "orders")
    by = ("o_year",) if partitioned else ()
    if partitioned:
        orders = orders.withColumn("o_year", F.year("o_orderdate"))
    late = F.coalesce(F.col("o_orderkey") % 3 == 0, F.lit(True))
    publish(orders.where(~late).repartition(4, *by), target, partition_by=by)
    for i in (0, 1):
        drop = orders.where(late & (F.coalesce(F.col("o_orderkey") % 2, F.lit(0)) == i))
        drop.repartition(PARTS).write.mode("append").insertInto(target)
    spark.catalog.refreshTable(target)
    compact_small_files(spark, target)
    return spark.table(target)


def compacted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 by file size: orders loaded in one go and two late drops of many small files, packed."""
    return _compacted(spark, sf_dir, False)


def compacted_orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 by file size on a partitioned table: the small files of each year packed apart."""
    return _compacted(spark, sf_dir, True)


PROFILED = ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")


def merged_line_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 kept up: order lines arrive in four loads, one of them twice; the profile added up from
    the stored states, its estimates held against exact counts: within 4 % of the distinct
    values, the median's rank within 2 % of the rows."""
    config = workspace("profiles")
    states = _scratch_table(spark, config, "profiles")
    lines = table(spark, sf_dir, "lineitem").select(*PROFILED)
    for i in (0, 1, 2, 3, 1):
        store_profile(lines.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(4)) == i), states, f"load {i}")
    found = table_profile(spark, states, (0.5,))
    medians = {r["column"]: r["q50"] for r in found.collect()}     # a row a column
    numbers = {c: measure(F.col(c), lines.schema[c].dataType) for c in PROFILED}
    exact = lines.agg(F.array(*[F.struct(
        F.lit(c).alias("c"), F.count_distinct(c).alias("distinct"), F.count(c).alias("n"),
        F.count_if(numbers[c] < F.lit(medians[c])).alias("below"),
        F.count_if(numbers[c] <= F.lit(medians[c])).alias("upto")) for c in PROFILED]).alias("e"))
    exact = exact.select(F.explode("e").alias("e")).select("e.*")
    near = F.abs(F.col("n_distinct") - F.col("distinct")) <= F.greatest(F.lit(1.0), F.col("distinct") * 0.04)
    middle = (F.col("below") <= F.col("n") * 0.52) & (F.col("upto") >= F.col("n") * 0.48)
    return found.join(F.broadcast(exact), F.col("column") == F.col("c")).select(
        "column", "n_rows", "n_null", "n_blank", "least", "largest",
        near.alias("distinct_near"), middle.alias("median_near"))


QUERIES = {
    "compacted_orders": compacted_orders,
    "compacted_orders_by_year": compacted_orders_by_year,
    "merged_line_profiles": merged_line_profiles,
    "replayed_batch": replayed_batch,
    "batch_ledger": batch_ledger,
    "replayed_stream": replayed_stream,
    "delta_kept_layers": delta_kept_layers,
    "delta_kept_sales": delta_kept_sales,
    "upsert_orders_partitioned": upsert_orders_partitioned,
    "apply_order_changes_partitioned": apply_order_changes_partitioned,
    "merged_order_history": merged_order_history,
    "merged_priority_changes": merged_priority_changes,
    "accounted_clean_layer": accounted_clean_layer,
    "contract_violations": contract_violations,
    "contract_quarantine": contract_quarantine,
    "range_laid_out_orders": range_laid_out_orders,
    "interleaved_orders": interleaved_orders,
    "versioned_orders": versioned_orders,
}


def oracle_sql(cleaned_ctes, base: dict[str, str]) -> dict[str, str]:
    raw = dict(zip(cat.CLEAN_ORDER, ("r_customers", "r_addresses", "r_products", "r_headers_first", "r_details")))
    one_delivery = layers_sql(cleaned_ctes, "headers_drops")
    ledger = raw_ctes("r_customers", "r_addresses", "r_products", "r_headers_drops", "r_headers_first", "r_details")
    ledger += "\n" + "\nunion all\n".join(
        f"""select '{t}' as "table", 'full' as batch_id, 'done' as phase, (select count(*) from {v}) as n_rows"""
        for t, v in raw.items())
    ledger += f"""
union all select '{cat.HEADERS}', 'second', 'raw',
  (select count(*) from r_headers_drops) - (select count(*) from r_headers_first)
union all select '{cat.HEADERS}', 'second', 'cleaned', null
union all select '{cat.HEADERS}', 'second', 'done', null"""
    sales = cleaned_ctes("s_headers", "s_customers_drops") + """,
sales as (select c.CompanyName, count(distinct h.SalesOrderID) as Total_Orders, cast(sum(h.TotalDue) as double) as Total_Revenue
  from s_headers h left join s_customers_drops c on h.CustomerID = c.CustomerID group by 1),
people as (select CompanyName as c, count(CustomerID) as Total_Valid_Contacts from s_customers_drops group by 1)
select coalesce(CompanyName, c) as CompanyName, Total_Orders, Total_Revenue, Total_Valid_Contacts
from sales full join people on CompanyName is not distinct from c"""
    detail_rules = {"detail_product": "ProductID is not null", "detail_quantity": "OrderQty between 1 and 45",
                    "detail_total": "LineTotal > 1000", "detail_shipped": "ShipDate >= timestamp '1996-01-01'"}
    header_rules = {"header_customer": "CustomerID is not null", "header_due": "TotalDue > 5000",
                    "header_urgent_due": "trim(PurchaseOrderNumber) <> '1-URGENT' or TotalDue > 20000"}
    known = {"detail_order": ("r_details", "SalesOrderID", "s_headers"),
             "detail_product_known": ("r_details", "ProductID", "s_products"),
             "header_customer_known": ("r_headers", "CustomerID", "s_customers")}
    reports = [f"select '{n}' as rule, count(*) as n_rows, count(*) filter (where not coalesce({c}, false)) as n_broken from {v}"
               for v, rules in (("r_details", detail_rules), ("r_headers", header_rules)) for n, c in rules.items()]
    reports += [f"select '{n}' as rule, count(*) as n_rows, count(*) filter (where {c} is not null and not exists "
                f"(select 1 from {other} o where o.{c} = d.{c})) as n_broken from {v} d" for n, (v, c, other) in known.items()]
    profiles = []
    for c in PROFILED:
        text = c == "l_returnflag"
        number = f"length({c})::double" if text else f"{c}::double"
        blank = f"count(*) filter (where trim({c}) = '')" if text else "0::bigint"
        profiles.append(f"""select '{c}' as "column", count(*) as n_rows, count(*) - count({c}) as n_null, {blank} as n_blank,
  case when min({number}) = 0 then 0.0::double else min({number}) end as least,
  case when max({number}) = 0 then 0.0::double else max({number}) end as largest, true as distinct_near, true as median_near from lineitem""")
    names = ", ".join(f"case when not coalesce({c}, false) then '{n}' end" for n, c in header_rules.items())
    return {
        "accounted_clean_layer": base["reconcile_clean"],
        "contract_violations": cleaned_ctes("s_headers", "s_products", "s_customers").replace(
            "with ", raw_ctes("r_details") + ",\n", 1) + "\n" + "\nunion all\n".join(reports),
        "contract_quarantine": raw_ctes("r_headers") + f"""
select * from (select SalesOrderID, CustomerID, concat_ws(',', {names}) as broken_rules from r_headers)
where broken_rules <> ''""",
        "compacted_orders": "select * from orders",
        "compacted_orders_by_year": "select *, cast(year(o_orderdate) as int) as o_year from orders",
        "merged_line_profiles": "\nunion all\n".join(profiles),
        "range_laid_out_orders": "select * from orders",
        "interleaved_orders": "select * from orders",
        "versioned_orders": """select o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 as o_totalprice, o_orderdate,
  o_orderpriority, cast(year(o_orderdate) as int) as o_year from orders""",
        "replayed_batch": one_delivery,
        "batch_ledger": ledger,
        "replayed_stream": one_delivery,
        "delta_kept_layers": one_delivery,
        "delta_kept_sales": sales,
        "upsert_orders_partitioned": """select o_orderkey, o_custkey, o_orderstatus,
  case when o_orderstatus = 'P' or year(o_orderdate) = 1996 then o_totalprice * 2 else o_totalprice end as o_totalprice,
  o_orderdate, o_orderpriority, cast(year(o_orderdate) as int) as o_year
from orders""",
        "merged_order_history": base["customer_order_history"],
        "merged_priority_changes": """with one as (select o_custkey, o_orderdate, max(o_orderkey) as o_orderkey,
    arg_max(o_orderstatus, o_orderkey) as o_orderstatus, arg_max(o_orderpriority, o_orderkey) as o_orderpriority
  from orders group by 1, 2),
runs as (select *, lag(o_orderpriority) over w as was, row_number() over w as n from one
  window w as (partition by o_custkey order by o_orderdate asc nulls first))
select o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_orderpriority,
  lead(o_orderdate) over w as valid_to, lead(o_orderdate) over w is null as is_current
from runs where n = 1 or o_orderpriority is distinct from was
window w as (partition by o_custkey order by o_orderdate asc nulls first)""",
        "apply_order_changes_partitioned": f"""select o_orderkey, o_custkey, o_totalprice,
  cast(floor(o_totalprice / 50000) as int) as band from ({base["apply_order_changes"]})""",
    }
