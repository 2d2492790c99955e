"""Queries that publish tables and read them back: sinks, table upkeep,
layer runs and the post-run checks.

Each call works in fresh schemas (a new name per call) in the session's
warehouse, so runs never meet; the returned ``DataFrame`` reads the
published tables lazily.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.audit import INGESTION_TIME
from strata.plans import catalogue as cat
from strata.plans.pipeline import (LayerConfig, all_tables, loads_from, reset_pipeline,
                                   run_clean_layer, run_pipeline, run_raw_layer,
                                   run_summary_layer)
from strata.plans.queries import raw
from strata.plans.validate import reconcile_clean, reconcile_totals, row_counts, schema_of, table_list
from strata.sinks.tables import compact_table, ensure_schema, publish
from strata.sources.fixtures import RAW_VIEWS, raw_ctes, table
from strata.sources.retry import RetryPolicy, TRANSIENT_MESSAGE


# tables of a layer published as concurrent jobs in the registered queries
PARALLEL_TABLES = 5


def workspace(tag: str) -> LayerConfig:
    """Layer schemas unique to one call: ``strata_<tag>_<id>_{bronze,silver,gold}``."""
    run = f"strata_{tag}_{uuid.uuid4().hex[:10]}"
    return LayerConfig(raw=f"{run}_{cat.RAW}", cleaned=f"{run}_{cat.CLEANED}",
                       aggregated=f"{run}_{cat.AGGREGATED}", state=f"{run}_state", max_parallel=PARALLEL_TABLES)


def fixture_loads(sf_dir: str):
    return loads_from({t: (lambda spark, t=t: RAW_VIEWS[t](spark, sf_dir)) for t in RAW_VIEWS})


def _scratch_table(spark: SparkSession, config: LayerConfig, name: str) -> str:
    ensure_schema(spark, config.catalog, config.raw)
    return config.raw_table(name)


# ------------------------------------------------------------------ sources

def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish ``part``, read it back by qualified name."""
    config = workspace("scan")
    name = _scratch_table(spark, config, "part")
    publish(table(spark, sf_dir, "part"), name)
    return spark.read.table(name)


class _FlakySource:
    """A reader that fails ``failures`` times with a transient error first."""

    def __init__(self, sf_dir: str, failures: int):
        self.sf_dir, self.failures, self.calls = sf_dir, failures, 0

    def __call__(self, spark: SparkSession) -> DataFrame:
        self.calls += 1
        if self.calls <= self.failures:
            raise RuntimeError(f"Database is {TRANSIENT_MESSAGE}; try again later")
        return table(spark, self.sf_dir, "orders")


def load_with_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: a source down twice, then up; the load retries read and write."""
    from strata.specs import LoadSpec

    config = replace(workspace("retry"), retry=RetryPolicy(delay_seconds=0.0, sleep=lambda s: None))
    source = _FlakySource(sf_dir, failures=2)
    (run,) = run_raw_layer(spark, config, [LoadSpec(target="orders", reader=source)])
    return (spark.table(config.raw_table("orders")).drop(INGESTION_TIME)
            .withColumn("attempts", F.lit(run.attempts).cast("long")))


# -------------------------------------------------------------------- sinks

def overwrite_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/K2: ``(key, name)`` then ``(key, balance)`` -> ``(key, name NULL, balance)``."""
    config = workspace("merge")
    name = _scratch_table(spark, config, "customer")
    c = table(spark, sf_dir, "customer")
    publish(c.select("c_custkey", "c_name"), name, schema_policy="merge")
    publish(c.select("c_custkey", "c_acctbal"), name, schema_policy="merge")
    return spark.table(name)


def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/K3: same schema written twice -> the second content."""
    config = workspace("overwrite")
    name = _scratch_table(spark, config, "customer")
    c = table(spark, sf_dir, "customer")
    publish(c, name, schema_policy="strict")
    publish(c.withColumn("c_name", F.upper("c_name")), name, schema_policy="strict")
    return spark.table(name)


def compact_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: ``orders`` written as 16 files, compacted, read back."""
    config = workspace("compact")
    name = _scratch_table(spark, config, "orders")
    publish(table(spark, sf_dir, "orders").repartition(16), name)
    compact_table(spark, name)
    return spark.table(name)


def reset_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: publish all 14 tables, drop them last-consumer first, list what is left."""
    config = workspace("reset")
    run_pipeline(spark, config, fixture_loads(sf_dir))
    reset_pipeline(spark, config)
    return table_list(spark, config.catalog, [config.raw, config.cleaned, config.aggregated]) \
        .withColumn("layer", F.regexp_extract("layer", r"_([a-z]+)$", 1))


# ------------------------------------------------------------------- layers

# columns of each published table compared by content (without the load time)
COLUMNS = {
    cat.CUSTOMERS: ("CustomerID", "EmailAddress", "CompanyName"),
    cat.ADDRESSES: ("AddressID", "AddressLine1", "AddressLine2", "City", "StateProvince",
                    "CountryRegion", "PostalCode"),
    cat.PRODUCTS: ("ProductID", "Name", "ProductNumber", "Color", "ListPrice"),
    cat.HEADERS: ("SalesOrderID", "CustomerID", "OrderDate", "PurchaseOrderNumber",
                  "AccountNumber", "ShipMethod", "TotalDue"),
    cat.DETAILS: ("SalesOrderID", "SalesOrderDetailID", "ProductID", "OrderQty", "ShipDate",
                  "SupplierID", "LineTotal"),
    cat.BY_COMPANY: ("CompanyName", "Total_Valid_Contacts"),
    cat.BY_COLOR: ("Color", "Total_Products", "Average_List_Price"),
    cat.SALES_BY_CUSTOMER: ("CompanyName", "Total_Orders", "Total_Revenue"),
    cat.SALES_BY_DAY: ("OrderDateKey", "Total_Orders", "Total_Revenue"),
}
AMOUNTS = ("ListPrice", "TotalDue", "OrderQty", "LineTotal", "Total_Revenue")


def row_text(table: str) -> str:
    """SQL text, valid in Spark and DuckDB, of a row as one string: the columns
    in order, NULL as ``~``, amounts with four decimals, a mean as its total."""
    def text(c: str) -> str:
        if c in AMOUNTS:
            c = f"cast({c} as decimal(28,4))"
        elif c == "Average_List_Price":
            c = "cast(Average_List_Price * Total_Products as decimal(28,2))"
        return f"coalesce(cast({c} as string), '~')"

    return " || '|' || ".join(text(c) for c in COLUMNS[table])


def _contents(spark: SparkSession, tables: Iterable[tuple[str, str, str]]) -> DataFrame:
    """``(table, n_rows, digest)`` for ``(label, table, qualified name)``.

    ``digest`` adds 24 bits of each row's MD5, so a changed, lost or repeated
    row shows; one aggregate per table, partial in every task."""
    digest = "cast(conv(substr(md5({}), 1, 6), 16, 10) as bigint)"
    frames = [spark.table(name).agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.sum(F.expr(digest.format(row_text(t)))).alias("digest"))
              .select(F.lit(label).alias("table"), "n_rows", "digest")
              for label, t, name in tables]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def all_contents(spark: SparkSession, config: LayerConfig) -> DataFrame:
    """Rows and digest of all 14 published tables, labelled ``layer.table``."""
    tables = ([(cat.RAW, t) for t in cat.CLEAN_ORDER] + [(cat.CLEANED, t) for t in cat.CLEAN_ORDER]
              + [(cat.AGGREGATED, t) for t in cat.SUMMARY_ORDER])
    return _contents(spark, [(f"{layer}.{t}", t, name)
                             for (layer, t), name in zip(tables, all_tables(config))])


def run_raw_layer_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five sources -> five raw tables; rows and digest per table."""
    config = workspace("raw")
    run_raw_layer(spark, config, fixture_loads(sf_dir))
    return _contents(spark, [(t, t, config.raw_table(t)) for t in cat.CLEAN_ORDER])


def run_clean_layer_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw -> five cleaned tables; rows and digest per table."""
    config = workspace("clean")
    run_raw_layer(spark, config, fixture_loads(sf_dir))
    run_clean_layer(spark, config)
    return _contents(spark, [(t, t, config.cleaned_table(t)) for t in cat.CLEAN_ORDER])


def run_summary_layer_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned -> four aggregate tables; rows and digest per table."""
    config = workspace("summary")
    run_raw_layer(spark, config, fixture_loads(sf_dir))
    run_clean_layer(spark, config)
    run_summary_layer(spark, config)
    return _contents(spark, [(t, t, config.aggregated_table(t)) for t in cat.SUMMARY_ORDER])


def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw -> cleaned -> aggregated; rows and digest of all 14 tables."""
    config = workspace("pipeline")
    run_pipeline(spark, config, fixture_loads(sf_dir))
    return all_contents(spark, config)


def published_sales_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published sales-by-day table read back in full (decimal
    revenue compared as double)."""
    config = workspace("gold")
    run_pipeline(spark, config, fixture_loads(sf_dir))
    df = spark.table(config.aggregated_table(cat.SALES_BY_DAY))
    return df.withColumn("Total_Revenue", F.col("Total_Revenue").cast("double"))


def ordered_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published sales-by-day table read back in full, latest day first."""
    return published_sales_by_day(spark, sf_dir).orderBy(F.desc("OrderDateKey"))


# ------------------------------------------------------------------- checks

def validate_table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: tables per layer after a run (5, 5, 4)."""
    config = workspace("list")
    run_pipeline(spark, config, fixture_loads(sf_dir))
    return table_list(spark, config.catalog, [config.raw, config.cleaned, config.aggregated]) \
        .withColumn("layer", F.regexp_extract("layer", r"_([a-z]+)$", 1))


def validate_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: columns of the raw customers table, ``_ingestion_time`` last."""
    config = workspace("schema")
    run_raw_layer(spark, config, [s for s in fixture_loads(sf_dir) if s.target == cat.CUSTOMERS])
    return schema_of(spark, config.raw_table(cat.CUSTOMERS))


def validate_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: ``count(*)`` of each published cleaned table."""
    config = workspace("counts")
    run_raw_layer(spark, config, fixture_loads(sf_dir))
    run_clean_layer(spark, config)
    return row_counts(spark, {t: config.cleaned_table(t) for t in cat.CLEAN_ORDER})


def reconcile_clean_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: input = duplicates + rejected + output, per cleaned table."""
    frames = [reconcile_clean(raw(spark, sf_dir, t), cat.CLEAN_SPECS[t]) for t in cat.CLEAN_ORDER]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def reconcile_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: order and revenue totals of G3 and G4 against the cleaned headers."""
    from strata.plans.queries import cleaned, summary

    return reconcile_totals(
        cleaned(spark, sf_dir, cat.HEADERS),
        {cat.SALES_BY_CUSTOMER: summary(spark, sf_dir, cat.SALES_BY_CUSTOMER, comparable=False, sort=False),
         cat.SALES_BY_DAY: summary(spark, sf_dir, cat.SALES_BY_DAY, comparable=False, sort=False)})


QUERIES = {
    "scan_table": scan_table,
    "load_with_retry": load_with_retry,
    "overwrite_merge_schema": overwrite_merge_schema,
    "overwrite_table": overwrite_table,
    "compact_table": compact_table_query,
    "reset_tables": reset_tables_query,
    "run_raw_layer": run_raw_layer_query,
    "run_clean_layer": run_clean_layer_query,
    "run_summary_layer": run_summary_layer_query,
    "layers_end_to_end": layers_end_to_end,
    "published_sales_by_day": published_sales_by_day,
    "ordered_read_back": ordered_read_back,
    "validate_table_list": validate_table_list,
    "validate_schema": validate_schema,
    "validate_row_counts": validate_row_counts,
    "reconcile_clean": reconcile_clean_query,
    "reconcile_summary": reconcile_summary_query,
}


def _count_rows(pairs) -> str:
    return "\nunion all\n".join(
        f"select '{label}' as \"table\", count(*) as n_rows from {view}" for label, view in pairs)


RAW_NAMES = ("r_customers", "r_addresses", "r_products", "r_headers", "r_details")
CLEAN_NAMES = ("s_customers", "s_addresses", "s_products", "s_headers", "s_details")


def _summary_views(customers: str, products: str, headers: str) -> dict[str, str]:
    return {
        cat.BY_COMPANY: f"(select CompanyName, count(CustomerID) as Total_Valid_Contacts from {customers} group by 1)",
        cat.BY_COLOR: f"""(select Color, count(ProductID) as Total_Products,
  cast(sum(ListPrice) as double) / count(ListPrice) as Average_List_Price
from {products} where Color is not null group by 1)""",
        cat.SALES_BY_CUSTOMER: f"""(select c.CompanyName, count(distinct h.SalesOrderID) as Total_Orders,
  sum(h.TotalDue) as Total_Revenue
from {headers} h left join {customers} c on h.CustomerID = c.CustomerID group by 1)""",
        cat.SALES_BY_DAY: f"""(select cast(OrderDate as date) as OrderDateKey,
  count(distinct SalesOrderID) as Total_Orders, sum(TotalDue) as Total_Revenue
from {headers} group by 1)""",
    }


def _content_rows(triples) -> str:
    """``(label, table, view)`` -> the rows of ``_contents`` in DuckDB."""
    return "\nunion all\n".join(
        f"""select '{label}' as "table", count(*) as n_rows,
  cast(sum(cast('0x' || substr(md5({row_text(t)}), 1, 6) as bigint)) as bigint) as digest from {view}"""
        for label, t, view in triples)


def layers_sql(cleaned_ctes, headers: str = "headers") -> str:
    """All 14 tables of a full run; ``headers`` names the header views."""
    raw_views = [v.replace("headers", headers) for v in RAW_NAMES]
    clean_views = [v.replace("headers", headers) for v in CLEAN_NAMES]
    summaries = _summary_views("s_customers", "s_products", f"s_{headers}")
    triples = ([(f"{cat.RAW}.{t}", t, v) for t, v in zip(cat.CLEAN_ORDER, raw_views)]
               + [(f"{cat.CLEANED}.{t}", t, v) for t, v in zip(cat.CLEAN_ORDER, clean_views)]
               + [(f"{cat.AGGREGATED}.{t}", t, v) for t, v in summaries.items()])
    return cleaned_ctes(*clean_views) + "\n" + _content_rows(triples)


def oracle_sql(cleaned_ctes) -> dict[str, str]:
    raw_pairs = list(zip(cat.CLEAN_ORDER, RAW_NAMES))
    clean_pairs = list(zip(cat.CLEAN_ORDER, CLEAN_NAMES))
    summaries = _summary_views("s_customers", "s_products", "s_headers")
    all_clean = cleaned_ctes(*CLEAN_NAMES)
    by_day = cleaned_ctes("s_headers") + """
select cast(OrderDate as date) as OrderDateKey, count(distinct SalesOrderID) as Total_Orders,
  cast(sum(TotalDue) as double) as Total_Revenue
from s_headers group by 1"""
    dedupe_rows = {
        "r_customers": ("(select distinct * from r_customers)", "EmailAddress"),
        "r_addresses": ("(select distinct * from r_addresses)", "AddressLine1"),
        "r_products": ("(select distinct * from r_products)", "Name"),
        "r_headers": ("(select distinct * from r_headers)", "CustomerID"),
        "r_details": ("(select * from (select *, row_number() over (partition by SalesOrderID, "
                      "SalesOrderDetailID order by ProductID asc nulls last, OrderQty asc nulls last, "
                      "ShipDate asc nulls last, SupplierID asc nulls last, LineTotal asc nulls last) rn "
                      "from r_details) where rn = 1)", "ProductID"),
    }
    recon = "\nunion all\n".join(
        f"select '{t}' as \"table\", (select count(*) from {r}) as input, "
        f"(select count(*) from {r}) - (select count(*) from {dedupe_rows[r][0]}) as duplicates, "
        f"(select count(*) from {dedupe_rows[r][0]} where {dedupe_rows[r][1]} is null) as rejected, "
        f"(select count(*) from {s}) as output"
        for (t, r), (_, s) in zip(raw_pairs, clean_pairs))
    return {
        "scan_table": "select * from part",
        "load_with_retry": "select *, cast(3 as bigint) as attempts from orders",
        "overwrite_merge_schema":
            "select c_custkey, cast(null as varchar) as c_name, c_acctbal from customer",
        "overwrite_table": """select c_custkey, upper(c_name) as c_name, c_nationkey, c_acctbal, c_mktsegment
from customer""",
        "compact_table": "select * from orders",
        "reset_tables": f"""select '{cat.RAW}' as layer, cast(0 as bigint) as n_tables
union all select '{cat.CLEANED}', 0 union all select '{cat.AGGREGATED}', 0""",
        "run_raw_layer": raw_ctes(*RAW_NAMES) + "\n" + _content_rows((t, t, v) for t, v in raw_pairs),
        "run_clean_layer": all_clean + "\n" + _content_rows((t, t, v) for t, v in clean_pairs),
        "run_summary_layer": all_clean + "\n" + _content_rows((t, t, v) for t, v in summaries.items()),
        "layers_end_to_end": layers_sql(cleaned_ctes),
        "published_sales_by_day": by_day,
        "ordered_read_back": by_day,
        "validate_table_list": f"""select '{cat.RAW}' as layer, cast(5 as bigint) as n_tables
union all select '{cat.CLEANED}', 5 union all select '{cat.AGGREGATED}', 4""",
        "validate_schema": """select cast(0 as bigint) as position, 'CustomerID' as "column", 'bigint' as type
union all select 1, 'EmailAddress', 'string'
union all select 2, 'CompanyName', 'string'
union all select 3, '_ingestion_time', 'timestamp'""",
        "validate_row_counts": all_clean + "\n" + _count_rows(clean_pairs),
        "reconcile_clean": all_clean + "\n" + recon,
        "reconcile_summary": cleaned_ctes("s_customers", "s_headers") + f"""
, t as (select count(distinct SalesOrderID) as o, cast(sum(TotalDue) as double) as r from s_headers)
select '{cat.SALES_BY_CUSTOMER}' as summary, o as summary_orders, o as input_orders,
  cast(0 as bigint) as diff_orders, r as summary_revenue, r as input_revenue,
  cast(0 as double) as diff_revenue from t
union all
select '{cat.SALES_BY_DAY}', o, o, 0, r, r, cast(0 as double) from t""",
    }
