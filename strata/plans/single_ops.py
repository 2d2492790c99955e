"""One query per single operator of the reference (projections, filters,
dedupe, scalar text functions, the join, aggregates, sorts).

Each runs over whole raw views or whole driver tables; the only ``limit``s
are in the sort/preview queries, where an ordered top-k is the feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.audit import INGESTION_TIME, with_ingestion_time
from strata.functions.dates import date_key
from strata.functions.text import lower_trim, trim_spaces, upper_trim
from strata.operators.dedupe import dedupe
from strata.operators.filters import require
from strata.operators.joins import checked_join
from strata.operators.summarise import summarise
from strata.plans import catalogue as cat
from strata.plans.queries import cleaned, raw
from strata.plans.validate import preview
from strata.sources.fixtures import raw_ctes, table
from strata.specs import Metric, SummarySpec

PREVIEW_ROWS = 10


def audit_ingestion_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load time per write -> n rows, no NULL, one distinct value."""
    df = with_ingestion_time(table(spark, sf_dir, "orders"))
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col(INGESTION_TIME).isNull()).alias("n_null"),
                  F.count_distinct(INGESTION_TIME).alias("n_distinct"))


def project_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two customer columns the join needs."""
    return cleaned(spark, sf_dir, cat.CUSTOMERS).select("CustomerID", "CompanyName")


def derive_date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar day of each order's timestamp."""
    return raw(spark, sf_dir, cat.HEADERS).select(
        "SalesOrderID", "OrderDate", date_key("OrderDate").alias("OrderDateKey"))


def filter_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop customers without an e-mail; blanks pass."""
    return require(raw(spark, sf_dir, cat.CUSTOMERS), ["EmailAddress"])


def dedupe_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lineitem row per order key (real differing duplicates)."""
    return dedupe(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


def dedupe_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with NULL keys: one raw order per customer; the orders without a
    customer are one group, so one of them stays (the first in order)."""
    return dedupe(raw(spark, sf_dir, cat.HEADERS), ["CustomerID"])


def dedupe_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order-detail row per (order, line)."""
    return dedupe(raw(spark, sf_dir, cat.DETAILS), ["SalesOrderID", "SalesOrderDetailID"])


def scalar_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trim every padded address column."""
    cols = ("AddressLine1", "AddressLine2", "City", "StateProvince", "CountryRegion", "PostalCode")
    return raw(spark, sf_dir, cat.ADDRESSES).select(
        "AddressID", *[trim_spaces(c).alias(c) for c in cols])


def scalar_lower_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail normalisation."""
    return raw(spark, sf_dir, cat.CUSTOMERS).select(
        "CustomerID", lower_trim("EmailAddress").alias("EmailAddress"))


def scalar_upper_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-number normalisation."""
    return raw(spark, sf_dir, cat.PRODUCTS).select(
        "ProductID", upper_trim("ProductNumber").alias("ProductNumber"))


def left_join_orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cleaned order with its customer's company (NULL if none)."""
    headers = cleaned(spark, sf_dir, cat.HEADERS)
    customers = cleaned(spark, sf_dir, cat.CUSTOMERS).select("CustomerID", "CompanyName")
    # cleaning only drops rows and trims text: the raw columns bound the cleaned ones
    bound = raw(spark, sf_dir, cat.CUSTOMERS).select("CustomerID", "CompanyName")
    return checked_join(headers, customers, ["CustomerID"], "left", bound_by=bound)


def _agg(spark, sf_dir, table_name, group, metric):
    spec = SummarySpec(name=metric.name, source=table_name, group_by=(group,), metrics=(metric,))
    return summarise(raw(spark, sf_dir, table_name), spec, comparable=True, sort=False)


def agg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/A2: non-null e-mails per company; the NULL company is a group."""
    return _agg(spark, sf_dir, cat.CUSTOMERS, "CompanyName", Metric("n_email", "count", "EmailAddress"))


def agg_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: mean list price per colour (NULL prices skipped)."""
    return _agg(spark, sf_dir, cat.PRODUCTS, "Color", Metric("avg_price", "avg", "ListPrice"))


def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: distinct orders per product over the raw details (true duplicates)."""
    return _agg(spark, sf_dir, cat.DETAILS, "ProductID",
                Metric("n_orders", "count_distinct", "SalesOrderID"))


def agg_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: revenue per customer over the raw headers (NULL customer a group)."""
    return _agg(spark, sf_dir, cat.HEADERS, "CustomerID", Metric("revenue", "sum", "TotalDue"))


def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales-by-day summary in full, date descending."""
    from strata.plans.queries import summary

    return summary(spark, sf_dir, cat.SALES_BY_DAY, comparable=True, sort=True)


def sort_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: products by colour in full, product count then mean price descending."""
    from strata.plans.queries import summary

    return summary(spark, sf_dir, cat.BY_COLOR, comparable=True, sort=True)


def preview_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3/V4: ten cleaned customers by key."""
    return preview(cleaned(spark, sf_dir, cat.CUSTOMERS), ["CustomerID"], PREVIEW_ROWS)


QUERIES = {
    "audit_ingestion_time": audit_ingestion_time,
    "project_subset": project_subset,
    "derive_date_key": derive_date_key,
    "filter_required": filter_required,
    "dedupe_single_key": dedupe_single_key,
    "dedupe_null_keys": dedupe_null_keys,
    "dedupe_composite_key": dedupe_composite_key,
    "scalar_trim": scalar_trim,
    "scalar_lower_trim": scalar_lower_trim,
    "scalar_upper_trim": scalar_upper_trim,
    "left_join_orders_customers": left_join_orders_customers,
    "agg_count": agg_count,
    "agg_avg": agg_avg,
    "agg_count_distinct": agg_count_distinct,
    "agg_sum": agg_sum,
    "sort_desc": sort_desc,
    "sort_two_keys": sort_two_keys,
    "preview_table": preview_table,
}

LINEITEM_REST = ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def oracle_sql(cleaned_ctes) -> dict[str, str]:
    li_order = ", ".join(f"{c} asc nulls last" for c in LINEITEM_REST)
    return {
        "audit_ingestion_time": """
select count(*) as n, cast(0 as bigint) as n_null, cast(1 as bigint) as n_distinct from orders""",
        "project_subset": cleaned_ctes("s_customers") + "\nselect CustomerID, CompanyName from s_customers",
        "derive_date_key": raw_ctes("r_headers") + """
select SalesOrderID, OrderDate, cast(OrderDate as date) as OrderDateKey from r_headers""",
        "filter_required": raw_ctes("r_customers") + """
select * from r_customers where EmailAddress is not null""",
        "dedupe_single_key": f"""
select * exclude(rn) from (select *, row_number() over (partition by l_orderkey order by {li_order}) rn
  from lineitem) where rn = 1""",
        "dedupe_null_keys": raw_ctes("r_headers") + """
select * exclude(rn) from (select *, row_number() over (partition by CustomerID
    order by SalesOrderID asc nulls last, OrderDate asc nulls last, PurchaseOrderNumber asc nulls last,
             AccountNumber asc nulls last, ShipMethod asc nulls last, TotalDue asc nulls last) rn
  from r_headers) where rn = 1""",
        "dedupe_composite_key": raw_ctes("r_details") + """
select * exclude(rn) from (select *, row_number() over (partition by SalesOrderID, SalesOrderDetailID
    order by ProductID asc nulls last, OrderQty asc nulls last, ShipDate asc nulls last,
             SupplierID asc nulls last, LineTotal asc nulls last) rn from r_details)
where rn = 1""",
        "scalar_trim": raw_ctes("r_addresses") + """
select AddressID, trim(AddressLine1) AddressLine1, trim(AddressLine2) AddressLine2, trim(City) City,
  trim(StateProvince) StateProvince, trim(CountryRegion) CountryRegion, trim(PostalCode) PostalCode
from r_addresses""",
        "scalar_lower_trim": raw_ctes("r_customers") + """
select CustomerID, lower(trim(EmailAddress)) as EmailAddress from r_customers""",
        "scalar_upper_trim": raw_ctes("r_products") + """
select ProductID, upper(trim(ProductNumber)) as ProductNumber from r_products""",
        "left_join_orders_customers": cleaned_ctes("s_customers", "s_headers") + """
select h.*, c.CompanyName from s_headers h
left join (select CustomerID, CompanyName from s_customers) c on h.CustomerID = c.CustomerID""",
        "agg_count": raw_ctes("r_customers") + """
select CompanyName, count(EmailAddress) as n_email from r_customers group by 1""",
        "agg_avg": raw_ctes("r_products") + """
select Color, cast(sum(ListPrice) as double) / count(ListPrice) as avg_price from r_products group by 1""",
        "agg_count_distinct": raw_ctes("r_details") + """
select ProductID, count(distinct SalesOrderID) as n_orders from r_details group by 1""",
        "agg_sum": raw_ctes("r_headers") + """
select CustomerID, cast(sum(TotalDue) as double) as revenue from r_headers group by 1""",
        "sort_desc": cleaned_ctes("s_headers") + """
select cast(OrderDate as date) as OrderDateKey, count(distinct SalesOrderID) as Total_Orders,
  cast(sum(TotalDue) as double) as Total_Revenue
from s_headers group by 1 order by OrderDateKey desc nulls last""",
        "sort_two_keys": cleaned_ctes("s_products") + """
select Color, count(ProductID) as Total_Products,
  cast(sum(ListPrice) as double) / count(ListPrice) as Average_List_Price
from s_products where Color is not null group by 1 order by 2 desc, 3 desc""",
        "preview_table": cleaned_ctes("s_customers") + """
select * from s_customers order by CustomerID asc nulls last limit 10""",
    }
