"""Raw source views over the driver's TPC-H-style tables.

The reference reads five relational tables (customers, addresses, products,
order headers, order details).  These views map the driver's parquet tables
onto those five shapes and add the dirt the cleaning rules exist for: NULL
required fields, padded text and duplicate rows.  Every view reads the whole
base table; the ``% n`` rules only decide which rows get a NULL or an extra
copy, they never remove a row.

The same views exist twice: as DataFrame code (used by the queries) and as
SQL text (used by the outside oracle).  The two must stay equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import checked_join

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _with_copies(df: DataFrame, copy_when: Column) -> DataFrame:
    """All rows, plus one exact copy of the rows matching ``copy_when``
    (``union all`` of the rows and the matching rows, made in one scan: each
    row is emitted once or twice)."""
    times = F.when(copy_when, F.lit(2)).otherwise(F.lit(1))
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(1), times))).drop("__copy")


def r_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    b = c.select(
        F.col("c_custkey").alias("CustomerID"),
        _null_when(F.col("c_custkey") % 11 == 0,
                   F.concat(F.lit("  "), F.col("c_name"), F.lit("@X.COM "))).alias("EmailAddress"),
        _null_when(F.col("c_custkey") % 13 == 0,
                   F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("  "))).alias("CompanyName"),
    )
    return _with_copies(b, F.col("CustomerID") % 5 == 0)


def r_customers_drops(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The customers in two raw drops: all of them, then addresses for those that
    have none (rejected before, kept now), another company for every seventh (it
    wins the dedupe) and copies of every fifth with a company that loses."""
    c = table(spark, sf_dir, "customer")
    key = F.col("CustomerID")
    b = c.select(
        F.col("c_custkey").alias("CustomerID"),
        _null_when(F.col("c_custkey") % 11 == 0,
                   F.concat(F.lit("  "), F.col("c_name"), F.lit("@X.COM "))).alias("EmailAddress"),
        _null_when(F.col("c_custkey") % 13 == 0,
                   F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("  "))).alias("CompanyName"))
    late = b.filter(key % 11 == 0).withColumn("EmailAddress", F.concat(F.lit(" late@X.COM"), key.cast("string")))
    moved = b.filter(key % 7 == 0).withColumn("CompanyName", F.lit("  MOVED"))
    losing = b.filter(key % 5 == 0).withColumn("CompanyName", F.lit("zzz"))
    return _with_copies(b, key % 5 == 0), late.unionByName(moved).unionByName(losing)


def r_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    b = checked_join(s, n.withColumnRenamed("n_nationkey", "s_nationkey"), ["s_nationkey"], "inner").select(
        key.alias("AddressID"),
        _null_when(key % 9 == 0, F.concat(F.lit("  "), F.col("s_name"))).alias("AddressLine1"),
        _null_when(key % 2 == 0,
                   F.concat(F.lit(" Unit "), key.cast("string"), F.lit(" "))).alias("AddressLine2"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("City"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("StateProvince"),
        F.concat(F.lit(" "), F.col("n_name")).alias("CountryRegion"),
        F.concat(F.lit(" "), key.cast("string"), F.lit(" ")).alias("PostalCode"),
    )
    return _with_copies(b, F.col("AddressID") % 3 == 0)


def r_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    b = p.select(
        key.alias("ProductID"),
        _null_when(key % 17 == 0, F.concat(F.lit(" "), F.col("p_name"))).alias("Name"),
        F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")).alias("ProductNumber"),
        _null_when(key % 7 == 0, F.concat(F.col("p_type"), F.lit(" "))).alias("Color"),
        F.col("p_retailprice").cast("decimal(19,4)").alias("ListPrice"),
    )
    return _with_copies(b, F.col("ProductID") % 4 == 0)


def _headers_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    b = o.select(
        key.alias("SalesOrderID"),
        _null_when(key % 19 == 0, F.col("o_custkey")).alias("CustomerID"),
        F.col("o_orderdate").alias("OrderDate"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")).alias("PurchaseOrderNumber"),
        F.concat(F.lit(" AC-"), F.col("o_custkey").cast("string")).alias("AccountNumber"),
        F.concat(F.col("o_orderstatus"), F.lit("  ")).alias("ShipMethod"),
        F.col("o_totalprice").cast("decimal(19,4)").alias("TotalDue"),
    )
    return b


def r_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_copies(_headers_base(spark, sf_dir), F.col("SalesOrderID") % 3 == 0)


def r_headers_drops(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The order headers in two raw drops.

    First: four of five orders.  Second: the remaining orders (new keys,
    some without a customer), copies of every third order with a lower amount
    (they win the dedupe), copies of the orders without a customer that name
    one (rejected before, kept now) and copies of every seventh order without
    a customer (they lose)."""
    b = _headers_base(spark, sf_dir)
    key = F.col("SalesOrderID")
    late = (key % 5).eqNullSafe(0)
    lower = b.filter(key % 3 == 0).withColumn(
        "TotalDue", (F.col("TotalDue") - 1).cast("decimal(19,4)"))
    named = b.filter(key % 19 == 0).withColumn("CustomerID", F.lit(1).cast("long"))
    unnamed = b.filter(key % 7 == 0).withColumn("CustomerID", F.lit(None).cast("long"))
    second = b.filter(late)
    for more in (lower, named, unnamed):
        second = second.unionByName(more)
    return b.filter(~late), second


def r_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.col("l_linenumber").alias("SalesOrderDetailID"),
        _null_when(F.col("l_partkey") % 23 == 0, F.col("l_partkey")).alias("ProductID"),
        F.col("l_quantity").alias("OrderQty"),
        F.col("l_shipdate").alias("ShipDate"),
        F.col("l_suppkey").alias("SupplierID"),
        F.col("l_extendedprice").alias("LineTotal"),
    )


RAW_VIEWS = {
    "adventureworks_customers": r_customers,
    "adventureworks_addresses": r_addresses,
    "adventureworks_products": r_products,
    "adventureworks_salesorder_headers": r_headers,
    "adventureworks_salesorder_details": r_details,
}

# SQL text of the same views, for an outside engine (DuckDB) that has the
# base tables registered under their own names.
RAW_SQL = {
    "r_customers": """
with b as (select c_custkey as CustomerID,
    case when c_custkey % 11 = 0 then null else '  ' || c_name || '@X.COM ' end as EmailAddress,
    case when c_custkey % 13 = 0 then null else ' ' || c_mktsegment || '  ' end as CompanyName
  from customer)
select * from b union all select * from b where CustomerID % 5 = 0""",
    # both drops of r_customers_drops together
    "r_customers_drops": """
with b as (select c_custkey as CustomerID,
    case when c_custkey % 11 = 0 then null else '  ' || c_name || '@X.COM ' end as EmailAddress,
    case when c_custkey % 13 = 0 then null else ' ' || c_mktsegment || '  ' end as CompanyName
  from customer)
select * from b union all select * from b where CustomerID % 5 = 0
union all select * replace (' late@X.COM' || cast(CustomerID as varchar) as EmailAddress) from b where CustomerID % 11 = 0
union all select * replace ('  MOVED' as CompanyName) from b where CustomerID % 7 = 0
union all select * replace ('zzz' as CompanyName) from b where CustomerID % 5 = 0""",
    "r_addresses": """
with b as (select s_suppkey as AddressID,
    case when s_suppkey % 9 = 0 then null else '  ' || s_name end as AddressLine1,
    case when s_suppkey % 2 = 0 then null else ' Unit ' || cast(s_suppkey as varchar) || ' ' end as AddressLine2,
    ' ' || n_name || ' ' as City, n_name || ' ' as StateProvince, ' ' || n_name as CountryRegion,
    ' ' || cast(s_suppkey as varchar) || ' ' as PostalCode
  from supplier join nation on s_nationkey = n_nationkey)
select * from b union all select * from b where AddressID % 3 = 0""",
    "r_products": """
with b as (select p_partkey as ProductID,
    case when p_partkey % 17 = 0 then null else ' ' || p_name end as Name,
    ' ' || p_brand || ' ' as ProductNumber,
    case when p_partkey % 7 = 0 then null else p_type || ' ' end as Color,
    cast(p_retailprice as decimal(19,4)) as ListPrice
  from part)
select * from b union all select * from b where ProductID % 4 = 0""",
    "r_headers": """
with b as (select o_orderkey as SalesOrderID,
    case when o_orderkey % 19 = 0 then null else o_custkey end as CustomerID,
    o_orderdate as OrderDate,
    ' ' || o_orderpriority || ' ' as PurchaseOrderNumber,
    ' AC-' || cast(o_custkey as varchar) as AccountNumber,
    o_orderstatus || '  ' as ShipMethod,
    cast(o_totalprice as decimal(19,4)) as TotalDue
  from orders)
select * from b union all select * from b where SalesOrderID % 3 = 0""",
    # both drops of r_headers_drops together
    "r_headers_drops": """
with b as (select o_orderkey as SalesOrderID,
    case when o_orderkey % 19 = 0 then null else o_custkey end as CustomerID,
    o_orderdate as OrderDate,
    ' ' || o_orderpriority || ' ' as PurchaseOrderNumber,
    ' AC-' || cast(o_custkey as varchar) as AccountNumber,
    o_orderstatus || '  ' as ShipMethod,
    cast(o_totalprice as decimal(19,4)) as TotalDue
  from orders)
select * from b
union all select * replace (cast(TotalDue - 1 as decimal(19,4)) as TotalDue) from b where SalesOrderID % 3 = 0
union all select * replace (cast(1 as bigint) as CustomerID) from b where SalesOrderID % 19 = 0
union all select * replace (cast(null as bigint) as CustomerID) from b where SalesOrderID % 7 = 0""",
    # the first drop of r_headers_drops
    "r_headers_first": "select * from orders where o_orderkey % 5 <> 0 or o_orderkey is null",
    "r_details": """
select l_orderkey as SalesOrderID, l_linenumber as SalesOrderDetailID,
  case when l_partkey % 23 = 0 then null else l_partkey end as ProductID,
  l_quantity as OrderQty, l_shipdate as ShipDate, l_suppkey as SupplierID, l_extendedprice as LineTotal
from lineitem""",
}


def raw_ctes(*names: str) -> str:
    """``with`` clause text defining the named raw views (SQL side)."""
    parts = [f"{n} as ({RAW_SQL[n].strip()})" for n in names]
    return "with " + ",\n".join(parts)
