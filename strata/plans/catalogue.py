"""The reference's tables as specs: five cleaned tables, four aggregates.

Fixed values: the table names, column names and output names below are the
published contract of the reference's three layers and must stay as they are.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.specs import CleanSpec, JoinSpec, Metric, SummarySpec

# ---- fixed values: source relations and the raw/cleaned table names ----
SOURCE_TABLES = (
    ("SalesLT.Customer", "adventureworks_customers"),
    ("SalesLT.Address", "adventureworks_addresses"),
    ("SalesLT.Product", "adventureworks_products"),
    ("SalesLT.SalesOrderHeader", "adventureworks_salesorder_headers"),
    ("SalesLT.SalesOrderDetail", "adventureworks_salesorder_details"),
)
CUSTOMERS = "adventureworks_customers"
ADDRESSES = "adventureworks_addresses"
PRODUCTS = "adventureworks_products"
HEADERS = "adventureworks_salesorder_headers"
DETAILS = "adventureworks_salesorder_details"

# ---- fixed values: aggregate table names ----
BY_COMPANY = "customer_summary_by_company"
BY_COLOR = "product_summary_by_color"
SALES_BY_CUSTOMER = "sales_summary_by_customer"
SALES_BY_DAY = "sales_summary_by_day"

# ---- fixed values: layer (schema) names ----
RAW, CLEANED, AGGREGATED = "bronze", "silver", "gold"


CLEAN_SPECS: dict[str, CleanSpec] = {
    CUSTOMERS: CleanSpec(
        name=CUSTOMERS, keys=("CustomerID",), required=("EmailAddress",),
        lower_trim=("EmailAddress",), trim=("CompanyName",)),
    ADDRESSES: CleanSpec(
        name=ADDRESSES, keys=("AddressID",), required=("AddressLine1",),
        trim=("AddressLine1", "AddressLine2", "City", "StateProvince", "CountryRegion",
              "PostalCode")),
    PRODUCTS: CleanSpec(
        name=PRODUCTS, keys=("ProductID",), required=("Name",),
        trim=("Name", "Color"), upper_trim=("ProductNumber",)),
    HEADERS: CleanSpec(
        name=HEADERS, keys=("SalesOrderID",), required=("CustomerID",),
        trim=("PurchaseOrderNumber", "AccountNumber", "ShipMethod")),
    DETAILS: CleanSpec(
        name=DETAILS, keys=("SalesOrderID", "SalesOrderDetailID"), required=("ProductID",)),
}


def unique_columns(table: str) -> tuple[str, ...]:
    """Columns a cleaned table is unique on: its key, when the key is one column."""
    keys = CLEAN_SPECS[table].keys
    return keys if len(keys) == 1 else ()


SUMMARY_SPECS: dict[str, SummarySpec] = {
    BY_COMPANY: SummarySpec(
        name=BY_COMPANY, source=CUSTOMERS, group_by=("CompanyName",),
        metrics=(Metric("Total_Valid_Contacts", "count", "CustomerID"),),
        order_by=(("Total_Valid_Contacts", True),),
        unique=unique_columns(CUSTOMERS)),
    BY_COLOR: SummarySpec(
        name=BY_COLOR, source=PRODUCTS, group_by=("Color",),
        where_not_null=("Color",),
        metrics=(Metric("Total_Products", "count", "ProductID"),
                 Metric("Average_List_Price", "avg", "ListPrice")),
        order_by=(("Total_Products", True), ("Average_List_Price", True)),
        unique=unique_columns(PRODUCTS)),
    SALES_BY_CUSTOMER: SummarySpec(
        name=SALES_BY_CUSTOMER, source=HEADERS, group_by=("CompanyName",),
        join=JoinSpec(table=CUSTOMERS, on=("CustomerID",), columns=("CustomerID", "CompanyName"),
                      unique_on_key=True),
        metrics=(Metric("Total_Orders", "count_distinct", "SalesOrderID"),
                 Metric("Total_Revenue", "sum", "TotalDue")),
        order_by=(("Total_Revenue", True),),
        unique=unique_columns(HEADERS)),
    SALES_BY_DAY: SummarySpec(
        name=SALES_BY_DAY, source=HEADERS, group_by=("OrderDateKey",),
        derive=(("OrderDateKey", lambda: F.to_date(F.col("OrderDate"))),),
        metrics=(Metric("Total_Orders", "count_distinct", "SalesOrderID"),
                 Metric("Total_Revenue", "sum", "TotalDue")),
        order_by=(("OrderDateKey", True),),
        unique=unique_columns(HEADERS)),
}

# build order of the aggregate layer
SUMMARY_ORDER = (BY_COMPANY, BY_COLOR, SALES_BY_CUSTOMER, SALES_BY_DAY)
CLEAN_ORDER = (CUSTOMERS, ADDRESSES, PRODUCTS, HEADERS, DETAILS)
