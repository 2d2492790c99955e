"""Checks run after each layer (the reference does them by hand).

Counts and totals are Spark aggregates over whole tables.  Combining several
one-row aggregates is done by ``union`` + ``groupBy`` on a name column, never
by a cross join.  Catalog listings and schemas are metadata.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.operators.dedupe import dedupe
from strata.sinks.tables import STAGING_SUFFIX
from strata.specs import CleanSpec


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def table_list(spark: SparkSession, catalog: str | None, layers: Sequence[str]) -> DataFrame:
    """``(layer, n_tables)`` from the catalog (SHOW TABLES IN each layer)."""
    rows = []
    for layer in layers:
        ns = f"{catalog}.{layer}" if catalog else layer
        if not spark.catalog.databaseExists(ns):
            rows.append((layer, 0))
            continue
        names = [t.name for t in spark.catalog.listTables(ns) if not t.isTemporary
                 and not re.search(STAGING_SUFFIX + "_[0-9a-f]{12}$", t.name)]
        rows.append((layer, len(names)))
    schema = StructType([StructField("layer", StringType(), False),
                         StructField("n_tables", LongType(), False)])
    return spark.createDataFrame(rows, schema)


def schema_of(spark: SparkSession, name: str) -> DataFrame:
    """``(position, column, type)`` of a table (DESCRIBE TABLE)."""
    fields = spark.table(name).schema.fields
    schema = StructType([StructField("position", LongType(), False),
                         StructField("column", StringType(), False),
                         StructField("type", StringType(), False)])
    return spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)], schema)


def missing_columns(spark: SparkSession, name: str, required: Sequence[str]) -> list[str]:
    cols = set(spark.table(name).columns)
    return [c for c in required if c not in cols]


def row_counts(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """``(table, n_rows)`` for label -> qualified name, one lazy union."""
    return _union([spark.table(name).agg(F.count(F.lit(1)).alias("n_rows"))
                   .select(F.lit(label).alias("table"), "n_rows")
                   for label, name in tables.items()])


def preview(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows under a stated order (a ``LIMIT`` alone is any n rows)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)


def _required_missing(spec: CleanSpec) -> Column:
    if not spec.required:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.required])


def reconcile_clean(raw: DataFrame, spec: CleanSpec, label: str | None = None) -> DataFrame:
    """Raw -> cleaned accounting: ``input = duplicates + rejected + output``.

    ``duplicates`` are rows dropped by the dedupe, ``rejected`` rows dropped
    for a missing required value.  Two one-row aggregates (over the raw rows
    and over the deduped rows) are folded into one row by a union on the
    table label."""
    label = label or spec.name
    zero = F.lit(0).cast("long")
    missing = _required_missing(spec)
    if spec.dedupe_after_filter:
        # filter first: rejected are raw rows, the dedupe sees the rest
        kept = dedupe(raw.filter(~missing), spec.keys, spec.tie_break)
        parts = [raw.agg(F.count(F.lit(1)).alias("input"), F.count_if(missing).alias("rejected"),
                         zero.alias("kept")),
                 kept.agg(zero.alias("input"), zero.alias("rejected"),
                          F.count(F.lit(1)).alias("kept"))]
    else:
        deduped = dedupe(raw, spec.keys, spec.tie_break)
        parts = [raw.agg(F.count(F.lit(1)).alias("input"), zero.alias("rejected"),
                         zero.alias("kept")),
                 deduped.agg(zero.alias("input"), F.count_if(missing).alias("rejected"),
                             F.count(F.lit(1)).alias("kept"))]
    folded = _union([p.withColumn("table", F.lit(label)) for p in parts]).groupBy("table").agg(
        F.sum("input").alias("input"), F.sum("rejected").alias("rejected"),
        F.sum("kept").alias("kept"))
    if spec.dedupe_after_filter:
        output = F.col("kept")
        duplicates = F.col("input") - F.col("rejected") - F.col("kept")
    else:
        output = F.col("kept") - F.col("rejected")
        duplicates = F.col("input") - F.col("kept")
    return folded.select("table", "input", duplicates.alias("duplicates"), "rejected",
                         output.alias("output"))


def reconcile_totals(headers: DataFrame, summaries: dict[str, DataFrame],
                     orders_col: str = "Total_Orders", revenue_col: str = "Total_Revenue",
                     order_key: str = "SalesOrderID", amount: str = "TotalDue") -> DataFrame:
    """Order count and revenue of each summary against its cleaned input.

    One row per summary: its totals, the input's totals and the differences
    (0 when the summary lost or double-counted nothing)."""
    base = headers.agg(F.count_distinct(order_key).alias("o"),
                       F.sum(amount).alias("r"))
    parts = []
    for name, df in summaries.items():
        parts.append(df.agg(F.sum(orders_col).cast("long").alias("summary_orders"),
                            F.sum(revenue_col).alias("summary_revenue"),
                            F.lit(0).cast("long").alias("input_orders"),
                            F.lit(0).alias("input_revenue"))
                     .withColumn("summary", F.lit(name)))
        parts.append(base.select(F.lit(0).cast("long").alias("summary_orders"),
                                 F.lit(0).alias("summary_revenue"),
                                 F.col("o").cast("long").alias("input_orders"),
                                 F.col("r").alias("input_revenue"))
                     .withColumn("summary", F.lit(name)))
    folded = _union(parts).groupBy("summary").agg(
        *[F.sum(c).alias(c) for c in ("summary_orders", "summary_revenue",
                                      "input_orders", "input_revenue")])
    return folded.select(
        "summary", "summary_orders", "input_orders",
        (F.col("summary_orders") - F.col("input_orders")).alias("diff_orders"),
        F.col("summary_revenue").cast("double").alias("summary_revenue"),
        F.col("input_revenue").cast("double").alias("input_revenue"),
        # subtracted in the summaries' own type: decimals stay exact
        F.round(F.col("summary_revenue") - F.col("input_revenue"), 4).cast("double").alias("diff_revenue"))
