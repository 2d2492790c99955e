"""Incremental batch load by high-water mark.

The mark is the largest value of a column already in the target, one scalar
aggregate.  Source rows at the mark, above it or without a value are read
again; those the target holds already (by ``keys``, else by all source
columns, NULLs equal) are left out, the rest is appended.  So rows that
arrive later with the mark's own value or with NULL are not lost, and a
re-run adds nothing.  Only rows that arrive late *below* the mark are not
seen.  A failed append commits nothing (job commit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.audit import with_ingestion_time
from strata.operators.joins import null_safe_join
from strata.sinks.tables import align_for_append, publish, table_exists


def high_water_mark(spark: SparkSession, target: str, column: str):
    if not table_exists(spark, target):
        return None
    return spark.table(target).agg(F.max(column).alias("m")).first()["m"]


def incremental_load(spark: SparkSession, source: DataFrame, target: str, column: str,
                     audit: bool = True, keys: Sequence[str] | None = None) -> object:
    """Append the rows of ``source`` the target does not hold yet (see above).

    Returns the mark used (``None`` on the first load)."""
    mark = high_water_mark(spark, target, column)
    exists = table_exists(spark, target)

    def again(c):
        return F.lit(True) if mark is None else c.isNull() | (c >= F.lit(mark))

    new = source.filter(again(F.col(column)))
    if exists:
        keys = list(source.columns if keys is None else keys)
        held = spark.table(target).filter(again(F.col(column))).select(*keys)
        new = null_safe_join(new, held, keys, "left_anti")
    if audit:
        new = with_ingestion_time(new)
    if not exists:
        publish(new, target, schema_policy="replace")
    else:
        align_for_append(spark.table(target).schema, new).write.mode("append").saveAsTable(target)
    return mark
