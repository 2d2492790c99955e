"""Upsert and change-capture apply without a transactional table format.

``upsert``: rows of the target whose key is not among the updates, plus all
updates (``left_anti`` join + ``unionByName``).  The anti join broadcasts the
update keys only when they are proven small, else both sides shuffle on the
key (AQE splits a skewed key).  Publishing goes through ``publish``, which
writes a staging table first, so the new content may be computed from the
very table it replaces.  With Delta installed, use ``MERGE INTO`` instead.

``apply_changes``: a change feed holds ``(key, sequence, op, columns...)``
rows; the last change per key wins (the deterministic dedupe, latest first,
with its pre-shuffle partial limit), deletes remove the key, the rest are
upserted.  NULL keys count as equal, as in the dedupe.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe
from strata.operators.joins import checked_join


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New content of ``target`` after inserting/replacing ``updates`` by key.

    ``updates`` must be unique on ``keys`` (dedupe it first otherwise): two
    updates of one key raise, as a transactional merge does."""
    updates = updates.select(*target.columns)
    if not updates.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"several updates of one key {list(keys)}: dedupe them first")
    kept = checked_join(target, updates.select(*keys), keys, "left_anti", null_safe=True)
    return kept.unionByName(updates)


def latest_changes(changes: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The last change per key (highest ``sequence``; ties by the other columns)."""
    rest = [c for c in changes.columns if c not in keys and c != sequence]
    order = [F.col(sequence).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in rest]
    return dedupe(changes, keys, order_by=order)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], sequence: str,
                  op: str = "op", delete_value: str = "D") -> DataFrame:
    """New content of ``target`` after applying a change feed."""
    last = latest_changes(changes, keys, sequence)
    touched = checked_join(target, last.select(*keys), keys, "left_anti", null_safe=True,
                           bound_by=changes.select(*keys))
    upserts = last.filter(~F.col(op).eqNullSafe(F.lit(delete_value))).select(*target.columns)
    return touched.unionByName(upserts)


def upsert_table(target: str, updates: DataFrame, keys: Sequence[str],
                 table_format: str = "parquet") -> str:
    """Upsert ``updates`` into the published table ``target``.

    Delta: one transactional ``MERGE INTO`` (matched keys updated, others
    inserted).  Other formats: a partitioned table has only its touched
    partitions rewritten (``merge_partitions``); any other is published anew
    from ``upsert`` above, through the staging swap of ``publish``."""
    from strata.sinks.partitions import merge_partitions
    from strata.sinks.tables import publish, table_layout

    spark = updates.sparkSession
    if table_format == "delta":
        view = f"__strata_updates_{uuid.uuid4().hex[:12]}"
        updates.createOrReplaceTempView(view)
        cond = " AND ".join(f"t.`{k}` <=> u.`{k}`" for k in keys)
        try:
            spark.sql(f"MERGE INTO {target} t USING {view} u ON {cond} "
                      "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")
        finally:
            spark.catalog.dropTempView(view)
        return target
    if table_layout(spark, target)[0]:
        merge_partitions(target, updates.select(*spark.table(target).columns), keys)
        return target
    return publish(upsert(spark.table(target), updates, keys), target, schema_policy="strict")


def apply_changes_table(target: str, changes: DataFrame, keys: Sequence[str], sequence: str,
                        op: str = "op", delete_value: str = "D") -> str:
    """Apply a change feed to the published table ``target``; of a partitioned
    table only the partitions that hold or get a changed key are rewritten."""
    from strata.sinks.partitions import merge_partitions
    from strata.sinks.tables import publish, table_layout

    spark = changes.sparkSession
    if not table_layout(spark, target)[0]:
        return publish(apply_changes(spark.table(target), changes, keys, sequence, op, delete_value), target,
                       schema_policy="strict")
    last = latest_changes(changes, keys, sequence)
    upserts = last.filter(~F.col(op).eqNullSafe(F.lit(delete_value))).select(*spark.table(target).columns)
    merge_partitions(target, upserts, keys, touched=changes.select(*keys))
    return target
