"""Writes scoped to the touched partitions of a partitioned table.

``overwrite_partitions`` replaces exactly the partitions that the new rows
lie in (Spark's dynamic partition overwrite: the job writes to a staging
folder and its commit swaps whole partitions, so a task retried after a lost
executor leaves nothing behind).  Other partitions, their files and names
stay as they are.

``merge_partitions`` is an upsert or delete by key: a semi join of the keys
finds the partitions that hold them now (it reads only the key and partition
columns), the new rows name theirs; the content of these partitions, without
the touched keys and with the new rows, replaces them.  A partition that
loses its last row is dropped.  The list of touched partitions is metadata,
at most the table's number of partitions.  A merge that died half-way is
repaired by running it again: keys are found wherever they lie by then.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import checked_join
from strata.sinks.tables import align_for_append, quote, table_layout

_MODE = "spark.sql.sources.partitionOverwriteMode"


# writes under way per session and setting, and its value before the first of them: tables of a
# layer are written by several threads of one session
_under_way: dict[tuple[str, str], tuple[int, str | None]] = {}
_lock = threading.Lock()


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` set to ``value`` within the block; the session's own value
    comes back when its last such block ends."""
    at = spark._jsparkSession.sessionUUID(), key
    with _lock:
        n, before = _under_way.get(at, (0, spark.conf.get(key, None)))
        _under_way[at] = (n + 1, before)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            n, before = _under_way.pop(at)
            if n > 1:
                _under_way[at] = (n - 1, before)
            elif before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


def _dynamic(spark: SparkSession):
    """Partition overwrite by content.  (The per-write option does not reach
    an insert into a table: it would replace the whole table.)"""
    return session_setting(spark, _MODE, "dynamic")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    parts, _ = table_layout(spark, name)
    if not parts:
        raise ValueError(f"{name} is not partitioned")
    return parts


def overwrite_partitions(df: DataFrame, name: str, rebalance: bool = True) -> str:
    """Replace the partitions of table ``name`` that ``df`` has rows in.

    ``df`` may read the table itself.  With ``rebalance`` AQE gathers a
    partition's rows into evenly sized files, splitting a large partition."""
    spark = df.sparkSession
    out = align_for_append(spark.table(name).schema, df)
    if rebalance:
        out = out.hint("rebalance", *partition_columns(spark, name))
    with _dynamic(spark):
        out.write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)
    return name


def within(partition_by: Sequence[str], values: Sequence[Row]) -> Column:
    """The rows of these partitions, as a filter the scan prunes by."""
    if not values:
        return F.lit(False)
    if len(partition_by) == 1:
        col = F.col(quote(partition_by[0]))
        some = [v[0] for v in values if v[0] is not None]
        cond = col.isin(some) if some else F.lit(False)
        return cond | col.isNull() if len(some) < len(values) else cond
    return reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(quote(c)).eqNullSafe(F.lit(x)) for c, x in zip(partition_by, v)])
        for v in values])


def _distinct(df: DataFrame, partition_by: Sequence[str]) -> set[Row]:
    return set(df.select(*partition_by).distinct().collect())


def drop_partitions(spark: SparkSession, name: str, partition_by: Sequence[str], values: Sequence[tuple]) -> None:
    """Remove whole partitions, rows and catalog entries."""
    types = {f.name: f.dataType for f in spark.table(name).schema.fields}
    for v in values:
        spec = ", ".join(
            f"{quote(c)} = null" if x is None else f"{quote(c)} = cast('{str(x)}' as {types[c].simpleString()})"
            if not isinstance(x, str) else f"{quote(c)} = '" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
            for c, x in zip(partition_by, v))
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    if values:
        spark.catalog.refreshTable(name)


def merge_partitions(name: str, upserts: DataFrame, keys: Sequence[str], touched: DataFrame | None = None,
                     unique: bool = True) -> list[Row]:
    """Replace the rows of the ``touched`` keys by ``upserts`` (see module doc).

    ``touched`` defaults to the keys of ``upserts``; a key in it without a new
    row is deleted.  ``upserts`` must be unique on ``keys`` unless a key's rows
    are replaced as a whole (``unique=False``).  NULL keys match each other.
    Returns the partitions that were replaced or dropped."""
    spark = upserts.sparkSession
    target = spark.table(name)
    partition_by = partition_columns(spark, name)
    upserts = align_for_append(target.schema, upserts)
    if unique and not upserts.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"several updates of one key {list(keys)}: dedupe them first")
    touched = (upserts if touched is None else touched).select(*keys).distinct()
    new = _distinct(upserts, partition_by)
    # partitions that get new rows are replaced anyway: the scan passes over them
    others = target.where(~F.coalesce(within(partition_by, list(new)), F.lit(False)))
    held = _distinct(checked_join(others.select(*dict.fromkeys([*keys, *partition_by])), touched, keys, "left_semi",
                                  null_safe=True), partition_by)
    scope = sorted(held | new, key=repr)
    if not scope:
        return []
    kept = checked_join(target.where(within(partition_by, scope)), touched, keys, "left_anti", null_safe=True)
    # only partitions that get no new row can lose all they have
    losing = sorted(held, key=repr)
    left = _distinct(kept.where(within(partition_by, losing)), partition_by) if losing else set()
    overwrite_partitions(kept.unionByName(upserts), name)
    drop_partitions(spark, name, partition_by, [v for v in losing if v not in left])
    return scope
