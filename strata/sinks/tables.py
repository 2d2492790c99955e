"""Catalog tables: names, schemas (layers), publishing, compaction, reset.

Publishing replaces a table's rows.  The new rows are first written to a
staging table next to the target (a new name per call); only when that write has finished (every
task committed, lost executors retried by Spark) is the old table dropped
and the staging table renamed into place.  A failed write therefore leaves
the old rows intact, and a plan may read the very table it replaces (which
a direct overwrite refuses).  The swap is two catalog operations, not one
transaction: a reader between them finds no table.  With Delta installed the
write is a single transactional overwrite instead.

Schema policy on replace:

* ``merge``   -- keep the old columns in their order, append new ones, fill
  missing ones with NULL; a changed type is an error (raw, cleaned layers);
* ``strict``  -- the schema must equal the old one (aggregate layer);
* ``replace`` -- the new schema wins.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STAGING_SUFFIX = "__staging"


class SchemaMismatch(ValueError):
    """A published table and new rows disagree on a column's type or set."""


def quote(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def qualified_name(catalog: str | None, schema: str, table: str) -> str:
    """``catalog.schema.table`` with each part quoted; no catalog -> two parts."""
    parts = ([catalog] if catalog else []) + [schema, table]
    return ".".join(quote(p) for p in parts)


def split_name(name: str) -> list[str]:
    """Parts of a (possibly quoted) qualified name."""
    parts, cur, inq, i = [], "", False, 0
    while i < len(name):
        ch = name[i]
        if ch == "`":
            if inq and i + 1 < len(name) and name[i + 1] == "`":
                cur += "`"
                i += 1
            else:
                inq = not inq
        elif ch == "." and not inq:
            parts.append(cur)
            cur = ""
        else:
            cur += ch
        i += 1
    parts.append(cur)
    return parts


def ensure_schema(spark: SparkSession, catalog: str | None, schema: str,
                  location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` (idempotent)."""
    target = ".".join(quote(p) for p in ([catalog] if catalog else []) + [schema])
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {target}{loc}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _merged(existing: StructType, new: DataFrame) -> DataFrame:
    """``new`` laid out on ``existing`` + new columns (missing ones NULL)."""
    new_types = {f.name: f.dataType for f in new.schema.fields}
    clashes = [f"{f.name}: {f.dataType.simpleString()} -> {new_types[f.name].simpleString()}"
               for f in existing.fields if f.name in new_types and new_types[f.name] != f.dataType]
    if clashes:
        raise SchemaMismatch("column type changed: " + ", ".join(clashes))
    old_names = {f.name for f in existing.fields}
    cols = [F.col(quote(f.name)) if f.name in new_types else F.lit(None).cast(f.dataType).alias(f.name)
            for f in existing.fields]
    cols += [F.col(quote(f.name)) for f in new.schema.fields if f.name not in old_names]
    return new.select(*cols)


def align_for_append(existing: StructType, new: DataFrame) -> DataFrame:
    """``new`` in the column order of ``existing``, missing columns as NULL.

    An append cannot add columns or change a type: either raises
    ``SchemaMismatch`` (republish with the ``merge`` policy instead)."""
    extra = [c for c in new.columns if c not in {f.name for f in existing.fields}]
    if extra:
        raise SchemaMismatch(f"new columns {extra}: publish with schema_policy='merge' first")
    return _merged(existing, new)


def _strict(existing: StructType, new: DataFrame) -> DataFrame:
    old = [(f.name, f.dataType) for f in existing.fields]
    got = [(f.name, f.dataType) for f in new.schema.fields]
    if old != got:
        raise SchemaMismatch(
            f"schema changed: {[(n, t.simpleString()) for n, t in old]} -> "
            f"{[(n, t.simpleString()) for n, t in got]}")
    return new


def publish(df: DataFrame, name: str, schema_policy: str = "merge",
            table_format: str = "parquet", partition_by: Sequence[str] = (),
            bucket_by: tuple[int, Sequence[str]] | None = None,
            contract: StructType | None = None, compression: str | None = None) -> str:
    """Replace the rows of table ``name`` with ``df`` (see module doc).

    ``contract`` (declared columns and types) is checked before anything is
    written; a breach raises and leaves the table as it was.  ``compression``
    names the file codec (e.g. ``zstd``); by default the session's.  A table
    replaced under ``merge`` or ``strict`` keeps its partition and bucket
    columns unless others are given."""
    if schema_policy not in ("merge", "strict", "replace"):
        raise ValueError(f"unknown schema policy {schema_policy!r}")
    if contract is not None:
        from strata.operators.quality import enforce_contract

        enforce_contract(df, contract)
    spark = df.sparkSession
    exists = table_exists(spark, name)
    out = df
    if exists and schema_policy != "replace":
        existing = spark.table(name).schema
        out = _merged(existing, df) if schema_policy == "merge" else _strict(existing, df)
        if not partition_by and bucket_by is None and table_format != "delta":
            partition_by, bucket_by = table_layout(spark, name)

    if table_format == "delta":
        writer = out.write.format("delta").mode("overwrite")
        if schema_policy == "merge":
            writer = writer.option("mergeSchema", "true")
        elif schema_policy == "replace":
            writer = writer.option("overwriteSchema", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(name)
        return name

    parts = split_name(name)
    # A staging name of its own per call: a failed write job leaves its (empty)
    # folder behind without a catalog entry, and a retry must not collide with it.
    staging_parts = parts[:-1] + [f"{parts[-1]}{STAGING_SUFFIX}_{uuid.uuid4().hex[:12]}"]
    staging = ".".join(quote(p) for p in staging_parts)
    writer = out.write.format(table_format).mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    try:
        writer.saveAsTable(staging)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    # the new rows are committed; swap them in
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    target_in_schema = ".".join(quote(p) for p in parts[-2:]) if len(parts) >= 2 else quote(parts[-1])
    spark.sql(f"ALTER TABLE {staging} RENAME TO {target_in_schema}")
    if partition_by:
        # partition entries still name the staging folders: re-read them from
        # the table's own folder
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    return name


def table_layout(spark: SparkSession, name: str) -> tuple[list[str], tuple[int, list[str]] | None]:
    """``(partition columns, (buckets, bucket columns) or None)`` from the catalog."""
    cols = spark.catalog.listColumns(name)
    parts = [c.name for c in cols if c.isPartition]
    bucket_cols = [c.name for c in cols if c.isBucket]
    if not bucket_cols:
        return parts, None
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return parts, (int(info["Num Buckets"]), bucket_cols)


def compact_table(spark: SparkSession, name: str, table_format: str = "parquet",
                  target_files: int | None = None) -> str:
    """Rewrite a table into fewer, evenly sized files; rows and layout unchanged.

    Delta: ``OPTIMIZE``.  Other formats: rewrite through a ``rebalance``
    hint (AQE sizes the output partitions to
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``), or to exactly
    ``target_files`` files when given; partition and bucket columns are kept
    (a partitioned table is rebalanced by its partition columns)."""
    if table_format == "delta":
        spark.sql(f"OPTIMIZE {name}")
        return name
    partition_by, bucket_by = table_layout(spark, name)
    df = spark.table(name)
    if target_files:
        df = df.repartition(target_files, *partition_by) if partition_by else df.repartition(target_files)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    else:
        df = df.hint("rebalance")
    return publish(df, name, schema_policy="strict", table_format=table_format,
                   partition_by=partition_by, bucket_by=bucket_by)


def reset_tables(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """``DROP TABLE IF EXISTS`` each name, in the order given (pass the last
    consumers first)."""
    dropped = []
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
        dropped.append(n)
    return dropped


def file_count(spark: SparkSession, name: str) -> int:
    """Number of data files behind a table (metadata only)."""
    return len(spark.table(name).inputFiles())
