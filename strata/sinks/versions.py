"""Atomic publishing without a transactional format: versions of a table.

Every publish writes its rows to a new folder below the table's base folder
and then points the table at it, one catalog operation: a reader sees the
old rows or the new ones, and never no table.  The files a running query has
listed stay until ``keep`` newer versions exist.  A write that fails or a driver that
dies before the switch leaves the table as it was; its folder goes with the next
publish.  The catalog entry stays one external table; dropping the table leaves
its folders to ``drop_versions``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.tables import _merged, _strict, quote, split_name, table_exists

_PREFIX = "version-"


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as its own kind."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def location(spark: SparkSession, name: str) -> str:
    """The folder that a table's rows lie in."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"]


def versions(spark: SparkSession, base: str) -> list[str]:
    """Version folders below ``base``, oldest first."""
    fs, p = _files(spark, base)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if n.startswith(_PREFIX))


def publish_version(df: DataFrame, name: str, base: str, schema_policy: str = "merge", keep: int = 2,
                    number: int | None = None) -> str:
    """Replace the rows of the unpartitioned table ``name``, whose versions lie below ``base``.

    ``df`` may read the table itself.  Schema policies as in ``publish``; a
    column that is added or lost is a change of the catalog entry beside the
    switch of its folder, so there a reader may see the new columns as NULL.
    Versions older than the last ``keep`` are removed."""
    if keep < 1:
        raise ValueError("keep at least the version that is read")
    spark = df.sparkSession
    exists = table_exists(spark, name)
    out = df
    if exists and schema_policy != "replace":
        old = spark.table(name).schema
        out = _merged(old, df) if schema_policy == "merge" else _strict(old, df)
    base = base.rstrip("/")
    known = versions(spark, base)
    if number is None:
        number = 1 + max((int(v.split("-")[1]) for v in known), default=0)
    folder = f"{base}/{_PREFIX}{number:012d}-{uuid.uuid4().hex[:8]}"
    out.write.mode("errorifexists").parquet(folder)
    if not exists:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{folder}'")
    else:
        fields = {f.name for f in spark.table(name).schema.fields}
        added = [f for f in out.schema.fields if f.name not in fields]
        if schema_policy == "replace" and out.schema.fieldNames() != spark.table(name).schema.fieldNames():
            raise ValueError("a versioned table cannot take another column order: drop it first")
        if added:
            columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    fs, _ = _files(spark, base)
    # a writer at work beside this one has the highest number: it is never among the oldest
    for old in versions(spark, base)[:-keep]:
        if not location(spark, name).rstrip("/").endswith(old):
            fs.delete(_files(spark, f"{base}/{old}")[1], True)
    return folder


def drop_versions(spark: SparkSession, name: str, base: str) -> None:
    """Drop the table and remove all of its versions."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    fs, _ = _files(spark, base)
    for old in versions(spark, base):
        fs.delete(_files(spark, f"{base.rstrip('/')}/{old}")[1], True)


def default_base(spark: SparkSession, name: str) -> str:
    """A base folder beside the managed tables of the warehouse."""
    parts = split_name(name)
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{parts[-2]}.versions/{parts[-1]}"
