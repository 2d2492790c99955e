"""Compaction by file size: small files are packed together, large ones stay.

The sizes come from the scan's ``_metadata`` columns, and a filter on them
prunes the large files: they are neither read nor moved, and keep their
names.  Within each folder (a partition, or the table) the small files are
packed in the order of their age by running sums of their bytes, so a pack
has at most one and a half times the target and files written together
stay together.  A pack of one file is left as it is.

The packing is stored as a plan below the table, in a folder that readers
pass over, and the packs are written beside it by one Spark job.  Only when
that job has committed are packs moved in and the files they replace removed,
pack by pack.  A driver that dies before the commit leaves the table
untouched; after it, ``finish_compactions`` (also the first step of the next
compaction) carries the plan out: every step can be repeated.  Rows are never
missing; a reader that lists the folder while packs are moved in may see a
pack beside its sources, so compact between loads, one compaction at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.sinks.partitions import session_setting
from strata.sinks.tables import quote, table_layout
from strata.sinks.versions import _files, location

_PREFIX = "_compact-"
_PACK = "__strata_pack"
#: paths that a broadcast of the plan may hold; beyond them the plan is joined by a shuffle
BROADCAST_FILES = 100_000
#: files a task of the packing job holds open at once, a row group in memory each
OPEN_PACKS = 4


def file_sizes(spark: SparkSession, name: str, below: int | None = None) -> DataFrame:
    """``(file, bytes, changed)`` of the table's files that hold rows, from the scan's metadata columns."""
    files = spark.table(name)
    if below is not None:
        files = files.where(F.col("_metadata.file_size") < below)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
                        F.col("_metadata.file_modification_time").alias("changed")).distinct()


def plan_packs(files: DataFrame, target_bytes: int) -> DataFrame:
    """``(file, folder, pack)`` for the files of packs with two files or more."""
    folder = Window.partitionBy("folder")
    before = F.sum("bytes").over(folder.orderBy("changed", "file").rowsBetween(Window.unboundedPreceding, -1))
    placed = (files.withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))
              .withColumn("nth", F.floor(F.coalesce(before, F.lit(0)) / F.lit(target_bytes))))
    packs = (placed.groupBy(F.col("folder").alias("f"), F.col("nth").alias("k")).agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("f", "k", F.sha2(F.concat_ws("|", "f", "k"), 256).substr(1, 24).alias("pack")))
    return (placed.join(packs, (F.col("folder") == F.col("f")) & (F.col("nth") == F.col("k")))
            .select("file", "folder", "pack"))


def compact_small_files(spark: SparkSession, name: str, target_bytes: int = 128 << 20,
                        small: float = 0.5) -> int:
    """Pack the files below ``small`` of ``target_bytes`` of a Parquet table; how many packs were made."""
    partition_by, bucket_by = table_layout(spark, name)
    if bucket_by is not None:
        raise ValueError(f"{name} is bucketed: its file names carry the bucket, use compact_table")
    finish_compactions(spark, name)
    spark.catalog.refreshTable(name)
    work = f"{location(spark, name).rstrip('/')}/{_PREFIX}{uuid.uuid4().hex[:12]}"
    # stored first, so that the job, its retries and the clean-up all follow one plan
    plan_packs(file_sizes(spark, name, int(target_bytes * small)), target_bytes).write.parquet(f"{work}/plan")
    plan = spark.read.parquet(f"{work}/plan")
    n_files, n_packs = plan.agg(F.count(F.lit(1)), F.countDistinct("pack")).first()
    if n_packs:
        _write_packs(spark, name, partition_by, plan, n_files, n_packs, int(target_bytes * small), f"{work}/data")
    finish_compactions(spark, name)
    return n_packs


def _write_packs(spark: SparkSession, name: str, partition_by: Sequence[str], plan: DataFrame, n_files: int,
                 n_packs: int, below: int, out: str) -> None:
    keys = plan.select(F.col("file").alias("__strata_file"), F.col("pack").alias(_PACK))
    if n_files <= BROADCAST_FILES:
        keys = F.broadcast(keys)
    # the filter on the size prunes the scan to the small files
    columns = [quote(c) for c in spark.table(name).columns if c not in partition_by]
    rows = (spark.table(name).where(F.col("_metadata.file_size") < below)
            .select(*columns, F.col("_metadata.file_path").alias("__strata_at")))
    packed = rows.join(keys, F.col("__strata_at") == F.col("__strata_file")).select(*columns, _PACK)
    # a task gets a pack, or few: their rows go straight to their files, where a write by
    # partition else sorts all rows of the task first
    with session_setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_PACKS)):
        packed.repartition(n_packs, _PACK).write.partitionBy(_PACK).parquet(out)


def finish_compactions(spark: SparkSession, name: str) -> int:
    """Carry out the compactions whose packs are committed, drop what others left; how many were carried out."""
    base = location(spark, name)
    fs, p = _files(spark, base)
    done = 0
    for status in fs.listStatus(p) if fs.exists(p) else ():
        if not status.getPath().getName().startswith(_PREFIX):
            continue
        work = status.getPath()
        if fs.exists(_child(spark, work, "data/_SUCCESS")):
            _move_in(spark, fs, work)
            done += 1
        fs.delete(work, True)
    if done:
        spark.catalog.refreshTable(name)
    return done


def _child(spark: SparkSession, parent, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(parent, name)


def _path(spark: SparkSession, uri: str):
    """The path of a file name as ``_metadata`` gives it (an encoded URI)."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def _move_in(spark: SparkSession, fs, work) -> None:
    """Per pack: its files into the folder of those it replaces, then these removed; safe to repeat."""
    data = _child(spark, work, "data")
    plan = spark.read.parquet(_child(spark, work, "plan").toString())
    packs = plan.groupBy("pack").agg(F.first("folder").alias("folder"), F.collect_list("file").alias("files"))
    # names only, a pack at a time
    for r in packs.toLocalIterator():
        source = _child(spark, data, f"{_PACK}={r['pack']}")
        target = _path(spark, r["folder"])
        for f in fs.listStatus(source) if fs.exists(source) else ():
            part = f.getPath().getName()
            if not fs.rename(f.getPath(), _child(spark, target, f"pack-{r['pack']}-{part}")):
                raise OSError(f"could not move {f.getPath()} into {target}")
        for old in r["files"]:
            fs.delete(_path(spark, old), False)
