"""Replay-safe increments: raw rows kept by batch, and a ledger of batches.

A raw table with a batch layout is partitioned by ``_batch_id``.  A batch is
written by overwriting its own partition, so a batch that is delivered again
(a retried job, a replayed micro-batch) replaces itself instead of adding
copies.  The ledger is an append-only table with one row per batch, table
and finished phase; with it a run that died half-way goes on behind its last
finished phase, and a delivery of a finished batch is recognised and left
out.  A batch id stands for its rows: other rows under a known id raise
``BatchConflict`` before anything is written.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from strata.functions.audit import INGESTION_TIME, with_ingestion_time
from strata.operators.dedupe import default_tie_break
from strata.sinks.partitions import overwrite_partitions
from strata.sinks.tables import publish, table_exists

BATCH = "_batch_id"
#: the batch of a full load
FULL = "full"
#: phases of a batch on its way through the layers, in order
PHASES = ("raw", "delta", "cleaned", "done")

LEDGER_SCHEMA = StructType([
    StructField("table", StringType(), False),
    StructField("batch_id", StringType(), False),
    StructField("phase", StringType(), False),
    StructField("rows", LongType(), True),
    StructField("digest", StringType(), True),
    StructField("logged_at", TimestampType(), True),
])


_lock = threading.Lock()


class BatchConflict(ValueError):
    """A known batch id was delivered with other rows."""


@dataclass(frozen=True)
class Entry:
    phase: str
    rows: int | None
    digest: str | None


def content(df: DataFrame) -> tuple[int, str]:
    """``(rows, digest)`` of a frame, whatever its order and partitions: one
    aggregate, every task sends two numbers.  Map columns do not count."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in default_tie_break(df, ())]).cast("decimal(38,0)")
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(hashed), F.lit(0)).cast("string").alias("d")).first()
    return int(r["n"]), r["d"]


class Ledger:
    """The batches of the tables of one raw layer."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def log(self, table: str, batch_id: str, phase: str, rows: int | None = None, digest: str | None = None) -> None:
        row = self.spark.createDataFrame([(table, batch_id, phase, rows, digest, None)], LEDGER_SCHEMA)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LEDGER_SCHEMA.fields)
        # tables of a layer are loaded by several threads: one entry at a time
        with _lock:
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet")
            row.withColumn("logged_at", F.current_timestamp()).coalesce(1).write.mode("append").saveAsTable(self.name)

    def entry(self, table: str, batch_id: str) -> Entry | None:
        """The furthest phase of a batch since the table's last full load."""
        if not table_exists(self.spark, self.name):
            return None
        self.spark.catalog.refreshTable(self.name)
        own = self.spark.table(self.name).where(F.col("table") == table)
        last_full = own.where(F.col("batch_id") == FULL).agg(F.max("logged_at")).first()[0]
        mine = own.where(F.col("batch_id") == batch_id)
        if last_full is not None:
            mine = mine.where(F.col("logged_at") >= F.lit(last_full))
        # at most a row per phase and attempt
        found = sorted(mine.collect(), key=lambda r: PHASES.index(r["phase"]))
        if not found:
            return None
        first = next((r for r in found if r["digest"] is not None), found[0])
        return Entry(found[-1]["phase"], first["rows"], first["digest"])

    def reached(self, entry: Entry | None, phase: str) -> bool:
        return entry is not None and PHASES.index(entry.phase) >= PHASES.index(phase)


def publish_full(df: DataFrame, name: str, schema_policy: str = "merge", compression: str | None = None) -> str:
    """Replace a raw table by a full load, its rows in the batch ``full``."""
    return publish(df.withColumn(BATCH, F.lit(FULL)), name, schema_policy=schema_policy, partition_by=(BATCH,),
                   compression=compression)


def write_batch(rows: DataFrame, name: str, table: str, batch_id: str, ledger: Ledger) -> Entry | None:
    """Write a batch into the raw table ``name`` unless the ledger has it.

    Returns the ledger's entry from before, ``None`` for a new batch."""
    if batch_id == FULL:
        raise ValueError(f"batch id {FULL!r} names the full load")
    known = ledger.entry(table, batch_id)
    n, digest = content(rows)
    if known and (known.rows, known.digest) != (n, digest):
        raise BatchConflict(f"batch {batch_id!r} of {table}: {n} rows now, {known.rows} before, or other values")
    if not ledger.reached(known, "raw"):
        spark = rows.sparkSession
        out = with_ingestion_time(rows).withColumn(BATCH, F.lit(batch_id))
        if table_exists(spark, name):
            overwrite_partitions(out, name)
        else:
            publish(out, name, partition_by=(BATCH,))
        ledger.log(table, batch_id, "raw", n, digest)
    return known


def batch_rows(spark: SparkSession, name: str, batch_id: str) -> DataFrame:
    """The source columns of one batch, read from its partition."""
    return spark.table(name).where(F.col(BATCH) == batch_id).drop(BATCH, INGESTION_TIME)
