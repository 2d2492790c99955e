"""Available-now streaming load of landed files into a raw table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.functions.audit import with_ingestion_time
from strata.sinks.tables import align_for_append


def stream_files_into_table(spark: SparkSession, landing_path: str, schema: StructType,
                            target: str, checkpoint_location: str, file_format: str = "parquet",
                            max_files_per_trigger: int | None = None,
                            wait: bool = True, sink: str = "append") -> StreamingQuery:
    """Append every new file under ``landing_path`` to table ``target``.

    ``sink="append"`` (default): each micro-batch is appended with a batch
    write, so the target may hold rows written by batch jobs (a first full
    load, then increments).  At-least-once: a batch replayed after a failure
    is appended again; its copies carry a later ``_ingestion_time`` and the
    cleaning dedupe keeps the earlier ones.
    ``sink="table"``: Spark's file sink, exactly-once through its commit log
    in the table folder; readers then see only files the sink wrote, so use
    it only for a target that nothing else writes.

    ``checkpoint_location`` must be on storage every executor and the driver
    share (under ``spark.checkpoint.dir`` on a cluster).  Each micro-batch
    gets its own ``_ingestion_time``."""
    if sink not in ("append", "table"):
        raise ValueError(f"unknown sink {sink!r}")
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = with_ingestion_time(reader.load(landing_path))
    writer = stream.writeStream.option("checkpointLocation", checkpoint_location) \
        .trigger(availableNow=True)
    if sink == "table":
        query = writer.toTable(target)
    else:
        def append(batch, batch_id):
            out = batch
            if batch.sparkSession.catalog.tableExists(target):
                # a column the table lacks raises instead of vanishing
                out = align_for_append(batch.sparkSession.table(target).schema, batch)
            out.write.mode("append").saveAsTable(target)

        query = writer.foreachBatch(append).start()
    if wait:
        query.awaitTermination()
        # the caller's session may hold the table's file listing from before
        spark.catalog.refreshTable(target)
    return query


def stream_files_into_layers(spark: SparkSession, config, table: str, landing_path: str,
                             schema: StructType, checkpoint_location: str,
                             file_format: str = "parquet", wait: bool = True,
                             stream: str = "stream") -> StreamingQuery:
    """Carry every new file under ``landing_path`` through all layers.

    Each micro-batch runs ``refresh_layers``.  ``foreachBatch`` is
    at-least-once.  With ``config.raw_batches`` the micro-batch is the batch
    ``<stream>-<number>`` of the ledger: replayed after a failure it replaces
    itself, so all layers, raw included, are the same as after one delivery.
    Without, a replayed batch appends its raw rows again; those copies come
    later in the dedupe's order, so only the raw table differs."""
    from strata.plans.pipeline import refresh_layers

    from strata.plans.pipeline import all_tables

    def apply(batch, batch_id):
        # the batch has a session of its own (tables are read and written there)
        if not batch.isEmpty():
            refresh_layers(batch.sparkSession, config, table, batch,
                           batch_id=f"{stream}-{batch_id}" if config.raw_batches else None)

    stream = spark.readStream.schema(schema).format(file_format).load(landing_path)
    query = (stream.writeStream
             .option("checkpointLocation", checkpoint_location)
             .foreachBatch(apply)
             .trigger(availableNow=True)
             .start())
    if wait:
        query.awaitTermination()
        # the caller's session may hold file listings from before the stream
        for name in all_tables(config):
            if spark.catalog.tableExists(name):
                spark.catalog.refreshTable(name)
    return query
