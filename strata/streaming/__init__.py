"""Incremental ingestion with Structured Streaming.

The reference has no stream processing; its README names incremental loads
as the next step for the raw layer.  Files landing in a folder are appended
to a raw table by a streaming query with an available-now trigger: each run
takes every file not yet taken (the checkpoint remembers them) and stops.
Micro-batches are appended with batch writes, at-least-once; the cleaning
dedupe absorbs a replayed batch.  Spark's exactly-once file sink is an
option for a table only the stream writes.
``stream_files_into_layers`` drives all layers from landed files, one
micro-batch at a time.
"""

from strata.streaming.incremental import stream_files_into_layers, stream_files_into_table

__all__ = ["stream_files_into_layers", "stream_files_into_table"]
