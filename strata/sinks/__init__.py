"""Sinks: qualified names, schemas (layers), publishing with a schema policy
through a staging table, compaction, reset."""
