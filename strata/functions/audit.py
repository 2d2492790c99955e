"""Audit columns added when a table is published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGESTION_TIME = "_ingestion_time"


def with_ingestion_time(df: DataFrame, name: str = INGESTION_TIME) -> DataFrame:
    """Add the load time.  ``current_timestamp()`` is fixed once per query,
    so every row of one write (and every retried task) gets the same value."""
    return df.withColumn(name, F.current_timestamp())
