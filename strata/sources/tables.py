"""Catalog and file sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Current content of a catalog table by (qualified) name."""
    return spark.read.table(name)


def parquet_reader(path: str) -> Callable[[SparkSession], DataFrame]:
    """A ``LoadSpec.reader`` for a parquet path."""
    return lambda spark: spark.read.parquet(path)
