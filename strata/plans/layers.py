"""Layer objects for the reference's workflow: load one or many source
tables, clean one or many tables by name, build the aggregate tables.

    raw = RawLayer(spark, config, url_for=lambda server, db: sqlserver_url(server, db),
                   properties={"user": ..., "password": ...})
    raw.load_many("db-host", "sales", cat.SOURCE_TABLES)
    CleanLayer(spark, config).run_many(cat.CLEAN_ORDER)
    SummaryLayer(spark, config).run()

Each call is the same Spark work as ``strata.plans.pipeline``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from strata.plans import catalogue as cat
from strata.plans.pipeline import (LayerConfig, TableRun, build_summary, clean_table,
                                   run_clean_layer, run_raw_layer, run_summary_layer)
from strata.sources.jdbc import JdbcSource, jdbc_reader, sqlserver_url
from strata.specs import LoadSpec


class RawLayer:
    """Source tables -> raw tables with ``_ingestion_time``, retried."""

    def __init__(self, spark: SparkSession, config: LayerConfig,
                 properties: Mapping[str, str] | None = None,
                 url_for: Callable[[str, str], str] = sqlserver_url,
                 partitioning: Mapping[str, dict] | None = None):
        self.spark, self.config = spark, config
        self.properties = dict(properties or {})
        self.url_for = url_for
        self.partitioning = dict(partitioning or {})   # source table -> JdbcSource kwargs

    def _spec(self, server: str, database: str, source: str, target: str) -> LoadSpec:
        src = JdbcSource(url=self.url_for(server, database), table=source,
                         properties=self.properties, **self.partitioning.get(source, {}))
        return LoadSpec(target=target, reader=jdbc_reader(src), source_name=source)

    def load(self, server: str, database: str, source: str, target: str) -> TableRun:
        (run,) = run_raw_layer(self.spark, replace(self.config, max_parallel=1),
                               [self._spec(server, database, source, target)])
        return run

    def load_many(self, server: str, database: str,
                  mappings: Iterable[tuple[str, str]] = cat.SOURCE_TABLES) -> list[TableRun]:
        return run_raw_layer(self.spark, self.config,
                             [self._spec(server, database, s, t) for s, t in mappings])

    def load_from(self, readers: Sequence[LoadSpec]) -> list[TableRun]:
        """Any other source (files, views): ``LoadSpec``s with their own readers."""
        return run_raw_layer(self.spark, self.config, readers)


class CleanLayer:
    """Raw -> cleaned tables by name (an unmapped name is an error)."""

    def __init__(self, spark: SparkSession, config: LayerConfig):
        self.spark, self.config = spark, config

    def run(self, table: str) -> TableRun:
        return clean_table(self.spark, self.config, table)

    def run_many(self, tables: Iterable[str] = cat.CLEAN_ORDER) -> list[TableRun]:
        return run_clean_layer(self.spark, self.config, tables)


class SummaryLayer:
    """Cleaned -> aggregate tables."""

    def __init__(self, spark: SparkSession, config: LayerConfig):
        self.spark, self.config = spark, config

    def build(self, name: str) -> DataFrame:
        """The aggregate as a lazy ``DataFrame`` (not written)."""
        return build_summary(self.spark, self.config, cat.SUMMARY_SPECS[name])

    def run_one(self, name: str) -> TableRun:
        (run,) = run_summary_layer(self.spark, self.config, [name])
        return run

    def run(self, names: Iterable[str] = cat.SUMMARY_ORDER) -> list[TableRun]:
        return run_summary_layer(self.spark, self.config, names)
