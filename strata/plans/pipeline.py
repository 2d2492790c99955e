"""Layer runs: raw load, cleaning, aggregation, and the three chained.

Each table is one Spark job written through ``publish``; the only hand-over
between layers is the published tables, so every layer starts from a
short lineage (a table scan) and a lost executor only re-runs tasks of the
current table's job.  By default tables of a layer run one after another
and the first failure stops the layer (the reference behaviour);
``max_parallel`` runs a layer's independent tables as concurrent jobs.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampType)

from strata.functions.audit import with_ingestion_time
from strata.operators.clean import CleanCounts, clean, refresh_cleaned
from strata.operators.joins import checked_join
from strata.operators.maintain import StateTable, state_delta
from strata.operators.summarise import summarise
from strata.plans import catalogue as cat
from strata.session import ensure_checkpoint_dir
from strata.sinks.partitions import merge_partitions
from strata.sinks.tables import (align_for_append, compact_table, ensure_schema, publish,
                                 qualified_name, reset_tables)
from strata.sources.ledger import BATCH, FULL, Ledger, batch_rows, publish_full, write_batch
from strata.sources.retry import RetryPolicy, with_retry
from strata.specs import CleanSpec, LoadSpec, SummarySpec

T = TypeVar("T")

log = logging.getLogger("strata")


@dataclass(frozen=True)
class LayerConfig:
    """Where the three layers live and how tables are written.

    ``*_policy``: schema policy of each layer's writes (see ``publish``).
    ``compact``: run ``OPTIMIZE`` after each write when the format is Delta;
    parquet writes come out of an AQE-coalesced shuffle already evenly sized.
    ``sort_aggregates``: write aggregates in their published order.
    ``retry``: policy for each raw table's read and write.
    """

    catalog: str | None = "spark_catalog"
    raw: str = cat.RAW
    cleaned: str = cat.CLEANED
    aggregated: str = cat.AGGREGATED
    table_format: str = "parquet"
    raw_policy: str = "merge"
    cleaned_policy: str = "merge"
    aggregated_policy: str = "strict"
    compact: bool = True
    sort_aggregates: bool = True
    # bucket cleaned tables by their key (X9): joins and aggregates on the key
    # then read them without a shuffle on that side
    cleaned_buckets: int | None = None
    # tables of one layer run as concurrent Spark jobs (1 = one after another)
    max_parallel: int = 1
    # file codec of published tables (None: the session's, e.g. snappy; zstd is smaller)
    compression: str | None = None
    retry: RetryPolicy = field(default_factory=RetryPolicy)
    # raw tables partitioned by batch, with a ledger: ``refresh_layers`` takes a batch id
    # and a batch delivered again replaces itself
    raw_batches: bool = False
    # cleaned tables in so many parts by a hash of their key (a column ``_part``): a refresh
    # rewrites the parts of the touched keys only
    cleaned_parts: int | None = None
    # aggregates kept up by deltas, their state in so many parts; None: rebuilt
    state_parts: int | None = None
    state: str = "state"
    # cleaning runs count their input, dropped and written rows in the writing job
    accounting: bool = False

    def name(self, layer: str, table: str) -> str:
        return qualified_name(self.catalog, layer, table)

    def raw_table(self, table: str) -> str:
        return self.name(self.raw, table)

    def cleaned_table(self, table: str) -> str:
        return self.name(self.cleaned, table)

    def aggregated_table(self, table: str) -> str:
        return self.name(self.aggregated, table)

    def state_table(self, spec: SummarySpec) -> StateTable:
        return StateTable(self.name(self.state, spec.name), spec, self.state_parts)

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.raw_table("_batches"))


@dataclass(frozen=True)
class TableRun:
    layer: str
    table: str
    seconds: float
    attempts: int = 1
    rows: int | None = None
    # cleaning runs: input, duplicates, rejected and output rows, observed by the write
    account: dict[str, int] | None = None


#: part of a cleaned table, by a hash of its key
PART = "_part"


def _parted(df: DataFrame, spec: CleanSpec, parts: int) -> DataFrame:
    return df.withColumn(PART, F.pmod(F.xxhash64(*[F.col(k) for k in spec.keys]), F.lit(parts)).cast("int"))


def _raw_input(spark: SparkSession, config: LayerConfig, table: str) -> DataFrame:
    """The raw rows the cleaning reads: the batch they came in is not one of their columns."""
    df = spark.table(config.raw_table(table))
    return df.drop(BATCH) if config.raw_batches else df


def _write(spark: SparkSession, config: LayerConfig, layer: str, table: str, df: DataFrame,
           policy: str, bucket_by: tuple[int, Sequence[str]] | None = None,
           partition_by: Sequence[str] = ()) -> str:
    ensure_schema(spark, config.catalog, layer)
    name = config.name(layer, table)
    log.info("publishing %s", name)
    publish(df, name, schema_policy=policy, table_format=config.table_format, bucket_by=bucket_by,
            partition_by=partition_by, compression=config.compression)
    log.info("published %s", name)
    if config.compact and config.table_format == "delta":
        compact_table(spark, name, config.table_format)
    return name


def run_each(tasks: Sequence[Callable[[], T]], max_parallel: int = 1) -> list[T]:
    """Run independent table jobs; results in task order.

    One at a time, the first failure stops the rest.  With ``max_parallel`` >
    1 the tasks are submitted from driver threads as concurrent Spark jobs;
    on the first failure the tasks not yet started are cancelled and the
    error is raised once the running ones have finished."""
    if max_parallel <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
        done, waiting = wait(futures, return_when=FIRST_EXCEPTION)
        for f in waiting:
            f.cancel()
        for f in futures:
            if f in done and f.exception():
                raise f.exception()
        return [f.result() for f in futures]


def run_raw_layer(spark: SparkSession, config: LayerConfig,
                  loads: Sequence[LoadSpec]) -> list[TableRun]:
    """Load each source and publish it with ``_ingestion_time``.

    The retry covers the read **and** the write of one table: with JDBC the
    rows are only fetched when the write runs, so a transient outage shows
    up there, not when the reader is defined."""
    ensure_schema(spark, config.catalog, config.raw)

    def load(spec: LoadSpec) -> TableRun:
        t0 = time.perf_counter()

        def attempt():
            # rows written, counted by the write job itself (no second scan);
            # a fresh observation per attempt
            obs = Observation()
            df = with_ingestion_time(spec.reader(spark)).observe(obs, F.count(F.lit(1)).alias("rows"))
            if config.raw_batches:
                publish_full(df, config.raw_table(spec.target), config.raw_policy, config.compression)
                config.ledger(spark).log(spec.target, FULL, "done", obs.get.get("rows"))
            else:
                _write(spark, config, config.raw, spec.target, df, config.raw_policy)
            return obs.get.get("rows")

        rows, attempts = with_retry(attempt, config.retry)
        log.info("loaded %s from %s: %s rows, %d attempt(s)", spec.target,
                 spec.source_name or "source", rows, attempts)
        return TableRun(config.raw, spec.target, time.perf_counter() - t0, attempts, rows)

    return run_each([lambda s=s: load(s) for s in loads], config.max_parallel)


def clean_table(spark: SparkSession, config: LayerConfig, table: str,
                specs: dict[str, CleanSpec] | None = None) -> TableRun:
    """Clean one raw table by name; an unmapped name is an error raised
    before anything is read."""
    specs = cat.CLEAN_SPECS if specs is None else specs
    if table not in specs:
        raise ValueError(f"no cleaning rule for table {table!r}")
    t0 = time.perf_counter()
    spec = specs[table]
    counts = CleanCounts() if config.accounting else None
    df = clean(_raw_input(spark, config, table), spec, counts)
    if config.cleaned_parts:
        df = _parted(df, spec, config.cleaned_parts).hint("rebalance", PART)
        _write(spark, config, config.cleaned, table, df, config.cleaned_policy, partition_by=(PART,))
    else:
        buckets = (config.cleaned_buckets, spec.keys) if config.cleaned_buckets else None
        _write(spark, config, config.cleaned, table, df, config.cleaned_policy, buckets)
    account = counts.account() if counts else None
    return TableRun(config.cleaned, table, time.perf_counter() - t0, rows=account and account["output"], account=account)


def run_clean_layer(spark: SparkSession, config: LayerConfig,
                    tables: Iterable[str] = cat.CLEAN_ORDER,
                    specs: dict[str, CleanSpec] | None = None) -> list[TableRun]:
    specs = cat.CLEAN_SPECS if specs is None else specs
    tables = list(tables)
    unknown = [t for t in tables if t not in specs]
    if unknown:
        raise ValueError(f"no cleaning rule for table {unknown[0]!r}")
    ensure_schema(spark, config.catalog, config.cleaned)
    return run_each([lambda t=t: clean_table(spark, config, t, specs) for t in tables],
                    config.max_parallel)


def build_summary(spark: SparkSession, config: LayerConfig, spec: SummarySpec) -> DataFrame:
    """The aggregate of ``spec`` over the published cleaned tables (lazy)."""
    return summarise(
        spark.table(config.cleaned_table(spec.source)), spec,
        resolve=lambda t: spark.table(config.cleaned_table(t)),
        comparable=False, sort=config.sort_aggregates)


def run_summary_layer(spark: SparkSession, config: LayerConfig,
                      names: Iterable[str] = cat.SUMMARY_ORDER,
                      specs: dict[str, SummarySpec] | None = None) -> list[TableRun]:
    specs = cat.SUMMARY_SPECS if specs is None else specs
    ensure_schema(spark, config.catalog, config.aggregated)

    def build(n: str) -> TableRun:
        t0 = time.perf_counter()
        if config.state_parts:
            config.state_table(specs[n]).build(spark.table(config.cleaned_table(specs[n].source)),
                                               lambda t: spark.table(config.cleaned_table(t)))
            _publish_state(spark, config, specs[n])
        else:
            _write(spark, config, config.aggregated, n, build_summary(spark, config, specs[n]),
                   config.aggregated_policy)
        return TableRun(config.aggregated, n, time.perf_counter() - t0)

    return run_each([lambda n=n: build(n) for n in names], config.max_parallel)


def _publish_state(spark: SparkSession, config: LayerConfig, spec: SummarySpec) -> None:
    """Publish an aggregate from its state (one row per group; no cleaned row is read)."""
    df = config.state_table(spec).published(spark, spark.table(config.cleaned_table(spec.source)),
                                            config.sort_aggregates)
    _write(spark, config, config.aggregated, spec.name, df, config.aggregated_policy)


def run_pipeline(spark: SparkSession, config: LayerConfig, loads: Sequence[LoadSpec],
                 clean_specs: dict[str, CleanSpec] | None = None,
                 summary_specs: dict[str, SummarySpec] | None = None) -> list[TableRun]:
    """raw -> cleaned -> aggregated; each layer starts only after the
    previous one succeeded.  A loaded table without a cleaning rule raises.
    ``clean_specs`` and ``summary_specs`` replace the catalogue's rules; with
    ``summary_specs`` every aggregate in it is built."""
    rules = cat.CLEAN_SPECS if clean_specs is None else clean_specs
    unknown = [s.target for s in loads if s.target not in rules]
    if unknown:
        raise ValueError(f"no cleaning rule for {unknown}")
    runs = run_raw_layer(spark, config, loads)
    runs += run_clean_layer(spark, config, [s.target for s in loads], rules)
    names = cat.SUMMARY_ORDER if summary_specs is None else tuple(summary_specs)
    runs += run_summary_layer(spark, config, names, summary_specs)
    return runs


def refresh_layers(spark: SparkSession, config: LayerConfig, table: str, new_rows: DataFrame,
                   clean_specs: dict[str, CleanSpec] | None = None,
                   summary_specs: dict[str, SummarySpec] | None = None,
                   batch_id: str | None = None) -> list[TableRun]:
    """New source rows of one table, carried through the layers without a
    full rebuild; the result equals a full run over all rows.

    Raw: the rows are appended with their load time, or written as the batch
    ``batch_id`` (``raw_batches``).  Cleaned: only the touched keys are
    cleaned again; the whole table is rewritten, or only the parts that hold them
    (``cleaned_parts``).  Aggregates: rebuilt, or kept up by the delta of
    the touched keys' rows (``state_parts``).

    With batches a run that died may be started again with the same batch id:
    the ledger names its last finished phase, every phase replaces what it wrote
    before, and the delta, taken between the cleaned rows before and after, is
    stored and logged before the cleaned rows change.  A finished batch is
    left out.  The specs are those of ``run_pipeline``."""
    spec = (cat.CLEAN_SPECS if clean_specs is None else clean_specs)[table]
    summaries = cat.SUMMARY_SPECS if summary_specs is None else summary_specs
    affected = [n for n, s in summaries.items()
                if s.source == table or (s.join is not None and s.join.table == table)]
    raw_name, cleaned_name = config.raw_table(table), config.cleaned_table(table)
    ledger = known = None

    def log_phase(phase: str) -> None:
        if ledger:
            ledger.log(table, batch_id, phase)

    t0 = time.perf_counter()
    if config.raw_batches:
        if batch_id is None:
            raise ValueError("raw tables kept by batch need a batch id")
        ledger = config.ledger(spark)
        known = write_batch(new_rows, raw_name, table, batch_id, ledger)
        if ledger.reached(known, "done"):
            return [TableRun(config.raw, table, time.perf_counter() - t0, rows=0)]
        fresh = batch_rows(spark, raw_name, batch_id)
    else:
        audited = align_for_append(spark.table(raw_name).schema, with_ingestion_time(new_rows))
        audited.write.mode("append").saveAsTable(raw_name)
        fresh, batch_id = new_rows, batch_id or uuid.uuid4().hex
    runs = [TableRun(config.raw, table, time.perf_counter() - t0)]

    t0 = time.perf_counter()
    if not (ledger and ledger.reached(known, "cleaned")):
        # only the keys of the new rows are used: their raw rows are read back from the table
        cleaned = spark.table(cleaned_name)
        if not (config.state_parts or config.cleaned_parts):
            refreshed = refresh_cleaned(cleaned, _raw_input(spark, config, table), fresh, spec)
            _write(spark, config, config.cleaned, table, refreshed, config.cleaned_policy)
        else:
            _refresh_touched(spark, config, table, spec, fresh, batch_id, [summaries[n] for n in affected],
                             ledger and ledger.reached(known, "delta"), log_phase)
        log_phase("cleaned")
    runs.append(TableRun(config.cleaned, table, time.perf_counter() - t0))

    if not config.state_parts:
        runs += run_summary_layer(spark, config, affected, summaries)
    else:
        def apply(n: str) -> TableRun:
            t0 = time.perf_counter()
            config.state_table(summaries[n]).apply_delta(spark, batch_id)
            _publish_state(spark, config, summaries[n])
            return TableRun(config.aggregated, n, time.perf_counter() - t0)

        runs += run_each([lambda n=n: apply(n) for n in affected], config.max_parallel)
    log_phase("done")
    return runs


def _refresh_touched(spark: SparkSession, config: LayerConfig, table: str, spec: CleanSpec, fresh: DataFrame,
                     batch_id: str, summaries: Sequence[SummarySpec], has_delta: bool,
                     log_phase: Callable[[str], None]) -> None:
    """Clean the touched keys again, store the deltas, then replace the keys' cleaned rows."""
    name = config.cleaned_table(table)
    cleaned, keys = spark.table(name), list(spec.keys)
    touched = fresh.select(*keys).distinct()
    new = clean(checked_join(_raw_input(spark, config, table), touched, keys, "left_semi", null_safe=True), spec)
    if config.state_parts and not has_delta:
        # both sides of the change are read by every delta: written once
        ensure_checkpoint_dir(spark)
        before = checked_join(cleaned.drop(PART), touched, keys, "left_semi", null_safe=True).checkpoint(eager=True)
        new = new.checkpoint(eager=True)
        for s in summaries:
            delta = state_delta(s, table, before, new, lambda t: spark.table(config.cleaned_table(t)))
            config.state_table(s).write_delta(delta, batch_id)
        log_phase("delta")
    if config.cleaned_parts:
        merge_partitions(name, _parted(new, spec, config.cleaned_parts), keys, touched=touched)
    else:
        untouched = checked_join(cleaned, touched, keys, "left_anti", null_safe=True)
        _write(spark, config, config.cleaned, table, untouched.unionByName(new), config.cleaned_policy)


RUN_LOG_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("layer", StringType(), False),
    StructField("table", StringType(), False),
    StructField("seconds", DoubleType(), False),
    StructField("attempts", LongType(), False),
    StructField("rows", LongType(), True),
    StructField("logged_at", TimestampType(), True),
])


def append_run_log(spark: SparkSession, config: LayerConfig, run_id: str,
                   runs: Sequence[TableRun], table: str = "_load_runs") -> str:
    """Append one row per table run (duration, attempts, rows written) to a
    log table in the raw layer; the rows are the run's own few records."""
    ensure_schema(spark, config.catalog, config.raw)
    name = config.raw_table(table)
    log = spark.createDataFrame(
        [(run_id, r.layer, r.table, float(r.seconds), int(r.attempts), r.rows, None) for r in runs],
        RUN_LOG_SCHEMA).withColumn("logged_at", F.current_timestamp())
    log.write.mode("append").saveAsTable(name)
    return name


ACCOUNT_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("table", StringType(), False),
    *[StructField(c, LongType(), False) for c in ("input", "duplicates", "rejected", "output")],
])


def append_clean_log(spark: SparkSession, config: LayerConfig, run_id: str, runs: Sequence[TableRun],
                     table: str = "_clean_runs") -> str:
    """Append the accounts of cleaning runs (``accounting``) to a log table in the cleaned layer."""
    ensure_schema(spark, config.catalog, config.cleaned)
    name = config.cleaned_table(table)
    rows = [(run_id, r.table, *(r.account[c] for c in ("input", "duplicates", "rejected", "output")))
            for r in runs if r.account]
    spark.createDataFrame(rows, ACCOUNT_SCHEMA).coalesce(1).write.mode("append").saveAsTable(name)
    return name


def all_tables(config: LayerConfig) -> list[str]:
    """Every published table, in build order."""
    return ([config.raw_table(t) for t in cat.CLEAN_ORDER]
            + [config.cleaned_table(t) for t in cat.CLEAN_ORDER]
            + [config.aggregated_table(t) for t in cat.SUMMARY_ORDER])


def reset_pipeline(spark: SparkSession, config: LayerConfig) -> list[str]:
    """Drop every published table, last consumers first."""
    return reset_tables(spark, list(reversed(all_tables(config))))


def loads_from(readers: dict[str, Callable[[SparkSession], DataFrame]]) -> list[LoadSpec]:
    """Load specs for the reference's five sources from table -> reader."""
    return [LoadSpec(target=target, reader=readers[target], source_name=source)
            for source, target in cat.SOURCE_TABLES if target in readers]
