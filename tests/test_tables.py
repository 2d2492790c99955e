"""Publishing, schema policies, compaction, reset, retry, layer runs."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.plans import catalogue as cat
from strata.plans.pipeline import LayerConfig, clean_table, reset_pipeline, run_pipeline
from strata.plans.table_ops import fixture_loads, workspace
from strata.plans.validate import table_list
from strata.sinks.tables import (SchemaMismatch, compact_table, ensure_schema, file_count, publish,
                                 qualified_name, split_name)
from strata.sources.retry import RetryPolicy, with_retry


def _name(spark, table="t"):
    db = f"tdb_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, "spark_catalog", db)
    return qualified_name("spark_catalog", db, table)


def test_qualified_name_quotes_parts():
    assert qualified_name("c", "s", "t") == "`c`.`s`.`t`"
    assert qualified_name(None, "s", "we`ird") == "`s`.`we``ird`"
    assert split_name("`c`.`s`.`we``ird`") == ["c", "s", "we`ird"]


def test_merge_schema_adds_and_nulls(spark):
    name = _name(spark)
    publish(spark.createDataFrame([(1, "x")], "a long, b string"), name, "merge")
    publish(spark.createDataFrame([(2, 3.5)], "a long, c double"), name, "merge")
    df = spark.table(name)
    assert df.columns == ["a", "b", "c"]
    assert [tuple(r) for r in df.collect()] == [(2, None, 3.5)]


def test_type_clash_raises_and_keeps_old_table(spark):
    name = _name(spark)
    publish(spark.createDataFrame([(1,)], "a int"), name, "merge")
    with pytest.raises(SchemaMismatch):
        publish(spark.createDataFrame([("x",)], "a string"), name, "merge")
    assert [tuple(r) for r in spark.table(name).collect()] == [(1,)]


def test_strict_policy_rejects_new_column(spark):
    name = _name(spark)
    publish(spark.createDataFrame([(1,)], "a long"), name, "strict")
    with pytest.raises(SchemaMismatch):
        publish(spark.createDataFrame([(1, 2)], "a long, b long"), name, "strict")


def test_republish_from_own_rows(spark):
    name = _name(spark)
    publish(spark.range(10), name)
    publish(spark.table(name).withColumn("id", F.col("id") * 2), name, "strict")
    assert sorted(r.id for r in spark.table(name).collect()) == [i * 2 for i in range(10)]


def test_compaction_keeps_rows_fewer_files(spark):
    name = _name(spark)
    publish(spark.range(3000).repartition(16), name)
    before = file_count(spark, name)
    compact_table(spark, name, target_files=1)
    assert before >= 8 and file_count(spark, name) == 1
    assert spark.table(name).count() == 3000


def test_retry_transient_then_success():
    calls, waits = [], []

    def action():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("The service is Not Currently Available")
        return "ok"

    result, attempts = with_retry(action, RetryPolicy(delay_seconds=20, sleep=waits.append))
    assert (result, attempts, waits) == ("ok", 3, [20, 20])


def test_retry_other_error_raises_at_once():
    waits = []

    def action():
        raise ValueError("login failed")

    with pytest.raises(ValueError):
        with_retry(action, RetryPolicy(sleep=waits.append))
    assert waits == []


def test_retry_gives_up_after_last_attempt():
    waits = []

    def action():
        raise RuntimeError("not currently available")

    with pytest.raises(RuntimeError):
        with_retry(action, RetryPolicy(attempts=6, delay_seconds=20, sleep=waits.append))
    assert waits == [20] * 5


def test_retry_backoff():
    p = RetryPolicy(delay_seconds=1, backoff=2.0, max_delay_seconds=5)
    assert [p.delay(i) for i in range(1, 6)] == [1, 2, 4, 5, 5]


def test_unmapped_table_is_an_error_before_reading(spark):
    with pytest.raises(ValueError):
        clean_table(spark, LayerConfig(raw="does_not_exist"), "no_such_table")


def test_pipeline_runs_twice_same_tables_then_resets(spark, sf_small):
    config = workspace("t")
    loads = fixture_loads(sf_small)
    run_pipeline(spark, config, loads)
    first = {t: sorted(map(tuple, spark.table(config.aggregated_table(t)).collect()), key=str)
             for t in cat.SUMMARY_ORDER}
    run_pipeline(spark, config, loads)
    second = {t: sorted(map(tuple, spark.table(config.aggregated_table(t)).collect()), key=str)
              for t in cat.SUMMARY_ORDER}
    assert first == second
    layers = [config.raw, config.cleaned, config.aggregated]
    assert [r.n_tables for r in table_list(spark, config.catalog, layers).collect()] == [5, 5, 4]
    raw_cols = spark.table(config.raw_table(cat.CUSTOMERS)).columns
    assert raw_cols[-1] == "_ingestion_time"
    reset_pipeline(spark, config)
    assert [r.n_tables for r in table_list(spark, config.catalog, layers).collect()] == [0, 0, 0]


def test_published_aggregate_keeps_sorted_order_and_types(spark, sf_small):
    config = workspace("t")
    run_pipeline(spark, config, fixture_loads(sf_small))
    df = spark.table(config.aggregated_table(cat.SALES_BY_DAY))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types == {"OrderDateKey": "date", "Total_Orders": "bigint", "Total_Revenue": "decimal(29,4)"}
    by_color = spark.table(config.aggregated_table(cat.BY_COLOR))
    assert by_color.schema["Average_List_Price"].dataType.simpleString() == "decimal(23,8)"


def test_partitioned_publish_prunes_partitions(spark):
    name = _name(spark)
    df = spark.range(100).select((F.col("id") % 4).alias("p"), F.col("id"))
    publish(df, name, partition_by=["p"])
    q = spark.table(name).filter("p = 2")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and "(p#" in plan
    assert sorted(r.id for r in q.collect()) == list(range(2, 100, 4))


def test_bucketed_publish_keeps_bucket_spec(spark):
    name = _name(spark)
    publish(spark.range(100).withColumnRenamed("id", "k"), name, bucket_by=(4, ["k"]))
    plan = spark.table(name).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan          # grouped by the bucket key: no shuffle


def test_null_safe_checked_join(spark):
    from strata.operators.joins import checked_join

    left = spark.createDataFrame([(None, 1), (2, 2)], "k long, v long")
    right = spark.createDataFrame([(None, "n"), (2, "two")], "k long, w string")
    plain = sorted(map(tuple, checked_join(left, right, ["k"], "left").collect()), key=str)
    safe = sorted(map(tuple, checked_join(left, right, ["k"], "left", null_safe=True).collect()), key=str)
    assert plain == sorted([(None, 1, None), (2, 2, "two")], key=str)
    assert safe == sorted([(None, 1, "n"), (2, 2, "two")], key=str)
    semi = checked_join(left, right, ["k"], "left_semi", null_safe=True)
    assert semi.count() == 2 and semi.columns == ["k", "v"]


def test_compaction_keeps_partitions_and_buckets(spark):
    from strata.sinks.tables import table_layout

    name = _name(spark)
    df = spark.range(400).select((F.col("id") % 4).alias("p"), F.col("id"))
    publish(df.repartition(16), name, partition_by=["p"])
    compact_table(spark, name)
    assert table_layout(spark, name) == (["p"], None)
    assert spark.table(name).filter("p = 3").count() == 100

    name2 = _name(spark)
    publish(spark.range(100).withColumnRenamed("id", "k").repartition(8), name2, bucket_by=(4, ["k"]))
    compact_table(spark, name2)
    assert table_layout(spark, name2) == ([], (4, ["k"]))
    assert spark.table(name2).count() == 100


def test_retry_covers_the_write(spark):
    from dataclasses import replace

    from strata.plans.pipeline import run_raw_layer
    from strata.specs import LoadSpec

    calls = []

    def reader(s):
        calls.append(1)
        df = s.range(50)
        if len(calls) == 1:
            # the read is fine; the rows fail while the write job runs
            df = df.withColumn("id", F.when(F.col("id") >= 0, F.raise_error(
                F.lit("source is not currently available"))).otherwise(F.col("id")))
        return df

    config = replace(workspace("retrywrite"), retry=RetryPolicy(delay_seconds=0, sleep=lambda s: None))
    (run,) = run_raw_layer(spark, config, [LoadSpec(target="t", reader=reader)])
    assert run.attempts == 2 and run.rows == 50
    assert spark.table(config.raw_table("t")).count() == 50


def test_publish_checks_contract_before_writing(spark):
    from pyspark.sql.types import LongType, StructField, StructType

    from strata.operators.quality import ContractViolation

    name = _name(spark)
    contract = StructType([StructField("id", LongType())])
    publish(spark.range(3), name, contract=contract)
    with pytest.raises(ContractViolation):
        publish(spark.range(5).selectExpr("cast(id as string) as id"), name, contract=contract)
    assert spark.table(name).count() == 3


def test_refresh_layers_equals_full_run(spark, sf_small):
    from strata.plans.pipeline import refresh_layers
    from strata.sources.fixtures import RAW_VIEWS, r_headers_drops
    from strata.specs import LoadSpec

    first, second = r_headers_drops(spark, sf_small)

    def loads(headers):
        return [LoadSpec(target=t, reader=(lambda s, t=t: headers if t == cat.HEADERS
                                           else RAW_VIEWS[t](s, sf_small)))
                for t in cat.CLEAN_ORDER]

    inc, full = workspace("inc"), workspace("full")
    run_pipeline(spark, inc, loads(first))
    refresh_layers(spark, inc, cat.HEADERS, second)
    run_pipeline(spark, full, loads(first.unionByName(second)))

    def rows(config, layer_table):
        df = spark.table(layer_table(config))
        df = df.drop("_ingestion_time") if "_ingestion_time" in df.columns else df
        return sorted(map(tuple, df.collect()), key=str)

    assert rows(inc, lambda c: c.cleaned_table(cat.HEADERS)) == rows(full, lambda c: c.cleaned_table(cat.HEADERS))
    for n in cat.SUMMARY_ORDER:
        assert rows(inc, lambda c: c.aggregated_table(n)) == rows(full, lambda c: c.aggregated_table(n))
    assert spark.table(inc.raw_table(cat.HEADERS)).count() == first.count() + second.count()


def test_publish_with_zstd(spark):
    import pyarrow.parquet as pq

    name = _name(spark)
    publish(spark.range(1000), name, compression="zstd")
    f = spark.table(name).inputFiles()[0].replace("file://", "").replace("file:", "")
    assert pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD"
    assert spark.table(name).count() == 1000


def test_replayed_batch_leaves_cleaned_and_aggregates_unchanged(spark, sf_small):
    from strata.plans.pipeline import refresh_layers
    from strata.sources.fixtures import RAW_VIEWS, r_headers_drops
    from strata.specs import LoadSpec

    first, second = r_headers_drops(spark, sf_small)
    loads = [LoadSpec(target=t, reader=(lambda s, t=t: first if t == cat.HEADERS
                                        else RAW_VIEWS[t](s, sf_small)))
             for t in cat.CLEAN_ORDER]
    once, twice = workspace("once"), workspace("twice")
    for config, deliveries in ((once, 1), (twice, 2)):
        run_pipeline(spark, config, loads)
        for _ in range(deliveries):          # at-least-once: the same batch again
            refresh_layers(spark, config, cat.HEADERS, second)

    def rows(name):
        df = spark.table(name)
        df = df.drop("_ingestion_time") if "_ingestion_time" in df.columns else df
        return sorted(map(tuple, df.collect()), key=str)

    assert rows(once.cleaned_table(cat.HEADERS)) == rows(twice.cleaned_table(cat.HEADERS))
    for n in cat.SUMMARY_ORDER:
        assert rows(once.aggregated_table(n)) == rows(twice.aggregated_table(n))
    raw_once = spark.table(once.raw_table(cat.HEADERS)).count()
    assert spark.table(twice.raw_table(cat.HEADERS)).count() == raw_once + second.count()


def test_align_for_append(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from strata.sinks.tables import align_for_append

    existing = StructType([StructField("a", LongType()), StructField("b", StringType())])
    out = align_for_append(existing, spark.createDataFrame([(1,)], "a long"))
    assert out.columns == ["a", "b"] and out.first().b is None
    with pytest.raises(SchemaMismatch):
        align_for_append(existing, spark.createDataFrame([(1, 2)], "a long, c long"))
    with pytest.raises(SchemaMismatch):
        align_for_append(existing, spark.createDataFrame([("x",)], "a string"))


def test_refresh_layers_with_new_keys_rebuilds_joined_aggregate(spark, sf_small):
    from strata.plans.pipeline import refresh_layers
    from strata.sources.fixtures import RAW_VIEWS
    from strata.specs import LoadSpec

    customers = RAW_VIEWS[cat.CUSTOMERS](spark, sf_small)
    first = customers.filter(F.col("CustomerID") % 2 == 0)
    second = customers.filter(F.col("CustomerID") % 2 == 1)   # keys the tables have not seen

    def loads(c):
        return [LoadSpec(target=t, reader=(lambda s, t=t: c if t == cat.CUSTOMERS
                                           else RAW_VIEWS[t](s, sf_small)))
                for t in cat.CLEAN_ORDER]

    inc, full = workspace("incc"), workspace("fullc")
    run_pipeline(spark, inc, loads(first))
    runs = refresh_layers(spark, inc, cat.CUSTOMERS, second)
    assert [r.table for r in runs[2:]] == [cat.BY_COMPANY, cat.SALES_BY_CUSTOMER]
    run_pipeline(spark, full, loads(customers))

    def rows(name):
        df = spark.table(name)
        df = df.drop("_ingestion_time") if "_ingestion_time" in df.columns else df
        return sorted(map(tuple, df.collect()), key=str)

    assert rows(inc.cleaned_table(cat.CUSTOMERS)) == rows(full.cleaned_table(cat.CUSTOMERS))
    for n in (cat.BY_COMPANY, cat.SALES_BY_CUSTOMER):
        assert rows(inc.aggregated_table(n)) == rows(full.aggregated_table(n))
