"""Quality metrics, quarantine, contracts, upsert, change apply, incremental loads."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.operators.merge import apply_changes, latest_changes, upsert
from strata.operators.quality import (ContractViolation, check_contract, clean_with_rejects,
                                      column_metrics, enforce_contract)
from strata.plans import catalogue as cat
from strata.sinks.tables import ensure_schema, qualified_name
from strata.sources.incremental import high_water_mark, incremental_load
from strata.specs import CleanSpec


def test_column_metrics_counts_nulls_and_blanks(spark):
    df = spark.createDataFrame([(1, " "), (2, None), (None, "x")], "a long, b string")
    got = {r.column: (r.n_rows, r.n_null, r.n_blank) for r in column_metrics(df).collect()}
    assert got == {"a": (3, 1, 0), "b": (3, 1, 1)}


def test_rejects_account_for_every_dropped_row(spark):
    rows = [(1, "a"), (1, "a"), (1, "a"), (2, None), (3, "c"), (3, "d")]
    df = spark.createDataFrame(rows, "k long, v string")
    spec = CleanSpec(name="t", keys=("k",), required=("v",))
    kept, rejects = clean_with_rejects(df, spec)
    assert sorted(map(tuple, kept.collect())) == [(1, "a"), (3, "c")]
    reasons = sorted((r.k, r._reject_reason) for r in rejects.collect())
    assert reasons == [(1, "duplicate"), (1, "duplicate"), (2, "missing:v"), (3, "duplicate")]
    assert kept.count() + rejects.count() == df.count()


def test_rejects_filter_first(spark):
    df = spark.createDataFrame([(1, None, 0), (1, "a", 1), (1, "a", 1)], "k long, v string, s int")
    spec = CleanSpec(name="t", keys=("k",), required=("v",), tie_break=("s",), dedupe_after_filter=True)
    kept, rejects = clean_with_rejects(df, spec)
    assert [tuple(r)[:2] for r in kept.collect()] == [(1, "a")]
    assert sorted(r._reject_reason for r in rejects.collect()) == ["duplicate", "missing:v"]


def test_contract(spark):
    contract = StructType([StructField("a", LongType()), StructField("b", StringType())])
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    issues = check_contract(df.schema, contract)
    assert [(i.column, i.expected, i.actual) for i in issues] == [("b", "string", "bigint")]
    with pytest.raises(ContractViolation):
        enforce_contract(df, contract)
    ok = spark.createDataFrame([(1, "x", 3)], "a long, b string, c int")
    assert enforce_contract(ok, contract) is ok
    assert check_contract(ok.schema, contract, allow_extra=False)[0].column == "c"


def test_upsert_replaces_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    updates = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k long")
    out = sorted(map(tuple, upsert(target, updates, ["k"]).collect()))
    assert out == [(1, "a"), (2, "B"), (3, "C")]


def test_change_apply_last_change_wins_and_deletes(spark):
    target = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "k long, v double")
    changes = spark.createDataFrame(
        [(1, 1, "U", 11.0), (1, 2, "U", 12.0), (2, 1, "U", 21.0), (2, 5, "D", None), (4, 1, "U", 40.0)],
        "k long, seq int, op string, v double")
    assert [r.seq for r in latest_changes(changes, ["k"], "seq").orderBy("k").collect()] == [2, 5, 1]
    out = sorted(map(tuple, apply_changes(target, changes, ["k"], "seq").collect()))
    assert out == [(1, 12.0), (3, 30.0), (4, 40.0)]


def test_incremental_load_appends_only_new_rows(spark):
    db = f"inc_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, "spark_catalog", db)
    target = qualified_name("spark_catalog", db, "t")
    src = spark.range(10).withColumn("v", F.col("id") * 2)
    assert incremental_load(spark, src.filter("id < 4"), target, "id") is None
    assert incremental_load(spark, src, target, "id") == 3
    assert incremental_load(spark, src, target, "id") == 9
    assert sorted(r.id for r in spark.table(target).collect()) == list(range(10))
    assert high_water_mark(spark, target, "id") == 9


def test_hot_key_dedupe_is_exact(spark):
    # a third of all rows on one key: still one survivor, the first in order
    hot = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                    (F.col("id") * 7 % 1000).alias("v"))
    from strata.operators.dedupe import dedupe
    out = dedupe(hot, ["k"])
    assert out.count() == 20001
    assert out.filter("k = 0").first().v == 0


def test_summary_spec_catalogue_is_consistent():
    for spec in cat.SUMMARY_SPECS.values():
        assert spec.source in cat.CLEAN_SPECS
        if spec.join:
            assert spec.join.table in cat.CLEAN_SPECS
            assert cat.CLEAN_SPECS[spec.join.table].keys == spec.join.on


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 40, 3])
def test_validity_ranges_match_lead_with_hot_and_null_keys(spark, rows_per_slice):
    from oracle_compare import compare, duck

    from strata.operators.history import validity_ranges

    sf = "/root/testdata/sf0.001"
    con = duck(sf)
    con.execute("""create or replace view hist as select
        case when o_orderkey % 3 = 0 then 7 when o_orderkey % 7 = 0 then null else o_custkey end as k,
        o_orderdate as v, o_orderkey as t from orders""")
    df = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(7))
         .when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("k"),
        F.col("o_orderdate").alias("v"), F.col("o_orderkey").alias("t"))
    out = validity_ranges(df, ["k"], "v", ["t"], rows_per_slice=rows_per_slice)
    r = compare(out, con, """select k, v, t, lead(v) over w as valid_to, lead(v) over w is null as is_current
        from hist window w as (partition by k order by v asc nulls first, t asc nulls first)""")
    assert r["rows_ok"] and r["hash_ok"], r["diff"]


def test_upsert_null_key_replaces_null_key(spark):
    target = spark.createDataFrame([(None, "old"), (1, "a")], "k long, v string")
    updates = spark.createDataFrame([(None, "new")], "k long, v string")
    out = sorted(map(tuple, upsert(target, updates, ["k"]).collect()), key=str)
    assert out == sorted([(None, "new"), (1, "a")], key=str)


def test_failed_incremental_append_commits_nothing_and_rerun_completes(spark):
    db = f"inc_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, "spark_catalog", db)
    target = qualified_name("spark_catalog", db, "t")
    src = spark.range(20).withColumn("v", F.col("id") * 2)
    incremental_load(spark, src.filter("id < 10"), target, "id")
    broken = src.withColumn("v", F.when(F.col("id") >= 15, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        incremental_load(spark, broken, target, "id")
    assert spark.table(target).count() == 10          # the failed job committed no file
    incremental_load(spark, src, target, "id")
    assert sorted(r.id for r in spark.table(target).collect()) == list(range(20))


def test_parallel_layer_run_raises_first_failure(spark):
    from dataclasses import replace

    from strata.plans.pipeline import run_raw_layer
    from strata.plans.table_ops import workspace
    from strata.specs import LoadSpec

    def bad(s):
        raise ValueError("login failed")

    config = replace(workspace("par"), max_parallel=3)
    loads = [LoadSpec(target="a", reader=lambda s: s.range(5)), LoadSpec(target="b", reader=bad),
             LoadSpec(target="c", reader=lambda s: s.range(7))]
    with pytest.raises(ValueError, match="login failed"):
        run_raw_layer(spark, config, loads)


def test_column_metrics_odd_names(spark):
    df = spark.createDataFrame([(1, " "), (None, "it's")], "`a.b` long, `c d` string")
    got = {r.column: (r.n_null, r.n_blank) for r in column_metrics(df).collect()}
    assert got == {"a.b": (1, 0), "c d": (0, 1)}


def test_validity_ranges_composite_key_with_nulls(spark):
    from pyspark.sql import Window

    from strata.operators.history import validity_ranges

    rows = [(a, b, v, t) for t, (a, b, v) in enumerate(
        [(1, None, 5), (1, None, 3), (1, None, 9), (None, None, 1), (None, None, 2), (1, 2, 7),
         (1, 2, 7), (1, None, 4), (2, 2, 1)] * 5)]
    df = spark.createDataFrame(rows, "a long, b long, v long, t long")
    w = Window.partitionBy("a", "b").orderBy(F.col("v").asc_nulls_first(), F.col("t").asc_nulls_first())
    want = sorted(map(tuple, df.withColumn("valid_to", F.lead("v").over(w))
                      .withColumn("is_current", F.col("valid_to").isNull()).collect()), key=str)
    for rows_per_slice in (1_000_000, 4, 2):
        got = validity_ranges(df, ["a", "b"], "v", ["t"], rows_per_slice=rows_per_slice)
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_stream_append_is_visible_to_a_session_that_read_the_table_before(spark, tmp_path):
    from strata.session import ensure_checkpoint_dir
    from strata.sinks.tables import publish
    from strata.streaming.incremental import stream_files_into_table

    db = f"st_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, "spark_catalog", db)
    target = qualified_name("spark_catalog", db, "t")
    first = spark.range(10).withColumn("_ingestion_time", F.current_timestamp())
    publish(first, target)
    assert spark.table(target).count() == 10             # the session now knows the files
    shared = ensure_checkpoint_dir(spark).rstrip("/")
    run = uuid.uuid4().hex[:8]
    landing, ck = f"{shared}/t-landing-{run}", f"{shared}/t-stream-{run}"
    spark.range(10, 25).write.parquet(landing)
    stream_files_into_table(spark, landing, spark.range(1).schema, target, ck)
    assert spark.table(target).count() == 25


def test_stream_file_sink_for_a_table_only_the_stream_writes(spark):
    from strata.session import ensure_checkpoint_dir
    from strata.streaming.incremental import stream_files_into_table

    db = f"st_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, "spark_catalog", db)
    target = qualified_name("spark_catalog", db, "t")
    shared = ensure_checkpoint_dir(spark).rstrip("/")
    run = uuid.uuid4().hex[:8]
    landing, ck = f"{shared}/s-landing-{run}", f"{shared}/s-stream-{run}"
    spark.range(10).write.parquet(landing)
    stream_files_into_table(spark, landing, spark.range(1).schema, target, ck, sink="table")
    spark.range(10, 30).write.mode("append").parquet(landing)
    stream_files_into_table(spark, landing, spark.range(1).schema, target, ck, sink="table")
    stream_files_into_table(spark, landing, spark.range(1).schema, target, ck, sink="table")
    assert sorted(r.id for r in spark.table(target).collect()) == list(range(30))


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 300, 50, 7])
def test_validity_ranges_with_common_and_null_versions(spark, rows_per_slice):
    from pyspark.sql import Window

    from strata.operators.history import validity_ranges

    i = F.col("id")
    df = spark.range(3000).select(
        F.when(i % 3 == 0, F.lit("hot")).when(i % 10 < 2, F.lit("nulls")).otherwise((i % 40).cast("string")).alias("k"),
        F.when(i % 10 < 2, F.lit(None)).when(i % 4 < 2, F.lit(5)).otherwise(i % 11).cast("long").alias("v"),
        i.alias("t"), F.lit("x").alias("extra"))
    w = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first(), F.col("t").asc_nulls_first())
    want = df.withColumn("valid_to", F.lead("v").over(w)).withColumn("is_current", F.col("valid_to").isNull())
    got = validity_ranges(df, ["k"], "v", ["t"], rows_per_slice=rows_per_slice)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_common_version_is_spread_over_groups(spark):
    from strata.operators import history

    df = spark.range(4000).select(F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(
        F.col("id")).alias("v"), F.col("id").alias("t"))
    cuts = history._hot_cuts(df, ["k"], "v", 200)
    out = history._slice_of(history._join_small(df, cuts.bounds, ["k"], "left", cuts.small), "v", cuts.pieces,
                            F.xxhash64("t"))
    sizes = [r["count"] for r in out.groupBy(history._SLICE, history._GROUP).count().collect()]
    assert max(sizes) <= 400 and sum(sizes) == 4000


def test_rejected_copies_are_written_in_chunks(spark):
    df = spark.range(45_000).select(F.lit(1).alias("k"), F.lit(None).cast("string").alias("v")).union(
        spark.createDataFrame([(2, "b"), (2, "b")], "k int, v string"))
    spec = CleanSpec(name="t", keys=("k",), required=("v",))
    kept, rejects = clean_with_rejects(df, spec)
    copies = rejects.filter("_reject_reason = 'duplicate'")
    assert kept.count() == 1 and copies.count() == 45_000 and rejects.count() == 45_001
    per_task = [r["count"] for r in copies.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) < 45_000
