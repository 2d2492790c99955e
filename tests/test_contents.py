"""The content oracles see wrong contents: a refresh that does nothing and
zeroed metrics must make the queries differ from their SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_compare import compare, duck
from strata.operators import summarise as summarise_module
from strata.plans import extended, pipeline
from strata.sinks.tables import publish, table_layout

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _matches(spark, con, name):
    r = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    return r["cols_ok"] and r["rows_ok"] and r["hash_ok"]


@pytest.mark.parametrize("name", ["incremental_clean_headers", "layers_refresh", "stream_layers_refresh"])
def test_refresh_that_does_nothing_is_seen(spark, con, monkeypatch, name):
    def nothing(cleaned, raw_all, new_rows, spec):
        return cleaned

    monkeypatch.setattr(extended, "refresh_cleaned", nothing)
    monkeypatch.setattr(pipeline, "refresh_cleaned", nothing)
    assert not _matches(spark, con, name)


@pytest.mark.parametrize("name", ["run_summary_layer", "layers_end_to_end", "layers_rerun", "layers_refresh"])
def test_zeroed_metric_is_seen(spark, con, monkeypatch, name):
    def zeroed(*args, **kwargs):
        out = summarise_module.summarise(*args, **kwargs)
        for f in out.schema.fields:
            if f.name.startswith("Total_"):
                out = out.withColumn(f.name, F.lit(0).cast(f.dataType))
        return out

    monkeypatch.setattr(pipeline, "summarise", zeroed)
    assert not _matches(spark, con, name)


def test_lost_raw_row_is_seen(spark, con, monkeypatch):
    plain = pipeline.with_ingestion_time
    monkeypatch.setattr(pipeline, "with_ingestion_time", lambda df: plain(df).distinct())
    assert not _matches(spark, con, "run_raw_layer")


def test_replacing_a_table_keeps_its_layout(spark):
    spark.sql("create schema if not exists layout_kept")
    df = spark.range(20).select("id", (F.col("id") % 3).alias("p"))
    publish(df, "layout_kept.buckets", bucket_by=(4, ["id"]))
    publish(df, "layout_kept.buckets")
    assert table_layout(spark, "layout_kept.buckets") == ([], (4, ["id"]))
    publish(df, "layout_kept.parts", partition_by=["p"])
    publish(df.select("p", "id"), "layout_kept.parts", schema_policy="merge")
    assert table_layout(spark, "layout_kept.parts")[0] == ["p"]
    assert spark.table("layout_kept.parts").count() == 20


def test_layers_with_the_users_own_specs(spark):
    from strata.plans.table_ops import workspace
    from strata.specs import CleanSpec, LoadSpec, Metric, SummarySpec

    config = workspace("ownspecs")
    cleaning = {"visits": CleanSpec(name="visits", keys=("id",), required=("page",), trim=("page",))}
    totals = {"by_page": SummarySpec(name="by_page", source="visits", group_by=("page",),
                                     metrics=(Metric("n", "count", "id"),), order_by=(("n", True),))}
    rows = [(1, " a "), (1, " a "), (2, "a"), (3, None), (4, "b")]
    first = spark.createDataFrame(rows, "id long, page string")
    pipeline.run_pipeline(spark, config, [LoadSpec(target="visits", reader=lambda s: first)], cleaning, totals)
    table = config.aggregated_table("by_page")
    assert {r.page: r.n for r in spark.table(table).collect()} == {"a": 2, "b": 1}
    more = spark.createDataFrame([(3, "b"), (5, "c")], "id long, page string")
    pipeline.refresh_layers(spark, config, "visits", more, cleaning, totals)
    assert {r.page: r.n for r in spark.table(table).collect()} == {"a": 2, "b": 2, "c": 1}
    with pytest.raises(ValueError, match="no cleaning rule"):
        pipeline.run_pipeline(spark, config, [LoadSpec(target="unknown", reader=lambda s: first)], cleaning, totals)
