"""Partition-scoped writes: only touched partitions are rewritten, moves, deletes, NULLs."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import apply_changes, apply_changes_table, upsert, upsert_table
from strata.sinks.partitions import merge_partitions, overwrite_partitions, partition_columns
from strata.sinks.tables import SchemaMismatch, ensure_schema, publish, qualified_name

SCHEMA = "k long, v double, p string"


def _table(spark, rows, schema=SCHEMA, by=("p",)):
    db = f"tdb_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, "spark_catalog", db)
    name = qualified_name("spark_catalog", db, "t")
    publish(spark.createDataFrame(rows, schema), name, partition_by=by)
    return name


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files_of(spark, name, **where):
    df = spark.table(name)
    for c, v in where.items():
        df = df.where(F.col(c).eqNullSafe(F.lit(v)))
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


BASE = [(1, 1.0, "a"), (2, 2.0, "a"), (3, 3.0, "b"), (4, 4.0, "c"), (5, 5.0, None), (None, 6.0, "c")]


def test_untouched_partitions_keep_their_files(spark):
    name = _table(spark, BASE)
    before = {p: files_of(spark, name, p=p) for p in ("a", "b", "c", None)}
    upsert_table(name, spark.createDataFrame([(3, 30.0, "b"), (9, 9.0, "b")], SCHEMA), ["k"])
    assert rows_of(spark.table(name).select("k", "v", "p")) == rows_of(spark.createDataFrame(
        [(1, 1.0, "a"), (2, 2.0, "a"), (3, 30.0, "b"), (9, 9.0, "b"), (4, 4.0, "c"), (5, 5.0, None), (None, 6.0, "c")], SCHEMA))
    after = {p: files_of(spark, name, p=p) for p in ("a", "b", "c", None)}
    assert [p for p in before if before[p] != after[p]] == ["b"]


def test_a_key_that_moves_leaves_its_partition_and_the_last_one_drops_it(spark):
    name = _table(spark, BASE)
    merge_partitions(name, spark.createDataFrame([(3, 3.5, "a"), (5, 5.5, "z")], SCHEMA), ["k"])
    got = {r.k: (r.v, r.p) for r in spark.table(name).collect()}
    assert got[3] == (3.5, "a") and got[5] == (5.5, "z") and len(got) == 6
    assert {r.p for r in spark.table(name).select("p").distinct().collect()} == {"a", "c", "z"}
    assert sorted(r[0] for r in spark.sql(f"show partitions {name}").collect()) == ["p=a", "p=c", "p=z"]


def test_deletes_null_keys_and_nothing_to_do(spark):
    name = _table(spark, BASE)
    none = spark.createDataFrame([], SCHEMA)
    assert merge_partitions(name, none, ["k"]) == []
    merge_partitions(name, none, ["k"], touched=spark.createDataFrame([(None,), (1,), (77,)], "k long"))
    assert sorted(r.k for r in spark.table(name).collect()) == [2, 3, 4, 5]


def test_two_updates_of_a_key_and_wrong_columns_raise(spark):
    name = _table(spark, BASE)
    with pytest.raises(ValueError):
        merge_partitions(name, spark.createDataFrame([(3, 1.0, "a"), (3, 2.0, "b")], SCHEMA), ["k"])
    with pytest.raises(SchemaMismatch):
        merge_partitions(name, spark.createDataFrame([(3, 1.0, "a", 1)], SCHEMA + ", extra int"), ["k"])
    assert len(spark.table(name).collect()) == 6


def test_run_again_after_a_merge_that_died_between_its_steps(spark):
    """The overwrite is done, the emptied partition not yet dropped."""
    name = _table(spark, BASE)
    moved = spark.createDataFrame([(3, 3.5, "a")], SCHEMA)
    overwrite_partitions(spark.table(name).where("p = 'a'").unionByName(moved), name)
    assert spark.table(name).where("k = 3").count() == 2
    merge_partitions(name, moved, ["k"])
    assert rows_of(spark.table(name).where("k = 3").select("k", "v", "p")) == [(3, 3.5, "a")]


def test_session_setting_comes_back(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    name = _table(spark, BASE)
    overwrite_partitions(spark.createDataFrame([(8, 8.0, "b")], SCHEMA), name)
    assert spark.conf.get(key) == before
    assert sorted(r.k for r in spark.table(name).where("p = 'b'").collect()) == [8]


def test_overlapping_writes_of_one_session_stay_scoped(spark):
    from strata.sinks.partitions import _MODE, _dynamic

    before = spark.conf.get(_MODE)
    first, second = _dynamic(spark), _dynamic(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(_MODE) == "dynamic"
    second.__exit__(None, None, None)
    assert spark.conf.get(_MODE) == before


@pytest.mark.parametrize("seed", range(3))
def test_merges_equal_the_whole_table_forms(spark, seed):
    rng = random.Random(seed)
    schema = "k long, v double, p string, q int"
    make = lambda ks: [(k, rng.random(), rng.choice(["x", "y'z", "w w", None]), rng.choice([1, 2, None])) for k in ks]
    rows = make(range(60))
    name = _table(spark, rows, schema, ("p", "q"))
    assert partition_columns(spark, name) == ["p", "q"]
    whole = spark.createDataFrame(rows, schema)
    updates = spark.createDataFrame(make(rng.sample(range(80), 25)), schema)
    upsert_table(name, updates, ["k"])
    want = upsert(whole, updates, ["k"])
    assert rows_of(spark.table(name).select("k", "v", "p", "q")) == rows_of(want)
    feed = spark.createDataFrame([(*r, i, rng.choice("UD")) for i, r in enumerate(make(rng.choices(range(90), k=60)))],
                                 schema + ", seq int, op string")
    apply_changes_table(name, feed, ["k"], "seq")
    assert rows_of(spark.table(name).select("k", "v", "p", "q")) == rows_of(apply_changes(want, feed, ["k"], "seq"))
