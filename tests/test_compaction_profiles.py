"""Compaction by file size, and column profiles added up over loads."""

import datetime
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.operators.profiles import column_states, merge_states, store_profile, table_profile
from strata.sinks import compaction
from strata.sinks.compaction import compact_small_files, file_sizes, finish_compactions
from strata.sinks.tables import ensure_schema, publish, qualified_name


def _name(spark, table="t"):
    db = f"tdb_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, "spark_catalog", db)
    return qualified_name("spark_catalog", db, table)


def _mixed(spark, rows=60_000):
    """A table of two large files and many small ones, all of its rows."""
    name = _name(spark)
    wide = spark.range(rows).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    publish(wide.repartition(2), name)
    small = wide.where("id % 20 = 0").withColumn("id", -F.col("id"))
    small.repartition(24).write.mode("append").insertInto(name)
    spark.catalog.refreshTable(name)
    return name


def _files(spark, name):
    return {r["file"]: r["bytes"] for r in file_sizes(spark, name).collect()}


def _digest(spark, name):
    return spark.table(name).agg(F.count(F.lit(1)), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()


def test_small_files_are_packed_and_large_ones_keep_their_names(spark):
    name = _mixed(spark)
    before, rows = _files(spark, name), _digest(spark, name)
    target = 100_000
    large = {f for f, b in before.items() if b >= target / 2}
    small = sum(b for f, b in before.items() if f not in large)
    assert len(large) == 2 and len(before) == 26
    packs = compact_small_files(spark, name, target)
    after = _files(spark, name)
    assert large <= set(after) and _digest(spark, name) == rows
    assert len(after) - len(large) <= small // target + 1 and packs >= 1
    assert not set(after) & (set(before) - large)
    # nothing small is left together: a second run packs at most the remainders
    assert compact_small_files(spark, name, 1) == 0 and _files(spark, name) == after


def test_large_files_are_not_read(spark):
    name = _mixed(spark, 4000)
    sizes = sorted(_files(spark, name).values())
    below = spark.table(name).where(F.col("_metadata.file_size") < sizes[-1])
    assert len(below.inputFiles()) == 26 and below.select("_metadata.file_path").distinct().count() < 26


def test_partitions_are_packed_apart(spark):
    name = _name(spark)
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("a b/="), F.col("id") % 3)).alias("p"))
    publish(rows.repartition(4), name, partition_by=("p",))
    rows.repartition(3).withColumn("id", F.col("id") + 5000).write.mode("append").insertInto(name)
    spark.catalog.refreshTable(name)
    before = _digest(spark, name)
    assert compact_small_files(spark, name) == 3
    assert len(_files(spark, name)) == 3 and _digest(spark, name) == before
    assert spark.table(name).where("p is null").count() == 2000


@pytest.mark.parametrize("when", ["before the commit", "while packs move in"])
def test_a_compaction_that_died_loses_nothing(spark, monkeypatch, when):
    name = _mixed(spark, 20_000)
    before = _digest(spark, name)
    if when == "before the commit":
        monkeypatch.setattr(compaction, "_write_packs", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    else:
        real = compaction._path
        calls = []

        def path(spark, uri):
            calls.append(uri)
            if len(calls) == 4:
                raise RuntimeError("lost")
            return real(spark, uri)

        monkeypatch.setattr(compaction, "_path", path)
    with pytest.raises(RuntimeError):
        compact_small_files(spark, name, 1 << 20)
    monkeypatch.undo()
    spark.catalog.refreshTable(name)
    assert spark.table(name).select("id").distinct().count() == 20_000 + 20_000 // 20 - 1
    assert finish_compactions(spark, name) == (0 if when == "before the commit" else 1)
    spark.catalog.refreshTable(name)
    assert _digest(spark, name) == before
    assert compact_small_files(spark, name, 1 << 20) == (1 if when == "before the commit" else 0)
    assert _digest(spark, name) == before


def test_bucketed_and_empty_tables(spark):
    name, empty = _name(spark), _name(spark)
    publish(spark.range(100), name, bucket_by=(4, ["id"]))
    with pytest.raises(ValueError):
        compact_small_files(spark, name)
    publish(spark.range(0), empty)
    assert compact_small_files(spark, empty) == 0 and spark.table(empty).count() == 0


def test_profiles_of_loads_add_up_within_their_bounds(spark, sf_check):
    name = _name(spark)
    lines = spark.read.parquet(f"{sf_check}/lineitem.parquet")
    columns = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"]
    for i in range(4):
        store_profile(lines.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(4)) == i), name, f"load {i}", columns)
    store_profile(lines.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(4)) == 2), name, "load 2", columns)
    got = {r["column"]: r for r in table_profile(spark, name, (0.1, 0.5, 0.9)).collect()}
    db = duckdb.connect()
    db.execute(f"create view t as select {', '.join(columns)} from '{sf_check}/lineitem.parquet'")
    for c in columns:
        number = {"l_shipdate": "date_diff('day', date '1970-01-01', l_shipdate::date)::double",
                  "l_returnflag": "length(l_returnflag)::double"}.get(c, f"{c}::double")
        if c == "l_shipdate" and not dict(lines.dtypes)[c] == "date":
            number = "epoch_us(l_shipdate)::double"
        n, nulls, distinct, least, largest = db.sql(
            f"select count(*), count(*) - count({c}), count(distinct {c}), min({number}), max({number}) from t").fetchall()[0]
        r = got[c]
        assert (r["n_rows"], r["n_null"], r["least"], r["largest"]) == (n, nulls, least, largest), c
        assert abs(r["n_distinct"] - distinct) <= max(1, 0.04 * distinct), c
        for q, value in ((0.1, r["q10"]), (0.5, r["q50"]), (0.9, r["q90"])):
            below, upto = db.sql(f"select count(*) filter (where {number} < {value!r}) / count(*)::double, "
                                 f"count(*) filter (where {number} <= {value!r}) / count(*)::double from t").fetchall()[0]
            assert below - 0.02 <= q <= upto + 0.02, (c, q)


def test_profiles_of_odd_columns(spark):
    rows = spark.createDataFrame(
        [(None, None, float("nan"), None, True, [1]), (1, " ", 2.0, datetime.date(2020, 1, 2), None, None),
         (1, "ab", None, None, False, [1])],
        "a int, `b c` string, d double, e date, f boolean, g array<int>")
    got = {r["column"]: r for r in merge_states(column_states(rows, "x")).collect()}
    assert [(r["n_rows"], r["n_null"], r["n_blank"], r["n_distinct"]) for r in (got[c] for c in rows.columns)] == [
        (3, 1, 0, 1), (3, 1, 1, 2), (3, 1, 0, 2), (3, 2, 0, 1), (3, 1, 0, 2), (3, 1, 0, 1)]
    assert (got["d"]["least"], got["d"]["largest"], got["d"]["q50"]) == (2.0, 2.0, 2.0)
    assert got["b c"]["largest"] == 2.0 and got["f"]["q50"] is None and got["e"]["q50"] == 18263.0
    none = {r["column"]: r for r in merge_states(column_states(rows.limit(0), "x")).collect()}
    assert none["a"]["n_rows"] == 0 and none["a"]["n_distinct"] == 0 and none["a"]["q50"] is None


def test_packs_are_written_without_a_sort_of_their_rows(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    key, seen = "spark.sql.maxConcurrentOutputFileWriters", {}
    before = spark.conf.get(key, None)
    write = DataFrameWriter.parquet

    def watched(self, path, *args, **kwargs):
        seen[path.rsplit("/", 1)[1]] = int(spark.conf.get(key, "0"))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    name = _mixed(spark, 4000)
    rows = _digest(spark, name)
    # more packs than files that a task may hold open
    assert compact_small_files(spark, name, 20_000) > 1 and _digest(spark, name) == rows
    assert seen["data"] > 0 and spark.conf.get(key, None) == before
    finish_compactions(spark, name)
