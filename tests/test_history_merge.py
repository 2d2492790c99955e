"""Late versions merged into stored ranges, and versions without a change folded."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators.history import fold_unchanged, merge_history_table, merge_versions, validity_ranges
from strata.sinks.tables import ensure_schema, publish, qualified_name

SCHEMA = "k string, v int, seq int, a string, b int, part int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def versions(rng, n, keys="xyz"):
    # most rows belong to one key; versions repeat and may be NULL
    return [(rng.choice([keys[0]] * 6 + [*keys, None]), rng.choice([None, *range(12)]), i, rng.choice("pq"), rng.choice([1, None]), 0)
            for i in range(n)]


def folded(rows):
    out, last = [], {}
    one = {}
    for r in sorted(rows, key=lambda r: r[2]):
        one[r[0], r[1]] = r
    for r in sorted(one.values(), key=lambda r: (r[0] or "", r[1] is not None, r[1] or 0)):
        if last.get(r[0], ()) != r[3:5]:
            out.append(r)
        last[r[0]] = r[3:5]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,limit", [(0, 10 ** 6), (1, 4), (2, 2), (3, 1)])
def test_fold_equals_brute_force(spark, seed, limit):
    rows = versions(random.Random(seed), 70)
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(fold_unchanged(df, ["k"], "v", ["a", "b"], ["seq"], rows_per_slice=limit)) == folded(rows)


def test_fold_of_many_versions_of_one_key(spark):
    rng = random.Random(5)
    rows = [("x", i, i, rng.choice("pq"), 1, 0) for i in rng.sample(range(500), 300)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(fold_unchanged(df, ["k"], "v", ["a"], ["seq"], rows_per_slice=20)) == folded(rows)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert fold_unchanged(none, ["k"], "v", ["a"]).collect() == []
    assert merge_versions(validity_ranges(none, ["k"], "v"), none, ["k"], "v").collect() == []


@pytest.mark.parametrize("limit", [10 ** 6, 5])
def test_late_versions_equal_ranges_over_all(spark, limit):
    rng = random.Random(9)
    rows = [(k, v, s, a, b, hash(k) % 3 if k else 7) for k, v, s, a, b, _ in
            ((k, v * 50 + s, s, a, b, p) if v is not None else (k, s, s, a, b, p) for k, v, s, a, b, p in versions(rng, 90, "xyzuvw"))]
    rng.shuffle(rows)
    db = f"tdb_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, "spark_catalog", db)
    whole, changes = (qualified_name("spark_catalog", db, t) for t in ("h", "c"))
    make = lambda some: spark.createDataFrame(some, SCHEMA)
    first, batches = rows[:50], [rows[50:52], rows[52:], rows[50:52]]
    publish(validity_ranges(make(first), ["k"], "v", ["seq"]), whole, partition_by=("part",))
    publish(validity_ranges(fold_unchanged(make(first), ["k"], "v", ["a"], ["seq"]), ["k"], "v", ["seq"]), changes,
            partition_by=("part",))
    seen = list(first)
    for batch in batches:
        files = {r[0] for r in spark.table(whole).select("_metadata.file_path", "part").where(
            ~F.col("part").isin([r[5] for r in seen if r[0] in {b[0] for b in batch}] + [b[5] for b in batch])).distinct().collect()}
        merge_history_table(whole, make(batch), ["k"], "v", ["seq"], changes, ["a"], rows_per_slice=limit)
        seen += [b for b in batch if b not in seen]
        assert files <= {r[0] for r in spark.table(whole).select("_metadata.file_path").distinct().collect()}
        want = validity_ranges(make(seen), ["k"], "v", ["seq"])
        assert rows_of(spark.table(whole).select(*want.columns)) == rows_of(want)
        want = validity_ranges(fold_unchanged(make(seen), ["k"], "v", ["a"], ["seq"]), ["k"], "v", ["seq"])
        assert rows_of(spark.table(changes).select(*want.columns)) == rows_of(want)


def test_the_slice_search_is_one_expression_at_every_size(spark):
    from strata.operators.history import _slice_of

    df = spark.sql("select 5 v, array(named_struct('bound', 5, 'below', 0, 'upto', 3)) __strata_bounds, 1L __strata_null_pieces")

    def steps(pieces):
        out = _slice_of(df, "v", pieces, F.lit(7))
        assert out.first().asDict() == {"v": 5, "__strata_slice": 3, "__strata_group": 2}
        return out._jdf.queryExecution().analyzed().toString().count("Project")
    assert steps(1 << 14) == steps(2)


def test_many_slices_of_common_and_null_versions(spark):
    from pyspark.sql import Window

    rng = random.Random(3)
    rows = [(rng.choice("xxxxxy"), rng.choice([None, 1, 1, 2, 3, rng.randrange(200)]), i, "a", 1, 0) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    w = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first(), "seq")
    want = df.withColumn("valid_to", F.lead("v").over(w))
    got = validity_ranges(df, ["k"], "v", ["seq"], rows_per_slice=3).drop("is_current")
    # of rows equal in version the last may differ, not how many end where
    assert sorted(map(repr, got.select("k", "v", "valid_to").collect())) == sorted(map(repr, want.select("k", "v", "valid_to").collect()))


def test_a_replayed_batch_rewrites_nothing(spark):
    rows = [(k, v, v, "pq"[v % 2], 1, 0) for k in "xy" for v in range(6)]
    db = f"tdb_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, "spark_catalog", db)
    whole, changes = (qualified_name("spark_catalog", db, t) for t in ("h", "c"))
    first = spark.createDataFrame(rows[::2], SCHEMA)
    publish(validity_ranges(first, ["k"], "v", ["seq"]), whole, partition_by=("part",))
    publish(validity_ranges(fold_unchanged(first, ["k"], "v", ["a"], ["seq"]), ["k"], "v", ["seq"]), changes, partition_by=("part",))

    def files():
        return {r[0] for t in (whole, changes) for r in spark.table(t).select("_metadata.file_path").distinct().collect()}

    before = files()
    late = spark.createDataFrame(rows[1::2] * 2, SCHEMA)
    merge_history_table(whole, late, ["k"], "v", ["seq"], changes, ["a"])
    after = files()
    assert not before & after and spark.table(whole).count() == 12 and spark.table(changes).count() == 12
    merge_history_table(whole, late, ["k"], "v", ["seq"], changes, ["a"])
    assert files() == after
