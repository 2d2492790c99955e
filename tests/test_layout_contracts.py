"""Range and interleaved layouts, versions switched under a reader, row contracts, accounting."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators.contracts import (ContractBroken, Reference, Rule, enforce_rows, orphans, reference_report, rule_report,
                                        split_rows)
from strata.sinks.layout import files_met, publish_layout, z_value
from strata.sinks.tables import SchemaMismatch, ensure_schema, qualified_name
from strata.sinks.versions import default_base, drop_versions, location, publish_version, versions


def _name(spark, table="t"):
    db = f"tdb_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, "spark_catalog", db)
    return qualified_name("spark_catalog", db, table)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def grid(spark):
    return spark.range(64 * 64).select((F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"), "id")


def test_range_layout_lets_a_filter_meet_few_files(spark):
    name = _name(spark)
    publish_layout(grid(spark).repartition(5), name, ["x"], 16)
    t = spark.table(name)
    assert files_met(t) == 16 and files_met(t.where("x = 9")) == 1 and files_met(t.where("y = 9")) == 16
    assert rows_of(t) == rows_of(grid(spark))


def test_interleaved_layout_serves_both_columns(spark):
    name = _name(spark)
    publish_layout(grid(spark).repartition(5), name, ["x", "y"], 16, interleave=True)
    t = spark.table(name)
    assert rows_of(t) == rows_of(grid(spark))
    for c in ("x", "y"):
        assert max(files_met(t.where(F.col(c) == v)) for v in (0, 9, 40, 63)) <= 6
    assert files_met(t.where("x between 8 and 11 and y between 8 and 11")) <= 2


def test_interleaving_of_all_kinds_nulls_and_skew(spark):
    rows = [(None, None, float("nan"), None)] * 3 + [("same", "2020-01-01", 1.0, True)] * 200
    rows += [(f"w{i % 17}", f"2021-01-{1 + i % 28:02d}", i / 7, i % 2 == 0) for i in range(150)]
    df = spark.createDataFrame(rows, "s string, d string, f double, b boolean").withColumn("d", F.to_date("d"))
    out = z_value(df, ["s", "d", "f", "b"], bits=6)
    assert list(map(repr, rows_of(out.drop("__strata_z")))) == list(map(repr, rows_of(df)))
    z = [r["__strata_z"] for r in out.collect()]
    assert 0 <= min(z) and max(z) < 1 << 24 and len(set(z)) > 50
    with pytest.raises(ValueError):
        z_value(df, ["s", "d", "f"], bits=21)
    assert z_value(df.limit(0), ["s"], 3).collect() == []


def test_a_reader_never_fails_during_ten_publishes(spark):
    name = _name(spark)
    base = default_base(spark, name)
    make = lambda n: spark.range(50).withColumn("n", F.lit(n))
    publish_version(make(0), name, base)
    stop, seen, failed = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(spark.table(name).agg(F.count("*"), F.min("n"), F.max("n")).first()))
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 11):
        publish_version(make(n), name, base, keep=4)
    stop.set()
    reader.join()
    assert not failed and seen and all(c == 50 and a == b for c, a, b in seen)
    assert tuple(spark.table(name).agg(F.count("*"), F.min("n")).first()) == (50, 10)
    assert len(versions(spark, base)) == 4 and location(spark, name).endswith(versions(spark, base)[-1])
    drop_versions(spark, name, base)
    assert versions(spark, base) == []


def test_versions_read_themselves_add_columns_and_survive_a_failed_write(spark):
    name = _name(spark)
    base = default_base(spark, name)
    publish_version(spark.range(5), name, base)
    publish_version(spark.table(name).withColumn("id", F.col("id") * 2), name, base)
    assert rows_of(spark.table(name)) == [(0,), (2,), (4,), (6,), (8,)]
    publish_version(spark.range(2).withColumn("more", F.lit("x")), name, base)
    assert rows_of(spark.table(name)) == [(0, "x"), (1, "x")]
    with pytest.raises(SchemaMismatch):
        publish_version(spark.range(1), name, base, schema_policy="strict")
    with pytest.raises(Exception):
        publish_version(spark.range(9).select("id", F.raise_error(F.lit("no")).cast("string").alias("more")), name, base)
    assert rows_of(spark.table(name)) == [(0, "x"), (1, "x")]


RULES = [Rule("positive", "n > 0"), Rule("named", "name is not null and name <> ''"), Rule("known", "kind in ('a', 'b')")]


def items(spark):
    return spark.createDataFrame([(1, "x", "a"), (0, "", "c"), (None, None, None), (5, "y", "b"), (-1, "z", "a")],
                                 "n int, name string, kind string")


def test_rules_are_counted_in_one_pass(spark):
    report = rule_report(items(spark), RULES)
    assert rows_of(report) == [("known", 5, 2), ("named", 5, 2), ("positive", 5, 3)]
    assert report._jdf.queryExecution().executedPlan().toString().count("Scan") <= 2     # one input
    good, bad = split_rows(items(spark), RULES)
    assert rows_of(good) == [(1, "x", "a"), (5, "y", "b")]
    assert sorted(map(tuple, (r.broken_rules for r in bad.collect()))) == [
        ("positive",), ("positive", "named", "known"), ("positive", "named", "known")]
    assert rows_of(rule_report(items(spark).limit(0), RULES)) == [(r, 0, 0) for r in ("known", "named", "positive")]


def test_rules_that_do_not_fit_raise(spark):
    with pytest.raises(ValueError):
        rule_report(items(spark), [Rule(f"r{i}", "true") for i in range(64)])
    with pytest.raises(ValueError):
        rule_report(items(spark), [RULES[0], RULES[0]])
    assert rule_report(items(spark), [Rule(f"r{i}", "n = 5") for i in range(63)]).where("n_broken <> 4").count() == 0


def test_references_with_hot_and_null_values(spark):
    rows = [(1, 7)] * 500 + [(2, 8)] * 3 + [(None, 7), (3, None), (1, 9)]
    df = spark.createDataFrame(rows, "a int, b int")
    other = spark.createDataFrame([(1, 7), (1, 7), (4, 4), (None, None)], "x int, y int")
    ref = Reference("pair", ("a", "b"), ("x", "y"))
    assert rows_of(orphans(df, ref, other)) == [(1, 9, 1), (2, 8, 3)]
    assert rows_of(reference_report(df, ref, other)) == [("pair", 506, 4)]
    assert rows_of(reference_report(df.limit(0), ref, other)) == [("pair", 0, 0)]


def test_enforce_names_what_is_broken(spark):
    good = items(spark).where("n > 0")
    assert enforce_rows(good, RULES) is good
    with pytest.raises(ContractBroken, match="positive: 3 rows"):
        enforce_rows(items(spark), RULES)
    assert enforce_rows(items(spark), RULES, allowed=3) is not None
    ref = Reference("n_known", ("n",), ("id",))
    with pytest.raises(ContractBroken, match="n_known: 2 rows"):
        enforce_rows(good, references=[(ref, spark.range(1))])


@pytest.mark.parametrize("filter_first", [False, True])
def test_accounting_by_the_writing_job(spark, filter_first):
    from strata.operators.clean import CleanCounts, clean
    from strata.specs import CleanSpec

    rows = [(1, "a"), (1, "a"), (1, None), (2, None), (3, " c "), (3, "d"), (None, "e")]
    df = spark.createDataFrame(rows, "k long, v string").repartition(3)
    spec = CleanSpec(name="t", keys=("k",), required=("v",), trim=("v",), dedupe_after_filter=filter_first)
    counts = CleanCounts()
    out = clean(df, spec, counts)
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
    got = rows_of(out)
    assert got == rows_of(clean(df, spec))
    kept = counts.account()
    assert kept["input"] == 7 and kept["output"] == len(got)
    assert kept["duplicates"] + kept["rejected"] + kept["output"] == kept["input"]
    assert (kept["duplicates"], kept["rejected"]) == ((2, 2) if filter_first else (3, 1))


def test_accounting_of_no_rows(spark):
    from strata.operators.clean import CleanCounts, clean
    from strata.specs import CleanSpec

    counts = CleanCounts()
    clean(spark.createDataFrame([], "k long, v string"), CleanSpec(name="t", keys=("k",)), counts).collect()
    assert counts.account() == {"input": 0, "duplicates": 0, "rejected": 0, "output": 0}
