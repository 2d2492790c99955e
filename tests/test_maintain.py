"""Aggregates kept up by deltas against a rebuild; batches, ledger and replays through the layers."""

import random
import uuid
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions.audit import INGESTION_TIME
from strata.operators.maintain import StateTable, build_state, finish_state, state_delta
from strata.operators.summarise import summarise
from strata.plans import catalogue as cat
from strata.plans import pipeline
from strata.plans.pipeline import refresh_layers, run_pipeline
from strata.plans.table_ops import workspace
from strata.sources.ledger import BATCH, BatchConflict, batch_rows, content
from strata.specs import CleanSpec, JoinSpec, LoadSpec, Metric, SummarySpec
from strata.streaming.incremental import stream_files_into_layers

FACTS = "id long, c long, amount decimal(19,4), n int, tag string"
SIDES = "c long, name string"
BY_TAG = SummarySpec(
    name="by_tag", source="facts", group_by=("tag",), unique=("id",),
    metrics=(Metric("rows", "count_distinct", "id"), Metric("with_n", "count", "n"), Metric("total", "sum", "amount"),
             Metric("n_total", "sum", "n"), Metric("mean", "avg", "amount"), Metric("n_mean", "avg", "n")),
    order_by=(("total", True),))
BY_NAME = SummarySpec(
    name="by_name", source="facts", group_by=("name",), unique=("id",), where_not_null=("id",),
    join=JoinSpec(table="sides", on=("c",), columns=("c", "name"), unique_on_key=True),
    metrics=(Metric("rows", "count_distinct", "id"), Metric("total", "sum", "amount")))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def facts(spark, rows):
    return spark.createDataFrame(rows, FACTS)


def random_facts(rng, ids):
    return [(i, rng.choice([1, 2, 3, 9, None]), rng.choice([None, Decimal(rng.randrange(-9999, 9999)) / 100]),
             rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", "c", None])) for i in ids]


def fresh(spark, spec):
    return StateTable(f"`spark_catalog`.`st_{uuid.uuid4().hex[:8]}`.`{spec.name}`", spec, parts=5)


def step(spark, state, spec, table, old, new, tables, batch):
    state.write_delta(state_delta(spec, table, old, new, tables.__getitem__), batch)
    return state.apply_delta(spark, batch)


@pytest.mark.parametrize("seed", range(3))
def test_deltas_equal_a_rebuild(spark, seed):
    rng = random.Random(seed)
    now = {r[0]: r for r in random_facts(rng, range(60))}
    sides = {c: (c, rng.choice(["x", "y", None])) for c in (1, 2, 3)}
    by_tag, by_name = fresh(spark, BY_TAG), fresh(spark, BY_NAME)
    side = lambda: spark.createDataFrame(list(sides.values()), SIDES)
    by_tag.build(facts(spark, list(now.values())))
    by_name.build(facts(spark, list(now.values())), lambda t: side())
    for batch in range(2):
        touched = rng.sample(range(75), 20)
        old = [now[i] for i in touched if i in now]
        new = random_facts(rng, [i for i in touched if rng.random() < .7])
        for i in touched:
            now.pop(i, None)
        now.update({r[0]: r for r in new})
        for state, spec in ((by_tag, BY_TAG), (by_name, BY_NAME)):
            step(spark, state, spec, "facts", facts(spark, old), facts(spark, new), {"sides": side()}, f"f{batch}")
        # the joined side: one row changes, one goes, one comes
        old_sides = [sides[c] for c in (1, 2, 9) if c in sides]
        sides.pop(2, None)
        sides[1], sides[9] = (1, rng.choice(["x", "z"])), (9, "x")
        step(spark, by_name, BY_NAME, "sides", spark.createDataFrame(old_sides, SIDES),
             spark.createDataFrame([sides[1], sides[9]], SIDES), {"facts": facts(spark, list(now.values()))}, f"s{batch}")
        whole = facts(spark, list(now.values()))
        for state, spec in ((by_tag, BY_TAG), (by_name, BY_NAME)):
            want = summarise(whole, spec, resolve=lambda t: side())
            got = state.published(spark, whole)
            assert got.dtypes == want.dtypes
            assert rows_of(got) == rows_of(want)


def test_groups_vanish_and_sums_become_null(spark):
    rows = [(1, 1, Decimal("2.5"), 1, "a"), (2, 1, None, None, "a"), (3, 1, Decimal("1"), 2, "b")]
    state = fresh(spark, BY_TAG)
    state.build(facts(spark, rows))
    step(spark, state, BY_TAG, "facts", facts(spark, [rows[0], rows[2]]), facts(spark, []), {}, "x")
    assert rows_of(state.published(spark, facts(spark, []))) == [("a", 1, 0, None, None, None, None)]


def test_only_touched_parts_are_replaced_and_a_delta_applies_once(spark):
    rows = [(i, 1, Decimal(i), i, f"g{i}") for i in range(40)]
    state = fresh(spark, BY_TAG)
    state.build(facts(spark, rows))
    files = lambda: {r[0] for r in spark.table(state.name).select("_metadata.file_path").distinct().collect()}
    before = files()
    old, new = facts(spark, [rows[3]]), facts(spark, [(3, 1, Decimal(7), 3, "g3")])
    assert step(spark, state, BY_TAG, "facts", old, new, {}, "b1") == 1
    assert len(before - files()) == 1
    kept = files()
    assert state.apply_delta(spark, "b1") == 0 and files() == kept
    want = facts(spark, [r if r[0] != 3 else (3, 1, Decimal(7), 3, "g3") for r in rows])
    assert rows_of(state.published(spark, want)) == rows_of(summarise(want, BY_TAG))


def test_a_change_that_cancels_out_touches_nothing(spark):
    rows = [(1, 1, Decimal(1), 1, "a")]
    state = fresh(spark, BY_TAG)
    state.build(facts(spark, rows))
    assert step(spark, state, BY_TAG, "facts", facts(spark, rows), facts(spark, rows), {}, "b") == 0


def test_what_counts_cannot_keep_raises(spark):
    rows = spark.createDataFrame([(1, 1.5, "a")], "id long, x double, tag string")
    for m in (Metric("m", "sum", "x"), Metric("m", "count_distinct", "x")):
        with pytest.raises(ValueError):
            build_state(replace(BY_TAG, metrics=(m,)), rows)
    with pytest.raises(ValueError):
        state_delta(BY_TAG, "sides", rows, rows, {}.__getitem__)


def test_empty_input(spark):
    assert finish_state(build_state(BY_TAG, facts(spark, [])), BY_TAG, facts(spark, [])).collect() == []


# ------------------------------------------------------------------ through the layers

RAW = "id long, c long, amount decimal(19,4), n int, tag string"
CLEAN = {"facts": CleanSpec(name="facts", keys=("id",), required=("tag",), trim=("tag",)),
         "sides": CleanSpec(name="sides", keys=("c",))}
SUMMARIES = {"by_tag": BY_TAG, "by_name": BY_NAME}
FIRST = [(i, i % 4, Decimal(i), i, f" t{i % 3}") for i in range(20)]
SECOND = [(3, 1, Decimal("-5"), 3, "t9"), (21, 2, Decimal(8), 1, "t0 "), (5, 5, Decimal(1), 1, None)]


def config_for(tag, **more):
    return replace(workspace(tag), raw_batches=True, **more)


def loaded(spark, config):
    loads = [LoadSpec("facts", lambda s: facts(s, FIRST)),
             LoadSpec("sides", lambda s: s.createDataFrame([(0, "x"), (1, "y"), (2, "x")], SIDES))]
    run_pipeline(spark, config, loads, CLEAN, SUMMARIES)


def tables(spark, config):
    raw = [rows_of(spark.table(config.raw_table(t)).drop(INGESTION_TIME)) for t in CLEAN]
    cleaned = [rows_of(spark.table(config.cleaned_table(t)).drop(INGESTION_TIME)) for t in CLEAN]
    return raw, cleaned, [rows_of(spark.table(config.aggregated_table(n))) for n in SUMMARIES]


def refresh(spark, config, rows=SECOND, batch="day2", table="facts"):
    schema = FACTS if table == "facts" else SIDES
    return refresh_layers(spark, config, table, spark.createDataFrame(rows, schema), CLEAN, SUMMARIES, batch_id=batch)


def rebuilt(spark, config):
    clean = {t: pipeline.clean(spark.table(config.raw_table(t)).drop(BATCH), CLEAN[t]) for t in CLEAN}
    return ([rows_of(clean[t].drop(INGESTION_TIME)) for t in CLEAN],
            [rows_of(summarise(clean[s.source], s, resolve=clean.__getitem__)) for s in SUMMARIES.values()])


FORMS = [{}, {"cleaned_parts": 4, "state_parts": 3}]


@pytest.mark.parametrize("form", FORMS)
def test_a_batch_delivered_twice_equals_one_delivery(spark, form):
    config = config_for("twice", **form)
    loaded(spark, config)
    refresh(spark, config)
    once = tables(spark, config)
    assert len(once[0][0]) == len(FIRST) + len(SECOND)
    (run,) = refresh(spark, config)
    assert run.rows == 0 and tables(spark, config) == once
    cleaned, summaries = rebuilt(spark, config)
    assert [[r[:len(c[0])] for r in rows] for rows, c in zip(once[1], cleaned)] == cleaned and once[2] == summaries
    with pytest.raises(BatchConflict):
        refresh(spark, config, SECOND[:1])
    assert tables(spark, config) == once
    with pytest.raises(ValueError):
        refresh(spark, config, batch=None)


@pytest.mark.parametrize("form,at", [(f, k) for f in FORMS for k in ("log:raw", "log:delta", "write", "log:cleaned", "log:done")
                                     if f or k != "log:delta"])
def test_a_run_that_died_goes_on(spark, monkeypatch, form, at):
    config = config_for("died", **form)
    loaded(spark, config)

    class Died(Exception):
        pass

    with monkeypatch.context() as patch:
        if at == "write":
            name = "merge_partitions" if form else "_write"
            real = getattr(pipeline, name)

            def write(*a, **k):
                real(*a, **k)
                raise Died
            patch.setattr(pipeline, name, write)
        else:
            log = pipeline.Ledger.log

            def dying(self, table, batch_id, phase, *a):
                if phase == at[4:]:
                    raise Died
                log(self, table, batch_id, phase, *a)
            patch.setattr(pipeline.Ledger, "log", dying)
        with pytest.raises(Died):
            refresh(spark, config)
    refresh(spark, config)
    got = tables(spark, config)
    cleaned, summaries = rebuilt(spark, config)
    assert len(got[0][0]) == len(FIRST) + len(SECOND)
    assert [[r[:len(c[0])] for r in rows] for rows, c in zip(got[1], cleaned)] == cleaned and got[2] == summaries


def test_the_joined_side_is_refreshed_and_a_full_load_starts_anew(spark):
    config = config_for("side", cleaned_parts=4, state_parts=3)
    loaded(spark, config)
    refresh(spark, config, [(1, "a"), (3, "new")], "s1", "sides")
    refresh(spark, config)
    assert tables(spark, config)[2] == rebuilt(spark, config)[1]
    loaded(spark, config)
    assert {r[0] for r in spark.table(config.raw_table("facts")).select(BATCH).distinct().collect()} == {"full"}
    refresh(spark, config)                       # the same id again, after the full load
    assert len(tables(spark, config)[0][0]) == len(FIRST) + len(SECOND)
    assert tables(spark, config)[2] == rebuilt(spark, config)[1]


def test_untouched_parts_of_a_cleaned_table_keep_their_files(spark):
    config = config_for("parts", cleaned_parts=8, state_parts=3)
    loaded(spark, config)
    name = config.cleaned_table("facts")
    files = lambda: {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}
    before = files()
    refresh(spark, config, SECOND[:1])
    assert len(before - files()) == 1


def test_a_replayed_stream_replaces_itself(spark, tmp_path):
    config = config_for("replay", cleaned_parts=4, state_parts=3)
    base = [LoadSpec(t, (lambda s, t=t: s.createDataFrame([], "CustomerID long, CompanyName string, EmailAddress string")
                         if t == cat.CUSTOMERS else s.createDataFrame(
                             [(1, 1, Decimal(5), None)], "SalesOrderID long, CustomerID long, TotalDue decimal(19,4), OrderDate timestamp")))
            for t in (cat.CUSTOMERS, cat.HEADERS)]
    rules = {t: replace(cat.CLEAN_SPECS[t], trim=(), lower_trim=()) for t in (cat.CUSTOMERS, cat.HEADERS)}
    kept = {n: cat.SUMMARY_SPECS[n] for n in (cat.SALES_BY_CUSTOMER, cat.SALES_BY_DAY, cat.BY_COMPANY)}
    run_pipeline(spark, config, base, rules, kept)
    new = spark.createDataFrame([(2, 1, Decimal(7), None), (1, 2, Decimal(1), None)],
                                "SalesOrderID long, CustomerID long, TotalDue decimal(19,4), OrderDate timestamp")
    landing = str(tmp_path / "landing")
    new.coalesce(1).write.parquet(landing)
    real = dict(cat.CLEAN_SPECS), dict(cat.SUMMARY_SPECS)
    cat.CLEAN_SPECS.update(rules)
    drop = [n for n in cat.SUMMARY_SPECS if n not in kept]
    for n in drop:
        cat.SUMMARY_SPECS.pop(n)
    try:
        for run in (1, 2):       # a new checkpoint: the micro-batch comes again under its number
            stream_files_into_layers(spark, config, cat.HEADERS, landing, new.schema, str(tmp_path / f"ck{run}"))
            assert spark.table(config.raw_table(cat.HEADERS)).count() == 3
            by_day = spark.table(config.aggregated_table(cat.SALES_BY_DAY)).collect()
            assert [(r.Total_Orders, r.Total_Revenue) for r in by_day] == [(2, Decimal(12))]
    finally:
        cat.CLEAN_SPECS.update(real[0])
        cat.SUMMARY_SPECS.clear()
        cat.SUMMARY_SPECS.update(real[1])


def test_content_does_not_depend_on_order_or_partitions(spark):
    df = facts(spark, FIRST)
    assert content(df) == content(df.repartition(5).orderBy(F.desc("id")))
    assert content(df) != content(df.withColumn("n", F.col("n") + 1))
    assert content(facts(spark, [])) == (0, "0")


def test_batch_rows_are_the_source_rows(spark):
    config = config_for("rows")
    loaded(spark, config)
    refresh(spark, config)
    assert rows_of(batch_rows(spark, config.raw_table("facts"), "day2")) == rows_of(facts(spark, SECOND))
