"""Aggregate specs: NULL groups, sort order, the pre-aggregated join."""

import decimal

from pyspark.sql import functions as F

from strata.operators.joins import checked_join, decide_broadcast
from strata.operators.summarise import summarise
from strata.plans import catalogue as cat
from strata.specs import JoinSpec, Metric, SummarySpec

D = decimal.Decimal


def _headers(spark, rows):
    return spark.createDataFrame(
        rows, "SalesOrderID long, CustomerID long, OrderDate timestamp, TotalDue decimal(19,4)")


def _customers(spark, rows):
    return spark.createDataFrame(rows, "CustomerID long, CompanyName string")


def test_unmatched_order_goes_to_null_company(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    h = _headers(spark, [(1, 10, t, D("5.0000")), (2, 99, t, D("7.5000")), (3, 10, t, D("1.0000"))])
    c = _customers(spark, [(10, "A")])
    spec = cat.SUMMARY_SPECS[cat.SALES_BY_CUSTOMER]
    out = {r.CompanyName: r for r in summarise(h, spec, resolve=lambda _: c).collect()}
    assert out["A"].Total_Orders == 2 and out["A"].Total_Revenue == D("6.0000")
    assert out[None].Total_Orders == 1 and out[None].Total_Revenue == D("7.5000")


def test_all_null_amount_sums_to_null_orders_counted(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    h = _headers(spark, [(1, 10, t, None), (2, 10, t, None)])
    c = _customers(spark, [(10, "A")])
    (row,) = summarise(h, cat.SUMMARY_SPECS[cat.SALES_BY_CUSTOMER], resolve=lambda _: c).collect()
    assert row.Total_Orders == 2 and row.Total_Revenue is None


def test_null_date_is_one_group_sorted_last(spark):
    import datetime as dt
    h = _headers(spark, [(1, 1, dt.datetime(2024, 1, 1, 23, 59), D("1")),
                         (2, 1, None, D("2")), (3, 1, None, D("3")),
                         (4, 1, dt.datetime(2024, 1, 2, 0, 1), D("4"))])
    rows = summarise(h, cat.SUMMARY_SPECS[cat.SALES_BY_DAY]).collect()
    assert [str(r.OrderDateKey) for r in rows] == ["2024-01-02", "2024-01-01", "None"]
    assert rows[-1].Total_Orders == 2


def test_tied_counts_second_key_decides(spark):
    p = spark.createDataFrame([(1, "a", "Red", D("10")), (2, "b", "Red", D("20")),
                               (3, "c", "Blue", D("30")), (4, "d", "Blue", D("40")),
                               (5, "e", None, D("1"))],
                              "ProductID long, Name string, Color string, ListPrice decimal(19,4)")
    rows = summarise(p, cat.SUMMARY_SPECS[cat.BY_COLOR]).collect()
    assert [r.Color for r in rows] == ["Blue", "Red"]
    assert rows[0].Average_List_Price == D("35.00000000")


def test_output_types_match_direct_plan(spark):
    import datetime as dt
    h = _headers(spark, [(1, 10, dt.datetime(2024, 1, 1), D("5"))])
    c = _customers(spark, [(10, "A")])
    out = summarise(h, cat.SUMMARY_SPECS[cat.SALES_BY_CUSTOMER], resolve=lambda _: c)
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types == {"CompanyName": "string", "Total_Orders": "bigint", "Total_Revenue": "decimal(29,4)"}


def test_preaggregated_join_equals_direct_join(spark):
    rows = [(i, i % 37 if i % 11 else None, None, D(i % 13) if i % 5 else None) for i in range(2000)]
    h = _headers(spark, rows)
    c = _customers(spark, [(k, f"co{k % 4}" if k % 6 else None) for k in range(30)])
    spec = cat.SUMMARY_SPECS[cat.SALES_BY_CUSTOMER]
    fast = summarise(h, spec, resolve=lambda _: c, sort=False)
    direct = (h.join(c, "CustomerID", "left").groupBy("CompanyName")
              .agg(F.count_distinct("SalesOrderID").alias("Total_Orders"),
                   F.sum("TotalDue").alias("Total_Revenue")))
    assert sorted(map(tuple, fast.collect()), key=str) == sorted(map(tuple, direct.collect()), key=str)
    plan = fast._jdf.queryExecution().optimizedPlan().toString()
    # aggregated per customer below the join
    assert plan.index("Join") < plan.rindex("Aggregate")


def test_distinct_count_without_uniqueness_is_exact(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "g long, v long")
    spec = SummarySpec(name="x", source="t", group_by=("g",), metrics=(Metric("n", "count_distinct", "v"),))
    out = {r.g: r.n for r in summarise(df, spec).collect()}
    assert out == {1: 2, 2: 1}


def test_non_unique_join_side_uses_direct_join(spark):
    df = spark.createDataFrame([(1, 5), (2, 6)], "k long, v long")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k long, g string")
    spec = SummarySpec(name="x", source="t", group_by=("g",),
                       join=JoinSpec(table="r", on=("k",), columns=("k", "g"), unique_on_key=False),
                       metrics=(Metric("s", "sum", "v"),))
    out = {r.g: r.s for r in summarise(df, spec, resolve=lambda _: right).collect()}
    assert out == {"a": 5, "b": 5, None: 6}


def test_broadcast_only_within_bounds(spark):
    small = spark.range(100)
    assert decide_broadcast(small, max_rows=1000).broadcast
    assert not decide_broadcast(small, max_rows=10).broadcast
    assert not decide_broadcast(small, max_rows=1000, max_bytes=8).broadcast
    d = decide_broadcast(spark.createDataFrame([("abc",), (None,)], "s string"), max_rows=10)
    assert (d.rows, d.bytes) == (2, 3)
    big = spark.range(50)
    j = checked_join(big, spark.range(10), ["id"], "left", max_rows=5)
    assert "BroadcastHashJoin" not in j._jdf.queryExecution().executedPlan().toString()


def test_broadcast_proof_can_measure_a_bounding_frame(spark):
    left, right = spark.range(50), spark.range(10)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    # the bound (100 rows) exceeds max_rows: no broadcast although right itself is small
    j = checked_join(left, right, ["id"], "left", max_rows=20, bound_by=spark.range(100))
    assert "BroadcastHashJoin" not in plan(j)
    j = checked_join(left, right, ["id"], "left", max_rows=20, bound_by=spark.range(15))
    assert "BroadcastHashJoin" in plan(j)
