"""Cleaning rules on tiny frames (FIXTURES section 5)."""

from pyspark.sql import functions as F

from strata.operators.clean import clean
from strata.operators.dedupe import dedupe
from strata.plans import catalogue as cat
from strata.specs import CleanSpec


def test_null_key_rows_are_one_group(spark):
    df = spark.createDataFrame([(None, "q"), (None, "r")], "k long, v string")
    out = dedupe(df, ["k"]).collect()
    assert len(out) == 1 and out[0].v == "q"


def test_dedupe_then_filter_loses_key_filter_first_keeps_it(spark):
    # the NULL row is first under the tie-break, as an arbitrary pick could be
    df = spark.createDataFrame([(1, None, 0), (1, "a", 1)], "k long, v string, seq int")
    ref = CleanSpec(name="t", keys=("k",), required=("v",), tie_break=("seq",))
    assert clean(df, ref).count() == 0
    opt = CleanSpec(name="t", keys=("k",), required=("v",), tie_break=("seq",),
                    dedupe_after_filter=True)
    rows = clean(df, opt).collect()
    assert [(r.k, r.v) for r in rows] == [(1, "a")]


def test_default_tie_break_is_total_and_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "b", 2), (1, "a", 9)], "k long, v string, w int")
    (row,) = dedupe(df, ["k"]).collect()
    assert (row.v, row.w) == ("a", 9)


def test_dedupe_same_rows_for_any_partitioning(spark):
    rows = [(i % 50, f"v{(i * 7919) % 1000:04d}", i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k long, v string, n long")
    picks = []
    for parts in (1, 3, 7):
        out = dedupe(df.repartition(parts), ["k"]).orderBy("k").collect()
        picks.append([tuple(r) for r in out])
    assert picks[0] == picks[1] == picks[2]
    assert len(picks[0]) == 50


def test_blank_required_text_kept_and_trimmed_to_empty(spark):
    df = spark.createDataFrame([(1, "   ", " X ")], "CustomerID long, EmailAddress string, CompanyName string")
    (row,) = clean(df, cat.CLEAN_SPECS[cat.CUSTOMERS]).collect()
    assert row.EmailAddress == "" and row.CompanyName == "X"


def test_trim_removes_only_spaces(spark):
    df = spark.createDataFrame([(1, "\t a  ", None)], "CustomerID long, EmailAddress string, CompanyName string")
    (row,) = clean(df, cat.CLEAN_SPECS[cat.CUSTOMERS]).collect()
    assert row.EmailAddress == "\t a  "
    assert row.CompanyName is None


def test_upper_and_lower_normalisation(spark):
    df = spark.createDataFrame([(1, " Bolt ", " ab-1 ", " Red ")],
                               "ProductID long, Name string, ProductNumber string, Color string")
    (row,) = clean(df, cat.CLEAN_SPECS[cat.PRODUCTS]).collect()
    assert (row.Name, row.ProductNumber, row.Color) == ("Bolt", "AB-1", "Red")


def test_columns_keep_name_and_position(spark):
    df = spark.createDataFrame([(1, " a ", "x", 3)], "AddressID long, AddressLine1 string, City string, extra int")
    spec = CleanSpec(name="a", keys=("AddressID",), required=("AddressLine1",), trim=("AddressLine1", "City"))
    out = clean(df, spec)
    assert out.columns == ["AddressID", "AddressLine1", "City", "extra"]


def test_composite_key(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 1, 5), (1, 2, None), (2, 1, 7)],
                               "SalesOrderID long, SalesOrderDetailID int, ProductID long")
    out = clean(df, cat.CLEAN_SPECS[cat.DETAILS]).orderBy("SalesOrderID", "SalesOrderDetailID").collect()
    assert [tuple(r) for r in out] == [(1, 1, 5), (2, 1, 7)]


def test_dedupe_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    plan = dedupe(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_reconcile_both_orders(spark):
    from strata.plans.validate import reconcile_clean

    df = spark.createDataFrame([(1, None, 0), (1, "a", 1), (2, "b", 0), (2, "b", 0), (3, None, 0)],
                               "k long, v string, s int")
    ref = CleanSpec(name="t", keys=("k",), required=("v",), tie_break=("s",))
    (r,) = reconcile_clean(df, ref).collect()
    assert (r.input, r.duplicates, r.rejected, r.output) == (5, 2, 2, 1)
    opt = CleanSpec(name="t", keys=("k",), required=("v",), tie_break=("s",), dedupe_after_filter=True)
    (r,) = reconcile_clean(df, opt).collect()
    assert (r.input, r.duplicates, r.rejected, r.output) == (5, 1, 2, 2)
    assert clean(df, opt).count() == r.output and clean(df, ref).count() == 1


def test_refresh_cleaned_equals_full_clean(spark):
    from strata.operators.clean import refresh_cleaned

    spec = CleanSpec(name="t", keys=("k",), required=("v",), trim=("v",), tie_break=("s",))
    old = spark.createDataFrame([(1, " a ", 5), (2, " b ", 5), (3, " c ", 5), (4, None, 5)],
                                "k long, v string, s int")
    new = spark.createDataFrame([(1, " a2 ", 1),      # new survivor for key 1
                                 (2, None, 0),        # new survivor lacks v: key 2 disappears
                                 (5, " e ", 0),       # new key
                                 (3, " c9 ", 9)],     # later copy: key 3 keeps its row
                                "k long, v string, s int")
    raw_all = old.unionByName(new)
    refreshed = refresh_cleaned(clean(old, spec), raw_all, new, spec)
    full = clean(raw_all, spec)
    assert sorted(map(tuple, refreshed.collect())) == sorted(map(tuple, full.collect()))
    assert sorted(r.k for r in refreshed.collect()) == [1, 3, 5]
