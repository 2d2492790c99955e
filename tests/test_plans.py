"""Plan shape on published tables: pushdown, pruning, no Python, co-location."""

from strata.plans import catalogue as cat
from strata.plans.pipeline import build_summary, run_pipeline
from strata.plans.table_ops import fixture_loads, workspace


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_published_layers_plan_shapes(spark, sf_small):
    config = workspace("plan")
    run_pipeline(spark, config, fixture_loads(sf_small))

    by_color = build_summary(spark, config, cat.SUMMARY_SPECS[cat.BY_COLOR])
    plan = _plan(by_color)
    assert "PushedFilters: [IsNotNull(Color)]" in plan
    assert "ReadSchema: struct<ProductID:bigint,Color:string,ListPrice:decimal(19,4)>" in plan

    by_customer = build_summary(spark, config, cat.SUMMARY_SPECS[cat.SALES_BY_CUSTOMER])
    plan = _plan(by_customer)
    # headers are read with three columns and aggregated per customer before the join
    assert "ReadSchema: struct<SalesOrderID:bigint,CustomerID:bigint,TotalDue:decimal(19,4)>" in plan
    assert "ReadSchema: struct<CustomerID:bigint,CompanyName:string>" in plan
    assert "count(distinct" not in plan.lower()
    for df in (by_color, by_customer):
        p = _plan(df)
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_cleaning_published_raw_table_plan(spark, sf_small):
    from strata.operators.clean import clean

    config = workspace("plan2")
    run_pipeline(spark, config, fixture_loads(sf_small))
    df = clean(spark.table(config.raw_table(cat.DETAILS)), cat.CLEAN_SPECS[cat.DETAILS])
    plan = _plan(df)
    assert plan.count("WindowGroupLimit") == 2      # partial before, final after the shuffle
    assert plan.count("Exchange hashpartitioning(SalesOrderID") == 1
