"""The driver contract and the command line."""

import uuid

import __spark_entry__ as E

# planned in SURVEY 7.4 (its pipeline_end_to_end is registered as layers_end_to_end);
# scan_jdbc needs a database (see README)
PLANNED = """load_with_retry scan_table overwrite_merge_schema overwrite_table compact_table reset_tables
audit_ingestion_time project_subset derive_date_key filter_required dedupe_single_key dedupe_composite_key
scalar_trim scalar_lower_trim scalar_upper_trim left_join_orders_customers agg_count agg_avg
agg_count_distinct agg_sum sort_desc sort_two_keys preview_table clean_customers clean_addresses
clean_products clean_order_headers clean_order_details summary_customers_by_company
summary_products_by_color summary_sales_by_customer summary_sales_by_day run_raw_layer run_clean_layer
run_summary_layer layers_end_to_end validate_table_list validate_schema validate_row_counts
reconcile_clean reconcile_summary""".split()


def test_planned_queries_are_registered():
    missing = set(PLANNED) - set(E.queries())
    assert not missing, missing


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_cli_pipeline_validate_reset(spark, sf_small, capsys):
    from strata.__main__ import main

    run = f"cli_{uuid.uuid4().hex[:8]}"
    schemas = ["--raw-schema", f"{run}_b", "--cleaned-schema", f"{run}_s", "--aggregated-schema", f"{run}_g"]
    assert main(["pipeline", "--parquet-dir", sf_small, "--parallel", "3", "--compression", "zstd",
                 *schemas]) == 0
    assert main(["validate", *schemas]) == 0
    out = capsys.readouterr().out
    assert '"n_tables": 5' in out and '"n_tables": 4' in out and '"diff_orders": 0' in out
    assert main(["reset", *schemas]) == 0
    main(["validate", *schemas])
    assert capsys.readouterr().out.count('"n_tables": 0') == 3


def test_layer_objects(spark, sf_small):
    from strata.plans.layers import CleanLayer, RawLayer, SummaryLayer
    from strata.plans.table_ops import fixture_loads, workspace

    config = workspace("layers")
    runs = RawLayer(spark, config).load_from(fixture_loads(sf_small))
    assert [r.rows for r in runs] == [180, 14, 250, 2000, 6000]
    import pytest
    with pytest.raises(ValueError):
        CleanLayer(spark, config).run("not_a_table")
    assert len(CleanLayer(spark, config).run_many()) == 5
    summary = SummaryLayer(spark, config)
    assert summary.build("sales_summary_by_day").count() > 0
    assert len(summary.run()) == 4
    # a JDBC load spec is built from server and database names (not run: no database here)
    spec = RawLayer(spark, config, properties={"user": "u"})._spec("h", "db", "SalesLT.Customer", "t")
    assert spec.source_name == "SalesLT.Customer" and spec.target == "t"
