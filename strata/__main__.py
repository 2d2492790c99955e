"""Command line: run the layers of the catalogue.

    python -m strata raw      --jdbc-url URL --user U --password-env VAR [--jdbc-partitions N]
    python -m strata raw      --parquet-dir DIR            (the driver's test tables)
    python -m strata clean    [--tables t1,t2]
    python -m strata summary
    python -m strata pipeline --parquet-dir DIR
    python -m strata validate
    python -m strata reset

The session comes from ``SparkSession.builder.getOrCreate()`` (spark-submit
settings apply); ``--local`` makes a local one.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from strata.plans import catalogue as cat
from strata.plans.pipeline import (LayerConfig, loads_from, reset_pipeline, run_clean_layer,
                                   run_pipeline, run_raw_layer, run_summary_layer)
from strata.plans.validate import reconcile_totals, row_counts, table_list
from strata.session import apply_required_conf, ensure_checkpoint_dir, local_session


def _loads(args, spark):
    if args.parquet_dir:
        from strata.sources.fixtures import RAW_VIEWS

        return loads_from({t: (lambda s, t=t: RAW_VIEWS[t](s, args.parquet_dir)) for t in RAW_VIEWS})
    if args.jdbc_url:
        from strata.sources.jdbc import JdbcSource, read_jdbc, with_bounds

        props = {"user": args.user or "", "password": os.environ.get(args.password_env or "", "")}

        def reader(source: str, target: str):
            def read(s):
                src = JdbcSource(url=args.jdbc_url, table=source, properties=props)
                if args.jdbc_partitions > 1:
                    # range reads on the table's key (its cleaning key), bounds from the database
                    src = with_bounds(s, src, cat.CLEAN_SPECS[target].keys[0], args.jdbc_partitions)
                return read_jdbc(s, src)
            return read

        return loads_from({target: reader(source, target) for source, target in cat.SOURCE_TABLES})
    sys.exit("raw load needs --parquet-dir or --jdbc-url")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("command", choices=["raw", "clean", "summary", "pipeline", "validate", "reset"])
    p.add_argument("--catalog", default="spark_catalog", help="catalog of the three layer schemas")
    p.add_argument("--raw-schema", default=cat.RAW, help="schema of the raw tables")
    p.add_argument("--cleaned-schema", default=cat.CLEANED, help="schema of the cleaned tables")
    p.add_argument("--aggregated-schema", default=cat.AGGREGATED, help="schema of the aggregates")
    p.add_argument("--parquet-dir", help="folder of the test tables (raw views are built from them)")
    p.add_argument("--jdbc-url", help="JDBC URL of the source database")
    p.add_argument("--user", help="database user")
    p.add_argument("--password-env", help="name of the environment variable holding the password")
    p.add_argument("--jdbc-partitions", type=int, default=1,
                   help="parallel range reads per table on its key column (1 = one task)")
    p.add_argument("--tables", help="comma-separated cleaned tables (default: all five)")
    p.add_argument("--parallel", type=int, default=1, help="tables of a layer run at once")
    p.add_argument("--compression", help="file codec of published tables, e.g. zstd")
    p.add_argument("--local", action="store_true", help="use a local[*] session")
    args = p.parse_args(argv)
    import logging

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s",
                        stream=sys.stderr)

    spark = local_session() if args.local else SparkSession.builder.getOrCreate()
    apply_required_conf(spark)
    ensure_checkpoint_dir(spark)
    config = LayerConfig(catalog=args.catalog, raw=args.raw_schema, cleaned=args.cleaned_schema,
                         aggregated=args.aggregated_schema, max_parallel=args.parallel,
                         compression=args.compression)

    if args.command == "raw":
        runs = run_raw_layer(spark, config, _loads(args, spark))
    elif args.command == "clean":
        tables = args.tables.split(",") if args.tables else list(cat.CLEAN_ORDER)
        runs = run_clean_layer(spark, config, tables)
    elif args.command == "summary":
        runs = run_summary_layer(spark, config)
    elif args.command == "pipeline":
        runs = run_pipeline(spark, config, _loads(args, spark))
    elif args.command == "reset":
        for name in reset_pipeline(spark, config):
            print(json.dumps({"dropped": name}))
        return 0
    else:
        layers = [config.raw, config.cleaned, config.aggregated]
        for r in table_list(spark, config.catalog, layers).collect():
            print(json.dumps(r.asDict()))
        from strata.sinks.tables import table_exists

        counts = {f"{cat.CLEANED}.{t}": config.cleaned_table(t) for t in cat.CLEAN_ORDER
                  if table_exists(spark, config.cleaned_table(t))}
        if counts:
            for r in row_counts(spark, counts).collect():
                print(json.dumps(r.asDict()))
        needed = [config.cleaned_table(cat.HEADERS)] + [
            config.aggregated_table(n) for n in (cat.SALES_BY_CUSTOMER, cat.SALES_BY_DAY)]
        if not all(table_exists(spark, n) for n in needed):
            return 0
        totals = reconcile_totals(
            spark.table(config.cleaned_table(cat.HEADERS)),
            {n: spark.table(config.aggregated_table(n)) for n in (cat.SALES_BY_CUSTOMER, cat.SALES_BY_DAY)})
        for r in totals.collect():
            print(json.dumps(r.asDict(), default=str))
        return 0
    for r in runs:
        print(json.dumps({"layer": r.layer, "table": r.table, "seconds": round(r.seconds, 3),
                          "attempts": r.attempts, "rows": r.rows}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
