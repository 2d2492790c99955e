"""Skew check: run the operators on data where one key holds a third of all
rows and report, per stage, the largest and the median number of records a
task read (from Spark's event log, written to a scratch folder).

    python tools/skew_check.py [sf_dir] [copies]

The skewed inputs are derived from the driver's ``orders`` table by Spark
(``copies`` shifted copies; every third row moved onto one key).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.operators.clean import clean  # noqa: E402
from strata.operators.history import validity_ranges  # noqa: E402
from strata.operators.summarise import summarise  # noqa: E402
from strata.plans import catalogue as cat  # noqa: E402
from strata.session import REQUIRED_CONF, ensure_checkpoint_dir  # noqa: E402


def session(events: str) -> SparkSession:
    b = (SparkSession.builder.master("local[8]").appName("strata-skew")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "16")
         .config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", events)
         .config("spark.eventLog.compress", "false")
         .config("spark.sql.warehouse.dir", os.path.join(os.path.dirname(events), "wh")))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    return s


def build_inputs(spark: SparkSession, sf_dir: str, copies: int, out: str) -> dict[str, str]:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    shift = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    big = o.select("*", shift).withColumn("o_orderkey", F.col("o_orderkey") + F.col("copy") * 100_000_000)
    hot = F.col("o_orderkey") % 3 == 0
    headers = big.select(
        F.when(hot, F.lit(1)).otherwise(F.col("o_orderkey")).alias("SalesOrderID"),   # dedupe hot key
        F.when(F.col("o_orderkey") % 3 == 1, F.lit(7)).otherwise(F.col("o_custkey")).alias("CustomerID"),
        F.col("o_orderdate").alias("OrderDate"),
        F.col("o_orderpriority").alias("PurchaseOrderNumber"),
        F.col("o_custkey").cast("string").alias("AccountNumber"),
        F.col("o_orderstatus").alias("ShipMethod"),
        F.col("o_totalprice").cast("decimal(19,4)").alias("TotalDue"))
    history = big.select(F.when(hot, F.lit(7)).otherwise(F.col("o_custkey")).alias("k"),
                         F.col("o_orderdate").alias("v"), F.col("o_orderkey").alias("t"))
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("EmailAddress"),
        F.col("c_mktsegment").alias("CompanyName"))
    paths = {}
    for name, df in (("headers", headers), ("history", history), ("customers", customers)):
        paths[name] = os.path.join(out, name)
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def stage_report(events: str) -> dict[str, list[tuple[int, int, float, float]]]:
    """job group -> [(stage, tasks, max records, median records)]"""
    files = sorted(f for f in glob.glob(os.path.join(events, "**", "*"), recursive=True)
                   if os.path.isfile(f) and not os.path.basename(f).startswith("appstatus"))
    stage_group, tasks = {}, {}
    for line in (ln for f in files for ln in open(f)):
        if True:
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0) \
                    + (m.get("Input Metrics") or {}).get("Records Read", 0)
                tasks.setdefault(e["Stage ID"], []).append(recs)
    out: dict[str, list] = {}
    for sid, recs in sorted(tasks.items()):
        group = stage_group.get(sid)
        if group and len(recs) > 1:
            out.setdefault(group, []).append((sid, len(recs), max(recs), statistics.median(recs)))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    run = tempfile.mkdtemp(prefix="strata-skew-")
    events = os.path.join(run, "events")
    os.makedirs(events)
    spark = session(events)
    paths = build_inputs(spark, sf_dir, copies, run)
    sc = spark.sparkContext
    headers = spark.read.parquet(paths["headers"])
    customers = spark.read.parquet(paths["customers"])
    timings = {}

    def timed(group, make):
        sc.setJobGroup(group, group)
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        timings[group] = round(time.perf_counter() - t0, 2)

    timed("dedupe_hot_key", lambda: clean(headers, cat.CLEAN_SPECS[cat.HEADERS]))
    cleaned_h = clean(headers, cat.CLEAN_SPECS[cat.HEADERS])
    timed("sales_by_company_hot_customer", lambda: summarise(
        cleaned_h, cat.SUMMARY_SPECS[cat.SALES_BY_CUSTOMER],
        resolve=lambda _: clean(customers, cat.CLEAN_SPECS[cat.CUSTOMERS])))
    hist = spark.read.parquet(paths["history"])
    rows = hist.count()
    timed("history_sliced", lambda: validity_ranges(hist, ["k"], "v", ["t"],
                                                    rows_per_slice=max(1, rows // 64)))

    from pyspark.sql import Window
    timed("history_naive_lead", lambda: hist.withColumn(
        "valid_to", F.lead("v").over(Window.partitionBy("k").orderBy("v", "t"))))
    spark.stop()

    report = stage_report(events)
    print(json.dumps({"rows": rows, "copies": copies, "seconds": timings,
                      "stages": {g: [{"stage": s, "tasks": n, "max_records": mx, "median_records": md}
                                     for s, n, mx, md in v] for g, v in report.items()}}, indent=1))


if __name__ == "__main__":
    main()
