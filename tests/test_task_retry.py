"""Results survive lost tasks: in a session that retries failed tasks, a
test-only UDF fails the first attempt of every map task; the dedupe and the
aggregate must give the same rows as a run without failures."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys, tempfile
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from strata.session import REQUIRED_CONF
    b = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp()))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    from strata.plans import queries as q, catalogue as cat
    from strata.sources import fixtures

    @F.udf("long")
    def flaky(x):
        # the first attempt of every task fails, as if its executor were lost
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("simulated task loss")
        return x

    sf = "/root/testdata/sf0.001"
    def run():
        return {{
            "headers": sorted(map(tuple, q.cleaned(spark, sf, cat.HEADERS).collect())),
            "by_customer": sorted(map(tuple, q.summary(spark, sf, cat.SALES_BY_CUSTOMER).collect()), key=str),
        }}
    clean_run = run()
    base = fixtures._headers_base
    fixtures._headers_base = lambda s, d: base(s, d).withColumn("SalesOrderID", flaky("SalesOrderID"))
    failing_run = run()
    print("SAME" if clean_run == failing_run and clean_run["headers"] else "DIFFERENT")
""")


def test_results_equal_after_task_retries(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.strip().splitlines()[-1] == "SAME"
