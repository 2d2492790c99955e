"""Write ``copies`` key-shifted copies of the driver's base tables, so the
same queries can be timed on more data (referential keys stay consistent:
every copy shifts customer, order, part and supplier keys by its own offset).

    python tools/scale_data.py /root/testdata/sf0.1 10 /tmp/run-x/sf1.0
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from strata.session import local_session  # noqa: E402

KEYS = {
    "customer": {"c_custkey": "cust"},
    "orders": {"o_orderkey": "order", "o_custkey": "cust"},
    "lineitem": {"l_orderkey": "order", "l_partkey": "part", "l_suppkey": "supp"},
    "part": {"p_partkey": "part"},
    "supplier": {"s_suppkey": "supp"},
}


def main() -> None:
    src, copies, out = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    spark = local_session()
    spans = {}
    for table, col, kind in (("customer", "c_custkey", "cust"), ("orders", "o_orderkey", "order"),
                             ("part", "p_partkey", "part"), ("supplier", "s_suppkey", "supp")):
        spans[kind] = spark.read.parquet(f"{src}/{table}.parquet").agg(F.max(col)).first()[0] + 1
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        df = spark.read.parquet(f"{src}/{table}.parquet")
        if table in KEYS:
            df = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__copy"))
            df = df.withColumns({c: F.col(c) + F.col("__copy") * F.lit(spans[k])
                                 for c, k in KEYS[table].items()}).drop("__copy")
            df = df.repartition(max(1, copies // 2))
        df.write.mode("overwrite").parquet(f"{out}/{table}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
