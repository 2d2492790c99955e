"""bench.py prints one JSON line the driver can read."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="clean_customers,summary_sales_by_day")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"clean_customers", "summary_sales_by_day"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
    assert not any(tmp_path.iterdir())          # nothing written to the working folder
