import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(
        os.environ,
        BENCH_SF_DIR="/root/testdata/sf0.001",
        BENCH_CPUS="2",
        BENCH_REPEAT="1",
        BENCH_QUERIES="watermark,category_totals,sales_job",
        BENCH_SALES_ROWS="10000",
    )
    out = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["metric"] and result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"watermark", "category_totals", "sales_job"}
    assert abs(result["value"] - sum(result["queries"].values())) < 0.01
