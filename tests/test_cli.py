import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_sales_cli_prints_the_report():
    out = subprocess.run(
        [sys.executable, "-m", "tessera", "sales", "--rows", "3000", "--local", "2"],
        cwd=ROOT, capture_output=True, text=True, timeout=300,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    for section in ("latest_order_date", "category_totals", "region_state_totals", "ship_mode_delay", "rows: 3000"):
        assert section in out.stdout
