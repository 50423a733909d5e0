import os
import subprocess
import sys
import textwrap

from tessera.session import TUNING
from tests.conftest import ROOT


def _in_new_process(code: str) -> str:
    """What ``code`` prints in a process of its own (this one's session has its name and settings already)."""
    out = subprocess.run(
        [sys.executable, "-c", f"import sys; sys.path.insert(0, {ROOT!r})\n" + textwrap.dedent(code)],
        capture_output=True, text=True, timeout=300,
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"},
    )
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_session_factory_names_the_application():
    """The name is the argument's, and a second call returns the running session (SRC-1)."""
    out = _in_new_process("""
        from tessera.session import create_session
        s = create_session("Test App")
        print("NAME", s.sparkContext.appName, create_session("Other") is s, s.range(5).count())
    """)
    assert "NAME Test App True 5" in out


def test_tuned_session_runs_with_its_settings():
    """The settings are the running session's, and the local switch sets the master (SRC-2)."""
    out = _in_new_process("""
        from tessera.session import TUNING, create_tuned_session
        s = create_tuned_session("Load", local_threads=3, extra_conf={"spark.sql.ansi.enabled": "true"}, shuffle_partitions=5)
        print("SET", s.sparkContext.master, all(s.conf.get(k) == v for k, v in TUNING.items()), s.conf.get("spark.sql.shuffle.partitions"))
        print("ROWS", s.range(100).groupBy("id").count().where("count = 1").count(), s.sql("select current_timezone()").first()[0])
    """)
    assert "SET local[3] True 5" in out and "ROWS 100 UTC" in out


def test_tuning_values():
    assert TUNING["spark.sql.adaptive.enabled"] == "true"
    assert TUNING["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert TUNING["spark.sql.files.maxPartitionBytes"] == str(200 * 1024 * 1024)
    assert TUNING["spark.sql.session.timeZone"] == "UTC"
