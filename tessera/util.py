"""Small helpers shared by the sub-packages."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound on rows for a join side that we hint as broadcast. The hint is
# only given after the bound has been proven by a bounded count.
BROADCAST_MAX_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast-hint ``df`` only if it provably holds at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (a ``limit`` pushed into the
    scan), so it costs almost nothing for a small dimension and stops early for
    a big one. Beyond the bound the frame is returned unhinted and the planner
    (with adaptive execution) picks a shuffle join.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def own_exchange(df: DataFrame) -> DataFrame:
    """``df`` with unknown partitioning, so that a join shuffles it itself.

    Adaptive skew-join handling splits a hot key only where both join inputs
    are shuffles of the join's own; an aggregate on the join key that the
    planner would reuse as the input's partitioning switches it off for the
    other side too. The narrow coalesce to more partitions than there can be
    moves nothing; it only hides the partitioning, at the cost of one shuffle
    of the (small, aggregated) side."""
    return df.coalesce(1 << 20)


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder is read from ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a private temporary folder (tests); a cluster
    session without it is an error, because a machine-local folder is not
    visible to executors on other hosts.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)  # ours, and only local runs have it
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, "tessera", f"{name}-{uuid.uuid4().hex[:12]}")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a shared folder to write to."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        shared_scratch(spark, "init")
        base = spark.conf.get("spark.checkpoint.dir")
    else:
        spark.sparkContext.setCheckpointDir(base)
    return base
