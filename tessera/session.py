"""Session factories (SRC-1, SRC-2).

Credentials and object-store settings are never handled here: they belong in
the cluster's Spark configuration. The tuned session pins the time zone to UTC
because the call-record timestamps are zone-less wall-clock values; the named one
changes no setting.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the incremental load runs with: adaptive execution re-plans joins
# and shuffle partition counts from runtime sizes, splits skewed join
# partitions, and scans read 200 MiB splits.
# Broadcast joins are chosen only from measured sizes: the static threshold
# (which trusts compressed file sizes) is off, adaptive execution converts a
# join to broadcast when a side's materialized shuffle output is under 10 MiB,
# and explicit hints are given only for sides whose size has been counted.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(200 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}

# Shuffle sizing for large inputs: start with many shuffle partitions and let
# adaptive execution coalesce them to ~256 MiB each, so a reduce task never
# has to hold more than a few hundred MiB whatever the input size.
SCALE_TUNING = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def create_session(app_name: str = "tessera") -> SparkSession:
    """Named get-or-create session (SRC-1)."""
    return SparkSession.builder.appName(app_name).getOrCreate()


def create_tuned_session(
    app_name: str = "tessera",
    local_threads: int | None = None,
    extra_conf: dict[str, str] | None = None,
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """Session with the load's tuning (SRC-2).

    ``local_threads`` selects ``local[n]`` for development; ``None`` leaves the
    master to ``spark-submit`` / the cluster manager and adds the large-input
    shuffle sizing. ``shuffle_partitions`` sets the initial shuffle width
    (adaptive execution coalesces it at run time).
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(TUNING)
    if local_threads is not None:
        builder = builder.master(f"local[{local_threads}]")
    else:
        conf.update(SCALE_TUNING)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**conf, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
