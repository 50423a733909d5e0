"""The incremental load as a Structured Streaming query.

A parquet file source with a checkpoint remembers which files it has already
processed, which replaces the 24-hour listing window of the batch job: a run
that is late or repeated neither misses nor re-reads files. With
``trigger(availableNow=True)`` each start processes everything new and stops,
so it can be scheduled like the batch job. Each micro-batch is merged into the
target and published as a new version inside ``foreachBatch``; the stream's
query id and the batch's epoch are recorded in the version log, so a micro-batch
replayed after a failure is skipped instead of applied twice, while a stream
with another checkpoint (which counts its epochs from 0 again) is not.

Two things a stream of rows can't do are here too. ``by_file=True`` streams the
*names* of new files (no content is read) and gives each batch of them to the
grouped scan of ``sources.files``, so files whose column types drift load as in the
batch job. ``start_latest_versions`` keeps the latest version of every id as
keyed state without a watermark: a late version of an id that hasn't moved on is
taken however old it is.
"""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.plans.jobs import merge_and_publish
from tessera.schemas import CALL_RECORD_SCHEMA
from tessera.sinks.publish import live, read_parts, source_published
from tessera.sources.files import conform, read_listed

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
QUERY_ID = "sql.streaming.queryId"  # the local property of a micro-batch's thread


def merge_batch_into(
    target_root: str,
    policy: str = "unique",
    schema=CALL_RECORD_SCHEMA,
    keep_versions: int = 3,
    watermark: str = "global",
    allowed_lateness: str | None = None,
    buckets: int | None = None,
    by_file: bool = False,
    foreign: str = "error",
):
    """The ``foreachBatch`` function: merge one micro-batch (of rows, or of file names) and publish."""

    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        source = f"{spark.sparkContext.getLocalProperty(QUERY_ID)}:{epoch_id}"
        if source_published(spark, target_root, source):
            return
        before = live(spark, target_root)
        if before is not None and read_parts(spark, target_root, before.parts).isEmpty():
            before = None  # an empty target is a first run
        if by_file:  # one row a file
            batch = read_listed(spark, sorted(unquote(r["file"]) for r in batch.collect()), schema, foreign)
        else:
            batch = conform(batch, schema)
        # Staged once: the micro-batch is not evaluated again for the merge.
        merge_and_publish(
            spark, before, batch, target_root, policy, watermark, keep_versions,
            allowed_lateness, source=source, buckets=buckets,
        )

    return apply


def start_incremental_load(
    spark: SparkSession,
    source_path: str,
    target_root: str,
    checkpoint_path: str,
    policy: str = "unique",
    schema=CALL_RECORD_SCHEMA,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    keep_versions: int = 3,
    watermark: str = "global",
    allowed_lateness: str | None = None,
    buckets: int | None = None,
    by_file: bool = False,
    foreign: str = "error",
) -> StreamingQuery:
    """Start the stream; call ``awaitTermination()`` on the result.

    ``checkpoint_path`` must be on shared storage. With ``by_file`` the files of a
    micro-batch are grouped by physical schema (``foreign`` as in ``read_files``)."""
    reader = spark.readStream.schema(FILE_SCHEMA if by_file else schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if by_file:
        stream = reader.format("binaryFile").load(source_path).select(F.col("_metadata.file_path").alias("file"))
    else:
        stream = reader.parquet(source_path)
    apply = merge_batch_into(
        target_root, policy, schema, keep_versions, watermark, allowed_lateness, buckets, by_file, foreign
    )
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _newest_first(columns: list[str], key: str, ts: str, order: str) -> Column:
    """A row as one struct that sorts as ``latest_per_key`` ranks: the latest time first (NULL last),
    of equal times the one that came first, then all other columns ascending (NULL last)."""
    parts = [F.col(ts).isNull(), -F.unix_micros(F.col(ts).cast("timestamp")), F.col(order)]
    for c in sorted(c for c in columns if c not in (key, ts, order)):
        parts += [F.col(c).isNull(), F.col(c)]
    return F.struct(*[p.alias(f"o{k}") for k, p in enumerate(parts)], *[F.col(c).alias(c) for c in columns if c != order])


def start_latest_versions(
    stream: DataFrame, out_path: str, checkpoint_path: str, key: str = "id", ts: str = "updated_at", order: str = "arrived"
) -> StreamingQuery:
    """Keep each id's latest version in the stream's state; call ``awaitTermination()`` on the result.

    ``order`` is a column that grows from one delivery to the next: a version
    replaces the stored one only if its time is later (a version without a time never
    does). The state is a streaming aggregate, so it is kept and checkpointed by
    Spark's state store, one row an id, and a hot id is reduced before the shuffle. Every
    micro-batch writes the versions of the ids it touched to ``out_path/epoch=<n>``,
    again if it is repeated; ``latest_versions`` reads the table they make up.
    Rows with a NULL id have no version."""
    columns = stream.columns
    rows = stream.where(F.col(key).isNotNull()).select(key, _newest_first(columns, key, ts, order).alias("row"))
    state = rows.groupBy(key).agg(F.min("row").alias("row"))

    def write(batch: DataFrame, epoch: int) -> None:
        flat = batch.select(*[F.col(f"row.{c}").alias(c) for c in columns if c != order])
        flat.write.mode("overwrite").parquet(os.path.join(out_path, f"epoch={epoch}"))

    writer = state.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint_path)
    return writer.trigger(availableNow=True).start()


def latest_versions(spark: SparkSession, out_path: str, key: str = "id") -> DataFrame:
    """The table that ``start_latest_versions`` has written: each id's row of its last epoch."""
    rows = spark.read.parquet(out_path)
    whole = F.struct(*rows.columns)
    last = rows.groupBy(key).agg(F.max_by(whole, F.col("epoch")).alias("row"))
    return last.select(*[F.col(f"row.{c}").alias(c) for c in rows.columns if c != "epoch"])
