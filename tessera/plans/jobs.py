"""The two jobs: sales analytics and the incremental call-record load.

Both return data (DataFrames / a result record) instead of printing, and let
errors propagate: a failed load leaves the previous published version live.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.casts import cast_call_records
from tessera.operators import analytics
from tessera.operators.enrich import enrich_sales
from tessera.operators.merge import BITMAP_IDS, FEW_IDS, POLICIES, changed_set, merge_incremental
from tessera.operators.rules import CALL_RECORD_RULES, MASK_COLUMN, cause_report, failed_mask, first_of_mask, mask_counts
from tessera.schemas import CALL_RECORD_SCHEMA
from tessera.sinks.publish import (
    ConcurrentPublish,
    bucket_of,
    delete_path,
    expire_versions,
    last_listing,
    live,
    new_run,
    publish,
    read_parts,
    staged_path,
    staging_path,
    stored_bytes,
)
from tessera.sources.files import read_changed_files, read_files, since_hours_ago
from tessera.sources.synth import sales_table

REJECT_COLUMN = "failed_rule"
#: A target larger than this is kept in buckets of the id, of about this size each.
BUCKET_BYTES = 1 << 30
#: Buckets of a target at most: the log lists one part for each.
MOST_BUCKETS = 4096
#: A target is dealt to more buckets once they have grown to this many times their size.
REBUCKET = 4


def run_sales(spark: SparkSession, n_records: int = 100_000_000, seed: int = 42) -> dict[str, DataFrame]:
    """Generate the sales table, enrich it, and return the four analytics.

    Nothing is cached: each result is one plan from ``range`` to its
    aggregate, and the generator is a pure function of the row id, so the
    plans can run in any order or be re-run after an executor loss."""
    enriched = enrich_sales(sales_table(spark, n_records, seed))
    return analytics.sales_report(enriched)


@dataclass
class LoadResult:
    """What a load did. The counts are read from the files that the run has
    staged and written, so a repeated task attempt counts once."""

    first_run: bool
    published_version: int | None
    rows_published: int | None
    rows_changed: int = 0
    rows_rejected: int = 0


def run_load(
    spark: SparkSession,
    source_path: str,
    target_root: str,
    since: str | None = None,
    window_hours: float = 24.0,
    policy: str = "unique",
    schema=CALL_RECORD_SCHEMA,
    single_file: bool = False,
    watermark: str = "global",
    keep_versions: int = 3,
    allowed_lateness: str | None = None,
    buckets: int | None = None,
    foreign: str = "error",
    group_by_schema: bool = True,
    target_file_bytes: int | None = None,
    bucket_bytes: int = BUCKET_BYTES,
) -> LoadResult:
    """Read new call-record files, merge them into the target, publish.

    First run (no published version): every file under ``source_path``.
    Later runs: files modified after ``since`` (default: the time at which the
    live version's run listed its files, so a late run misses nothing; now −
    ``window_hours`` for a table without such a record). No new files, no row
    newer than the target, or (``unique`` policy) no new row that passes the
    rules: nothing is published and the live version stays as it is.
    ``allowed_lateness`` (an interval such as ``"2 days"``) moves the watermark
    back. ``buckets`` keeps the target in that many buckets of the id (0: whole); a
    later run then reads and rewrites only the buckets that its ids fall into. By
    default a target of more than ``bucket_bytes`` has buckets of about that size:
    the first run counts the source's bytes; a run on a table that has outgrown its
    buckets fourfold, or has none, rewrites it whole in more of them.
    ``group_by_schema=False`` reads with the one declared schema, without a look at
    the footers. Otherwise new files without a row after the recorded watermark are
    not scanned. ``target_file_bytes`` sizes the target's files. After
    a publish, versions older than the newest ``keep_versions`` go (with their
    staged change sets)."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    # One second back: file times have whole seconds on some stores.
    listed_at = since_hours_ago(1 / 3600, dt.datetime.now(dt.timezone.utc), zone)
    before = live(spark, target_root)
    if before is None or read_parts(spark, target_root, before.parts).isEmpty():
        batch = read_files(spark, [source_path], schema, group_by_schema=group_by_schema, foreign=foreign)
        if buckets is None and not single_file:
            buckets = buckets_for(stored_bytes(spark, source_path), bucket_bytes)
        return merge_and_publish(
            spark, None, batch, target_root, policy, watermark, keep_versions,
            single_file=single_file, listed_at=listed_at, buckets=buckets, target_file_bytes=target_file_bytes,
        )
    since = since or last_listing(spark, target_root) or since_hours_ago(window_hours, time_zone=zone)
    bound = _file_bound(spark, before.watermark, watermark, allowed_lateness)
    batch = read_changed_files(
        spark, source_path, since, schema, group_by_schema=group_by_schema, foreign=foreign, newer_than=bound
    )
    return merge_and_publish(
        spark, before, batch, target_root, policy, watermark, keep_versions, allowed_lateness,
        single_file, listed_at, buckets, target_file_bytes=target_file_bytes, bucket_bytes=bucket_bytes,
    )


def buckets_for(n_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The power of two that gives buckets of at most ``bucket_bytes`` (0 where one would do)."""
    n = min(-(-n_bytes // bucket_bytes), MOST_BUCKETS)
    return 1 << (n - 1).bit_length() if n > 1 else 0


def _next_buckets(before, buckets: int | None, single_file: bool, bucket_bytes: int) -> int:
    """How many buckets the version after ``before`` has (other than now: all rows are rewritten).

    A bucketed table keeps its number unless the load chooses it (``None``)."""
    if buckets is not None or single_file:
        return before.buckets or buckets or 0
    fit = buckets_for(before.n_bytes or 0, bucket_bytes)
    return fit if fit >= REBUCKET * max(before.buckets, 1) or not before.buckets else before.buckets


def _file_bound(
    spark: SparkSession, recorded: str | None, watermark: str, allowed_lateness: str | None
) -> tuple[str, dt.datetime] | None:
    """The bound below which whole files can be left out, where the global watermark is known."""
    if recorded is None or watermark != "global":
        return None
    at = F.lit(recorded).cast("timestamp_ntz")
    if allowed_lateness:
        at = at - F.expr(f"INTERVAL {allowed_lateness}")
    return "updated_at", spark.range(1).select(at.alias("t")).first()["t"]


def merge_and_publish(
    spark: SparkSession,
    before,
    batch: DataFrame,
    target_root: str,
    policy: str = "unique",
    watermark: str = "global",
    keep_versions: int = 3,
    allowed_lateness: str | None = None,
    single_file: bool = False,
    listed_at: str | None = None,
    buckets: int | None = None,
    source: str | None = None,
    target_file_bytes: int | None = None,
    bucket_bytes: int = BUCKET_BYTES,
) -> LoadResult:
    """Stage the batch's typed change set once, merge it into the live version ``before``, publish.

    Each staged row is tagged with the first rule it fails (NULL when clean):
    the merge reads this table instead of listing, reading, casting and checking
    the new rows again, and the rejected rows stay inspectable next to the
    version they were part of. The staged rows are this run's own (the log entry
    names the run), so runs side by side don't touch each other's: the one that
    commits second is refused. ``before=None`` is a first run; of its input,
    which may be the whole history, only the rejected rows are staged."""
    run = new_run()
    try:
        load = _first_load if before is None else _next_load
        result = load(
            spark, before, batch, target_root, run, policy=policy, watermark=watermark, keep_versions=keep_versions,
            allowed_lateness=allowed_lateness, single_file=single_file, listed_at=listed_at, buckets=buckets,
            source=source, target_file_bytes=target_file_bytes, bucket_bytes=bucket_bytes,
        )
    except ConcurrentPublish:
        delete_path(spark, staging_path(target_root, run))
        raise
    if result.published_version is None:
        delete_path(spark, staging_path(target_root, run))
    return result


def _next_load(
    spark, before, batch, target_root, run, policy, watermark, keep_versions, allowed_lateness, single_file, listed_at,
    buckets, source, target_file_bytes, bucket_bytes,
) -> LoadResult:
    target = read_parts(spark, target_root, before.parts)
    recorded = before.watermark
    known = None if recorded is None else F.lit(recorded).cast(target.schema["updated_at"].dataType)
    changed = changed_set(
        batch, target, watermark=watermark, allowed_lateness=allowed_lateness, known_watermark=known
    )
    stage = staging_path(target_root, run)
    _tagged(changed).write.parquet(stage)
    staged = spark.read.parquet(stage)
    n_changed, n_rejected = staged.agg(F.count(F.lit(1)), F.count(REJECT_COLUMN)).first()
    # Under ``unique`` rejected rows change nothing; as coded, they remove ids.
    if n_changed == 0 or (policy == "unique" and n_changed == n_rejected):
        return LoadResult(False, None, None, n_changed, n_rejected)
    touched, n_buckets = None, _next_buckets(before, buckets, single_file, bucket_bytes)
    if n_buckets and n_buckets == before.buckets:
        rows = staged.where(F.col(REJECT_COLUMN).isNull()) if policy == "unique" else staged
        found = rows.select(bucket_of("id", before.buckets).alias("b")).distinct().collect()
        touched = sorted(r["b"] for r in found)  # at most ``buckets`` numbers
        parts = [p for p in before.parts if p["bucket"] in set(touched)]
        target = read_parts(spark, target_root, parts, target.schema) if parts else None
    staged = staged.drop(REJECT_COLUMN, MASK_COLUMN)
    if target is None:  # none of the buckets holds a row yet
        merged = merge_incremental(None, staged, policy=policy)
    else:
        merged = POLICIES[policy](
            target, staged, watermark=watermark, allowed_lateness=allowed_lateness, known_watermark=known,
            few_ids=n_changed <= FEW_IDS, bitmap=n_changed <= BITMAP_IDS,
        )
    version, rows = publish(
        merged, target_root, single_file=single_file, source=source, watermark_column="updated_at",
        listed_at=listed_at, key="id", buckets=n_buckets or None, changed=touched,
        based_on=before.version, staged=run, target_file_bytes=target_file_bytes,
    )
    expire_versions(spark, target_root, keep_versions)
    return LoadResult(False, version, rows, n_changed, n_rejected)


def _tagged(changed: DataFrame) -> DataFrame:
    """Typed rows tagged with the rules they fail (a bitmask, 0 when clean) and the first of them."""
    masked = cast_call_records(changed).withColumn(MASK_COLUMN, failed_mask(CALL_RECORD_RULES))
    return masked.withColumn(REJECT_COLUMN, first_of_mask(CALL_RECORD_RULES))


def _first_load(
    spark, before, batch, target_root, run, policy, watermark, keep_versions, allowed_lateness, single_file, listed_at,
    buckets, source, target_file_bytes, bucket_bytes,
) -> LoadResult:
    """First run: the whole input. A first pass writes the rejected rows and
    counts what it reads in that write; the second merges and publishes."""
    now = live(spark, target_root)
    stage = staging_path(target_root, run)
    merged = merge_incremental(None, batch, policy=policy)
    if batch.isEmpty():
        return LoadResult(True, None, None)
    _tagged(batch).where(F.col(MASK_COLUMN) != 0).write.parquet(stage)
    n_rejected = spark.read.parquet(stage).count()
    n_changed = batch.count()
    version, rows = publish(
        merged, target_root, single_file=single_file, source=source, watermark_column="updated_at",
        listed_at=listed_at, key="id", buckets=buckets, based_on=now.version if now else 0, staged=run,
        target_file_bytes=target_file_bytes,
    )
    expire_versions(spark, target_root, keep_versions)
    return LoadResult(True, version, rows, n_changed, n_rejected)


def rejected_rows(spark: SparkSession, target_root: str, version: int) -> DataFrame:
    """The rows of a run that failed the quality gate, with the first rule each
    failed (kept while ``version`` is retained)."""
    return spark.read.parquet(staged_path(spark, target_root, version)).filter(F.col(REJECT_COLUMN).isNotNull())


def reject_causes(spark: SparkSession, target_root: str, version: int) -> DataFrame:
    """For each rule, how many rows of a run failed it and how many failed it alone; only the
    staged bitmask is read."""
    return cause_report(mask_counts(spark.read.parquet(staged_path(spark, target_root, version))))
