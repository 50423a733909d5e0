"""Incremental merge of a batch into a target (AGG-2, AGG-7, FLT-3, JOIN-1,
SET-1, MRG-1, WIN-1).

The watermark stays a scalar subquery (``DataFrame.scalar()``) instead of a
value collected to the driver, so it is computed inside the same query and
pushed into the batch scan at run time; a watermark recorded when the target
was published can be passed instead (``known_watermark``), which spares the
scan. No plan counts anything while it is built: adaptive execution picks the
anti join from the measured size of the de-duplicated ids, and the load passes
``few_ids`` where the staged change set has been counted, so that the target is
probed in place instead of shuffled. In the sort-merge form both sides are
shuffles of the join's own (``util.own_exchange``), which is what lets adaptive
execution split a hot id.
Latest-per-key uses ``row_number() = 1``, which Spark plans with a partial
``WindowGroupLimit`` before the shuffle, so even a key holding a third of all
rows ships at most one row per input partition.

Two policies:

* ``merge_as_coded`` — take the change ids before cleaning, anti-join, union.
  A new version that fails the gate removes the old version too, and several
  versions of one id in a batch all survive.
* ``merge_unique`` — clean first, keep the latest version per id, and replace
  only ids whose new version survived the gate. Output has one row per id.

An empty target has a NULL watermark, which no row passes; the load's entry
point ``merge_incremental`` therefore treats an empty target as a first run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.casts import cast_call_records
from tessera.operators.rules import CALL_RECORD_RULES, Rule, clean
from tessera.util import own_exchange

KEY = "id"
TS = "updated_at"

# Rows of a counted change set up to which its ids are broadcast: at most about
# 100 bytes each as a hashed row, 100 MB.
FEW_IDS = 1_000_000

# Words of the bitmap of changed ids (16.7 million bits, about 10 MB as a hashed
# relation, whatever the number of ids), and the ids up to which it still tells
# most rows apart (a fifth of its bits set).
BITMAP_WORDS = 1 << 18
BITMAP_IDS = 4_000_000


def watermark(target: DataFrame, ts: str = TS) -> DataFrame:
    """One row: the target's high-watermark (NULL when the target is empty)."""
    return target.agg(F.max(ts).alias("watermark"))


def watermark_value(target: DataFrame, ts: str = TS) -> Column:
    """The watermark as a scalar-subquery column."""
    return target.select(F.max(ts)).scalar()


def changed_rows(
    batch: DataFrame,
    target: DataFrame,
    ts: str = TS,
    allowed_lateness: str | None = None,
    known_watermark: Column | None = None,
) -> DataFrame:
    """Batch rows strictly newer than the target's watermark (FLT-3).

    Rows with a NULL timestamp are dropped, as any comparison with NULL is,
    and so is every row when the target is empty (its watermark is NULL);
    ``merge_incremental`` treats an empty target as a first run instead.
    ``allowed_lateness`` (an interval such as ``"2 days"``) moves the
    watermark back, so rows that arrive late by up to that much still count.
    ``known_watermark`` (e.g. recorded when the target was published) is used
    instead of computing the target's maximum."""
    wm = known_watermark if known_watermark is not None else watermark_value(target, ts)
    if allowed_lateness:
        wm = wm - F.expr(f"INTERVAL {allowed_lateness}")
    return batch.filter(F.col(ts) > wm)


def changed_rows_per_key(batch: DataFrame, target: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Batch rows newer than the stored version of their own id; rows of ids
    the target does not hold are all new. Unlike the global watermark this
    never drops a late row for an id that has not moved on.

    The target is first cut to the batch's ids with a semi join, then reduced
    to (id, latest timestamp) with a partial aggregate; a hot id on the target
    side of the one join or on the batch side of the other is split by adaptive
    skew-join handling."""
    batch_ids = own_exchange(batch.select(key).distinct())
    stored = target.join(batch_ids, on=key, how="left_semi").groupBy(key).agg(F.max(ts).alias("_stored_ts"))
    newer = F.col("_stored_ts").isNull() | (F.col(ts) > F.col("_stored_ts"))
    return batch.join(own_exchange(stored), on=key, how="left").filter(newer).drop("_stored_ts")


def changed_set(
    batch: DataFrame,
    target: DataFrame,
    key: str = KEY,
    ts: str = TS,
    watermark: str = "global",
    allowed_lateness: str | None = None,
    known_watermark: Column | None = None,
) -> DataFrame:
    """The batch rows a merge would consider, under the chosen watermark."""
    if watermark == "per_key":
        return changed_rows_per_key(batch, target, key, ts)
    return changed_rows(batch, target, ts, allowed_lateness, known_watermark)


def changed_ids(changed: DataFrame, key: str = KEY) -> DataFrame:
    """Distinct ids of the change set (AGG-7, PRJ-4)."""
    return changed.select(key).distinct()


def _place(key: str) -> tuple[Column, Column]:
    """An id's word in the bitmap and its bit there; NULL for a NULL id."""
    h = F.when(F.col(key).isNotNull(), F.xxhash64(key))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 32).bitwiseAND(F.lit(63)).cast("int"))
    return F.pmod(h, F.lit(BITMAP_WORDS)), bit


def split_by_bitmap(target: DataFrame, ids: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(rows whose id is surely not among ``ids``, rows whose id may be).

    The ids set bits of a fixed-size table, one row a word, which is broadcast: at
    most ``BITMAP_WORDS`` rows. Ids that share a bit only make a row a candidate."""
    word, bit = _place(key)
    words = ids.select(word.alias("_word"), bit.alias("_bit")).where("_word is not null")
    words = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    rows = target.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(words), "_word", "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))
    return rows.where(~maybe).select(target.columns), rows.where(maybe).select(target.columns)


def unchanged_rows(
    target: DataFrame, ids: DataFrame, key: str = KEY, few_ids: bool = False, bitmap: bool = False
) -> DataFrame:
    """Target rows whose id is not in ``ids`` (left anti join, JOIN-1).

    NULL never equals NULL, so target rows with a NULL id always survive.
    The ids are de-duplicated first (a partial aggregate collapses a hot id to
    one row per map task). With ``few_ids`` — the caller has counted at most
    ``FEW_IDS`` of them — they are broadcast and the target is not shuffled.
    With ``bitmap`` — at most ``BITMAP_IDS`` — the target is read twice but only
    rows that may match are shuffled to the exact join (ids of one type on both
    sides). Otherwise adaptive execution decides from their measured size, and a
    hot id of the target is split in the sort-merge join."""
    distinct_ids = ids.select(key).distinct()
    if few_ids:
        return target.join(F.broadcast(distinct_ids), on=key, how="left_anti")
    if bitmap and target.schema[key].dataType == ids.schema[key].dataType:
        apart, maybe = split_by_bitmap(target, ids, key)
        return apart.unionByName(maybe.join(own_exchange(distinct_ids), on=key, how="left_anti").select(target.columns))
    return target.join(own_exchange(distinct_ids), on=key, how="left_anti")


def union_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union all by column name (SET-1)."""
    return first.unionByName(second)


def latest_per_key(
    df: DataFrame,
    key: str = KEY,
    ts: str = TS,
    tie_breakers: list[str] | None = None,
) -> DataFrame:
    """One row per non-null key: latest ``ts`` (NULLs last), ties broken by
    ``tie_breakers`` ascending (default: every other column in name order),
    so the winner does not depend on partitioning (WIN-1)."""
    if tie_breakers is None:
        tie_breakers = sorted(c for c in df.columns if c not in (key, ts))
    order = [F.col(ts).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(key).orderBy(*order)
    return (
        df.filter(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def merge_as_coded(
    target: DataFrame,
    batch: DataFrame,
    rules: list[Rule] = CALL_RECORD_RULES,
    key: str = KEY,
    ts: str = TS,
    watermark: str = "global",
    allowed_lateness: str | None = None,
    known_watermark: Column | None = None,
    few_ids: bool = False,
    bitmap: bool = False,
) -> DataFrame:
    """Watermark → change ids (before cleaning) → anti join → clean → union."""
    changed = changed_set(batch, target, key, ts, watermark, allowed_lateness, known_watermark)
    unchanged = unchanged_rows(target, changed, key, few_ids, bitmap)
    gated = clean(cast_call_records(changed), rules)
    return union_by_name(unchanged, gated)


def merge_unique(
    target: DataFrame,
    batch: DataFrame,
    rules: list[Rule] = CALL_RECORD_RULES,
    key: str = KEY,
    ts: str = TS,
    tie_breakers: list[str] | None = None,
    watermark: str = "global",
    allowed_lateness: str | None = None,
    known_watermark: Column | None = None,
    few_ids: bool = False,
    bitmap: bool = False,
) -> DataFrame:
    """Clean first, keep the latest version per id, replace only ids whose
    new version passed the gate. ``target`` is expected to hold one row per
    id already (every target this policy publishes does).

    ``watermark="global"`` compares with the target's overall maximum (as
    the original load), ``"per_key"`` with each id's own stored version."""
    changed = changed_set(batch, target, key, ts, watermark, allowed_lateness, known_watermark)
    gated = clean(cast_call_records(changed), rules)
    latest = latest_per_key(gated, key, ts, tie_breakers)
    # The ids to replace are the gated ids (the same set as ``latest``'s), so
    # the anti join needs no window computation.
    return union_by_name(unchanged_rows(target, gated, key, few_ids, bitmap), latest)


POLICIES = {"as_coded": merge_as_coded, "unique": merge_unique}


def merge_incremental(
    target: DataFrame | None,
    batch: DataFrame,
    rules: list[Rule] = CALL_RECORD_RULES,
    policy: str = "unique",
    key: str = KEY,
    ts: str = TS,
    tie_breakers: list[str] | None = None,
    watermark: str = "global",
    allowed_lateness: str | None = None,
    known_watermark: Column | None = None,
    few_ids: bool = False,
    bitmap: bool = False,
) -> DataFrame:
    """The load's transform. ``target=None`` (or an empty target) is a first
    run: every batch row is cleaned (rows with a NULL timestamp are kept, as
    there is no watermark); under the ``unique`` policy the latest version per
    id is kept. The emptiness probe reads at most one row."""
    if target is None or target.isEmpty():
        gated = clean(cast_call_records(batch), rules)
        return latest_per_key(gated, key, ts, tie_breakers) if policy == "unique" else gated
    if policy == "unique":
        return merge_unique(
            target, batch, rules, key, ts, tie_breakers, watermark, allowed_lateness, known_watermark, few_ids, bitmap
        )
    return merge_as_coded(target, batch, rules, key, ts, watermark, allowed_lateness, known_watermark, few_ids, bitmap)
