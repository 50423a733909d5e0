"""URL rules through a blocked Bloom filter and an exact hash join.

A rule is a canonical URL, host and path, with a verdict. It fits the URLs of
its host and of all subdomains whose path starts with the rule's; of several
the longest (host and path together, then the longer host) decides. So the
listed URLs that can fit a page are its host's last labels with its path's first
characters, and only label counts and lengths that some rule has (``shapes``)
are looked up.

The filter's blocks are 64-bit words: a URL sets ``BITS`` bits of one word, so a
lookup reads a single number. The words travel as a constant of the plan, at
most ``MAX_BLOCKS`` of them (2 MB) whatever the list's length; beyond about
``MAX_BLOCKS * 64 / BITS_PER_URL`` listed URLs more false positives reach the
join, never other results. Pages without a possible hit are finished in the
scan and never shuffled; the others meet the rules in a hash join on the
canonical URL, once per distinct (host, path), which removes false positives.
Everything is DataFrame functions.

Host and path follow the contract of ``parts``. A NULL or malformed URL has an
empty host and path and fits no rule. A rule without a host is ignored, a NULL
path is empty; of equal rules with several verdicts the greatest stands
(``block`` over ``allow``). Repeated pages are judged alike, an empty table gives
none. Further columns of the pages travel in one struct, so names can't clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.rowwise import ROW
from tessera.util import BROADCAST_MAX_ROWS, own_exchange

BITS = 4
BITS_PER_URL = 16
WORD = 64
MAX_BLOCKS = 1 << 18
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def listed(rules: DataFrame) -> DataFrame:
    """(key, labels, length, verdict) of every distinct rule; the key is its canonical URL."""
    host = F.translate(F.col("host"), UPPER, LOWER)
    path = F.coalesce(F.col("path"), F.lit(""))
    rows = rules.where(F.coalesce(F.col("host"), F.lit("")) != "").select(
        F.concat(host, path).alias("key"),
        F.size(F.split(host, r"\.")).alias("labels"),
        F.length(path).alias("length"),
        "verdict",
    )
    return rows.groupBy("key", "labels", "length").agg(F.max("verdict").alias("verdict"))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(key: Column) -> Column:
    """The bits of a URL in its block's word."""
    h, out = F.xxhash64(key, F.lit(1)), F.lit(0).cast("long")
    for j in range(BITS):
        place = F.shiftright(h, 6 * j).bitwiseAND(F.lit(WORD - 1)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


class BlockedBloom:
    """A blocked Bloom filter of a table's ``key`` column as a constant expression."""

    def __init__(self, keys: DataFrame, n: int, max_blocks: int = MAX_BLOCKS):
        want = max(1, n * BITS_PER_URL // WORD)
        self.blocks = min(max_blocks, 1 << math.ceil(math.log2(want)))
        words = [0] * self.blocks
        set_bits = keys.groupBy(_block(F.col("key"), self.blocks).alias("b")).agg(F.bit_or(_mask(F.col("key"))).alias("w"))
        for r in set_bits.collect():  # at most ``blocks`` rows
            words[r["b"]] = r["w"]
        # One text constant, folded to an array of numbers when the query is optimised.
        self.words = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")

    def may_hold(self, key: Column) -> Column:
        mask = _mask(key)
        return F.get(self.words, _block(key, self.blocks)).bitwiseAND(mask) == mask


def _candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Canonical URLs that could be listed and fit (host, path)."""
    if not shapes:
        return F.array().cast("array<string>")
    shape = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("length")) for a, b in shapes])

    def one(s: Column) -> Column:
        suffix = F.call_function("substring_index", host, F.lit("."), -s["labels"])
        return F.when(F.length(path) >= s["length"], F.concat(suffix, F.substr(path, F.lit(1), s["length"])))

    keys = F.array_distinct(F.array_compact(F.transform(shape, one)))
    return F.when(host != "", keys).otherwise(F.array().cast("array<string>"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``_row`` (the page's columns), host, path, rule (canonical URL or NULL) and verdict of every page.

    ``rules`` has host, path and verdict; a page that no rule fits gets ``default``."""
    book = listed(rules)
    shapes = sorted((r["labels"], r["length"]) for r in book.select("labels", "length").distinct().collect())
    n = book.count()
    bloom = BlockedBloom(book, n, max_blocks)
    host, path = parts(F.col(f"`{url}`"))
    probed = (
        pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias(ROW), host.alias("host"), path.alias("path"))
        .withColumn("maybe", F.filter(_candidates(F.col("host"), F.col("path"), shapes), bloom.may_hold))
    )
    clean = probed.where(F.size("maybe") == 0).select(
        ROW, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
    )
    hits = probed.where(F.size("maybe") > 0)
    asked = hits.dropDuplicates(["host", "path"]).select("host", "path", F.explode("maybe").alias("key"))
    book = book.select("key", F.struct(F.length("key").alias("n"), (F.length("key") - F.col("length")).alias("h"), "key", "verdict").alias("r"))
    # A common rule is a hot key: small lists are broadcast, for longer ones the join's own shuffles let it be split.
    book = F.broadcast(book) if n <= BROADCAST_MAX_ROWS else own_exchange(book)
    best = asked.join(book, "key").groupBy("host", "path").agg(F.max("r").alias("r"))
    told = hits.join(own_exchange(best), ["host", "path"], "left").select(
        ROW, "host", "path", F.col("r.key").alias("rule"), F.coalesce("r.verdict", F.lit(default)).alias("verdict")
    )
    return clean.unionByName(told)
