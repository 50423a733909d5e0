"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one ``failed`` bitmask per document; a policy is a versioned mask of the
rules that reject, so applying another policy or asking what one rule costs
(an ablation) reads the ledger only, never the texts.

Words are ``[^\\x20\\x09-\\x0D]+``. NULL and empty texts have no words: all
counts 0, rejected by ``few_words``. Repeated rows are measured one by one.
An empty table gives an empty ledger. Long texts are measured whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rowwise import annotate, annotate_whole, whole_rows
from tessera.llm.scan import (
    PLAIN,
    Texts,
    mix,
    prefix_hash,
    range_hash,
    separator_table,
    shingle_hashes,
    starts_of_code_points,
    words_of,
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_bars")
SYMBOLS = separator_table(np.frombuffer(b"#*$%&|<>", np.uint8))
BARS = separator_table(np.frombuffer(b"|", np.uint8))
LETTERS = separator_table(np.array([b for b in range(256) if b >= 0xC0 or chr(b).isalpha() and b < 0x80]))


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``failed`` (over the measurements) is true."""

    bit: int
    name: str
    failed: str


#: Bits are never reused: a ledger written today stays readable.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "many_symbols", "100 * n_symbols > 30 * n_words"),
    Rule(3, "table_bars", "100 * n_bars > 30 * n_words"),
    Rule(4, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines and n_lines >= 4"),
    Rule(5, "long_words", "word_chars > 25 * n_words"),
    Rule(6, "few_letters", "100 * n_letters < 30 * word_chars"),
)
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rejecting rules."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[name] for name in self.rules)


POLICIES = {
    p.version: p
    for p in (
        Policy("base", BASE),
        Policy("v1", (*BASE, "many_symbols", "duplicate_lines", "long_words", "few_letters")),
        Policy("strict", tuple(r.name for r in RULES)),
    )
}
DEFAULT_POLICY = "v1"


def _first_of(key: np.ndarray) -> np.ndarray:
    """For each key, whether an equal one comes earlier."""
    order = np.argsort(key, kind="stable")
    later = np.zeros(len(key), bool)
    later[order[1:]] = key[order[1:]] == key[order[:-1]]
    return later


def measure(t: Texts) -> dict[str, np.ndarray]:
    """The measurements of every text of a slice."""
    n = len(t)
    w = words_of(t, PLAIN)
    running = prefix_hash(t.data)
    inside = PLAIN[t.data]
    # lines: cut at \n and at text borders; only lines with a word count
    cut = np.zeros(len(t.data) + 1, bool)
    cut[t.offsets] = True
    newline = np.flatnonzero(t.data == 10)
    start = np.union1d(np.flatnonzero(cut[:-1]), newline + 1)
    start = start[start < len(t.data)]
    stop = np.append(start[1:], len(t.data))
    stop = stop - (t.data[stop - 1] == 10) if len(stop) else stop
    words_before = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(inside, out=words_before[1:])
    filled = words_before[stop] > words_before[start] if len(start) else np.zeros(0, bool)
    start, stop = start[filled], stop[filled]
    of = np.searchsorted(t.offsets, start, "right") - 1
    per = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    lines = np.bincount(of, minlength=n)
    again = _first_of(range_hash(running, start, stop) ^ per[of])
    # words inside 3-word windows that the text holds twice or more
    at, h = shingle_hashes(range_hash(running, w.start, w.end), w, 3)
    h ^= per[w.text[at]]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    repeated = np.zeros(len(w.start), bool)
    for j in range(3):
        repeated[at[twice] + j] = True
    return {
        "n_words": np.diff(w.first),
        "word_chars": t.per_text(inside & starts_of_code_points(t.data)),
        "n_symbols": t.per_text(SYMBOLS[t.data]),
        "n_lines": lines,
        "n_dup_lines": np.bincount(of[again], minlength=n),
        "n_repeat_words": np.bincount(w.text[repeated], minlength=n),
        "n_letters": t.per_text(LETTERS[t.data]),
        "n_bars": t.per_text(BARS[t.data]),
    }


def failed_mask() -> Column:
    """The bitmask of failed rules as one expression over the measurements."""
    mask = F.lit(0)
    for rule in RULES:
        mask = mask.bitwiseOR(F.when(F.expr(rule.failed), F.lit(1 << rule.bit)).otherwise(F.lit(0)))
    return mask


def ledger(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``_row`` (struct of ``carry``), the measurements and ``failed`` per document."""
    fields = [T.StructField(m, T.LongType(), False) for m in MEASURES]
    return annotate(docs, text, fields, measure, carry).withColumn("failed", failed_mask())


def rejects(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(book: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """The ledger with ``kept`` under a policy."""
    return book.withColumn("kept", ~rejects(POLICIES[version]))


def kept_rows(docs: DataFrame, text: str = "text", version: str = DEFAULT_POLICY) -> DataFrame:
    """The rows of ``docs``, all their columns, that a policy keeps."""
    fields = [T.StructField(m, T.LongType(), False) for m in MEASURES]
    book = annotate_whole(docs, text, fields, measure).withColumn("failed", failed_mask())
    return whole_rows(apply_policy(book, version).where("kept"), docs.columns, text)


def ablations(book: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only it rejects.

    The ledger is first counted per distinct mask (at most 2^rules groups, with
    a map-side partial count); the rest works on those few rows.
    """
    policy = POLICIES[version]
    counts = book.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("mask")).agg(F.count("*").alias("n"))
    table = [(r.name, 1 << r.bit) for r in RULES if r.name in policy.rules]
    out = [
        F.struct(
            F.lit(name).alias("rule"),
            F.when(F.col("mask").bitwiseAND(F.lit(bit)) != 0, F.col("n")).otherwise(0).alias("n_failed"),
            F.when(F.col("mask") == bit, F.col("n")).otherwise(0).alias("n_only"),
        )
        for name, bit in table
    ]
    return (
        counts.select(F.explode(F.array(*out)).alias("x"))
        .groupBy("x.rule")
        .agg(F.sum("x.n_failed").alias("n_failed"), F.sum("x.n_only").alias("n_only"))
    )
