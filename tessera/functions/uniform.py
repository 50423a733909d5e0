"""Reproducible uniform numbers as column expressions (FN-12, FN-21 … FN-24).

``rand(seed)`` depends on how rows fall into partitions; a hash of the row's
key does not. Each named stream of uniforms is a 32-bit integer mix of the
key with a per-stream constant, scaled to [0, 1) by 2^-32:

    x = (key & 0xFFFFFFFF) ^ stream_constant ^ (((key >> 32) * M) & 0xFFFFFFFF)
    x = x ^ (x >> 16);  x = (x * M) & 0xFFFFFFFF
    x = x ^ (x >> 16);  x = (x * M) & 0xFFFFFFFF
    x = x ^ (x >> 16)

with the multiplier M below 2^31, so every product fits a signed 64-bit
integer and nothing overflows under ANSI arithmetic. The mix is a bijection of
32-bit words with good avalanche, it is plain integer arithmetic (so it stays
in generated code, and Spark computes a repeated sub-expression once), and
any SQL engine with 64-bit integers reproduces it bit for bit; ``u * n`` and
``floor`` on the result are exact in double arithmetic.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the mixing function.
MASK32 = 0xFFFFFFFF
MIX_MULTIPLIER = 0x45D9F3B
SALT_MULTIPLIER = 0x2C1B3C6D
TWO_POW_32 = 4294967296.0


def stream_constant(seed: int, stream: str) -> int:
    """32-bit constant of a named stream (CRC-32 of ``"<seed>|<stream>"``)."""
    return zlib.crc32(f"{seed}|{stream}".encode())


def _xorshift(x: Column) -> Column:
    return x.bitwiseXOR(F.shiftright(x, 16))


def _multiply(x: Column) -> Column:
    return (x * F.lit(MIX_MULTIPLIER)).bitwiseAND(F.lit(MASK32))


MIX_STEPS = (_xorshift, _multiply, _xorshift, _multiply, _xorshift)


def mix32(x: Column) -> Column:
    for step in MIX_STEPS:
        x = step(x)
    return x


def keyed_sql(seed: int, stream: str, key_sql: str) -> str:
    """``keyed`` as SQL text over a non-negative integer expression."""
    key = f"cast({key_sql} as bigint)"
    return (
        f"((({key} & {MASK32}) ^ {stream_constant(seed, stream)}) ^ "
        f"((shiftright({key}, 32) * {MIX_MULTIPLIER}) & {MASK32}))"
    )


# The mix as three projections: each reads its input column twice in a
# xor-shift, so the optimizer keeps the projections apart.
_MIX_STAGES_SQL = (
    lambda x: f"({x}) ^ shiftright({x}, 16)",
    lambda x: f"(({x} * {MIX_MULTIPLIER}) & {MASK32}) ^ shiftright(({x} * {MIX_MULTIPLIER}) & {MASK32}, 16)",
    lambda x: f"(({x} * {MIX_MULTIPLIER}) & {MASK32}) ^ shiftright(({x} * {MIX_MULTIPLIER}) & {MASK32}, 16)",
)


def with_hash_columns(df: DataFrame, words: dict[str, str]) -> DataFrame:
    """Add mixed 32-bit words as columns.

    ``words`` maps a new column name to the SQL text of its pre-mix word
    (``keyed_sql``). The mix runs as three projections that each refer to
    the previous one's columns, so the expression trees stay small however
    many words a table needs (inlined, every xor-shift doubles the tree), and
    the plan is built with one call per word and stage. All three run in one
    stage of generated code."""
    first, *rest = _MIX_STAGES_SQL
    df = df.withColumns({name: F.expr(first(f"({sql})")) for name, sql in words.items()})
    for stage in rest:
        df = df.withColumns({name: F.expr(stage(f"`{name}`")) for name in words})
    return df


def keyed(seed: int, stream: str, key: Column) -> Column:
    """The pre-mix word of a non-negative 64-bit key in a stream."""
    key = key.cast("bigint")
    lo = key.bitwiseAND(F.lit(MASK32))
    hi = (F.shiftright(key, 32) * F.lit(MIX_MULTIPLIER)).bitwiseAND(F.lit(MASK32))
    return lo.bitwiseXOR(F.lit(stream_constant(seed, stream))).bitwiseXOR(hi)


def salted(word: Column, salt: Column) -> Column:
    """A word varied by a small non-negative integer (e.g. a position)."""
    return word.bitwiseXOR((salt.cast("bigint") * F.lit(SALT_MULTIPLIER)).bitwiseAND(F.lit(MASK32)))


def to_unit(h: Column) -> Column:
    return h / F.lit(TWO_POW_32)


def uniform(seed: int, stream: str, key: Column) -> Column:
    return to_unit(mix32(keyed(seed, stream, key)))


class Uniforms:
    """Named uniform streams of one key column."""

    def __init__(self, seed: int, stream: str, key: Column):
        self.seed, self.stream, self.key = seed, stream, key

    def __getitem__(self, name: str) -> Column:
        return uniform(self.seed, f"{self.stream}.{name}", self.key)

    def index(self, name: str, n: int) -> Column:
        """Uniform integer in [0, n)."""
        return F.floor(self[name] * n).cast("int")

    def choice(self, name: str, values: list) -> Column:
        """Uniform choice from a fixed list (1-based ``element_at``)."""
        return F.element_at(F.array(*[F.lit(v) for v in values]), self.index(name, len(values)) + 1)

    def digits(self, name: str, width: int) -> Column:
        """A random decimal string of ``width`` digits (two draws of up to 8)."""
        hi, lo = width - width // 2, width // 2
        return F.concat(
            F.lpad(F.floor(self[f"{name}.hi"] * 10**hi).cast("bigint").cast("string"), hi, "0"),
            F.lpad(F.floor(self[f"{name}.lo"] * 10**lo).cast("bigint").cast("string"), lo, "0"),
        )


class StagedUniforms(Uniforms):
    """Uniforms read from hash columns that ``with_hash_columns`` adds.

    ``key`` is SQL text of the key; ``names`` lists every uniform the caller
    will use; ``words`` gives their pre-mix words (to add with
    ``with_hash_columns``), after which ``self[name]`` is a plain column
    reference."""

    def __init__(self, seed: int, stream: str, key: str, names: list[str], prefix: str):
        super().__init__(seed, stream, key)
        self.column_of = {name: f"{prefix}{i}" for i, name in enumerate(names)}

    def words(self) -> dict[str, str]:
        return {col: keyed_sql(self.seed, f"{self.stream}.{name}", self.key) for name, col in self.column_of.items()}

    def __getitem__(self, name: str) -> Column:
        return to_unit(F.col(self.column_of[name]))
