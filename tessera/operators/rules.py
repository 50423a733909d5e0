"""Declarative row-level quality rules (FLT-4 … FLT-18).

A rule is a name plus a boolean column; a row passes when the column is
TRUE. Under SQL three-valued logic a NULL result drops the row, so every
rule below is also a NOT NULL rule for the columns it reads. ``clean``
keeps rows passing all rules, ``rejects`` keeps the others and names the
first rule each one failed, ``rule_report`` counts passes per rule in one
aggregation pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``build`` makes the boolean column when a plan is built (columns need
    an active session, so rules are defined as builders)."""

    name: str
    build: Callable[[], Column]

    @property
    def condition(self) -> Column:
        return self.build()

    def passes(self) -> Column:
        """TRUE / FALSE, never NULL."""
        return F.coalesce(self.condition, F.lit(False))


def matches(name: str, column: str, pattern: str) -> Rule:
    """Java-regex find (``rlike``); anchor the pattern for a full match."""
    return Rule(name, lambda: F.col(column).rlike(pattern))


def one_of(name: str, column: str, values: list[str]) -> Rule:
    return Rule(name, lambda: F.col(column).isin(values))


def positive(name: str, column: str) -> Rule:
    return Rule(name, lambda: F.col(column).isNotNull() & (F.col(column) > 0))


def not_before(name: str, later: str, earlier: str) -> Rule:
    return Rule(name, lambda: F.col(later) >= F.col(earlier))


# The call-record quality gate. Patterns are Java regular
# expressions, matched case-sensitively; value lists are exact matches.
SIM_CARD_PATTERN = r"^8930\d{15}$"
IMSI_PATTERN = r"^\d{15}$"
IMEI_PATTERN = r"^\d{15}$"
COUNTRY_CODE_PATTERN = r"^\+(234|1|44).*$"
CELL_TOWER_PATTERN = r"^CT-\d{4}$"
LOCATION_AREA_PATTERN = r"^\d{3}-\d{3}$"
CALL_TYPES = ["voice", "sms", "data"]
SERVICE_TYPES = ["prepaid", "postpaid"]
DIRECTIONS = ["incoming", "outgoing"]
NETWORK_TYPES = ["2G", "3G", "4G", "5G"]
NETWORK_PROVIDERS = ["MTN", "Airtel", "Glo", "9mobile"]
CURRENCIES = ["NGN", "USD"]

# Cheap null / membership checks come first in the conjunction; the regular
# expressions (never pushed into the scan) come last.
CALL_RECORD_RULES: list[Rule] = [
    positive("rule_id", "id"),
    one_of("rule_call_type", "call_type", CALL_TYPES),
    one_of("rule_service_type", "service_type", SERVICE_TYPES),
    one_of("rule_direction", "direction", DIRECTIONS),
    one_of("rule_network_type", "network_type", NETWORK_TYPES),
    one_of("rule_network_provider", "network_provider", NETWORK_PROVIDERS),
    one_of("rule_currency", "currency", CURRENCIES),
    not_before("rule_time_order", "call_end_time", "call_start_time"),
    matches("rule_sim_card_number", "sim_card_number", SIM_CARD_PATTERN),
    matches("rule_imsi_number", "imsi_number", IMSI_PATTERN),
    matches("rule_imei_number", "imei_number", IMEI_PATTERN),
    matches("rule_country_code", "country_code", COUNTRY_CODE_PATTERN),
    matches("rule_cell_tower_id", "cell_tower_id", CELL_TOWER_PATTERN),
    matches("rule_location_area_code", "location_area_code", LOCATION_AREA_PATTERN),
]

RULES_BY_NAME = {r.name: r for r in CALL_RECORD_RULES}


def all_pass(rules: list[Rule]) -> Column:
    """The conjunction as one predicate (NULL counts as failure)."""
    return reduce(lambda a, b: a & b, [r.condition for r in rules])


def clean(df: DataFrame, rules: list[Rule] = CALL_RECORD_RULES) -> DataFrame:
    """Rows passing every rule (FLT-18)."""
    return df.filter(all_pass(rules))


def first_failed(rules: list[Rule]) -> Column:
    """Name of the first rule the row fails, NULL if it passes all."""
    expr = F.lit(None).cast("string")
    for r in reversed(rules):
        expr = F.when(~r.passes(), F.lit(r.name)).otherwise(expr)
    return expr


MASK_COLUMN = "failed_rules"


def failed_mask(rules: list[Rule] = CALL_RECORD_RULES) -> Column:
    """Every rule the row fails, as a bitmask: bit k stands for rule k of the list, 0 for a clean row."""
    bits = [F.when(r.passes(), 0).otherwise(1 << k) for k, r in enumerate(rules)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")


def first_of_mask(rules: list[Rule] = CALL_RECORD_RULES, mask: str = MASK_COLUMN) -> Column:
    """Name of the first rule of a bitmask, NULL for 0."""
    expr = F.lit(None).cast("string")
    for k, r in reversed(list(enumerate(rules))):
        expr = F.when(F.col(mask).bitwiseAND(F.lit(1 << k)) != 0, F.lit(r.name)).otherwise(expr)
    return expr


def mask_counts(df: DataFrame, mask: str = MASK_COLUMN) -> DataFrame:
    """Rows per bitmask (a partial-aggregated count), the clean rows' 0 left out."""
    return df.where(F.col(mask) != 0).groupBy(F.col(mask).alias("mask")).agg(F.count(F.lit(1)).alias("rows"))


def reject_masks(df: DataFrame, rules: list[Rule] = CALL_RECORD_RULES) -> DataFrame:
    """Rejected rows per set of failed rules (FLT-18)."""
    masked = df.select(failed_mask(rules).alias(MASK_COLUMN))
    return mask_counts(masked.observe("rule check", F.count(F.lit(1)).alias("rows")))


def cause_report(counts: DataFrame, rules: list[Rule] = CALL_RECORD_RULES) -> DataFrame:
    """(rule, n_failed, n_only): rows that fail a rule, and rows that fail no other.

    Works on the counts per bitmask, at most 2^rules rows however many there were."""
    hit = lambda k: F.col("mask").bitwiseAND(F.lit(1 << k)) != 0
    each = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.when(hit(k), F.col("rows")).otherwise(0).alias("n_failed"),
            F.when(F.col("mask") == 1 << k, F.col("rows")).otherwise(0).alias("n_only"),
        )
        for k, r in enumerate(rules)
    ]
    rows = counts.select(F.explode(F.array(*each)).alias("x"))
    return rows.groupBy("x.rule").agg(F.sum("x.n_failed").alias("n_failed"), F.sum("x.n_only").alias("n_only"))


def rejects(df: DataFrame, rules: list[Rule] = CALL_RECORD_RULES) -> DataFrame:
    """Rows failing at least one rule, with the first failed rule's name.

    The rules are evaluated once: the name is NULL exactly where all pass, and
    the filter reads the name. The observation between the two keeps the
    optimizer from copying the rules into the filter."""
    named = df.withColumn("failed_rule", first_failed(rules))
    return named.observe("rule check", F.count("failed_rule").alias("rejected")).filter("failed_rule is not null")


def rule_report(df: DataFrame, rules: list[Rule] = CALL_RECORD_RULES) -> DataFrame:
    """One row: total rows, rows passing all rules, rows passing each rule."""
    aggs = [F.count(F.lit(1)).alias("rows_in"), F.count_if(F.coalesce(all_pass(rules), F.lit(False))).alias("rows_clean")]
    aggs += [F.count_if(r.passes()).alias(f"pass_{r.name}") for r in rules]
    return df.agg(*aggs)


def reject_summary(df: DataFrame, rules: list[Rule] = CALL_RECORD_RULES) -> DataFrame:
    """Rejected rows per first failed rule (a partial-aggregated count)."""
    return rejects(df, rules).groupBy("failed_rule").agg(F.count(F.lit(1)).alias("rows"))
