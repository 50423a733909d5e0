"""Truth table of each quality rule: pass, fail, NULL and boundary rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import rules

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)

GOOD = {
    "id": 5,
    "sim_card_number": "8930" + "1" * 15,
    "imsi_number": "1" * 15,
    "imei_number": "2" * 15,
    "country_code": "+234",
    "cell_tower_id": "CT-0042",
    "location_area_code": "123-456",
    "call_type": "voice",
    "service_type": "prepaid",
    "direction": "incoming",
    "network_type": "4G",
    "network_provider": "MTN",
    "currency": "NGN",
    "call_start_time": T0,
    "call_end_time": T0 + dt.timedelta(minutes=5),
}
SCHEMA = (
    "id bigint, sim_card_number string, imsi_number string, imei_number string, country_code string, "
    "cell_tower_id string, location_area_code string, call_type string, service_type string, direction string, "
    "network_type string, network_provider string, currency string, call_start_time timestamp_ntz, "
    "call_end_time timestamp_ntz"
)

# rule -> list of (value of its column, expected pass)
CASES = {
    "rule_id": ("id", [(1, True), (0, False), (-3, False), (None, False)]),
    "rule_sim_card_number": (
        "sim_card_number",
        [("8930" + "0" * 15, True), ("8930" + "0" * 14, False), ("8931" + "0" * 15, False), (None, False)],
    ),
    "rule_imsi_number": ("imsi_number", [("0" * 15, True), ("0" * 16, False), ("0" * 14 + "a", False), (None, False)]),
    "rule_imei_number": ("imei_number", [("9" * 15, True), ("x", False), ("9" * 14, False), (None, False)]),
    "rule_country_code": (
        "country_code",
        [("+234", True), ("+1", True), ("+44", True), ("+2348", True), ("+33", False), ("234", False), (None, False)],
    ),
    "rule_cell_tower_id": ("cell_tower_id", [("CT-0000", True), ("ct-0000", False), ("CT-00000", False), (None, False)]),
    "rule_location_area_code": (
        "location_area_code",
        [("000-999", True), ("000/999", False), ("00-999", False), (None, False)],
    ),
    "rule_call_type": ("call_type", [("voice", True), ("sms", True), ("data", True), ("fax", False), ("Voice", False), (None, False)]),
    "rule_service_type": ("service_type", [("prepaid", True), ("postpaid", True), ("trial", False), (None, False)]),
    "rule_direction": ("direction", [("incoming", True), ("outgoing", True), ("sideways", False), (None, False)]),
    "rule_network_type": ("network_type", [("2G", True), ("5G", True), ("6G", False), (None, False)]),
    "rule_network_provider": ("network_provider", [("9mobile", True), ("Glo", True), ("Other", False), (None, False)]),
    "rule_currency": ("currency", [("NGN", True), ("USD", True), ("EUR", False), (None, False)]),
    "rule_time_order": (
        "call_end_time",
        [(T0, True), (T0 + dt.timedelta(seconds=1), True), (T0 - dt.timedelta(microseconds=1), False), (None, False)],
    ),
}


def _rows(column, values):
    out = []
    for v in values:
        r = dict(GOOD)
        r[column] = v
        out.append(tuple(r[k] for k in GOOD))
    return out


def test_good_row_passes_everything(spark):
    df = spark.createDataFrame([tuple(GOOD.values())], SCHEMA)
    assert rules.clean(df).count() == 1
    assert rules.rejects(df).count() == 0


@pytest.mark.parametrize("rule_name", sorted(CASES))
def test_rule_truth_table(spark, rule_name):
    column, cases = CASES[rule_name]
    df = spark.createDataFrame(_rows(column, [v for v, _ in cases]), SCHEMA).withColumn(
        "_case", F.monotonically_increasing_id()
    )
    rule = rules.RULES_BY_NAME[rule_name]
    got = [r["ok"] for r in df.orderBy("_case").select(rule.passes().alias("ok")).collect()]
    assert got == [ok for _, ok in cases]
    # The conjunction agrees with the single rule when all others pass.
    assert rules.clean(df).count() == sum(ok for _, ok in cases)


def test_rejects_name_the_first_failed_rule(spark):
    bad = dict(GOOD, id=None, currency="EUR")
    df = spark.createDataFrame([tuple(bad.values())], SCHEMA)
    rows = rules.rejects(df).collect()
    assert [r["failed_rule"] for r in rows] == ["rule_id"]


def test_rule_report_counts(spark):
    rows = [tuple(GOOD.values()), tuple(dict(GOOD, currency="EUR").values()), tuple(dict(GOOD, id=None).values())]
    rep = rules.rule_report(spark.createDataFrame(rows, SCHEMA)).first()
    assert rep["rows_in"] == 3 and rep["rows_clean"] == 1
    assert rep["pass_rule_currency"] == 2 and rep["pass_rule_id"] == 2


def test_every_failed_rule_of_a_row_is_counted(spark):
    from tessera.operators.rules import Rule, cause_report, failed_mask, first_of_mask, mask_counts

    rules = [Rule("a", lambda: F.col("x") > 0), Rule("b", lambda: F.col("y") > 0), Rule("c", lambda: F.col("x") < 9)]
    rows = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (9, 0), (None, 1), (None, None), (0, 1)], "x int, y int")
    masked = rows.withColumn("failed_rules", failed_mask(rules)).withColumn("first", first_of_mask(rules))
    assert [r["failed_rules"] for r in masked.collect()] == [0, 1, 3, 6, 5, 7, 1]
    assert [r["first"] for r in masked.collect()] == [None, "a", "a", "b", "a", "a", "a"]
    counts = mask_counts(masked)
    assert {r["mask"]: r["rows"] for r in counts.collect()} == {1: 2, 3: 1, 6: 1, 5: 1, 7: 1}
    assert {r["rule"]: (r["n_failed"], r["n_only"]) for r in cause_report(counts, rules).collect()} == {"a": (5, 2), "b": (3, 0), "c": (3, 0)}
