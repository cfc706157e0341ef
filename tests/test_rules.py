"""Edges of the gate, the profile and the rules."""

from __future__ import annotations

import pytest
from helpers import NOON, card_rows
from pyspark.sql import Observation

from tallywright.operators import quality
from tallywright.operators.profile import profile_table, with_profile, with_zscore
from tallywright.operators.rules import FraudRules, with_fraud_flags
from tallywright.plans.fraud import flag_transactions, fraud_reports, print_reports
from tallywright.sources import load_card_transactions

NIGHT = "2026-07-17 03:00:00"


def ids(df):
    return {r["transaction_id"] for r in df.collect()}


@pytest.fixture(scope="module")
def gate(spark):
    return card_rows(
        spark,
        [
            ("null", "A", NOON, None),
            ("nan", "A", NOON, float("nan")),
            ("zero", "A", NOON, 0.0),
            ("negative", "A", NOON, -99.0),
            ("good", "B", NOON, 1.0),
        ],
    )


def test_gate_branches(gate):
    assert ids(quality.accepted(gate)) == {"nan", "good"}
    assert ids(quality.rejected(gate)) == {"zero", "negative"}
    assert ids(quality.unclassified(gate)) == {"null"}
    counts = quality.gate_counts(gate).first()
    assert counts == (5, 2, 2, 1, 1)
    assert counts["input_rows"] == sum(counts[1:4])


def test_gate_counts_ride_on_another_action(gate):
    seen = Observation("gate")
    assert quality.accepted_observed(gate, seen).count() == 2
    assert (seen.get["accepted_rows"], seen.get["rejected_rows"]) == (2, 2)


def test_nan_customer_never_hits_the_outlier_rule(gate):
    flagged = flag_transactions(gate)
    assert {r["transaction_id"]: r["is_fraudulent"] for r in flagged.collect()} == {
        "nan": False,
        "good": False,
    }


def flags(df, **columns):
    return {r["transaction_id"]: r["fraud_reason"] for r in flag_transactions(df, **columns).collect()}


def background(customer="P", amount=1_400.0, rows=6):
    """Rows that lift a customer's mean, so the outlier rule stays quiet."""
    return [(f"bg{customer}{i}", customer, NOON, amount) for i in range(rows)]


def test_night_amount_is_exclusive_and_hours_inclusive(spark):
    rows = background() + [
        ("at limit", "P", NIGHT, 1_000.0),
        ("above", "P", NIGHT, 1_000.01),
        ("04:59", "P", "2026-07-17 04:59:00", 1_500.0),
        ("05:00", "P", "2026-07-17 05:00:00", 1_500.0),
        ("05:59", "P", "2026-07-17 05:59:59", 1_500.0),
        ("06:00", "P", "2026-07-17 06:00:00", 1_500.0),
        ("next midnight", "P", "2026-07-18 00:00:00", 1_500.0),
    ]
    got = flags(card_rows(spark, rows))
    assert {k for k, v in got.items() if v == "night"} == {
        "above",
        "04:59",
        "05:00",
        "05:59",
        "next midnight",
    }
    assert not {v for v in got.values()} - {"night", None}


def test_category_amount_is_exclusive_and_null_category_is_no_hit(spark):
    rows = background() + [
        ("at limit", "P", NOON, 500.0, "Gambling"),
        ("above", "P", NOON, 500.01, "Gambling"),
        ("null", "P", NOON, 600.0, None),
    ]
    got = flags(card_rows(spark, rows))
    assert {k for k, v in got.items() if v} == {"above"}


def test_outlier_needs_four_rows(spark):
    three = [(f"a{i}", "A", NOON, v) for i, v in enumerate((100.0, 1.0, 1.0))]
    four = [(f"b{i}", "B", NOON, v) for i, v in enumerate((100.0, 1.0, 1.0, 1.0))]
    assert {k for k, v in flags(card_rows(spark, three + four)).items() if v} == {"b0"}


def test_first_matching_rule_names_the_reason(spark):
    rows = [("big", "A", NIGHT, 9_000.0, "Gambling")] + [
        (f"a{i}", "A", NOON, 1.0) for i in range(5)
    ]
    assert flags(card_rows(spark, rows))["big"] == "outlier"


def test_thresholds_are_parameters(spark):
    rules = FraudRules(outlier_factor=1e9, night_amount=10, night_hours_inclusive=(12, 12))
    got = flags(card_rows(spark, [("a", "A", NOON, 11.0), ("b", "A", NIGHT, 11.0)]), rules=rules)
    assert got == {"a": "night", "b": None}


def test_flag_is_the_reason_being_set(spark):
    profiled = with_profile(card_rows(spark, background() + [("n", "P", NIGHT, 1_200.0)]))
    both = with_fraud_flags(profiled).withColumn("direct", FraudRules().flag())
    assert all(r["direct"] == r["is_fraudulent"] for r in both.collect())


def test_single_row_has_no_deviation(spark):
    one = card_rows(spark, [("a", "A", NOON, 5.0)])
    row = with_zscore(with_profile(one)).first()
    assert row["cust_avg_amount"] == 5.0
    assert row["cust_std_amount"] is None and row["amount_zscore"] is None


def test_equal_amounts_have_no_zscore(spark):
    same = card_rows(spark, [("a", "A", NOON, 5.0), ("b", "A", NOON, 5.0)])
    assert [r["amount_zscore"] for r in with_zscore(with_profile(same)).collect()] == [None, None]


def test_decimal_amounts_give_the_same_flags(spark, sf_small):
    from tallywright.plans.queries import RULES, _raw

    raw = _raw(spark, sf_small)
    exact = raw.withColumn("amount", raw["amount"].cast("decimal(12,2)"))
    columns = ["transaction_id", "fraud_reason"]
    plain = flag_transactions(raw, RULES).select(*columns)
    assert sorted(map(str, plain.collect())) == sorted(
        map(str, flag_transactions(exact, RULES).select(*columns).collect())
    )


def test_null_customers_share_one_profile(spark):
    rows = card_rows(spark, [("a", None, NOON, 1.0), ("b", None, NOON, 3.0), ("c", "A", NOON, 9.0)])
    got = {r["transaction_id"]: r["cust_avg_amount"] for r in with_profile(rows).collect()}
    assert got == {"a": 2.0, "b": 2.0, "c": 9.0}
    assert profile_table(rows).count() == 2


def test_text_timestamps_are_cast(spark):
    text = card_rows(spark, [("a", "A", NOON, 1.0)]).selectExpr(
        "* except (timestamp)", f"'{NOON}' as timestamp"
    )
    loaded = load_card_transactions(text)
    assert loaded.schema["timestamp"].dataType.simpleString() == "timestamp"
    assert str(loaded.first()["timestamp"]) == NOON


def test_bad_text_stops_or_becomes_null(spark):
    text = card_rows(spark, [("a", "A", NOON, 1.0)]).selectExpr(
        "* except (timestamp)", "'soon' as timestamp"
    )
    assert load_card_transactions(text, tolerant=True).first()["timestamp"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_card_transactions(text).collect()


def test_job_reports_agree_with_each_other(spark, sf_small, capsys):
    from tallywright.plans.queries import RULES, _raw

    raw = _raw(spark, sf_small)
    out = fraud_reports(raw, RULES)
    summary = {r["is_fraudulent"]: r["tx_count"] for r in out.summary.collect()}
    assert out.gate["accepted_rows"] == sum(summary.values()) == 989
    assert out.gate["input_rows"] == raw.count()
    assert sum(r["fraud_count"] for r in out.by_category.collect()) == summary[True]
    cards = out.by_card.collect()
    assert sum(r["total_tx"] for r in cards) == 989
    assert sum(r["fraud_tx_count"] for r in cards) == summary[True]
    assert out.samples.count() == 10
    print_reports(out)
    assert "accepted_rows 989" in capsys.readouterr().out
    out.close()


def test_reports_from_rows_and_from_the_cube_are_equal(spark, sf_small):
    from tallywright.operators import reports
    from tallywright.plans.queries import _flagged

    flagged = _flagged(spark, sf_small)
    cube = reports.report_cube(flagged)
    for report in (reports.fraud_summary, reports.fraud_by_category, reports.fraud_by_card):
        assert sorted(report(flagged).collect()) == sorted(report(cube).collect())
