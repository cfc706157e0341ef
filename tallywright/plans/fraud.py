"""The fraud pipeline: load, gate, profile, flag, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation

from tallywright.operators import reports
from tallywright.operators.profile import attach_profile, profile_table, with_profile
from tallywright.operators.quality import accepted, accepted_observed
from tallywright.operators.rules import FraudRules, with_fraud_flags
from tallywright.operators.skew import DEFAULT_POLICY, SkewPolicy
from tallywright.operators.velocity import with_previous_amounts
from tallywright.session import written
from tallywright.sources import load_card_transactions


def flag_transactions(
    raw: DataFrame, rules: FraudRules | None = None, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Accepted transactions with profile and flag.

    The gate comes first: rejected rows must not enter a customer's mean.
    """
    valid = accepted(load_card_transactions(raw))
    return with_fraud_flags(with_profile(valid, policy), rules)


def score_transactions(
    raw: DataFrame, rules: FraudRules | None = None, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """As above, with the customer's previous two amounts beside each row."""
    valid = accepted(load_card_transactions(raw))
    profile = written(profile_table(valid), "profile")
    profiled = attach_profile(valid, profile, policy)
    counts = profile.withColumnRenamed("cust_rows", "_rows")
    return with_fraud_flags(with_previous_amounts(profiled, policy, counts), rules)


@dataclass
class FraudReports:
    """The job's outputs. ``close`` releases what was kept for them."""

    gate: dict[str, int]
    summary: DataFrame
    by_category: DataFrame
    by_card: DataFrame
    samples: DataFrame
    cube: DataFrame

    def close(self) -> None:
        self.cube.unpersist()


def fraud_reports(
    raw: DataFrame, rules: FraudRules | None = None, policy: SkewPolicy = DEFAULT_POLICY
) -> FraudReports:
    """All reports of the job.

    The three aggregates read one persisted cube of a few rows instead of a
    persisted copy of every flagged transaction, which would not fit at scale.
    The gate is counted by the pass that builds the profiles.
    """
    loaded = load_card_transactions(raw)
    gate = Observation("gate")
    profile = written(profile_table(accepted_observed(loaded, gate)), "profile")
    flagged = with_fraud_flags(attach_profile(accepted(loaded), profile, policy), rules)
    cube = reports.report_cube(flagged).persist(StorageLevel.MEMORY_AND_DISK)
    return FraudReports(
        gate=gate.get,
        summary=reports.fraud_summary(cube),
        by_category=reports.fraud_by_category(cube),
        by_card=reports.fraud_by_card(cube),
        samples=reports.fraud_samples(flagged),
        cube=cube,
    )


def print_reports(out: FraudReports) -> None:
    print("\nQuality gate: " + ", ".join(f"{name} {n}" for name, n in out.gate.items()))
    reports.show(out.summary, "Fraudulent and legitimate transactions")
    reports.show(out.by_category, "Merchant categories by fraud volume")
    reports.show(out.by_card, "Fraud rate by card type")
    reports.show(out.samples, "Flagged transactions", rows=10, truncate=False)
