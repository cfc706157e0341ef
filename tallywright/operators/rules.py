"""Fraud rules as one parameterised expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import hour_text


@dataclass(frozen=True)
class FraudRules:
    """Thresholds of the three rules; the defaults are fixed values of the rule set."""

    outlier_factor: float = 3
    night_amount: float = 1000.0
    night_hours_inclusive: tuple[int, int] = (0, 5)
    risky_category: str = "Gambling"
    risky_amount: float = 500.0

    def conditions(self) -> dict[str, Column]:
        """The rules by reason, in the order they are tried."""
        amount = F.col("amount")
        first, last = (f"{hour:02d}" for hour in self.night_hours_inclusive)
        return {
            "outlier": amount > F.col("cust_avg_amount") * self.outlier_factor,
            "night": (amount > self.night_amount)
            & hour_text(F.col("timestamp")).between(first, last),
            "category": (F.col("merchant_category") == self.risky_category)
            & (amount > self.risky_amount),
        }

    def reason(self) -> Column:
        """Name of the first rule that holds, else NULL. An unknown outcome is no hit."""
        chain = F
        for name, condition in self.conditions().items():
            chain = chain.when(condition, F.lit(name))
        return chain

    def flag(self) -> Column:
        """True or False, never NULL."""
        return self.reason().isNotNull()


def with_fraud_flags(profiled: DataFrame, rules: FraudRules | None = None) -> DataFrame:
    """Add ``is_fraudulent`` and the first matching ``fraud_reason``."""
    rules = rules or FraudRules()
    return profiled.withColumn("fraud_reason", rules.reason()).withColumn(
        "is_fraudulent", F.col("fraud_reason").isNotNull()
    )
