"""Quality gate on amounts, and declarative expectations on any table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.schemas import EXPECTATION_RESULT


class DataQualityError(RuntimeError):
    """Raised where a failed check has to stop what comes after it."""


def accepted(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Rows with a positive amount. NULL is not accepted, NaN is."""
    return df.filter(F.col(amount) > 0)


def rejected(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Rows with a zero or negative amount. NULL is not among them."""
    return df.filter(F.col(amount) <= 0)


def unclassified(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Rows whose amount is NULL, which are in neither branch.

    NaN compares as the largest amount, so it is accepted; the gate counts it apart.
    """
    return df.filter(F.col(amount).isNull())


def _is_nan(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.isnan(column)
    return F.lit(False)


def gate_counts(df: DataFrame, amount: str = "amount") -> DataFrame:
    """One row with all, accepted, rejected and unclassified rows, in one pass.

    The three classes add up to all rows; ``nan_rows`` are among the accepted.
    """
    return df.agg(*_gate_measures(df, amount))


def _gate_measures(df: DataFrame, amount: str) -> list[Column]:
    value = F.col(amount)
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(value > 0).alias("accepted_rows"),
        F.count_if(value <= 0).alias("rejected_rows"),
        F.count_if(value.isNull()).alias("unclassified_rows"),
        F.count_if(_is_nan(df, amount)).alias("nan_rows"),
    ]


def accepted_observed(
    df: DataFrame, observation: Observation, amount: str = "amount"
) -> DataFrame:
    """The accepted rows; the action that reads them also fills ``observation``."""
    return accepted(df.observe(observation, *_gate_measures(df, amount)), amount)


def has_key(columns: Sequence[str]) -> Column:
    """No part of the key is NULL; written so that the scan can use it."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


@dataclass(frozen=True)
class Expectation:
    """A named check. ``failed`` is true on a bad row; ``unique`` names key columns."""

    name: str
    failed: Column | None = None
    unique: tuple[str, ...] = ()


def not_null(column: str) -> Expectation:
    return Expectation(f"not_null({column})", F.col(column).isNull())


def in_set(column: str, values: Sequence) -> Expectation:
    """NULL passes here; pair with ``not_null`` to refuse it."""
    return Expectation(f"in_set({column})", ~F.col(column).isin(list(values)))


def in_range(column: str, low, high) -> Expectation:
    """Inclusive on both sides; NULL passes."""
    return Expectation(f"in_range({column})", ~F.col(column).between(low, high))


def unique(*columns: str) -> Expectation:
    """Every row of a repeated key fails; a key with a NULL part is not checked."""
    return Expectation(f"unique({','.join(columns)})", unique=columns)


def check(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation: checked rows, failed rows, success.

    All row checks share one aggregation over one scan. Each uniqueness check
    counts rows per key first, which combines on the map side, so a key repeated
    very often costs no more than any other.
    """
    row_checks = [e for e in expectations if not e.unique]
    if not expectations:
        return df.sparkSession.createDataFrame([], EXPECTATION_RESULT)
    parts = []
    if row_checks:
        totals = df.agg(
            F.count(F.lit(1)).alias("_checked"),
            *[F.count_if(e.failed).alias(f"_failed_{i}") for i, e in enumerate(row_checks)],
        )
        results = F.array(
            *[
                F.struct(
                    F.lit(e.name).alias("expectation"),
                    F.col("_checked").alias("checked_rows"),
                    F.col(f"_failed_{i}").alias("failed_rows"),
                )
                for i, e in enumerate(row_checks)
            ]
        )
        parts.append(totals.select(F.inline(results)))
    for e in (e for e in expectations if e.unique):
        keyed = df.filter(has_key(e.unique))
        per_key = keyed.groupBy(*e.unique).agg(F.count(F.lit(1)).alias("_rows"))
        parts.append(
            per_key.agg(
                F.lit(e.name).alias("expectation"),
                F.coalesce(F.sum("_rows"), F.lit(0)).alias("checked_rows"),
                F.coalesce(F.sum(F.when(F.col("_rows") > 1, F.col("_rows"))), F.lit(0)).alias(
                    "failed_rows"
                ),
            )
        )
    return reduce(DataFrame.unionByName, parts).withColumn("success", F.col("failed_rows") == 0)


def halt_on_failure(results: DataFrame) -> DataFrame:
    """Stop the job when an expectation failed; one row per expectation is read."""
    failures = results.filter(~F.col("success")).collect()
    if failures:
        detail = ", ".join(f"{r['expectation']}: {r['failed_rows']} rows" for r in failures)
        raise DataQualityError(f"failed expectations: {detail}")
    return results


def require_rows(df: DataFrame, minimum: int, label: str) -> int:
    """Raise unless at least ``minimum`` rows are visible; returns the count."""
    found = df.count()
    if found < minimum:
        raise DataQualityError(f"expected at least {minimum} rows in {label}, found {found}")
    return found
