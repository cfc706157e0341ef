"""Reports over flagged transactions and over the ingest table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.money import exact_parts, exact_sum, exact_total

SAMPLE_COLUMNS = (
    "transaction_id",
    "customer_id",
    "timestamp",
    "amount",
    "merchant_category",
    "card_type",
)


def report_cube(flagged: DataFrame) -> DataFrame:
    """Counts and volume by flag, category and card type.

    Its size is the product of three small domains, whatever the number of
    transactions; the three reports below read it as well as the rows themselves.
    """
    return flagged.groupBy("is_fraudulent", "merchant_category", "card_type").agg(
        F.count("transaction_id").alias("tx_count"),
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(part).alias(f"volume_{n}") for n, part in enumerate(exact_parts("amount"))],
    )


def _measures(df: DataFrame) -> tuple[Column, Column, Column]:
    """Id count, volume and rows per input row, for rows or for a cube of them."""
    if "row_count" in df.columns:
        volumes = [F.sum(c) for c in df.columns if c.startswith("volume_")]
        return F.sum("tx_count"), exact_total(volumes), F.col("row_count")
    return F.count("transaction_id"), exact_sum("amount"), F.lit(1)


def fraud_summary(flagged: DataFrame) -> DataFrame:
    """Fraudulent against legitimate transactions."""
    count, volume, _ = _measures(flagged)
    return flagged.groupBy("is_fraudulent").agg(
        count.alias("tx_count"), F.round(volume, 2).alias("total_volume")
    )


def fraud_by_category(flagged: DataFrame) -> DataFrame:
    """Categories by fraudulent volume, largest first."""
    count, volume, _ = _measures(flagged)
    return (
        flagged.filter("is_fraudulent")
        .groupBy("merchant_category")
        .agg(count.alias("fraud_count"), F.round(volume, 2).alias("fraud_volume"))
        .orderBy(F.desc("fraud_volume"), "merchant_category")
    )


def fraud_by_card(flagged: DataFrame) -> DataFrame:
    """Share of fraudulent transactions per card type, highest first."""
    count, _, each = _measures(flagged)
    return (
        flagged.groupBy("card_type")
        .agg(
            count.alias("total_tx"),
            F.sum(F.when(F.col("is_fraudulent"), each).otherwise(0)).alias("fraud_tx_count"),
        )
        .withColumn(
            "fraud_percentage",
            F.round(F.col("fraud_tx_count") / F.nullif(F.col("total_tx"), F.lit(0)) * 100, 2),
        )
        .orderBy(F.desc("fraud_percentage"), "card_type")
    )


def fraud_samples(flagged: DataFrame, rows: int = 10) -> DataFrame:
    """The first flagged transactions by id; each task keeps only ``rows`` of them."""
    return (
        flagged.filter("is_fraudulent")
        .select(*SAMPLE_COLUMNS)
        .orderBy("transaction_id")
        .limit(rows)
    )


def category_share(df: DataFrame) -> DataFrame:
    """Count and volume of each category and their shares of the whole.

    The totals are one subquery over the same aggregate. It reads both measures,
    so Spark reuses the exchange and the transactions are scanned once.
    """
    per_category = df.groupBy("merchant_category").agg(
        F.count("transaction_id").alias("tx_count"), exact_sum("amount").alias("volume")
    )
    whole = per_category.agg(
        F.struct(F.sum("tx_count").alias("tx_count"), exact_sum("volume").alias("volume"))
    ).scalar()
    return per_category.select(
        "merchant_category",
        "tx_count",
        F.round("volume", 2).alias("volume"),
        F.round(F.col("tx_count") / whole["tx_count"] * 100, 4).alias("tx_share"),
        F.round(F.col("volume") / whole["volume"] * 100, 4).alias("volume_share"),
    ).orderBy(F.desc("volume"), "merchant_category")


def category_counts(table: DataFrame, rows: int = 20) -> DataFrame:
    """Records per merchant category, most first; ties in category order."""
    return (
        table.groupBy("merchant_category")
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), "merchant_category")
        .limit(rows)
    )


def show(report: DataFrame, title: str, rows: int = 20, truncate: bool = True) -> None:
    """Print a report's first rows."""
    print(f"\n{title}")
    report.show(rows, truncate=truncate)
