"""Synthetic transactions in closed form, and the partition-overwrite contract."""

from __future__ import annotations

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallywright.operators import bronze
from tallywright.operators.quality import DataQualityError
from tallywright.plans.ingest import ingest_report, ingest_transactions
from tallywright.schemas import TRANSACTIONS_BRONZE
from tallywright.session import temporary_settings
from tallywright.sources import id_range, make_transactions

N = 100_000


@pytest.fixture(scope="module")
def full(spark):
    return make_transactions(id_range(spark, N), "run-1").persist()


def test_schema_and_order(full):
    assert full.columns == TRANSACTIONS_BRONZE.fieldNames()
    assert [f.dataType for f in full.schema] == [f.dataType for f in TRANSACTIONS_BRONZE]


def test_closed_form_counts(full):
    row = full.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("transaction_id").alias("ids"),
        F.countDistinct("account_id").alias("accounts"),
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct("merchant_category", "channel").alias("pairs"),
        F.count_if(~F.col("is_card_present")).alias("absent"),
        F.min("amount").alias("low"),
        F.max("amount").alias("high"),
    ).first()
    assert row[:6] == (N, N, 25_000, 15_000, 8, 33_334)
    assert 1 <= row["low"] and row["high"] <= 9_501
    assert {r["records"] for r in ingest_report(full).collect()} == {12_500}
    dates = {r["count"] for r in full.groupBy("processing_date").count().collect()}
    assert dates == {3_225, 3_226}


def test_known_row(full):
    row = full.filter(F.col("transaction_id") == "TX000000090061").first()
    assert (row["account_id"], row["customer_id"]) == ("ACCT00015061", "CUST0000061")
    assert row["event_date"] == date(2026, 7, 7)
    assert str(row["event_ts"]) == "2026-07-07 01:01:01"
    assert (row["merchant_category"], row["country"], row["channel"]) == (
        "cash_withdrawal",
        "IN",
        "mobile",
    )
    assert row["is_card_present"] is True
    assert 0.42 <= row["risk_score"] <= 0.77
    assert (row["currency"], row["ingestion_batch_id"]) == ("USD", "run-1")


def test_ids_match_the_formatter(spark):
    from tallywright.functions import padded_id

    ids = spark.range(0, 3).select((F.pow(F.lit(10), F.col("id") * 6).cast("long")).alias("n"))
    both = ids.select(padded_id("TX", 12, F.col("n")), F.format_string("TX%012d", F.col("n")))
    assert all(a == b for a, b in both.collect())
    wide = spark.range(1).select(padded_id("C", 2, F.lit(12345))).first()[0]
    assert wide == "C12345"


def test_hash_draws_ignore_the_layout(spark):
    def total(partitions):
        made = make_transactions(id_range(spark, 1_000, partitions), "x")
        return made.agg(F.sum("amount"), F.sum("risk_score")).first()

    assert total(16)[0] == total(3)[0]


def test_rand_draws_repeat_for_one_layout(spark):
    def total(partitions):
        made = make_transactions(id_range(spark, 1_000, partitions), "x", draws="rand")
        return made.agg(F.sum("amount")).first()[0]

    assert total(16) == total(16) != total(8)


def test_rand_mode_draws_with_fixed_seeds(spark):
    made = make_transactions(id_range(spark, 500), "x", draws="rand").select("amount").collect()
    plain = (
        spark.range(0, 500, 1, 16)
        .select(F.round(F.rand(42) * 9500.0 + 1.0, 2).cast("decimal(12,2)"))
        .collect()
    )
    assert [tuple(r) for r in made] == [tuple(r) for r in plain]


def test_unknown_draws_are_refused(spark):
    with pytest.raises(ValueError):
        make_transactions(id_range(spark, 1), draws="dice")


@pytest.fixture
def target(tmp_path):
    return {
        "identifier": f"bronze_tests.t_{uuid.uuid4().hex}",
        "location": str(tmp_path / "table"),
        "namespace_location": str(tmp_path / "namespace"),
    }


def test_rerun_replaces_and_absent_partitions_survive(spark, target):
    rows = make_transactions(id_range(spark, 930), "first")
    name = target["identifier"]
    ingest_transactions(rows, minimum_rows=930, **target)
    again = make_transactions(id_range(spark, 930), "second")
    table = ingest_transactions(again, minimum_rows=930, **target)
    assert table.count() == 930
    assert [r[0] for r in table.select("ingestion_batch_id").distinct().collect()] == ["second"]

    part = make_transactions(id_range(spark, 930), "third").filter(
        F.col("processing_date") == F.lit("2026-07-03").cast("date")
    )
    bronze.overwrite_partitions(part.select(*reversed(part.columns)), name)
    by_batch = spark.table(name).groupBy("ingestion_batch_id").count().collect()
    assert {r[0]: r[1] for r in by_batch} == {"second": 900, "third": 30}
    assert spark.table(name).select("transaction_id").distinct().count() == 930


def test_session_mode_is_restored(spark, target):
    before = spark.conf.get(bronze.OVERWRITE_MODE)
    ingest_transactions(make_transactions(id_range(spark, 31), "x"), minimum_rows=31, **target)
    assert spark.conf.get(bronze.OVERWRITE_MODE) == before


def test_files_are_zstd_and_partitioned(spark, target, tmp_path):
    import pyarrow.parquet as pq

    ingest_transactions(make_transactions(id_range(spark, 62), "x"), minimum_rows=62, **target)
    folders = sorted(p.name for p in (tmp_path / "table").glob("processing_date=*"))
    assert len(folders) == 31 and folders[0] == "processing_date=2026-07-01"
    one = next((tmp_path / "table").glob("*/*.parquet"))
    assert pq.ParquetFile(one).metadata.row_group(0).column(0).compression == "ZSTD"
    query = spark.table(target["identifier"]).filter("processing_date = date'2026-07-05'")
    assert query.count() == 2
    assert "PartitionFilters: [isnotnull(processing_date" in plan(query)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_short_table_raises(spark, target):
    with pytest.raises(DataQualityError, match="at least 32 rows"):
        ingest_transactions(make_transactions(id_range(spark, 31), "x"), minimum_rows=32, **target)


def test_hot_date_is_written_by_many_tasks(spark, tmp_path):
    """All rows carry one date; small target sizes stand for a large table."""
    rows = make_transactions(id_range(spark, 20_000), "x").withColumn(
        "processing_date", F.lit("2026-07-01").cast("date")
    )
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k",
    }
    with temporary_settings(spark, sizes):
        bronze.overwrite_partition_files(rows, str(tmp_path / "hot"), ["processing_date"])
    assert len(list((tmp_path / "hot").glob("*/*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 20_000


def test_file_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "files")
    rows = spark.range(0, 10).selectExpr("id", "id % 2 as part", "'a' as batch")
    bronze.overwrite_partition_files(rows, path, ["part"])
    bronze.overwrite_partition_files(
        rows.filter("part = 1").withColumn("batch", F.lit("b")), path, ["part"], tasks=2
    )
    got = spark.read.parquet(path).groupBy("part", "batch").count().collect()
    assert {tuple(r) for r in got} == {(0, "a", 5), (1, "b", 5)}
