from __future__ import annotations

from tallywright import session
from tallywright.session import CatalogConfig, SessionConfig


def test_no_catalog_unless_named():
    assert CatalogConfig.from_env({}) is None


def test_catalog_settings_from_the_environment():
    catalog = CatalogConfig.from_env(
        {
            "LAKE_CATALOG": "lake",
            "LAKE_CATALOG_IMPL": "org.apache.iceberg.nessie.NessieCatalog",
            "LAKE_CATALOG_URI": "http://catalog:1/api",
            "LAKE_CATALOG_REF": "main",
            "LAKE_CATALOG_AUTH": "NONE",
            "LAKE_WAREHOUSE": "s3://warehouse/w",
            "LAKE_IO_IMPL": "org.apache.iceberg.aws.s3.S3FileIO",
            "LAKE_S3_ENDPOINT": "http://store:2",
        }
    )
    got = SessionConfig(catalog=catalog).settings()
    prefix = "spark.sql.catalog.lake"
    assert got[prefix] == "org.apache.iceberg.spark.SparkCatalog"
    assert got[f"{prefix}.catalog-impl"].endswith("NessieCatalog")
    assert got[f"{prefix}.uri"] == "http://catalog:1/api"
    assert got[f"{prefix}.ref"] == "main"
    assert got[f"{prefix}.authentication.type"] == "NONE"
    assert got[f"{prefix}.warehouse"] == "s3://warehouse/w"
    assert got[f"{prefix}.io-impl"].endswith("S3FileIO")
    assert got[f"{prefix}.s3.endpoint"] == "http://store:2"
    assert got[f"{prefix}.s3.path-style-access"] == "true"
    assert got[f"{prefix}.cache-enabled"] == "false"
    assert "spark.sql.extensions" in got


def test_extra_settings_win():
    assert SessionConfig(extra={"spark.sql.session.timeZone": "CET"}).settings()[
        "spark.sql.session.timeZone"
    ] == "CET"


def test_shuffle_partitions_follow_the_input():
    assert session.shuffle_partitions_for(0) == 200
    assert session.shuffle_partitions_for(100 * 10**12) == 476_838


def test_shared_folder_is_the_sessions(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == configured
    first, second = (session.fresh_folder(spark, "x") for _ in range(2))
    assert first != second and first.startswith(configured)


def test_written_keeps_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "cast(id as decimal(12,2)) as d", "id % 2 = 0 as even")
    back = session.written(df, "t")
    assert back.dtypes == df.dtypes
    assert sorted(back.collect()) == sorted(df.collect())


def test_scratch_folders_are_deleted(spark):
    from pathlib import Path

    with session.scratch(spark):
        inside = session.fresh_folder(spark, "inside")
        spark.range(3).write.parquet(inside)
        with session.scratch(spark):
            inner = session.fresh_folder(spark, "inner")
            spark.range(3).write.parquet(inner)
        assert Path(inside).exists() and not Path(inner).exists()
    outside = session.fresh_folder(spark, "outside")
    spark.range(3).write.parquet(outside)
    assert not Path(inside).exists() and Path(outside).exists()


def test_shuffle_width_is_set_from_files(spark, sf_small):
    with session.temporary_settings(spark, {"spark.sql.shuffle.partitions": "4"}):
        assert session.fit_shuffle_partitions(spark, sf_small) == 200
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"


def test_time_zone_is_pinned(spark):
    spark.conf.set("spark.sql.session.timeZone", "CET")
    session.pin_time_zone(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
