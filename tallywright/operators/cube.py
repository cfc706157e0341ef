"""A cube of counts and volumes that follows replaced partitions by increments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.session import written

VOLUME = T.DecimalType(38, 6)


@dataclass(frozen=True)
class IncrementalCube:
    """Totals by ``dims`` below ``path``, with the share that each ``part`` (a date) has in them.

    Batches are numbered upwards. A batch writes its shares and the totals after it into folders
    of its own number, made from earlier numbers only, so one that is run again after a
    lost driver ends the same. Both tables are as small as the product of their domains.
    """

    path: str
    part: str
    dims: tuple[str, ...]

    def _schema(self, rows: DataFrame | T.StructType, with_part: bool) -> T.StructType:
        kinds = rows if isinstance(rows, T.StructType) else rows.schema
        names = ([self.part] if with_part else []) + list(self.dims)
        fields = [T.StructField(n, kinds[n].dataType) for n in names]
        return T.StructType([*fields, T.StructField("records", T.LongType()), T.StructField("volume", VOLUME)])

    def _read(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        wanted = T.StructType([*schema, T.StructField("batch", T.IntegerType())])
        if not files.exists(folder):
            return spark.createDataFrame([], wanted)
        return spark.read.schema(wanted).parquet(f"{self.path}/{name}")

    def _summed(self, rows: DataFrame, by: Sequence[str]) -> DataFrame:
        return rows.groupBy(*by).agg(
            F.sum("records").alias("records"), F.sum("volume").cast(VOLUME).alias("volume")
        )

    def replace(self, batch: int, rows: DataFrame, amount: str, emptied: DataFrame | None = None) -> DataFrame:
        """Take ``rows`` as all that their parts hold now; returns the signed change of the totals.

        The parts' old shares are taken out and the new ones put in; transactions of other parts
        are not read. ``emptied`` names parts (column ``part``) that hold nothing any more.
        Amounts are added as decimals, so what is taken out is exactly what was put in.
        """
        spark = rows.sparkSession
        schema = self._schema(rows, with_part=True)
        one = rows.select(self.part, *self.dims, F.lit(1).cast("long").alias("records"), F.col(amount).cast(VOLUME).alias("volume"))
        fresh = written(self._summed(one, [self.part, *self.dims]).select(*schema.names), "cube-shares")
        parts = fresh.select(self.part)
        if emptied is not None:
            parts = parts.unionByName(emptied.select(self.part))
        # A row for each part that the batch replaces, marked even if it is empty now.
        parts = written(parts.distinct().withColumnRenamed(self.part, "_part"), "cube-parts")
        before = self._read(spark, "shares", schema).filter(F.col("batch") < batch)
        old = before.join(parts, F.col(self.part).eqNullSafe(F.col("_part")), "left_semi")
        newest = W.partitionBy(self.part).orderBy(F.desc("batch"))
        old = old.withColumn("_age", F.dense_rank().over(newest)).filter(F.col("_age") == 1)
        taken = old.select(*schema.names).withColumns({"records": -F.col("records"), "volume": (-F.col("volume")).cast(VOLUME)})
        delta = written(self._summed(fresh.unionByName(taken), self.dims), "cube-delta")
        totals = self.totals(spark, rows.schema, before=batch)
        after = self._summed(totals.unionByName(delta), self.dims).filter(F.col("records") != 0)
        after.write.mode("overwrite").parquet(f"{self.path}/totals/batch={batch}")
        # A part without rows leaves a share of nothing, which hides its older ones.
        empty = parts.select(F.col("_part").alias(self.part)).join(
            fresh.select(F.col(self.part).alias("_held")).distinct(), F.col(self.part).eqNullSafe(F.col("_held")), "left_anti"
        )
        nothing = {n: F.lit(None).cast(schema[n].dataType) for n in self.dims}
        nothing |= {"records": F.lit(0).cast("long"), "volume": F.lit(0).cast(VOLUME)}
        shares = fresh.unionByName(empty.withColumns(nothing).select(*schema.names))
        shares.write.mode("overwrite").parquet(f"{self.path}/shares/batch={batch}")
        return delta.filter((F.col("records") != 0) | (F.col("volume") != 0))

    def totals(self, spark: SparkSession, schema: T.StructType, before: int | None = None) -> DataFrame:
        """The totals after the last batch, or after the last one ahead of ``before``."""
        stored = self._read(spark, "totals", self._schema(schema, with_part=False))
        if before is not None:
            stored = stored.filter(F.col("batch") < before)
        last = stored.agg(F.max("batch")).first()[0]
        return stored.filter(F.col("batch") == F.lit(last)).drop("batch")
