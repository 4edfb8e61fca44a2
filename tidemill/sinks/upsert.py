"""A keyed store where the last written value wins."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class UpsertTable:
    """Upserts as one Parquet folder per batch below `path`.

    Writing a batch replaces its own folder only, so a replayed batch changes
    nothing and the cost follows the batch, not the table.  Every `base_every`
    batches the state is also written as a base; a read takes the newest base
    and the batches after it, and keeps the latest row per key.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], base_every: int = 64):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.schema, self.base_every = schema, base_every
        self.values = [n for n in spark.createDataFrame([], schema).columns if n not in keys]

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Write a batch with at most one row per key."""
        rows = batch.select(*self.keys, *self.values)
        rows.write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")
        if batch_id and batch_id % self.base_every == 0:
            self.read(batch_id + 1).write.mode("overwrite").parquet(f"{self.path}/bases/up_to={batch_id}")

    def _rows(self, part: str, number: str) -> DataFrame:
        ddl = f"{self.schema}, {number} bigint"
        folder = f"{self.path}/{part}"
        try:
            return self.spark.read.schema(ddl).option("basePath", folder).parquet(folder)
        except AnalysisException:
            return self.spark.createDataFrame([], ddl)

    def log(self, before: int | None = None) -> DataFrame:
        """The newest base and the batches after it, each row with its batch number."""
        batches, bases = self._rows("batches", "batch_id"), self._rows("bases", "up_to")
        if before is not None:
            batches, bases = batches.filter(F.col("batch_id") < before), bases.filter(F.col("up_to") < before)
        base = bases.agg(F.max("up_to")).first()[0]
        if base is None:
            return batches
        newest = bases.filter(F.col("up_to") == base).withColumnRenamed("up_to", "batch_id")
        return newest.unionByName(batches.filter(F.col("batch_id") > base))

    def read(self, before: int | None = None) -> DataFrame:
        """Latest row per key, combined before the shuffle; `before` excludes a batch and those after it."""
        # A key has one row per batch, so the values picked per column belong together.
        latest = [F.max_by(v, "batch_id").alias(v) for v in self.values]
        return self.log(before).groupBy(*self.keys).agg(*latest)
