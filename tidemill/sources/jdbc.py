"""Database tables as dimension source and as sink."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a table read, split by a numeric column where one is given."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows)}
    for key, value in (("driver", driver), ("user", user), ("password", password)):
        if value is not None:
            options[key] = value
    if split_column:
        low, high = bounds
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def read_dimension(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def jdbc_writer(options: dict[str, str], batch_rows: int = 1000, retries: int = 100, pause_seconds: float = 1.0):
    """A foreachBatch function that writes a micro-batch in batches of `batch_rows`.

    The database may hold part of a failed attempt, so the rows carry `batch_id`
    and readers of an insert-only table drop repeated (batch_id, key) rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        from pyspark.sql import functions as F

        target = batch.withColumn("batch_id", F.lit(batch_id)).write.format("jdbc").mode("append")
        target = target.options(**options).option("batchsize", batch_rows)
        for attempt in range(retries + 1):
            try:
                target.save()
                return
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(pause_seconds)

    return write


class RefreshingDimension:
    """A dimension that `load` reads again once it is older than `ttl_seconds`.

    For use in foreachBatch: nothing is pulled to the driver, only the plan that
    reads the table is renewed.
    """

    def __init__(self, load, ttl_seconds: float = 600.0, clock=time.monotonic):
        self._load, self._ttl, self._clock = load, ttl_seconds, clock
        self._frame, self._read_at = None, None

    def current(self) -> DataFrame:
        now = self._clock()
        if self._frame is None or now - self._read_at >= self._ttl:
            if self._frame is not None:
                self._frame.unpersist()
            self._frame = self._load().persist()
            self._read_at = now
        return self._frame
