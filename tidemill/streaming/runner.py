"""Running a stream over what is there now and reading its result as a table."""

from __future__ import annotations

import time
from datetime import datetime, timedelta
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import run_dir
from tidemill.sinks.upsert import UpsertTable

#: Marks the closing row; a real row never has it set, whatever its time.
CLOSING = "closing"


class Flush:
    """One row sent after all real rows, `horizon` after the latest of them, so that every window of a stream closes.

    `attach` adds an empty side input to a stream, before its watermark is set,
    and the column CLOSING that tells the row from real ones; `run_append` sends
    the row once the stream has come to its end.  The row's own window stays open
    and is never emitted; row-wise operators drop it with `without_flush`.  A
    stream that goes on afterwards has its watermark moved by the horizon, so
    that must be more than window and delay, and no more than needed.
    """

    def __init__(self, horizon: timedelta = timedelta(days=2)):
        self.horizon = horizon
        self._sides: list[tuple[DataFrame, str, str, dict]] = []

    def attach(self, stream: DataFrame, ts: str, **values) -> DataFrame:
        """Columns of the row are null but for `values`: a join drops rows with a null key before it sees their time."""
        spark = stream.sparkSession
        folder = run_dir(spark, "flush")
        marked = stream.withColumn(CLOSING, F.lit(False))
        spark.createDataFrame([], marked.schema).coalesce(1).write.parquet(folder)
        self._sides.append((marked, folder, ts, values))
        return marked.unionByName(spark.readStream.schema(marked.schema).parquet(folder))

    def send(self, latest: datetime) -> None:
        for marked, folder, ts, values in self._sides:
            at = F.lit((latest + self.horizon).isoformat(sep=" "))
            known = {ts: at, CLOSING: F.lit(True), **{k: F.lit(v) for k, v in values.items()}}
            row = marked.sparkSession.range(1).select(
                *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in marked.schema]
            )
            row.coalesce(1).write.mode("append").parquet(folder)


def without_flush(df: DataFrame) -> DataFrame:
    """Spark moves a filter in front of the watermark, which would then not see the row, unless it reads the event time."""
    closing = F.col(CLOSING)
    for field in df.schema:
        if "spark.watermarkDelayMs" in field.metadata:
            closing = closing & F.col(field.name).isNotNull()
    return df.filter(~closing).drop(CLOSING)


def _latest(progress: list) -> datetime | None:
    """The largest event time that the micro-batches of a run have seen."""
    seen = [p["eventTime"].get(k) for p in progress for k in ("max", "watermark") if p["eventTime"]]
    times = [datetime.fromisoformat(x.replace("Z", "+00:00")).replace(tzinfo=None) for x in seen if x]
    return max(times, default=None)


def run_append(df: DataFrame, name: str, folder: str | None = None, flush: Flush | None = None) -> DataFrame:
    """Run an append-mode stream to its end into exactly-once Parquet files and return the table.

    With `flush` the stream goes on once more from its checkpoint, to close the
    windows that the last rows left open.
    """
    spark = df.sparkSession
    folder = folder or run_dir(spark, name)

    def run() -> list:
        query = (
            df.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return query.recentProgress

    progress = run()
    if flush and (latest := _latest(progress)):
        flush.send(latest)
        run()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def run_upsert(df: DataFrame, name: str, keys: list[str], folder: str | None = None) -> DataFrame:
    """Run an update-mode stream to its end into a keyed store and return its latest rows."""
    spark = df.sparkSession
    folder = folder or run_dir(spark, name)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    table = UpsertTable(spark, f"{folder}/out", ddl, keys)
    run_batches(df, lambda batch, batch_id: table.merge(batch, batch_id), folder, "update")
    return table.read()


def run_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], folder: str, mode: str = "append"
) -> None:
    """Run a stream to its end, handing each micro-batch to `write`."""
    (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def run_until_timers(df: DataFrame, name: str, every_ms: int) -> DataFrame:
    """Run a stream with processing-time timers until those of its last input batch have fired.

    A timer fires in the first micro-batch that starts after it.
    """
    folder = run_dir(df.sparkSession, name)
    stream = (
        df.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(processingTime="500 milliseconds")
        .start()
    )
    try:
        while not _timers_fired(stream.recentProgress, every_ms):
            if stream.exception() is not None:
                raise stream.exception()
            if not stream.isActive:
                raise RuntimeError(f"{name} stopped before its timers fired")
            time.sleep(0.2)
    finally:
        stream.stop()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


def _timers_fired(progress: list, every_ms: int) -> bool:
    at = [(datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")), p["numInputRows"]) for p in progress]
    fed = [when for when, n in at if n]
    return bool(fed) and at[-1][0] >= fed[-1] + timedelta(milliseconds=every_ms + 1)


def read_batches(spark: SparkSession, folder: str, ddl: str) -> DataFrame:
    """Rows written below `folder` in one `batch_id=...` folder per micro-batch."""
    return spark.read.schema(f"{ddl}, batch_id bigint").option("basePath", folder).parquet(folder).drop("batch_id")


def ddl_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
