"""Message topics as a sink, and how a reader gets each record once.

The topic sink repeats records when a micro-batch is replayed.  So every record
gets a key that a replay makes again, and the reader drops repeated keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.sources.lines import kafka_sink_options


def to_records(batch: DataFrame, batch_id: int, line: str, unique: str) -> DataFrame:
    """UTF-8 value and a key of batch number and the row's unique column."""
    key = F.concat_ws("-", F.lit(str(batch_id)), F.col(unique).cast("string"))
    return batch.select(key.alias("key"), F.col(line).cast("string").alias("value"))


def topic_writer(servers: str, topic: str, line: str, unique: str):
    """A foreachBatch function that writes keyed records to a topic."""
    options = kafka_sink_options(servers, topic)

    def write(batch: DataFrame, batch_id: int) -> None:
        to_records(batch, batch_id, line, unique).write.format("kafka").options(**options).save()

    return write


def drop_repeats(records: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Each key once; keys are remembered for `delay` of record time."""
    return records.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["key"])
