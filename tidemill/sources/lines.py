"""Text lines and message topics, and how their records are decoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string


def read_lines(spark: SparkSession, kind: str, **options) -> DataFrame:
    """A DataFrame with one string column `line`.

    kind: "text" (files, read once), "text_stream" (folder, watched), "socket"
    or "kafka" (streams).  A watched file is taken once; appending to it later
    does not bring its lines again.
    """
    if kind == "text":
        return _text(spark.read, options)
    if kind == "text_stream":
        return _text(spark.readStream, options)
    if kind == "socket":
        reader = spark.readStream.format("socket").options(host=options["host"], port=options["port"])
        return reader.load().withColumnRenamed("value", "line")
    if kind == "kafka":
        return decode_lines(spark.readStream.format("kafka").options(**kafka_options(**options)).load())
    raise ValueError(f"kind: {kind}")


def _text(reader, options: dict) -> DataFrame:
    files = options.get("files_per_batch")
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.schema("value string").option("lineSep", "\n").text(options["path"]).withColumnRenamed("value", "line")


def kafka_options(
    servers: str,
    topic: str,
    start: str = "earliest",
    group_prefix: str | None = None,
    max_records: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a topic source.  Offsets live in the query's checkpoint only.

    `max_records` bounds one micro-batch; `min_partitions` splits large topic
    partitions over more tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": "true",
    }
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}


def decode_lines(records: DataFrame) -> DataFrame:
    return records.select(F.col("value").cast("string").alias("line"))


def decode_csv(records: DataFrame, ddl: str, time_name: str = "ts") -> DataFrame:
    """Fields of a delimited value plus the record time.

    A field that does not parse becomes null; a record with too few or too many
    fields is skipped.  Fields may be quoted.
    """
    fields = _parse_datatype_string(ddl).fields
    texts = ", ".join(f"_{i} string" for i in range(len(fields))) + ", _odd string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_odd", "nullValue": "\0", "emptyValue": ""}
    parsed = records.select(
        F.col("timestamp").alias(time_name), F.from_csv(F.col("value").cast("string"), texts, options).alias("__f")
    )
    values = [F.col(f"__f._{i}").try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]
    # Each field is read as text, so only a wrong number of fields makes a record odd.
    return parsed.filter(F.col("__f").isNotNull() & F.col("__f._odd").isNull()).select(time_name, *values)


def decode_json(records: DataFrame, ddl: str, time_name: str = "ts") -> DataFrame:
    """Fields of a JSON value plus the record time; a value that is not JSON is skipped."""
    text = F.col("value").cast("string")
    sound = records.withColumn("__json", text).filter(F.try_parse_json(F.col("__json")).isNotNull())
    return sound.select(F.col("timestamp").alias(time_name), F.from_json("__json", ddl).alias("f")).select(
        time_name, "f.*"
    )


def with_event_time(
    df: DataFrame, ts: str, event_time: str = "event_time", proctime: str = "proctime", delay: str | None = None
) -> DataFrame:
    """Computed columns of a declared table: processing time, event time and its watermark."""
    out = df.withColumns({proctime: F.current_timestamp(), event_time: F.col(ts).cast("timestamp")})
    return out.withWatermark(event_time, delay) if delay else out


def from_values(spark: SparkSession, values: list, ddl: str) -> DataFrame:
    """A small in-memory collection as rows."""
    rows = [v if isinstance(v, (tuple, list)) else (v,) for v in values]
    return spark.createDataFrame(rows, ddl)


def sequence(spark: SparkSession, first: int, last: int, partitions: int | None = None) -> DataFrame:
    """The whole numbers first..last, made in parallel."""
    return spark.range(first, last + 1, 1, partitions).withColumnRenamed("id", "value")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Address rules from a '|'-separated file: fields 2, 3, 6 and 7 of each line."""
    fields = F.split(F.col("value"), "[|]")
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            fields[2].cast("long").alias("start_num"),
            fields[3].cast("long").alias("end_num"),
            fields[6].alias("province"),
            fields[7].alias("city"),
        )
    )
