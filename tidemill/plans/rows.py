"""Queries on sources, sinks and row-wise operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.text import split_trimmed
from tidemill.functions.udfs import register_functions
from tidemill.operators import keys, rows
from tidemill.operators.enrich import enrich
from tidemill.operators.iterate import iterate_until
from tidemill.plans import inputs as i
from tidemill.plans.registry import query
from tidemill.session import run_dir
from tidemill.sinks import files
from tidemill.sources import generated, lines
from tidemill.streaming.runner import ddl_of, read_batches, run_append, run_batches

# --- sources ---------------------------------------------------------------


@query("src_lines", f"SELECT doc_id, line_no, line FROM {i.LINES}")
def src_lines(spark, t):
    return i.lines(t)


@query("src_collection", """SELECT e.event_id, e.event_type, v.label FROM events e
LEFT JOIN (VALUES ('click', 'interest'), ('purchase', 'sale')) v(event_type, label) ON e.event_type = v.event_type""")
def src_collection(spark, t):
    """A literal collection of labels, joined to all events."""
    labels = lines.from_values(spark, [("click", "interest"), ("purchase", "sale")], "event_type string, label string")
    return t.events.join(labels, "event_type", "left").select("event_id", "event_type", "label")


@query("src_sequence", """SELECT s.value, count(o.o_custkey) AS n_orders
FROM (SELECT unnest(range(1, (SELECT max(c_custkey) + 1 FROM customer))) AS value) s
LEFT JOIN orders o ON o.o_custkey = s.value GROUP BY s.value""")
def src_sequence(spark, t):
    """Every number up to the largest customer key, with its orders; gaps show as zero."""
    last = t.customer.agg(F.max("c_custkey")).first()[0]
    per_key = t.orders.groupBy("o_custkey").agg(F.count("o_custkey").alias("n"))
    return (
        lines.sequence(spark, 1, last)
        .join(per_key, F.col("value") == F.col("o_custkey"), "left")
        .select("value", F.coalesce("n", F.lit(0)).cast("long").alias("n_orders"))
    )


@query("src_custom_bounded", """SELECT value, c_name, c_mktsegment FROM (SELECT unnest(range(0, (SELECT count(*) FROM customer)))
  AS value) LEFT JOIN customer ON c_custkey = value""")
def src_custom_bounded(spark, t):
    """The custom bounded source counts as far as there are customers; each number with the customer that has it."""
    generated.register_sources(spark)
    n = t.customer.count()
    numbers = spark.read.format("tidemill_count").option("count", n).option("partitions", 8).load()
    return numbers.join(t.customer, F.col("c_custkey") == F.col("value"), "left").select("value", "c_name", "c_mktsegment")


def _text_copy(spark, t, name: str) -> str:
    """The document lines as text files in the shared folder, as many as the table has splits."""
    folder = run_dir(spark, name)
    files.write_text(i.lines(t), folder)
    return folder


@query("src_text_once", f"SELECT line FROM {i.LINES}")
def src_text_once(spark, t):
    return lines.read_lines(spark, "text", path=_text_copy(spark, t, "text"))


@query("src_text_stream", f"SELECT line FROM {i.LINES}")
def src_text_stream(spark, t):
    """A watched folder, two files per micro-batch."""
    stream = lines.read_lines(spark, "text_stream", path=_text_copy(spark, t, "text"), files_per_batch=2)
    return run_append(stream, "text_stream")


@query("src_offset_files", f"SELECT line FROM {i.LINES}")
def src_offset_files(spark, t):
    """Files followed by byte offset, cut into ranges of whole lines."""
    generated.register_sources(spark)
    folder = _text_copy(spark, t, "tail")
    where = folder if "://" in folder else f"file://{folder}"
    stream = spark.readStream.format("tidemill_tail").option("path", where).option("split_bytes", 1 << 18).load()
    return run_append(stream.select("line"), "tail_stream")


@query("src_kafka_lines", f"SELECT line FROM {i.RAW_CSV}")
def src_kafka_lines(spark, t):
    return lines.decode_lines(i.topic(i.raw_csv(t, broken=True), "line"))


@query("src_csv_table", f"""SELECT try_cast(string_split(line, ',')[1] AS BIGINT) AS event_id,
  try_cast(string_split(line, ',')[2] AS BIGINT) AS user_id, string_split(line, ',')[3] AS behavior,
  try_cast(string_split(line, ',')[4] AS DOUBLE) AS value, ts FROM {i.RAW_CSV}""")
def src_csv_table(spark, t):
    records = i.topic(i.raw_csv(t, broken=True), "line")
    out = lines.decode_csv(records, "event_id bigint, user_id bigint, behavior string, value double")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("src_json_table", f"SELECT {i.JSON_K} AS k, ts FROM events WHERE event_id % 20 <> 0")
def src_json_table(spark, t):
    out = lines.decode_json(i.topic(i.raw_json(t), "line"), "k int")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("src_table_watermark", "SELECT event_id, ts AS event_time, true AS has_proctime FROM events")
def src_table_watermark(spark, t):
    """Computed time columns and a watermark on a stream."""
    stream = lines.with_event_time(t.stream("events"), "ts", delay="5 seconds")
    out = stream.select(
        "event_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), F.col("proctime").isNotNull().alias("has_proctime")
    )
    return run_append(out, "watermark")


@query("src_rules_file", f"SELECT * FROM {i.IP_RULES}")
def src_rules_file(spark, t):
    """Address rules written as '|'-separated lines and read back by field position."""
    folder = run_dir(spark, "rules")
    blank = F.lit("-")
    line = F.concat_ws("|", blank, blank, F.col("start_num").cast("string"), F.col("end_num").cast("string"),
                       blank, blank, "province", "city")
    files.write_text(i.ip_rules(t).select(line.alias("line")), folder)
    return lines.read_rules(spark, folder)


# --- sinks -----------------------------------------------------------------


@query("snk_text", f"SELECT upper(replace(line, 'ß', 'SS')) AS line FROM {i.LINES}")
def snk_text(spark, t):
    folder = run_dir(spark, "sink_text")
    files.write_text(i.lines(t).select(F.upper("line").alias("line")), folder)
    return lines.read_lines(spark, "text", path=folder)


@query("snk_custom", "SELECT concat_ws(' ', event_id, event_type) AS line FROM events")
def snk_custom(spark, t):
    """A custom writer that opens, writes each record and closes; only committed files are read."""
    generated.register_sources(spark)
    folder = run_dir(spark, "sink_custom")
    where = folder if "://" in folder else f"file://{folder}"
    t.events.select("event_id", "event_type").write.format("tidemill_lines").mode("append").option("path", where).save()
    return files.read_lines_sink(spark, folder)


@query("snk_exactly_once", "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'")
def snk_exactly_once(spark, t):
    """Filtered stream into the exactly-once file sink."""
    kept = rows.without_prefix(t.stream("events"), "event_type", "error")
    return run_append(kept.select("event_id", "user_id", "event_type"), "exactly_once")


# --- projection, filter, routing -------------------------------------------


@query("prj_upper", f"SELECT doc_id, upper(replace(line, 'ß', 'SS')) AS line FROM {i.LINES}")
def prj_upper(spark, t):
    return i.lines(t).select("doc_id", F.upper("line").alias("line"))


@query("prj_parse_line", "SELECT event_id, user_id, event_type, value FROM events")
def prj_parse_line(spark, t):
    return rows.parse_delimited(i.raw_csv(t), "line", "event_id bigint, user_id bigint, event_type string, value double")


@query("prj_parse_quarantine", f"SELECT event_id, line AS bad_line FROM {i.RAW_CSV} WHERE event_id % 50 = 0")
def prj_parse_quarantine(spark, t):
    """Malformed lines set apart instead of stopping the query."""
    out = rows.parse_delimited(
        i.raw_csv(t, broken=True), "line", "event_id bigint, user_id bigint, event_type string, value double", on_error="quarantine"
    )
    return out.filter(F.col("bad_line").isNotNull()).select("event_id", "bad_line")


@query("prj_flatmap_words", f"SELECT word FROM {i.WORDS}")
def prj_flatmap_words(spark, t):
    return i.word_rows(t)


@query("flt_not_prefix", "SELECT event_id, event_type FROM events WHERE NOT starts_with(event_type, 'error')")
def flt_not_prefix(spark, t):
    return rows.without_prefix(t.events, "event_type", "error").select("event_id", "event_type")


@query("flt_not_equal", """SELECT event_id, kind FROM (SELECT event_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS kind FROM events) WHERE kind IS DISTINCT FROM 'error'""")
def flt_not_equal(spark, t):
    """Inequality that keeps null rows."""
    kind = F.when(F.col("event_id") % 11 != 0, F.col("event_type"))
    return rows.without_value(t.events.select("event_id", kind.alias("kind")), "kind", "error")


@query("prj_positions", "SELECT event_type, ts FROM events")
def prj_positions(spark, t):
    return rows.at_positions(t.events, 3, 1)


@query("flt_since", "SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'")
def flt_since(spark, t):
    return rows.since_millis(t.events, "ts", 1704844800000).select("event_id", "ts", "event_type")


JSON_DDL = "k int"


@query("prj_json_clean", f"SELECT event_id, {i.JSON_K} AS k FROM events WHERE event_id % 20 <> 0")
def prj_json_clean(spark, t):
    return rows.json_split(i.raw_json(t), "line", JSON_DDL, ["event_id"])[0]


@query("prj_json_quarantine", f"SELECT event_id, line AS bad_json FROM {i.RAW_JSON} WHERE event_id % 20 = 0")
def prj_json_quarantine(spark, t):
    return rows.json_split(i.raw_json(t), "line", JSON_DDL, ["event_id"])[1]


@query("prj_guard", "SELECT event_id, event_type FROM events")
def prj_guard(spark, t):
    """A guard over all events: it would stop the query at a record without a type."""
    missing = F.col("event_type").isNull() | (F.col("event_type") == "")
    return rows.guard(t.events, missing, "record without a type").select("event_id", "event_type")


def _routed(t):
    return rows.tag_numbers(i.mixed(t), "line")


@query("side_odd", f"SELECT event_id, try_cast(line AS INTEGER) AS num FROM {i.MIXED} WHERE try_cast(line AS INTEGER) % 2 <> 0")
def side_odd(spark, t):
    return rows.routes(_routed(t), "tag", ["odd"])["odd"].select("event_id", "num")


@query("side_even", f"SELECT event_id, try_cast(line AS INTEGER) AS num FROM {i.MIXED} WHERE try_cast(line AS INTEGER) % 2 = 0")
def side_even(spark, t):
    return rows.routes(_routed(t), "tag", ["even"])["even"].select("event_id", "num")


@query("side_str", f"SELECT event_id, line FROM {i.MIXED} WHERE try_cast(line AS INTEGER) IS NULL")
def side_str(spark, t):
    return rows.routes(_routed(t), "tag", ["str"])["str"].select("event_id", "line")


@query("side_main", f"SELECT event_id, line FROM {i.MIXED}")
def side_main(spark, t):
    return _routed(t).select("event_id", "line")


@query("side_outputs_stream", f"""SELECT CASE WHEN try_cast(line AS INTEGER) IS NULL THEN 'str'
  WHEN try_cast(line AS INTEGER) % 2 = 0 THEN 'even' ELSE 'odd' END AS tag, line FROM {i.MIXED}""")
def side_outputs_stream(spark, t):
    """All side outputs of a stream written in one pass, one folder per tag."""
    folder = run_dir(spark, "side")
    value = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string"))
    tagged = rows.tag_numbers(t.stream("events").select(value.alias("line")), "line").select("tag", "line")

    def write(batch, batch_id):
        batch.write.mode("overwrite").partitionBy("tag").parquet(f"{folder}/out/batch_id={batch_id}")

    run_batches(tagged, write, folder)
    return read_batches(spark, f"{folder}/out", ddl_of(tagged))


@query("etl_clean", f"""SELECT line FROM (SELECT concat_ws(',', event_type, event_id) AS line FROM events
  UNION ALL SELECT concat_ws(',', o_orderpriority, o_orderkey) FROM orders) WHERE NOT starts_with(line, 'error')""")
def etl_clean(spark, t):
    """Union of a guarded and an unguarded stream, filtered, into the exactly-once sink."""
    risky = t.stream("orders").select(F.concat_ws(",", "o_orderpriority", F.col("o_orderkey").cast("string")).alias("line"))
    plain = t.stream("events").select(F.concat_ws(",", "event_type", F.col("event_id").cast("string")).alias("line"))
    guarded = rows.guard(risky, F.col("line").startswith("error"), "error record")
    return run_append(rows.without_prefix(rows.union_all(plain, guarded), "line", "error"), "etl")


@query("iterate_until", """WITH RECURSIVE it AS (SELECT p_partkey, p_size - 3 AS value FROM part
  UNION ALL SELECT p_partkey, value - 3 FROM it WHERE value > 0) SELECT p_partkey, value FROM it WHERE value <= 0""")
def iterate_until_query(spark, t):
    """Take 3 off each part's size until nothing is left."""
    seeds = t.part.select("p_partkey", F.col("p_size").alias("value"))
    return iterate_until(seeds, "value", lambda v: v - 3, lambda v: v > 0)


# --- keys and distribution --------------------------------------------------


@query("key_by_field", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def key_by_field(spark, t):
    return t.events.groupBy(*keys.key_columns(t.events, "user_id")).agg(F.count(F.lit(1)).alias("n"))


@query("key_by_composite", f"SELECT province, city, count(*) AS n FROM {i.INCOME} GROUP BY province, city")
def key_by_composite(spark, t):
    df = i.income(t)
    return df.groupBy(*keys.key_columns(df, ["province", "city"])).agg(F.count(F.lit(1)).alias("n"))


@query("key_by_concat", f"SELECT concat(province, city) AS place, count(*) AS n FROM {i.INCOME} GROUP BY 1")
def key_by_concat(spark, t):
    """The string form of a composite key."""
    return i.income(t).groupBy(keys.concat_key("province", "city").alias("place")).agg(F.count(F.lit(1)).alias("n"))


@query("key_by_positions", f"SELECT province, city, sum(cents)::BIGINT AS cents FROM {i.INCOME} GROUP BY province, city")
def key_by_positions(spark, t):
    df = i.income(t)
    return df.groupBy(*keys.key_columns(df, [0, 1])).agg(F.sum("cents").alias("cents"))


@query("key_by_object", f"SELECT word, sum(cnt)::BIGINT AS cnt FROM {i.PAIRS} GROUP BY word")
def key_by_object(spark, t):
    """A record key that compares by its word only."""
    records = i.pairs(t).select(F.struct("word", "cnt").alias("record"))
    return records.groupBy(F.col("record.word").alias("word")).agg(F.sum("record.cnt").alias("cnt"))


@query("dst_rebalance", "SELECT event_id, user_id FROM events")
def dst_rebalance(spark, t):
    return keys.rebalance(t.events.select("event_id", "user_id"), 8)


@query("dst_rescale", "SELECT event_id, user_id, true AS within FROM events")
def dst_rescale(spark, t):
    """Sixteen partitions put together to four without a shuffle; each row says whether it lies in one of the four."""
    wide = keys.rebalance(t.events.select("event_id", "user_id"), 16)
    return keys.rescale(wide, 4, current=16).withColumn("within", F.spark_partition_id() < 4)


@query("dst_shuffle", "SELECT event_id, user_id FROM events")
def dst_shuffle(spark, t):
    return keys.shuffled(t.events.select("event_id", "user_id"), 8, "event_id", seed=7)


@query("dst_key_by", "SELECT event_id, user_id FROM events")
def dst_key_by(spark, t):
    return keys.key_by(t.events.select("event_id", "user_id"), "user_id")


@query("dst_replicate", """SELECT s_suppkey, replica, replica AS part FROM supplier,
  (SELECT CAST(unnest(range(4)) AS INTEGER) AS replica)""")
def dst_replicate(spark, t):
    out = keys.replicate(t.supplier.select("s_suppkey"), 4)
    return out.withColumn("part", F.spark_partition_id())


LETTERS = {"a": 1, "b": 2, "m": 3}


@query("dst_custom", """SELECT p_partkey, CASE left(lower(p_name), 1) WHEN 'a' THEN 1 WHEN 'b' THEN 2 WHEN 'm' THEN 3
  ELSE 0 END AS part FROM part""")
def dst_custom(spark, t):
    """Rows sent to the partition their first letter names."""
    named = t.part.select("p_partkey", F.lower("p_name").alias("name"))
    out = keys.partition_by_id(named, 4, keys.first_letter_partition("name", LETTERS))
    return out.select("p_partkey", F.spark_partition_id().alias("part"))


# --- sets and co-processing --------------------------------------------------


@query("set_union_all", "SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def set_union_all(spark, t):
    return rows.union_all(
        t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation"))
    )


@query("co_map", """SELECT 'left' AS side, CAST(event_id * 10 AS VARCHAR) AS value FROM events
  UNION ALL SELECT 'right', upper(p_name) FROM part""")
def co_map(spark, t):
    return rows.co_map(t.events, (F.col("event_id") * 10).cast("string"), t.part, F.upper("p_name"))


# --- enrichment --------------------------------------------------------------


def place_of(longitude: float, latitude: float) -> tuple[str, str] | None:
    """Stands in for an outside service; it knows no place south of 22 degrees."""
    if latitude < 22:
        return None
    return f"p{int(longitude) // 10}", f"c{int(latitude) // 5}"


@query("enrich_unordered", """SELECT event_id, lon, lat, CASE WHEN lat >= 22 THEN 'p' || (CAST(lon AS BIGINT) // 10) END AS province,
  CASE WHEN lat >= 22 THEN 'c' || (CAST(lat AS BIGINT) // 5) END AS city FROM (SELECT event_id,
  CAST(100 + event_id % 30 AS DOUBLE) AS lon, CAST(20 + event_id % 20 AS DOUBLE) AS lat FROM events)""")
def enrich_unordered(spark, t):
    points = t.events.select(
        "event_id",
        (100 + F.col("event_id") % 30).cast("double").alias("lon"),
        (20 + F.col("event_id") % 20).cast("double").alias("lat"),
    )
    return enrich(points, ["lon", "lat"], place_of, "province string, city string")


@query("sql_udtf_split", f"""SELECT doc_id, unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
    ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM {i.LINES}""")
def sql_udtf_split(spark, t):
    """A table function in a lateral join, in its native form."""
    fields = split_trimmed("line", " ").alias("fields")
    i.lines(t).select("doc_id", fields).createOrReplaceTempView("tm_lines")
    return spark.sql("SELECT doc_id, word FROM tm_lines LATERAL VIEW explode(fields) f AS word")


@query("sql_udtf_split_python", f"SELECT event_id, unnest(string_split(line, ',')) AS word FROM {i.RAW_CSV}")
def sql_udtf_split_python(spark, t):
    """The same as a Python table function, called from SQL."""
    register_functions(spark)
    i.raw_csv(t, broken=True).createOrReplaceTempView("tm_csv")
    return spark.sql("SELECT event_id, word FROM tm_csv, LATERAL split_line(line, ',')")
