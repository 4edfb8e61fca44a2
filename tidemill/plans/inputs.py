"""Inputs derived from the tables, each in Spark and as a SQL subquery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import text_lines, tokens
from tidemill.sources.tables import Tables

EPOCH = "TIMESTAMP '1970-01-01'"


def lines(t: Tables) -> DataFrame:
    return text_lines(t.documents.select("doc_id", "text"), "text", keep=["doc_id"])


LINES = """(SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""


def word_rows(t: Tables) -> DataFrame:
    return lines(t).select(F.explode(tokens("line")).alias("word"))


WORDS = f"""(SELECT unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
    ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM {LINES})"""


def pairs(t: Tables) -> DataFrame:
    return _pairs(t.events)


def _pairs(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("word"), F.floor("value").cast("long").alias("cnt"), F.col("event_id").alias("seq")
    )


PAIRS = "(SELECT event_type AS word, CAST(floor(value) AS BIGINT) AS cnt, event_id AS seq FROM events)"


def timed_pairs(events: DataFrame) -> DataFrame:
    """Word, count, arrival order and event time; `events` is the table or its stream."""
    return events.select(
        F.col("event_type").alias("word"),
        F.floor("value").cast("long").alias("cnt"),
        F.col("event_id").alias("seq"),
        "user_id",
        F.col("ts").cast("timestamp").alias("ts") if events.isStreaming else F.col("ts"),
    )


TIMED = """(SELECT event_type AS word, CAST(floor(value) AS BIGINT) AS cnt, event_id AS seq, user_id, ts FROM events)"""


def arrivals(t: Tables) -> DataFrame:
    """Pairs with a recorded arrival time, some minutes after the event."""
    delay = F.make_dt_interval(mins=F.pmod("event_id", F.lit(7)).cast("int"))
    return t.events.select(
        F.col("event_type").alias("word"),
        F.floor("value").cast("long").alias("cnt"),
        "user_id",
        F.col("event_id").alias("seq"),
        (F.col("ts") + delay).alias("arrival"),
    )


ARRIVALS = """(SELECT event_type AS word, CAST(floor(value) AS BIGINT) AS cnt, user_id, event_id AS seq,
  ts + to_minutes(event_id % 7) AS arrival FROM events)"""


def late_events(events: DataFrame) -> DataFrame:
    """Every seventh event carries an event time two hours back."""
    back = F.col("ts") - F.expr("INTERVAL '2' HOUR")
    return events.select(
        "event_id",
        "event_type",
        F.floor("value").cast("long").alias("cnt"),
        F.when(F.col("event_id") % 7 == 0, back).otherwise(F.col("ts")).alias("et"),
    )


LATE = f"""(SELECT *, coalesce(time_bucket(INTERVAL '1 hour', et, {EPOCH}) + INTERVAL '1 hour'
    - INTERVAL '1 millisecond' <= seen, false) AS is_late
  FROM (SELECT *, max(et) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
    FROM (SELECT event_id, event_type, CAST(floor(value) AS BIGINT) AS cnt,
      CASE WHEN event_id % 7 = 0 THEN ts - INTERVAL '2 hours' ELSE ts END AS et FROM events)))"""


def raw_csv(t: Tables, broken: bool = False) -> DataFrame:
    """Events as delimited lines; the broken form has a word in place of some user numbers."""
    user = F.col("user_id").cast("string")
    if broken:
        user = F.when(F.col("event_id") % 50 == 0, "x").otherwise(user)
    return t.events.select(
        "event_id", "ts", F.concat_ws(",", F.col("event_id").cast("string"), user, "event_type",
                                      F.col("value").cast("string")).alias("line")
    )


RAW_CSV = """(SELECT event_id, ts, concat_ws(',', event_id,
    CASE WHEN event_id % 50 = 0 THEN 'x' ELSE CAST(user_id AS VARCHAR) END, event_type, value) AS line FROM events)"""


def raw_json(t: Tables) -> DataFrame:
    """Event properties; every twentieth lacks its closing brace."""
    cut = F.expr("left(props, length(props) - 1)")
    return t.events.select("event_id", "ts", F.when(F.col("event_id") % 20 == 0, cut).otherwise(F.col("props")).alias("line"))


RAW_JSON = """(SELECT event_id, ts, CASE WHEN event_id % 20 = 0 THEN left(props, length(props) - 1) ELSE props END
  AS line FROM events)"""

JSON_K = "CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS INTEGER)"


def topic(df: DataFrame, value: str) -> DataFrame:
    """Records in the shape of a message topic."""
    return df.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col(value).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.pmod("event_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def mixed(t: Tables) -> DataFrame:
    value = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string"))
    return t.events.select("event_id", value.alias("line"))


MIXED = """(SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS line
  FROM events)"""


def income(t: Tables) -> DataFrame:
    from tidemill.functions.text import cents

    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("r_name").alias("province"),
            F.col("n_name").alias("city"),
            cents("o_totalprice").alias("cents"),
            F.col("o_orderkey").alias("seq"),
        )
    )


INCOME = """(SELECT r_name AS province, n_name AS city, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
  o_orderkey AS seq FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def ads(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select((k % 10).alias("ad"), "event_type", "user_id", F.col("event_id").alias("seq"))


ADS = f"(SELECT {JSON_K} % 10 AS ad, event_type, user_id, event_id AS seq FROM events)"


def side(events: DataFrame, kind: str, prefix: str) -> DataFrame:
    """Events of one type with prefixed columns."""
    ts = F.col("ts").cast("timestamp") if events.isStreaming else F.col("ts")
    return events.filter(F.col("event_type") == kind).select(
        "user_id",
        F.col("event_id").alias(f"{prefix}_id"),
        ts.alias(f"{prefix}_ts"),
        F.round(F.col("value") * 100).cast("long").alias(f"{prefix}_cents"),
    )


def side_sql(kind: str, prefix: str) -> str:
    return f"""(SELECT user_id, event_id AS {prefix}_id, ts AS {prefix}_ts,
  CAST(round(value * 100) AS BIGINT) AS {prefix}_cents FROM events WHERE event_type = '{kind}')"""


def _op(seq: str):
    return F.element_at(F.array(F.lit("insert"), F.lit("update"), F.lit("delete")), (F.pmod(seq, F.lit(3)) + 1).cast("int"))


def tagged_changes(events: DataFrame) -> DataFrame:
    """Facts (no op) and, every fifth event, a change of the name of a user."""
    change = F.col("event_id") % 5 == 0
    return events.select(
        "event_id",
        "user_id",
        F.when(change, F.col("event_type")).alias("name"),
        F.when(change, _op("event_id")).alias("op"),
    )


CHANGES = """(SELECT event_id, user_id, event_type AS name, CASE event_id % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update'
  ELSE 'delete' END AS op FROM events WHERE event_id % 5 = 0)"""


def ip_rules(t: Tables) -> DataFrame:
    start = F.col("n_nationkey").cast("long") * 1024
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        start.alias("start_num"), (start + 899).alias("end_num"), F.col("n_name").alias("province"), F.col("r_name").alias("city")
    )


IP_RULES = """(SELECT CAST(n_nationkey AS BIGINT) * 1024 AS start_num, CAST(n_nationkey AS BIGINT) * 1024 + 899 AS end_num,
  n_name AS province, r_name AS city FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def ip_lines(t: Tables) -> DataFrame:
    third, fourth = F.pmod(F.col("event_id") * 37, F.lit(100)), F.pmod("event_id", F.lit(256))
    return t.events.select("event_id", F.concat(F.lit("0.0."), third.cast("string"), F.lit("."), fourth.cast("string")).alias("ip"))


IP_LINES = """(SELECT event_id, concat('0.0.', (event_id * 37) % 100, '.', event_id % 256) AS ip,
  ((event_id * 37) % 100) * 256 + event_id % 256 AS num FROM events)"""


def lookup_names(t: Tables) -> DataFrame:
    """A dimension that lacks every fourth nation."""
    return t.nation.filter(F.col("n_nationkey") % 4 != 0).select("n_nationkey", F.col("n_name").alias("name"))
