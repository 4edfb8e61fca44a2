"""Queries on joins and dimensions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemill.functions.udfs import ip_locate, register_functions
from tidemill.operators import joins as j
from tidemill.operators.cogroup import PairByRank, co_group_apply
from tidemill.operators.enrich import enrich
from tidemill.plans import inputs as i
from tidemill.plans.registry import query
from tidemill.session import run_dir
from tidemill.sources.jdbc import RefreshingDimension
from tidemill.sources.tables import SCHEMAS
from tidemill.streaming.keyed import LatestValue, keyed_state
from tidemill.streaming.joins import stream_interval_join, stream_windowed_join
from tidemill.streaming.replay import replay
from tidemill.streaming.runner import Flush, ddl_of, read_batches, run_append, run_batches

CLICKS, BUYS = i.side_sql("click", "click"), i.side_sql("purchase", "buy")


def _day(ts: str) -> str:
    return f"time_bucket(INTERVAL '1 day', {ts}, {i.EPOCH})"


def _sides(t):
    return i.side(t.events, "click", "click"), i.side(t.events, "purchase", "buy")


def _window_sql(kind: str) -> str:
    return f"""SELECT c.user_id, {_day('click_ts')} AS win_start, click_id, click_cents, buy_id, buy_cents FROM {CLICKS} c
  {kind} JOIN {BUYS} b ON c.user_id = b.user_id AND {_day('click_ts')} = {_day('buy_ts')}"""


PAIR = ["user_id", "win_start", "click_id", "click_cents", "buy_id", "buy_cents"]


@query("join_window_inner", _window_sql("INNER"))
def join_window_inner(spark, t):
    return j.windowed_join(*_sides(t), ["user_id"], "click_ts", "buy_ts", "1 day").select(*PAIR)


@query("join_window_left", _window_sql("LEFT"))
def join_window_left(spark, t):
    return j.windowed_join(*_sides(t), ["user_id"], "click_ts", "buy_ts", "1 day", "left").select(*PAIR)


@query("join_window_inner_stream", _window_sql("INNER"))
def join_window_inner_stream(spark, t):
    clicks, buys = _sides_of_stream(t)
    out = stream_windowed_join(clicks, buys, ["user_id"], "click_ts", "buy_ts", "1 day", "click_id")
    return run_append(out.select(*PAIR), "join_inner")


@query("join_window_left_stream", _window_sql("LEFT"))
def join_window_left_stream(spark, t):
    """Unmatched rows come out once the watermark has passed their window."""
    clicks, buys, flush = _flushed(t)
    out = stream_windowed_join(clicks, buys, ["user_id"], "click_ts", "buy_ts", "1 day", "click_id", "left")
    return run_append(out.select(*PAIR), "join_left", flush=flush)


def _flushed(t):
    clicks, buys = _sides_of_stream(t)
    # The two flush rows have different users, so they never meet.
    flush = Flush()
    return flush.attach(clicks, "click_ts", user_id=-1), flush.attach(buys, "buy_ts", user_id=-2), flush


def _sides_of_stream(t):
    events = replay(t.events, "event_id")
    return i.side(events, "click", "click"), i.side(events, "purchase", "buy")


@query("join_category_amount", f"""SELECT user_id, win_start, buy_cents, sum(click_cents)::BIGINT AS amount, count(*) AS n_pairs
  FROM ({_window_sql('INNER')}) GROUP BY ALL""")
def join_category_amount(spark, t):
    """Amounts per key, window and name of the right side, without building the pairs."""
    return j.joined_amounts(
        *_sides(t), ["user_id"], "click_ts", "buy_ts", "1 day", F.sum("click_cents"), ["buy_cents"]
    )


@query("co_group", f"""SELECT coalesce(c.user_id, b.user_id) AS user_id, coalesce(c.day, b.day) AS day, n_clicks, click_cents,
  n_buys, top_buy FROM (SELECT user_id, {_day('click_ts')} AS day, count(*) AS n_clicks, sum(click_cents)::BIGINT AS click_cents
  FROM {CLICKS} GROUP BY ALL) c FULL JOIN (SELECT user_id, {_day('buy_ts')} AS day, count(*) AS n_buys, max(buy_cents) AS top_buy
  FROM {BUYS} GROUP BY ALL) b ON c.user_id = b.user_id AND c.day = b.day""")
def co_group(spark, t):
    """Clicks and purchases of a user and day side by side."""
    clicks, buys = _sides(t)

    def day(ts):
        return F.window(ts, "1 day").getField("start").cast("timestamp_ntz")

    return j.co_group(
        clicks.withColumn("day", day("click_ts")),
        buys.withColumn("day", day("buy_ts")),
        ["user_id", "day"],
        {"n_clicks": F.count(F.lit(1)), "click_cents": F.sum("click_cents")},
        {"n_buys": F.count(F.lit(1)), "top_buy": F.max("buy_cents")},
    )


@query("co_group_rank", f"""SELECT user_id, day, pair, click_id, buy_id, (sum(coalesce(click_cents, 0) - coalesce(buy_cents, 0)) OVER (
  PARTITION BY user_id, day ORDER BY pair ROWS UNBOUNDED PRECEDING))::BIGINT AS balance FROM (
  SELECT coalesce(c.user_id, b.user_id) AS user_id, coalesce(c.day, b.day) AS day, coalesce(c.n, b.n) AS pair,
    click_id, buy_id, click_cents, buy_cents
  FROM (SELECT *, {_day('click_ts')} AS day, row_number() OVER (PARTITION BY user_id, {_day('click_ts')} ORDER BY click_id) AS n FROM {CLICKS}) c
  FULL JOIN (SELECT *, {_day('buy_ts')} AS day, row_number() OVER (PARTITION BY user_id, {_day('buy_ts')} ORDER BY buy_id) AS n FROM {BUYS}) b
  ON c.user_id = b.user_id AND c.day = b.day AND c.n = b.n)""")
def co_group_rank(spark, t):
    """Clicks and purchases of a user and day paired in their order, with the balance after each pair."""
    clicks, buys = _sides(t)
    day = lambda ts: F.window(ts, "1 day").getField("start").cast("timestamp_ntz")
    return co_group_apply(
        clicks.withColumn("day", day("click_ts")).drop("click_ts"),
        buys.withColumn("day", day("buy_ts")).drop("buy_ts"),
        ["user_id", "day"],
        "click_id",
        "buy_id",
        lambda: PairByRank("click_id", "buy_id", "click_cents", "buy_cents"),
        "pair bigint, click_id bigint, buy_id bigint, balance bigint",
        t.event_width,
    )


INTERVAL = f"""SELECT c.user_id, click_id, buy_id FROM {CLICKS} c JOIN {BUYS} b ON c.user_id = b.user_id
  AND buy_ts > click_ts - INTERVAL '1 hour' AND buy_ts <= click_ts + INTERVAL '1 hour'"""


@query("join_interval", INTERVAL)
def join_interval(spark, t):
    out = j.interval_join(*_sides(t), ["user_id"], "click_ts", "buy_ts", 3600, 3600)
    return out.select("user_id", "click_id", "buy_id")


@query("join_interval_stream", INTERVAL)
def join_interval_stream(spark, t):
    out = stream_interval_join(
        *_sides_of_stream(t), ["user_id"], "click_ts", "buy_ts", "1 hour", "1 hour", "click_id"
    )
    return run_append(out.select("user_id", "click_id", "buy_id"), "join_interval")


IP = f"""SELECT event_id, ip, province FROM {i.IP_LINES} l
  LEFT JOIN {i.IP_RULES} r ON l.num BETWEEN r.start_num AND r.end_num"""


@query("join_ip_range", IP.replace("ip, province", "ip, province, city"))
def join_ip_range(spark, t):
    return j.ip_lookup(i.ip_lines(t), "ip", i.ip_rules(t), ["province", "city"], shift=10)


@query("sql_ip_location", IP)
def sql_ip_location(spark, t):
    """The lookup in SQL with a native function; rules are listed by address block."""
    register_functions(spark)
    i.ip_lines(t).createOrReplaceTempView("tm_ips")
    i.ip_rules(t).createOrReplaceTempView("tm_rules")
    return spark.sql("""SELECT event_id, ip, province
        FROM (SELECT *, ip_number(ip) AS num FROM tm_ips) l
        LEFT JOIN (SELECT *, explode(sequence(shiftright(start_num, 10), shiftright(end_num, 10))) AS block FROM tm_rules) r
        ON shiftright(l.num, 10) = r.block AND l.num BETWEEN r.start_num AND r.end_num""")


@query("udf_ip_location", IP)
def udf_ip_location(spark, t):
    """The lookup by its short name."""
    return ip_locate(i.ip_lines(t), "ip", i.ip_rules(t), "province")


LOOKUP = """SELECT c_custkey, c_nationkey, n_name AS name FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 4 <> 0"""


@query("join_lookup", LOOKUP)
def join_lookup(spark, t):
    facts = t.customer.select("c_custkey", "c_nationkey")
    return j.lookup(facts, i.lookup_names(t), "c_nationkey", "n_nationkey")


@query("join_lookup_stream", LOOKUP)
def join_lookup_stream(spark, t):
    """A stream joined to a dimension that is read again when it is older than ten minutes."""
    folder = run_dir(spark, "lookup")
    dimension = RefreshingDimension(lambda: i.lookup_names(t), ttl_seconds=600)
    facts = replay(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")

    def write(batch, batch_id):
        out = j.lookup(batch, dimension.current(), "c_nationkey", "n_nationkey")
        out.write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")

    run_batches(facts, write, folder)
    return read_batches(spark, f"{folder}/out", f"{ddl_of(facts)}, name string")


@query("sql_insert_lookup", LOOKUP)
def sql_insert_lookup(spark, t):
    """Tables declared, joined in a view and written into a sink table by SQL text alone."""
    tag = uuid.uuid4().hex
    names = {n: f"tm_{n}_{tag}" for n in ("facts", "dim", "joined", "sink")}
    statements = [
        f"CREATE TABLE {names['facts']} ({SCHEMAS['customer']}) USING parquet LOCATION '{t.path('customer')}'",
        f"CREATE TABLE {names['dim']} ({SCHEMAS['nation']}) USING parquet LOCATION '{t.path('nation')}'",
        f"""CREATE TEMPORARY VIEW {names['joined']} AS SELECT f.c_custkey, f.c_nationkey, d.n_name AS name
            FROM {names['facts']} f LEFT JOIN {names['dim']} d ON f.c_nationkey = d.n_nationkey AND d.n_nationkey % 4 <> 0""",
        f"""CREATE TABLE {names['sink']} (c_custkey BIGINT, c_nationkey INT, name STRING) USING parquet
            LOCATION '{run_dir(spark, 'sql_sink')}'""",
        f"INSERT INTO {names['sink']} SELECT c_custkey, c_nationkey, name FROM {names['joined']}",
    ]
    for statement in statements:
        spark.sql(statement)
    return spark.sql(f"SELECT * FROM {names['sink']}")


@query("enrich_ordered", """SELECT o_orderkey, o_custkey, c_name AS name FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 4 <> 0""")
def enrich_ordered(spark, t):
    """Names by key from a service, twenty calls in flight of three seconds at most; rows keep their order in a partition."""
    rows = t.orders.select("o_orderkey", "o_custkey")
    return enrich(rows, ["o_custkey"], name_of, "name string", in_flight=20, timeout_seconds=3.0)


def name_of(number: int) -> tuple | None:
    """Stands for the outside service, which lacks every fourth customer."""
    return (f"Customer#{number:09d}",) if number % 4 else None


CDC = f"""SELECT f.event_id, f.user_id, CASE WHEN c.op <> 'delete' THEN c.name END AS name
  FROM (SELECT event_id, user_id FROM events WHERE event_id % 5 <> 0) f
  ASOF LEFT JOIN {i.CHANGES} c ON f.user_id = c.user_id AND f.event_id >= c.event_id"""


@query("join_broadcast_cdc", CDC)
def join_broadcast_cdc(spark, t):
    """Facts with the name their user had at that moment, from a log of changes."""
    tagged = i.tagged_changes(t.events)
    facts = tagged.filter(F.col("op").isNull()).drop("name", "op")
    changes = tagged.filter(F.col("op").isNotNull())
    return j.changing_dimension(facts, changes, "user_id", "event_id", "name", "op", t.event_width)


@query("join_broadcast_cdc_stream", CDC)
def join_broadcast_cdc_stream(spark, t):
    """Changes and facts in one stream: a user's state holds the name that facts get until it changes."""
    tagged = i.tagged_changes(replay(t.events, "event_id")).select(
        "event_id",
        "user_id",
        F.col("op").isNotNull().alias("change"),
        F.when(F.col("op") != "delete", F.col("name")).alias("name_now"),
    )
    step = LatestValue("change", "name_now", "name")
    keep = lambda c: c == "event_id"
    out = keyed_state(tagged, ["user_id"], "event_id", ["change", "name_now"], step, "name string", keep, many_keys=True)
    return run_append(out, "dimension")
