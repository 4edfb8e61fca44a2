"""Queries on keyed state and timers, run as streams of several micro-batches with one state entry a key."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemill.functions.text import cents, from_cents
from tidemill.operators.running import net_changes
from tidemill.plans import inputs as i
from tidemill.plans.registry import query
from tidemill.streaming import keyed as k
from tidemill.streaming.replay import BATCH_ROWS, replay, slice_sql
from tidemill.streaming.runner import Flush, run_append, run_until_timers, without_flush

SO_FAR = "OVER (PARTITION BY word ORDER BY seq ROWS UNBOUNDED PRECEDING)"
RUNNING = f"SELECT word, seq, cnt, (sum(cnt) {SO_FAR})::BIGINT AS running FROM {i.PAIRS}"


def _events(t):
    return replay(t.events, "event_id", most_rows=BATCH_ROWS)


def _pairs(t):
    return i._pairs(_events(t))


# --- value, map and list state --------------------------------------------------


@query("stateful_sum", RUNNING)
def stateful_sum(spark, t):
    """A value state per word; the running value is in the stream's own output."""
    return run_append(k.keyed_state(_pairs(t), ["word"], "seq", ["cnt"], k.RunningSum("cnt"), "running bigint"), "state_sum")


@query("running_sum_stream", RUNNING)
def running_sum_stream(spark, t):
    """The sum after every row of a stream."""
    out = k.keyed_state(_pairs(t), ["word"], "seq", ["cnt"], k.RunningSum("cnt"), "running bigint")
    return run_append(out, "running_sum")


@query("state_map_income", """SELECT event_type AS province, CAST(user_id AS VARCHAR) AS city, event_id AS seq,
  sum(cents) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) / 100.0::DOUBLE AS total_income,
  sum(cents) OVER (PARTITION BY event_type, user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) / 100.0::DOUBLE AS city_income
  FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)""")
def state_map_income(spark, t):
    """A map state of one sum per sub-key, and their total."""
    rows = _events(t).select(
        F.col("event_type").alias("province"),
        F.col("user_id").cast("string").alias("city"),
        F.col("event_id").alias("seq"),
        cents("value").alias("cents"),
    )
    step = k.MapSums("city", "cents", "c", "p")
    out = run_append(k.keyed_state(rows, ["province"], "seq", ["city", "cents"], step, "c bigint, p bigint"), "state_map")
    return out.select(
        "province", "city", "seq", from_cents("p").alias("total_income"), from_cents("c").alias("city_income")
    )


LISTS = """SELECT user_id, event_id, {n}string_agg(event_type, ',') OVER (
  PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS items FROM events"""


def _lists(t, name: str):
    step = k.GrowingList("event_type")
    out = k.keyed_state(_events(t), ["user_id"], "event_id", ["event_type"], step, "items array<string>", many_keys=True)
    return run_append(out, name)


@query("state_list_history", LISTS.format(n="count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS n_items, "))
def state_list_history(spark, t):
    """A list state per user: the list and its length after every event."""
    out = _lists(t, "state_list")
    return out.select("user_id", "event_id", F.size("items").cast("long").alias("n_items"), F.concat_ws(",", "items").alias("items"))


@query("state_list_full", LISTS.format(n=""))
def state_list_full(spark, t):
    """The whole list of a user after every event."""
    return _lists(t, "state_list_full").select("user_id", "event_id", F.concat_ws(",", "items").alias("items"))


# --- change log -------------------------------------------------------------------


def _changes(t, name: str):
    out = k.keyed_state(_pairs(t), ["word"], "seq", ["cnt"], k.ChangeLog("cnt", "total"), "total bigint, added boolean")
    return run_append(out, name)


@query("changelog_sum_stream", f"""WITH s AS (SELECT word, seq, cnt, (sum(cnt) {SO_FAR})::BIGINT AS new,
  row_number() OVER (PARTITION BY word ORDER BY seq) AS pos FROM {i.PAIRS})
  SELECT word, seq, true AS added, new AS total FROM s
  UNION ALL SELECT word, seq, false, new - cnt FROM s WHERE pos > 1""")
def changelog_sum_stream(spark, t):
    """The running sum as a stream of changes: the image before is taken back, the one after is added."""
    return _changes(t, "changelog").select("word", "seq", "added", "total")


@query("changelog_net_stream", f"SELECT word, sum(cnt)::BIGINT AS total FROM {i.PAIRS} GROUP BY word")
def changelog_net_stream(spark, t):
    """A consumer of the change log that nets what was added against what was taken back."""
    return net_changes(_changes(t, "changelog_net"), ["word"], "total")


# --- state shared by two streams ------------------------------------------------------

RULES = f"""(SELECT event_type AS word, event_id AS seq, CAST(floor(value) AS BIGINT) AS least FROM events
  WHERE event_id % 5 = 0)"""


@query("shared_state_rules", f"""SELECT p.word, p.seq, p.cnt, r.least, r.least IS NULL OR p.cnt >= r.least AS passes
  FROM (SELECT * FROM {i.PAIRS} WHERE seq % 5 <> 0) p ASOF LEFT JOIN {RULES} r ON p.word = r.word AND p.seq >= r.seq""")
def shared_state_rules(spark, t):
    """A stream of rules sets the least count of a word; a stream of counts is judged by the rule that holds then."""
    rule = F.pmod("event_id", F.lit(5)) == 0
    counts = i._pairs(_events(t).filter(~rule)).withColumns({"least": F.lit(None).cast("long"), "is_rule": F.lit(False)})
    rules = i._pairs(_events(t).filter(rule)).select(
        "word", F.lit(None).cast("long").alias("cnt"), "seq", F.col("cnt").alias("least"), F.lit(True).alias("is_rule")
    )
    both = counts.unionByName(rules)
    step = k.LatestValue("is_rule", "least", "held", LongType())
    out = k.keyed_state(both, ["word"], "seq", ["cnt", "least", "is_rule"], step, "held bigint", keep=lambda c: c in ("seq", "cnt"))
    judged = run_append(out, "rules").withColumnRenamed("held", "least")
    return judged.withColumn("passes", F.col("least").isNull() | (F.col("cnt") >= F.col("least")))


# --- timers -----------------------------------------------------------------------

MINUTE = 60_000
#: The watermark before a slice is the latest event time of the slices before it, in milliseconds; at first it is zero.
BEFORE = f"""SELECT word, cnt, seq, mark - mark % {MINUTE} + {MINUTE} AS flushed_at FROM (
  SELECT p.*, coalesce((SELECT max(epoch_us(q.ts) // 1000) FROM {slice_sql(i.TIMED, 'seq')} q WHERE q.slice < p.slice), 0) AS mark
  FROM {slice_sql(i.TIMED, 'seq')} p)"""


@query("timer_et_flush", BEFORE)
def timer_et_flush(spark, t):
    """Rows held until an event-time timer at the next minute of the watermark, with the time at which it stood."""
    flush, slices = Flush(), replay(t.events, "event_id")  # the results tell the slices, so their number is fixed
    timed = flush.attach(slices.withColumn("ts", F.col("ts").cast("timestamp")), "ts").withWatermark("ts", "0 seconds")
    rows = i._pairs(without_flush(timed))
    out = k.keyed_state(rows, ["word"], "seq", ["cnt"], k.HeldRowsByWatermark(MINUTE), "flushed_at bigint")
    return run_append(out, "timer_et", flush=flush)


@query("timer_pt_flush", f"SELECT word, cnt, seq, true AS on_time FROM {i.PAIRS}")
def timer_pt_flush(spark, t):
    """Rows held until a processing-time timer at the next full second after they came; tells whether it was that one."""
    step = k.HeldRowsByClock(1000, arrived="arrived")
    out = k.keyed_state(_pairs(t), ["word"], "seq", ["cnt"], step, "flushed_at bigint, arrived bigint")
    done = run_until_timers(out, "timer_pt", every_ms=1000)
    next_second = F.col("arrived") - F.pmod("arrived", F.lit(1000)) + 1000
    return done.select("word", "cnt", "seq", (F.col("flushed_at") == next_second).alias("on_time"))


# --- expiry in recorded time ------------------------------------------------------------

SIX_HOURS = 6 * 3600 * 1000
CLOCK = """(SELECT user_id, event_type, event_id AS seq, epoch_us(ts) // 1000 AS at_ms, CAST(floor(value) AS BIGINT) AS cnt
  FROM events)"""


def _live_sums(keys: str, columns: str) -> str:
    return f"""SELECT {columns}, (sum(cnt) OVER (PARTITION BY {keys}, part ORDER BY seq
    ROWS UNBOUNDED PRECEDING))::BIGINT AS live_sum FROM (
  SELECT *, sum(restart) OVER (PARTITION BY {keys} ORDER BY seq ROWS UNBOUNDED PRECEDING) AS part FROM (
    SELECT *, CASE WHEN at_ms - lag(at_ms) OVER (PARTITION BY {keys} ORDER BY seq) >= {SIX_HOURS} THEN 1 ELSE 0 END AS restart
    FROM {CLOCK}))"""


def _timed(t, flush: Flush):
    stream = flush.attach(_events(t).withColumn("ts", F.col("ts").cast("timestamp")), "ts").withWatermark("ts", "0 seconds")
    return without_flush(stream).select(
        "user_id", "event_type", F.col("event_id").alias("seq"), F.unix_millis("ts").alias("at_ms"), F.floor("value").cast("long").alias("cnt")
    )


@query("state_ttl_value_stream", _live_sums("user_id", "user_id, seq, at_ms, cnt"))
def state_ttl_value_stream(spark, t):
    """A value state per user that timers forget six hours after its last write."""
    flush = Flush()
    step = k.ExpiringSums(None, "cnt", "at_ms", SIX_HOURS)
    out = k.keyed_state(_timed(t, flush), ["user_id"], "seq", ["at_ms", "cnt"], step, "live_sum bigint", many_keys=True)
    return run_append(out, "ttl_value", flush=flush)


@query("state_ttl_map_stream", _live_sums("event_type, user_id", "event_type, user_id, seq, at_ms, cnt"))
def state_ttl_map_stream(spark, t):
    """A map state per type, whose entries of one user are forgotten six hours after their own last write."""
    flush = Flush()
    rows = _timed(t, flush).withColumn("member", F.col("user_id").cast("string"))
    step = k.ExpiringSums("member", "cnt", "at_ms", SIX_HOURS)
    keep = lambda c: c != "member"
    out = k.keyed_state(rows, ["event_type"], "seq", ["user_id", "member", "at_ms", "cnt"], step, "live_sum bigint", keep)
    return run_append(out, "ttl_map", flush=flush)


@query("state_ttl_list_stream", f"""SELECT a.user_id, a.seq, string_agg(b.event_type, ',' ORDER BY b.seq) AS items
  FROM {CLOCK} a JOIN {CLOCK} b ON a.user_id = b.user_id AND b.seq <= a.seq AND b.at_ms + {SIX_HOURS} > a.at_ms
  GROUP BY a.user_id, a.seq""")
def state_ttl_list_stream(spark, t):
    """A list state per user whose items live six hours each: what is alive after every event."""
    flush = Flush()
    step = k.ExpiringList("event_type", "at_ms", SIX_HOURS)
    keep = lambda c: c == "seq"
    out = k.keyed_state(_timed(t, flush), ["user_id"], "seq", ["event_type", "at_ms"], step, "items array<string>", keep, many_keys=True)
    return run_append(out, "ttl_list", flush=flush).select("user_id", "seq", F.concat_ws(",", "items").alias("items"))
