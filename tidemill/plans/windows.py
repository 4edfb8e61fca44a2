"""Queries on time windows, sessions, count windows and late rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import late as l
from tidemill.operators import windows as w
from tidemill.plans import inputs as i
from tidemill.plans.registry import ORACLES, query
from tidemill.streaming.carried import stream_split_late
from tidemill.streaming.keyed import CountWindows, RunningSum, keyed_state
from tidemill.streaming.replay import BATCH_ROWS, replay
from tidemill.streaming.runner import Flush, run_append


def _sum():
    return {"total": F.sum("cnt")}


def _bucket(size: str, ts: str) -> str:
    return f"time_bucket(INTERVAL '{size}', {ts}, {i.EPOCH})"


def tumble_sql(source: str, ts: str, size: str, keys: str = "word, ", extra: str = "") -> str:
    return f"""SELECT {keys}{_bucket(size, ts)} AS win_start, {_bucket(size, ts)} + INTERVAL '{size}' AS win_end,
  sum(cnt)::BIGINT AS total{extra} FROM {source} GROUP BY ALL"""


def slide_sql(source: str, ts: str, size: str, slide: str, panes: int, keys: str = "word, ") -> str:
    return f"""SELECT {keys}win_start, win_start + INTERVAL '{size}' AS win_end, sum(cnt)::BIGINT AS total FROM (
  SELECT *, {_bucket(slide, ts)} - unnest(range({panes})) * INTERVAL '{slide}' AS win_start FROM {source}) GROUP BY ALL"""


def session_sql(source: str, ts: str, gap: str, keys: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}min({ts}) AS win_start, max({ts}) + INTERVAL '{gap}' AS win_end, sum(cnt)::BIGINT AS total FROM (
  SELECT *, sum(opens) OVER ({part} ORDER BY {ts}, seq ROWS UNBOUNDED PRECEDING) AS no FROM (
    SELECT *, CASE WHEN {ts} - lag({ts}) OVER ({part} ORDER BY {ts}, seq) <= INTERVAL '{gap}' THEN 0 ELSE 1 END AS opens
    FROM {source})) GROUP BY {lead}no"""


def _timed(t):
    return i.timed_pairs(t.events)


def _timed_stream(t):
    flush = Flush()
    stream = flush.attach(replay(t.events, "event_id"), "ts")
    return i.timed_pairs(stream).withWatermark("ts", "0 seconds"), flush


# --- event time -------------------------------------------------------------


@query("win_tumble", tumble_sql(i.TIMED, "ts", "1 hour"))
def win_tumble(spark, t):
    return w.tumbling(_timed(t), ["word"], "ts", "1 hour", _sum())


@query("win_tumble_stream", tumble_sql(i.TIMED, "ts", "1 hour"))
def win_tumble_stream(spark, t):
    stream, flush = _timed_stream(t)
    return run_append(w.tumbling(stream, ["word"], "ts", "1 hour", _sum()), "tumble", flush=flush)


@query("win_tumble_first", tumble_sql(i.TIMED, "ts", "1 hour", extra=", arg_min(ts, seq) AS first_ts"))
def win_tumble_first(spark, t):
    """With the time of the window's first row to arrive."""
    return w.tumbling(_timed(t), ["word"], "ts", "1 hour", {**_sum(), "first_ts": F.min_by("ts", "seq")})


@query("win_tumble_all", tumble_sql(i.TIMED, "ts", "1 hour", keys=""))
def win_tumble_all(spark, t):
    return w.tumbling(_timed(t), [], "ts", "1 hour", _sum())


@query("win_slide", slide_sql(i.TIMED, "ts", "2 hours", "30 minutes", 4))
def win_slide(spark, t):
    return w.sliding_from_panes(_timed(t), ["word"], "ts", "2 hours", "30 minutes", _sum())


@query("win_slide_stream", slide_sql(i.TIMED, "ts", "2 hours", "30 minutes", 4))
def win_slide_stream(spark, t):
    stream, flush = _timed_stream(t)
    return run_append(w.sliding(stream, ["word"], "ts", "2 hours", "30 minutes", _sum()), "slide", flush=flush)


@query("win_session", session_sql(i.TIMED, "ts", "2 hours", "user_id"))
def win_session(spark, t):
    return w.sessions(_timed(t), ["user_id"], "ts", 7200, _sum())


@query("win_session_stream", session_sql(i.TIMED, "ts", "2 hours", "user_id"))
def win_session_stream(spark, t):
    stream, flush = _timed_stream(t)
    out = w.streaming_sessions(stream, ["user_id"], "ts", "2 hours", _sum())
    return run_append(out, "session", flush=flush)


@query("win_reduce", f"""SELECT word, {_bucket('30 minutes', 'ts')} AS win_start,
  {_bucket('30 minutes', 'ts')} + INTERVAL '30 minutes' AS win_end, max(cnt) AS top FROM {i.TIMED} GROUP BY ALL""")
def win_reduce(spark, t):
    return w.tumbling(_timed(t), ["word"], "ts", "30 minutes", {"top": F.max("cnt")})


@query("win_top3", f"""SELECT word, cnt, seq, win_start, rank FROM (SELECT *, CAST(row_number() OVER (
    PARTITION BY word, win_start ORDER BY cnt DESC, seq) AS INTEGER) AS rank
  FROM (SELECT *, {_bucket('1 day', 'ts')} AS win_start FROM {i.TIMED})) WHERE rank <= 3""")
def win_top3(spark, t):
    out = w.top_rows(_timed(t), ["word"], "ts", "1 day", "cnt", "seq", 3)
    return out.select("word", "cnt", "seq", "win_start", "rank")


@query("win_history_sum", f"""SELECT word, win_start, win_end, win_sum, (sum(win_sum) OVER (PARTITION BY word
  ORDER BY win_start ROWS UNBOUNDED PRECEDING))::BIGINT AS history_sum FROM (SELECT word, {_bucket('1 hour', 'ts')} AS win_start,
  {_bucket('1 hour', 'ts')} + INTERVAL '1 hour' AS win_end, sum(cnt)::BIGINT AS win_sum FROM {i.TIMED} GROUP BY ALL)""")
def win_history_sum(spark, t):
    return w.history_sums(_timed(t), ["word"], "ts", "1 hour", F.sum("cnt"))


@query("win_history_sum_stream", ORACLES["win_history_sum"])
def win_history_sum_stream(spark, t):
    """Window sums that feed a keyed history state, two stateful steps of one stream."""
    stream, flush = _timed_stream(t)
    sums = w.tumbling(stream, ["word"], "ts", "1 hour", {"win_sum": F.sum("cnt")})
    numbered = sums.withColumn("at", F.unix_seconds(F.col("win_start").cast("timestamp")))
    out = keyed_state(
        numbered, ["word"], "at", ["win_start", "win_end", "win_sum"], RunningSum("win_sum", "history_sum"), "history_sum bigint"
    )
    return run_append(out.drop("at"), "history", flush=flush)


@query("win_accumulate", f"""SELECT word, {_bucket('6 hours', 'ts')} AS win_start,
  {_bucket('6 hours', 'ts')} + INTERVAL '6 hours' AS win_end, count(*) AS n, sum(cnt)::DOUBLE / count(*)::DOUBLE AS mean
  FROM {i.TIMED} GROUP BY ALL""")
def win_accumulate(spark, t):
    """A mean as an accumulator of count and sum."""
    mean = w.Accumulator(
        {"s": F.sum("cnt"), "n": F.count(F.lit(1))},
        lambda p: {"n": p["n"], "mean": p["s"].cast("double") / p["n"].cast("double")},
    )
    return w.accumulate(_timed(t), ["word"], "ts", "6 hours", mean)


@query("win_accumulate_stream", f"""SELECT word, win_start, win_end, n, s::DOUBLE / n::DOUBLE AS mean, (sum(s) OVER (
  PARTITION BY word ORDER BY win_start ROWS UNBOUNDED PRECEDING))::BIGINT AS history FROM (
  SELECT word, {_bucket('6 hours', 'ts')} AS win_start, {_bucket('6 hours', 'ts')} + INTERVAL '6 hours' AS win_end,
  count(*) AS n, sum(cnt)::BIGINT AS s FROM {i.TIMED} GROUP BY ALL)""")
def win_accumulate_stream(spark, t):
    """An accumulator's parts by window, then a keyed history of one of them, in one stream."""
    stream, flush = _timed_stream(t)
    parts = w.tumbling(stream, ["word"], "ts", "6 hours", {"s": F.sum("cnt"), "n": F.count(F.lit(1))})
    numbered = parts.withColumn("at", F.unix_seconds(F.col("win_start").cast("timestamp")))
    out = keyed_state(numbered, ["word"], "at", ["win_start", "win_end", "n", "s"], RunningSum("s", "history"), "history bigint")
    mean = (F.col("s").cast("double") / F.col("n").cast("double")).alias("mean")
    return run_append(out.select("word", "win_start", "win_end", "n", mean, "history"), "accumulate", flush=flush)


@query("sql_tumble", f"""SELECT user_id, {_bucket('10 hours', 'ts')} AS win_start,
  {_bucket('10 hours', 'ts')} + INTERVAL '10 hours' AS win_end,
  sum(CAST(round(value * 100) AS BIGINT)) / 100.0::DOUBLE AS total_money FROM events GROUP BY ALL""")
def sql_tumble(spark, t):
    t.events.createOrReplaceTempView("tm_orders")
    return spark.sql("""SELECT user_id, window.start AS win_start, window.end AS win_end,
        sum(CAST(round(value * 100) AS BIGINT)) / 100.0D AS total_money
        FROM tm_orders GROUP BY window(ts, '10 hours'), user_id""")


@query("sql_hop", f"""SELECT user_id, win_start, win_start + INTERVAL '10 hours' AS win_end,
  sum(CAST(round(value * 100) AS BIGINT)) / 100.0::DOUBLE AS total_money FROM (SELECT *,
  {_bucket('2 hours', 'ts')} - unnest(range(5)) * INTERVAL '2 hours' AS win_start FROM events) GROUP BY ALL""")
def sql_hop(spark, t):
    """Hopping window in SQL: size first, then slide."""
    t.events.createOrReplaceTempView("tm_orders")
    return spark.sql("""SELECT user_id, window.start AS win_start, window.end AS win_end,
        sum(CAST(round(value * 100) AS BIGINT)) / 100.0D AS total_money
        FROM tm_orders GROUP BY window(ts, '10 hours', '2 hours'), user_id""")


# --- processing time, over a recorded arrival -----------------------------------


@query("win_pt_tumble", tumble_sql(i.ARRIVALS, "arrival", "1 hour"))
def win_pt_tumble(spark, t):
    return w.tumbling(i.arrivals(t), ["word"], "arrival", "1 hour", _sum())


@query("win_pt_tumble_all", tumble_sql(i.ARRIVALS, "arrival", "1 hour", keys=""))
def win_pt_tumble_all(spark, t):
    return w.tumbling(i.arrivals(t), [], "arrival", "1 hour", _sum())


@query("win_pt_slide", slide_sql(i.ARRIVALS, "arrival", "1 hour", "30 minutes", 2))
def win_pt_slide(spark, t):
    return w.sliding_from_panes(i.arrivals(t), ["word"], "arrival", "1 hour", "30 minutes", _sum())


@query("win_pt_slide_all", slide_sql(i.ARRIVALS, "arrival", "1 hour", "30 minutes", 2, keys=""))
def win_pt_slide_all(spark, t):
    return w.sliding_from_panes(i.arrivals(t), [], "arrival", "1 hour", "30 minutes", _sum())


@query("win_pt_session", session_sql(i.ARRIVALS, "arrival", "15 minutes", "word"))
def win_pt_session(spark, t):
    return w.sessions(i.arrivals(t), ["word"], "arrival", 900, _sum())


@query("win_pt_session_all", session_sql(i.ARRIVALS, "arrival", "5 minutes", ""))
def win_pt_session_all(spark, t):
    return w.sessions(i.arrivals(t), [], "arrival", 300, _sum())


# --- count windows ----------------------------------------------------------------


@query("win_count", f"""SELECT word, win_no, sum(cnt)::BIGINT AS total FROM (SELECT *, (row_number() OVER (
  PARTITION BY word ORDER BY seq) - 1) // 5 AS win_no FROM {i.PAIRS}) GROUP BY word, win_no HAVING count(*) = 5""")
def win_count(spark, t):
    return w.count_windows(i.pairs(t), ["word"], "seq", 5, _sum(), t.event_width)


@query("win_count_all", f"""SELECT win_no, sum(cnt)::BIGINT AS total FROM (SELECT *, (row_number() OVER (
  ORDER BY seq) - 1) // 5 AS win_no FROM {i.PAIRS}) GROUP BY win_no HAVING count(*) = 5""")
def win_count_all(spark, t):
    return w.count_windows(i.pairs(t), [], "seq", 5, _sum(), t.event_width)


def _count_stream(t, keys, name):
    rows = i._pairs(replay(t.events, "event_id", most_rows=BATCH_ROWS))
    out = keyed_state(rows, keys, "seq", ["cnt"], CountWindows("cnt", 5), "win_no bigint, total bigint", keep=lambda c: False)
    return run_append(out, name)


@query("win_count_stream", ORACLES["win_count"])
def win_count_stream(spark, t):
    """Count windows that fire and purge in state; a rest that never fills is never sent."""
    return _count_stream(t, ["word"], "win_count")


@query("win_count_all_stream", ORACLES["win_count_all"])
def win_count_all_stream(spark, t):
    """The same over all rows; packed rows, not rows, meet in one task."""
    return _count_stream(t, [], "win_count_all")


# --- late rows ----------------------------------------------------------------------

HOUR_SUM = f"""SELECT event_type, {_bucket('1 hour', 'et')} AS win_start, {_bucket('1 hour', 'et')} + INTERVAL '1 hour' AS win_end,
  sum(cnt)::BIGINT AS total FROM {i.LATE} WHERE NOT is_late GROUP BY ALL"""


@query("late_side_output", f"SELECT event_id, event_type, cnt, et FROM {i.LATE} WHERE is_late")
def late_side_output(spark, t):
    return l.split_late(i.late_events(t.events), "et", "event_id", 3600, width=t.event_width)[1]


@query("late_on_time_sum", HOUR_SUM)
def late_on_time_sum(spark, t):
    on_time, _ = l.split_late(i.late_events(t.events), "et", "event_id", 3600, width=t.event_width)
    return w.tumbling(on_time, ["event_type"], "et", "1 hour", _sum())


@query("late_dropped", f"""SELECT event_type, count(*) FILTER (is_late) AS n_late, count(*) FILTER (NOT is_late) AS n_kept
  FROM {i.LATE} GROUP BY event_type""")
def late_dropped(spark, t):
    """How many rows a window drops as late, and keeps."""
    marked = l.mark_late(i.late_events(t.events), "et", "event_id", 3600, width=t.event_width)
    return marked.groupBy("event_type").agg(
        F.count_if("is_late").alias("n_late"), F.count_if(~F.col("is_late")).alias("n_kept")
    )


@query("late_side_output_stream", f"SELECT event_id, event_type, cnt, et, is_late FROM {i.LATE}")
def late_side_output_stream(spark, t):
    """Late marks of a stream; the largest event time is carried between micro-batches."""
    return stream_split_late(i.late_events(replay(t.events, "event_id")), "et", "event_id", 3600)
