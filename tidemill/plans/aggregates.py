"""Queries on keyed aggregations: final, per row and as change log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.text import from_cents, words
from tidemill.functions.udfs import register_functions
from tidemill.operators import running as r
from tidemill.operators.scans import block_start, running, running_levels, scan_sum
from tidemill.plans import inputs as i
from tidemill.plans.registry import query
from tidemill.session import run_dir
from tidemill.sources.lines import read_lines
from tidemill.streaming.replay import replay
from tidemill.streaming.runner import run_batches, run_upsert
from tidemill.sinks.files import write_text
from tidemill.sinks.upsert import UpsertTable

WORD_COUNT = f"SELECT word, count(*) AS n FROM {i.WORDS} GROUP BY word"
SO_FAR = "OVER (PARTITION BY word ORDER BY seq ROWS UNBOUNDED PRECEDING)"


def count_words(words_df):
    return words_df.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("word_count", WORD_COUNT)
def word_count(spark, t):
    return count_words(i.word_rows(t))


def _word_stream(t):
    docs = replay(t.documents.select("doc_id", "text"), "doc_id").select(F.explode(F.split("text", "\n")).alias("line"))
    return words(docs, "line")


@query("word_count_stream", WORD_COUNT)
def word_count_stream(spark, t):
    """The same as a stream in update mode into a keyed store."""
    return run_upsert(count_words(_word_stream(t)), "word_count", ["word"])


@query("snk_upsert", WORD_COUNT)
def snk_upsert(spark, t):
    """Word counts of a folder read a third of its files at a time; every batch overwrites the words it touched.

    The folder has at least as many files as tasks read the documents, so that no file grows with the table.
    """
    source = run_dir(spark, "upsert_source")
    files = -(-t.documents.rdd.getNumPartitions() // 3)
    write_text(i.lines(t).repartition(3 * files), source)
    stream = words(read_lines(spark, "text_stream", path=source, files_per_batch=files), "line")
    return run_upsert(count_words(stream), "upsert", ["word"])


@query("resume_word_count", WORD_COUNT)
def resume_word_count(spark, t):
    """A word count that stops after half of its input and goes on from its checkpoint when the rest is there."""
    source, folder = run_dir(spark, "resume_source"), run_dir(spark, "resume")
    counts = count_words(words(read_lines(spark, "text_stream", path=f"{source}/*", files_per_batch=64), "line"))
    table = UpsertTable(spark, f"{folder}/out", "word string, n bigint", ["word"])
    even = F.pmod("doc_id", F.lit(2)) == 0
    for name, half in (("first", even), ("second", ~even)):
        write_text(i.lines(t).filter(half), f"{source}/{name}")
        run_batches(counts, lambda batch, batch_id: table.merge(batch, batch_id), folder, "update")
    return table.read()


# --- per key ------------------------------------------------------------------


@query("keyed_sum", f"SELECT word, sum(cnt)::BIGINT AS cnt FROM {i.PAIRS} GROUP BY word")
def keyed_sum(spark, t):
    return r.keyed_reduce(i.pairs(t), ["word"], "cnt")


@query("running_sum", f"SELECT word, seq, cnt, (sum(cnt) {SO_FAR})::BIGINT AS running FROM {i.PAIRS}")
def running_sum(spark, t):
    return r.running_reduce(i.pairs(t), ["word"], "seq", "cnt", width=t.event_width)


@query("running_reduce", f"SELECT word, seq, cnt, min(cnt) {SO_FAR} AS running FROM {i.PAIRS}")
def running_reduce(spark, t):
    return r.running_reduce(i.pairs(t), ["word"], "seq", "cnt", "min", width=t.event_width)


@query("running_max", f"""SELECT word, seq, cnt, max(cnt) {SO_FAR} AS max_cnt,
  first_value(seq) {SO_FAR} AS first_seq FROM {i.PAIRS}""")
def running_max(spark, t):
    """Maximum so far, with the other field of the first row."""
    return r.running_max_keep_first(i.pairs(t), ["word"], "seq", "cnt", ["seq"], t.event_width)


@query("max_by_first", f"""SELECT word, cnt, seq FROM (SELECT *, row_number() OVER (PARTITION BY word
  ORDER BY cnt DESC, seq) AS rn FROM {i.PAIRS}) WHERE rn = 1""")
def max_by_first(spark, t):
    return r.max_row(i.pairs(t), ["word"], "cnt", "seq", first=True)


@query("max_by_last", f"""SELECT word, cnt, seq FROM (SELECT *, row_number() OVER (PARTITION BY word
  ORDER BY cnt DESC, seq DESC) AS rn FROM {i.PAIRS}) WHERE rn = 1""")
def max_by_last(spark, t):
    return r.max_row(i.pairs(t), ["word"], "cnt", "seq", first=False)


def _running_best(tie: str) -> str:
    best = f"arg_max(seq, cnt * 1000000000000 {tie} seq) {SO_FAR}"
    return f"SELECT seq AS at_seq, word, max(cnt) {SO_FAR} AS cnt, {best} AS seq FROM {i.PAIRS}"


@query("running_max_by_first", _running_best("-"))
def running_max_by_first(spark, t):
    """The best row so far, after every row; the earliest of equals."""
    return r.running_max_row(i.pairs(t), ["word"], "cnt", "seq", True, t.event_width)


@query("running_max_by_last", _running_best("+"))
def running_max_by_last(spark, t):
    return r.running_max_row(i.pairs(t), ["word"], "cnt", "seq", False, t.event_width)


# --- distinct users per ad ------------------------------------------------------


@query("ad_count", f"""SELECT ad, event_type, count(*) AS n_rows, count(DISTINCT user_id) AS n_members
  FROM {i.ADS} GROUP BY ad, event_type""")
def ad_count(spark, t):
    return r.distinct_counts(i.ads(t), ["ad", "event_type"], "user_id")


@query("ad_count_running", f"""SELECT ad, event_type, user_id, seq, count(*) OVER w AS n_rows,
  (sum(CASE WHEN first_row = 1 THEN 1 ELSE 0 END) OVER w)::BIGINT AS n_members
  FROM (SELECT *, row_number() OVER (PARTITION BY ad, event_type, user_id ORDER BY seq) AS first_row FROM {i.ADS})
  WINDOW w AS (PARTITION BY ad, event_type ORDER BY seq ROWS UNBOUNDED PRECEDING)""")
def ad_count_running(spark, t):
    return r.running_distinct_counts(i.ads(t), ["ad", "event_type"], "user_id", "seq", t.event_width)


# --- income ---------------------------------------------------------------------


@query("income_final", f"SELECT province, city, sum(cents) / 100.0::DOUBLE AS income FROM {i.INCOME} GROUP BY province, city")
def income_final(spark, t):
    sums = r.keyed_reduce(i.income(t), ["province", "city"], "cents")
    return sums.select("province", "city", from_cents("cents").alias("income"))


@query("income_running", f"""SELECT province, city, seq,
  sum(cents) OVER (PARTITION BY province ORDER BY seq ROWS UNBOUNDED PRECEDING) / 100.0::DOUBLE AS province_income,
  sum(cents) OVER (PARTITION BY province, city ORDER BY seq ROWS UNBOUNDED PRECEDING) / 100.0::DOUBLE AS city_income
  FROM {i.INCOME}""")
def income_running(spark, t):
    """After every order: the province's income and the city's part of it."""
    levels = [(["province"], {"p": scan_sum("cents")}), (["province", "city"], {"c": scan_sum("cents")})]
    both = running_levels(i.income(t), levels, "seq", t.order_width)
    return both.select(
        "province", "city", "seq", from_cents("p").alias("province_income"), from_cents("c").alias("city_income")
    )


# --- history --------------------------------------------------------------------


@query("user_history", """SELECT user_id, event_id, event_type, pos, page, string_agg(event_type, ',') OVER (
  PARTITION BY user_id, page ORDER BY pos ROWS UNBOUNDED PRECEDING) AS page_items FROM (SELECT *, (pos - 1) // 64 AS page
  FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos FROM events))""")
def user_history(spark, t):
    """Each user's growing list of events, in pages of 64."""
    rows = t.events.select("user_id", "event_id", "event_type")
    out = r.paged_history(rows, ["user_id"], "event_id", "event_type", width=t.event_width)
    return out.withColumn("page_items", F.concat_ws(",", "page_items"))


@query("user_history_full", """SELECT user_id, event_id, event_type, pos, string_agg(event_type, ',') OVER (
  PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS items
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos FROM events)""")
def user_history_full(spark, t):
    """Each user's whole list of events after every event."""
    rows = t.events.select("user_id", "event_id", "event_type")
    paged = r.paged_history(rows, ["user_id"], "event_id", "event_type", width=t.event_width)
    out = r.full_history(paged, ["user_id"])
    return out.select("user_id", "event_id", "event_type", "pos", F.concat_ws(",", "items").alias("items"))


# --- SQL and change log -----------------------------------------------------------


@query("table_group_sum", f'SELECT word, sum(cnt)::BIGINT AS "total-counts" FROM {i.PAIRS} GROUP BY word')
def table_group_sum(spark, t):
    return i.pairs(t).groupBy("word").agg(F.sum("cnt").alias("total-counts"))


@query("sql_group_sum", f"SELECT word, sum(cnt)::BIGINT AS counts FROM {i.PAIRS} GROUP BY word")
def sql_group_sum(spark, t):
    i.pairs(t).toDF("word", "counts", "seq").createOrReplaceTempView("tm_word_count")
    return spark.sql("SELECT word, sum(counts) AS counts FROM tm_word_count GROUP BY word")


@query("sql_udaf_sum", f"SELECT word, sum(cnt)::BIGINT AS counts FROM {i.PAIRS} GROUP BY word")
def sql_udaf_sum(spark, t):
    """Own aggregate from SQL, over blocks of a key first so that no call gets a whole key."""
    register_functions(spark)
    i.pairs(t).withColumn("block", block_start("seq", 100_000)).createOrReplaceTempView("tm_pairs")
    return spark.sql(
        "SELECT word, my_sum(part) AS counts FROM "
        "(SELECT word, block, my_sum(cnt) AS part FROM tm_pairs GROUP BY word, block) GROUP BY word"
    )


@query("changelog_sum", f"""WITH s AS (SELECT word, seq, cnt, (sum(cnt) {SO_FAR})::BIGINT AS new,
  row_number() OVER (PARTITION BY word ORDER BY seq) AS pos FROM {i.PAIRS})
  SELECT word, seq, true AS added, new AS total FROM s
  UNION ALL SELECT word, seq, false, new - cnt FROM s WHERE pos > 1""")
def changelog_sum(spark, t):
    return r.changelog(i.pairs(t), ["word"], "seq", "cnt", width=t.event_width)


# --- state with expiry, in recorded arrival time -----------------------------------

CLOCK = "(SELECT user_id, event_id AS seq, epoch_us(ts) // 1000 AS at_ms, CAST(floor(value) AS BIGINT) AS cnt FROM events)"


def _clock(t):
    return t.events.select(
        "user_id",
        F.col("event_id").alias("seq"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"),
        F.floor("value").cast("long").alias("cnt"),
    )


SIX_HOURS = 6 * 3600 * 1000


@query("state_ttl_value", f"""SELECT user_id, seq, at_ms, cnt, (sum(cnt) OVER (PARTITION BY user_id, part ORDER BY seq
    ROWS UNBOUNDED PRECEDING))::BIGINT AS live_sum FROM (
  SELECT *, sum(restart) OVER (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS part FROM (
    SELECT *, CASE WHEN at_ms - lag(at_ms) OVER (PARTITION BY user_id ORDER BY seq) >= {SIX_HOURS} THEN 1 ELSE 0 END AS restart
    FROM {CLOCK}))""")
def state_ttl_value(spark, t):
    """A sum forgotten six hours after its last write."""
    return r.expiring_sum(_clock(t), ["user_id"], "seq", "at_ms", "cnt", SIX_HOURS, t.event_width)


@query("state_ttl_list", f"""SELECT user_id, seq, pos, first_live, pos - first_live + 1 AS n_live FROM (
  SELECT a.user_id, a.seq, a.pos, 1 + (SELECT count(*) FROM {CLOCK} b WHERE b.user_id = a.user_id
    AND b.at_ms + {SIX_HOURS} <= a.at_ms) AS first_live
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_ms, seq) AS pos FROM {CLOCK}) a)""")
def state_ttl_list(spark, t):
    """Which elements of a user's list are alive after every row, each living six hours."""
    return r.expiring_list(_clock(t), ["user_id"], "seq", "at_ms", SIX_HOURS)


@query("minute_sum", """SELECT event_type, strftime(ts, '%Y%m%d-%H%M') AS minute,
  sum(CAST(round(value * 100) AS BIGINT)) / 100.0::DOUBLE AS money FROM events GROUP BY 1, 2""")
def minute_sum(spark, t):
    from tidemill.functions.text import cents, minute_label

    sums = t.events.groupBy("event_type", minute_label("ts").alias("minute")).agg(F.sum(cents("value")).alias("c"))
    return sums.select("event_type", "minute", from_cents("c").alias("money"))


@query("state_ttl_map", """SELECT event_type, minute, event_id, sum(cents) OVER (PARTITION BY event_type, minute
  ORDER BY event_id ROWS UNBOUNDED PRECEDING) / 100.0::DOUBLE AS money FROM (SELECT event_type, event_id,
  strftime(ts, '%Y%m%d-%H%M') AS minute, CAST(round(value * 100) AS BIGINT) AS cents FROM events)""")
def state_ttl_map(spark, t):
    """Running sum per type and minute.  A minute's entry outlives its minute, so expiry never cuts a sum."""
    from tidemill.functions.text import cents, minute_label

    rows = t.events.select("event_type", minute_label("ts").alias("minute"), "event_id", cents("value").alias("cents"))
    out = running(rows, ["event_type", "minute"], "event_id", {"c": scan_sum("cents")}, t.event_width)
    return out.select("event_type", "minute", "event_id", from_cents("c").alias("money"))
