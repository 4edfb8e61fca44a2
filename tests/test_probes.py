"""Inputs outside the fixtures: repeated sequence values, nulls, hung calls, appended writes, quoted fields."""

import time

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemill.operators import running as r
from tidemill.operators import windows as w
from tidemill.operators.enrich import enrich
from tidemill.sinks.files import LineSink, read_lines_sink
from tidemill.sources.lines import decode_csv
from tidemill.sources.tail import _lines
from tidemill.streaming.runner import CLOSING, without_flush


def test_hung_calls_free_their_places(spark):
    df = spark.createDataFrame([(i,) for i in range(12)], "n int").coalesce(1)

    def call(n):
        if n < 2:
            time.sleep(30)
        return (n * 10,)

    got = enrich(df, ["n"], call, "m int", in_flight=2, timeout_seconds=1.0)
    assert rows(got, "n") == [(0, None), (1, None), *((n, n * 10) for n in range(2, 12))]


def test_appended_line_writes_are_all_kept(spark, tmp_path):
    spark.dataSource.register(LineSink)
    path = f"file://{tmp_path}/lines"
    for start, mode in ((0, "append"), (10, "append")):
        spark.range(start, start + 10).write.format("tidemill_lines").mode(mode).option("path", path).save()
    assert sorted(int(x.line) for x in read_lines_sink(spark, path).collect()) == list(range(20))
    spark.range(3).write.format("tidemill_lines").mode("overwrite").option("path", path).save()
    assert sorted(int(x.line) for x in read_lines_sink(spark, path).collect()) == [0, 1, 2]


def test_distinct_counts_with_sequences_per_key(spark):
    data = [("a", "u", 1), ("a", "v", 2), ("b", "u", 1), (None, "u", 1), ("b", None, 2)]
    df = spark.createDataFrame(data, "k string, m string, seq bigint")
    got = rows(r.running_distinct_counts(df, ["k"], "m", "seq").select("k", "m", "seq", "n_rows", "n_members"))
    assert got == sorted(
        [("a", "u", 1, 1, 1), ("a", "v", 2, 2, 2), ("b", "u", 1, 1, 1), ("b", None, 2, 2, 1), (None, "u", 1, 1, 1)], key=repr
    )


def test_changelog_with_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None), ("a", 4, 2)], "k string, seq bigint, v bigint")
    got = [(x.seq, x.added, x.total) for x in r.changelog(df, ["k"], "seq", "v").collect()]
    assert sorted(got, key=lambda x: (x[0], x[1])) == [
        (1, True, None), (2, False, None), (2, True, 5), (3, False, 5), (3, True, 5), (4, False, 5), (4, True, 7),
    ]


def test_maxima_over_panes_and_sessions(spark):
    df = spark.sql(
        "SELECT 'a' AS k, timestamp_ntz'2024-01-01 00:00:01' AS ts, 1 AS v "
        "UNION ALL SELECT 'a', timestamp_ntz'2024-01-01 00:00:06', 5"
    )
    panes = w.sliding_from_panes(df, ["k"], "ts", "10 seconds", "5 seconds", {"top": F.max("v"), "n": F.count("v")})
    assert {(str(x.win_start)[11:], x.top, x.n) for x in panes.collect()} == {
        ("23:59:55", 1, 1), ("00:00:00", 5, 2), ("00:00:05", 5, 1),
    }
    assert [(x.top, x.low) for x in w.sessions(df, ["k"], "ts", 5, {"top": F.max("v"), "low": F.min("v")}).collect()] == [(5, 1)]
    with pytest.raises(ValueError, match="put together"):
        w.sessions(df, ["k"], "ts", 5, {"mean": F.avg("v")})


def test_csv_records_with_quotes_and_decimals(spark):
    data = [('1,"x,y",2.50',), ("2,z",), ("no,z,1",), ("3,z,1,4",)]
    records = spark.createDataFrame(data, "value string").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    got = decode_csv(records, "a int, b string, c decimal(10,2)").select("a", "b", F.col("c").cast("string").alias("c"))
    assert rows(got) == sorted([(1, "x,y", "2.50"), (None, "z", "1.00")], key=repr)


def test_only_the_closing_row_is_dropped(spark):
    times = "SELECT timestamp'2200-01-01 00:00:00.000001' AS ts UNION ALL SELECT NULL UNION ALL SELECT timestamp'2024-01-01'"
    df = spark.sql(f"SELECT ts, c AS {CLOSING} FROM ({times}) CROSS JOIN VALUES (true), (false) AS v(c)")
    assert without_flush(df).count() == 3 and without_flush(df).columns == ["ts"]


def test_lines_are_read_once(tmp_path):
    data = b"".join(b"x" * (i % 200) + b"\n" for i in range(5000)) + b"rest"
    path = tmp_path / "a.log"
    path.write_bytes(data)

    class Counted:
        read_bytes = 0

        def __init__(self, file):
            self.file = file

        def seek(self, at):
            self.file.seek(at)

        def read(self, n):
            block = self.file.read(n)
            self.read_bytes += len(block)
            return block

    with path.open("rb") as file:
        counted = Counted(file)
        assert list(_lines(counted, 0, len(data))) == data.split(b"\n")
        assert counted.read_bytes == len(data)
        got = []
        for a in range(0, len(data), 40_000):
            part = list(_lines(file, max(0, a - 1), min(a + 40_000, len(data))))
            got += part if a == 0 else part[1:]
        assert got == data.split(b"\n")


def test_full_history(spark):
    df = spark.createDataFrame([("a", i, f"e{i}") for i in range(7)] + [("b", 9, "x")], "k string, seq bigint, v string")
    full = r.full_history(r.paged_history(df, ["k"], "seq", "v", page_rows=3), ["k"])
    assert {(x.k, x.seq, tuple(x["items"])) for x in full.collect()} == {
        *(("a", i, tuple(f"e{j}" for j in range(i + 1))) for i in range(7)), ("b", 9, ("x",)),
    }
