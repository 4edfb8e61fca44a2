"""Sources and sinks: custom formats, restart of the tailing source, option maps, retries."""

from __future__ import annotations

import os
import time

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemill.session import run_dir
from tidemill.sinks import files, topics
from tidemill.sources import generated, jdbc, lines
from tidemill.streaming import runner


@pytest.fixture(autouse=True)
def formats(spark):
    generated.register_sources(spark)


def test_collection_and_sequence(spark):
    assert rows(lines.from_values(spark, [3, 1, 2], "value int")) == [(1,), (2,), (3,)]
    out = lines.sequence(spark, 1, 10, 4)
    assert [r.value for r in out.orderBy("value").collect()] == list(range(1, 11))
    assert out.rdd.getNumPartitions() == 4


@pytest.mark.parametrize("parts", [1, 3])
def test_bounded_source(spark, parts):
    out = spark.read.format("tidemill_count").option("count", 100).option("partitions", parts).load()
    assert [r.value for r in out.orderBy("value").collect()] == list(range(100))


def test_random_parallel_source_is_replayable(spark):
    def take():
        stream = (
            spark.readStream.format("tidemill_random")
            .option("sources", 3).option("rate", 1000).option("limit", 5).option("seed", 7).load()
        )
        folder = run_dir(spark, "random")
        query = (
            stream.writeStream.format("parquet").option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/c").trigger(processingTime="200 milliseconds").start()
        )
        out, give_up = [], time.monotonic() + 60
        try:
            while len(out) < 15 and time.monotonic() < give_up:
                time.sleep(0.5)
                if os.path.exists(f"{folder}/out/_spark_metadata/0"):
                    out = spark.read.schema(stream.schema).parquet(f"{folder}/out").collect()
        finally:
            query.stop()
        return sorted(tuple(r) for r in out)

    one = take()
    assert len(one) == 15 and {r[0] for r in one} == {0, 1, 2}
    assert all(0 <= r[2] < 100 and r[3] == f"{r[0]} --> {r[2]}" for r in one)
    assert take() == one


def test_tail_source_reads_only_what_was_added_after_a_restart(spark, tmp_path):
    for n in range(2):
        (tmp_path / f"{n}.txt").write_text(f"{n}-a\n{n}-b\nünf {n}\n" + f"{n}-half")
    folder = run_dir(spark, "tail")

    def run():
        stream = spark.readStream.format("tidemill_tail").option("path", f"file://{tmp_path}").option("split_bytes", 5).load()
        return rows(runner.run_append(stream.select("source", "line"), "tail", folder))

    first = [(n, t) for n in range(2) for t in (f"{n}-a", f"{n}-b", f"ünf {n}")]
    assert run() == sorted(first, key=repr)
    with open(tmp_path / "1.txt", "a") as out:
        out.write(" done\nlast\n")
    assert run() == sorted([*first, (1, "1-half done"), (1, "last")], key=repr)


@pytest.fixture
def tail(spark, tmp_path):
    folder = run_dir(spark, "tail")

    def run(**options):
        stream = spark.readStream.format("tidemill_tail").option("path", f"file://{tmp_path}").options(**options).load()
        return sorted(r.line for r in runner.run_append(stream.select("source", "line"), "tail", folder).collect())

    return run


def test_tail_source_reads_a_rotated_file_from_its_start(tail, tmp_path):
    (tmp_path / "0.txt").write_text("old 1\nold 2\n")
    assert tail() == ["old 1", "old 2"]
    (tmp_path / "0.txt").write_text("new 1\nnew 2\nnew 3\n")
    assert tail() == ["new 1", "new 2", "new 3", "old 1", "old 2"]


def test_tail_source_reads_a_shortened_file_from_its_start(tail, tmp_path):
    (tmp_path / "0.txt").write_text("a\nb\nc\n")
    assert tail() == ["a", "b", "c"]
    (tmp_path / "0.txt").write_text("a\n")
    assert tail() == ["a", "a", "b", "c"]
    (tmp_path / "0.txt").write_text("a\nd\n")
    assert tail() == ["a", "a", "b", "c", "d"]


def test_tail_source_goes_on_without_a_vanished_file(tail, tmp_path):
    for n in range(2):
        (tmp_path / f"{n}.txt").write_text(f"{n}-a\n")
    assert tail() == ["0-a", "1-a"]
    os.remove(tmp_path / "0.txt")
    with open(tmp_path / "1.txt", "a") as out:
        out.write("1-b\n")
    assert tail() == ["0-a", "1-a", "1-b"]
    (tmp_path / "0.txt").write_text("back\n")
    assert tail() == ["0-a", "1-a", "1-b", "back"]


@pytest.mark.parametrize("split", ["3", "1000"])
def test_tail_source_delivers_the_last_line_at_the_end(tail, tmp_path, split):
    (tmp_path / "0.txt").write_text("a\nb\nunfinished")
    (tmp_path / "1.txt").write_text("")
    assert tail(split_bytes=split) == ["a", "b"]
    assert tail(split_bytes=split, finish="true") == ["a", "b", "unfinished"]
    assert tail(split_bytes=split, finish="true") == ["a", "b", "unfinished"]


def test_text_folder_is_read_once_per_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    folder = run_dir(spark, "text")

    def run():
        return rows(runner.run_append(lines.read_lines(spark, "text_stream", path=str(tmp_path)), "text", folder))

    assert run() == [("x",), ("y",)]
    (tmp_path / "b.txt").write_text("z\n")
    assert run() == [("x",), ("y",), ("z",)]
    assert rows(lines.read_lines(spark, "text", path=str(tmp_path))) == [("x",), ("y",), ("z",)]
    with pytest.raises(ValueError):
        lines.read_lines(spark, "pigeon")


def records(spark, *values):
    return spark.createDataFrame([(v.encode(),) for v in values], "value binary").withColumn(
        "timestamp", F.timestamp_millis(F.lit(1635585660000))
    )


def test_decode_skips_bad_records_and_nulls_bad_fields(spark):
    csv = lines.decode_csv(records(spark, "u1,i1,view", "u1,i1", "u2,i2,buy,x"), "user string, item string, behavior string")
    assert rows(csv.drop("ts")) == [("u1", "i1", "view")]
    ints = lines.decode_csv(records(spark, "101,x"), "user int, item int")
    assert rows(ints.drop("ts")) == [(101, None)]
    json = lines.decode_json(records(spark, '{"user_id": 1, "behavior": "view"}', "{bad", '{"user_id": "x"}'), "user_id bigint, behavior string")
    assert rows(json.drop("ts")) == [(1, "view"), (None, None)]


def test_topic_options():
    assert lines.kafka_options("h:9092", "wc") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "wc", "startingOffsets": "earliest", "failOnDataLoss": "true",
    }
    assert lines.kafka_options("h:9092", "wc", "latest", max_records=10)["maxOffsetsPerTrigger"] == "10"
    assert lines.kafka_sink_options("h:9092", "out")["topic"] == "out"


def test_topic_keys_are_the_same_on_replay_and_dropped_by_the_reader(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, line string")
    once = topics.to_records(batch, 4, "line", "id")
    assert rows(once) == [("4-1", "a"), ("4-2", "b")]
    twice = once.unionByName(topics.to_records(batch, 4, "line", "id")).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    twice.write.parquet(f"{tmp_path}/t")
    stream = spark.readStream.schema(twice.schema).parquet(f"{tmp_path}/t")
    assert rows(runner.run_append(topics.drop_repeats(stream).select("key", "value"), "dedup")) == rows(once)


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x://h/db", "dim", user="u", password="p")
    assert plain == {"url": "jdbc:x://h/db", "dbtable": "dim", "fetchsize": "10000", "user": "u", "password": "p"}
    split = jdbc.jdbc_options("jdbc:x://h/db", "dim", split_column="id", bounds=(0, 99), partitions=4)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "99", "4")


class Flaky:
    """Stands in for a batch whose write fails a few times."""

    def __init__(self, failures):
        self.failures, self.saves, self.set = failures, 0, {}

    def withColumn(self, *_):
        return self

    @property
    def write(self):
        return self

    def format(self, _):
        return self

    mode = format

    def options(self, **kw):
        self.set.update(kw)
        return self

    def option(self, k, v):
        self.set[k] = v
        return self

    def save(self):
        self.saves += 1
        if self.saves <= self.failures:
            raise OSError("gone")


def test_jdbc_writer_retries_a_bounded_number_of_times(spark):
    batch = Flaky(2)
    jdbc.jdbc_writer({"url": "u"}, retries=3, pause_seconds=0)(batch, 0)
    assert batch.saves == 3 and batch.set == {"url": "u", "batchsize": 1000}
    with pytest.raises(OSError):
        jdbc.jdbc_writer({"url": "u"}, retries=1, pause_seconds=0)(Flaky(5), 0)


def test_row_sink_opens_writes_and_closes(spark, tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\ny\n")
    target = f"{tmp_path}/out"

    class Out:
        def __init__(self, part, epoch):
            self.file = open(f"{target}/{epoch}-{part}.txt", "w")

        def write(self, row):
            self.file.write(row.line + "\n")

        def close(self):
            self.file.close()

    stream = lines.read_lines(spark, "text_stream", path=f"{tmp_path}/in")
    query = (
        stream.writeStream.foreach(files.RowSink(Out)).option("checkpointLocation", run_dir(spark, "rows"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.read.text(target)) == [("x",), ("y",)]


def test_custom_sink_ignores_files_without_commit(spark, tmp_path):
    spark.range(10).write.format("tidemill_lines").mode("append").option("path", f"file://{tmp_path}/s").save()
    (tmp_path / "s" / "part-99999-1.txt").write_text("left over\n")
    assert sorted(int(r.line) for r in files.read_lines_sink(spark, f"{tmp_path}/s").collect()) == list(range(10))


def test_console_label(spark):
    assert rows(files.label(spark.range(1), "late")) == [("late", 0)]


def test_cluster_without_shared_folder_is_refused(spark):
    from types import SimpleNamespace

    from tidemill.session import shared_dir

    lonely = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(lonely)
