"""File sinks: text folders, a custom line writer and an exactly-once stream sink."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def write_text(df: DataFrame, path: str, column: str = "line") -> None:
    """One line per row."""
    df.select(column).write.mode("overwrite").option("lineSep", "\n").text(path)


def label(df: DataFrame, text: str, name: str = "label") -> DataFrame:
    """Rows marked with the label a console sink shows."""
    return df.select(F.lit(text).alias(name), "*")


def to_console(df: DataFrame, text: str | None = None, mode: str = "append"):
    """A stream writer that prints, with a label where one is given; start it with `.start()`."""
    shown = label(df, text) if text else df
    return shown.writeStream.format("console").outputMode(mode).option("truncate", "false")


@dataclass
class _Written(WriterCommitMessage):
    path: str
    rows: int


class _LineWriter(DataSourceWriter):
    """Opens one file per task attempt, writes record by record, and closes it.

    A retried task writes a new file; only files named by a committed task are
    listed in the manifest that the commit leaves behind.  Every write has files
    and a manifest of its own, so appending keeps what was there; overwriting
    removes the earlier manifests once its own is written.
    """

    def __init__(self, options, overwrite=False):
        self.where = options["path"]
        self.overwrite = overwrite
        self.run = uuid.uuid4().hex

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.where)

    def write(self, rows):
        store, folder = self._store()
        context = TaskContext.get()
        path = f"{folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}-{self.run}.txt"
        store.create_dir(folder, recursive=True)
        n = 0
        with store.open_output_stream(path) as out:
            for row in rows:
                out.write((" ".join(str(v) for v in row) + "\n").encode("utf-8"))
                n += 1
        return _Written(path, n)

    def commit(self, messages):
        from pyarrow import fs

        store, folder = self._store()
        store.create_dir(folder, recursive=True)
        found = store.get_file_info(fs.FileSelector(folder)) if self.overwrite else []
        with store.open_output_stream(f"{folder}/manifest-{self.run}.tsv") as out:
            for message in messages:
                if message is not None:
                    out.write(f"{message.path}\t{message.rows}\n".encode())
        for old in found:
            if old.base_name.startswith("manifest-"):
                store.delete_file(old.path)

    def abort(self, messages):
        store, _ = self._store()
        for message in messages:
            if message is not None:
                store.delete_file(message.path)


class LineSink(DataSource):
    """Custom sink.  Option path: folder URI."""

    @classmethod
    def name(cls):
        return "tidemill_lines"

    def writer(self, schema, overwrite):
        return _LineWriter(self.options, overwrite)


class RowSink:
    """A stream sink object for `writeStream.foreach`: open, process each record, close."""

    def __init__(self, connect):
        self._connect = connect

    def open(self, partition_id, epoch_id):
        self._out = self._connect(partition_id, epoch_id)
        return True

    def process(self, row):
        self._out.write(row)

    def close(self, error):
        self._out.close()


def read_lines_sink(spark, path: str) -> DataFrame:
    """What finished `LineSink` writes committed."""
    files = (
        spark.read.text(f"{path}/manifest-*.tsv")
        .select(F.split("value", "\t")[0].alias("path"))
        .select(F.element_at(F.split("path", "/"), -1).alias("file"))
    )
    lines = spark.read.option("lineSep", "\n").text(f"{path}/part-*").select(
        F.col("value").alias("line"), F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")
    )
    return lines.join(files, "file").select("line")
