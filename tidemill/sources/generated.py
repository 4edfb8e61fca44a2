"""Custom sources on the Python data source API."""

from __future__ import annotations

import random
import time

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


class _CountReader(DataSourceReader):
    def __init__(self, count: int, partitions: int):
        self.count, self.parts = count, max(1, partitions)

    def partitions(self):
        cuts = [self.count * i // self.parts for i in range(self.parts + 1)]
        return [InputPartition((i, cuts[i], cuts[i + 1])) for i in range(self.parts)]

    def read(self, span):
        _, first, stop = span.value
        for value in range(first, stop):
            yield (value,)


class CountSource(DataSource):
    """Bounded: the numbers 0..count-1, then the end.  Options: count, partitions."""

    @classmethod
    def name(cls):
        return "tidemill_count"

    def schema(self):
        return "value bigint"

    def reader(self, schema):
        return _CountReader(int(self.options.get("count", "100")), int(self.options.get("partitions", "1")))


class _RandomReader(DataSourceStreamReader):
    """Each of `sources` parallel sources makes `rate` numbers per second.

    The offset is the number of rows per source, derived from the clock when a
    batch is planned.  A row is a function of (seed, source, row number), so a
    replayed batch brings the same rows.
    """

    def __init__(self, options):
        self.seed = int(options.get("seed", "0"))
        self.sources = int(options.get("sources", "1"))
        self.rate = float(options.get("rate", "1"))
        self.limit = int(options.get("limit", "0"))
        self.started = time.time()
        self.planned = 0

    def initialOffset(self):
        return {"rows": 0}

    def latestOffset(self):
        rows = int((time.time() - self.started) * self.rate)
        if self.limit:
            rows = min(rows, self.limit)
        self.planned = max(self.planned, rows)
        return {"rows": self.planned}

    def partitions(self, start, end):
        self.planned = max(self.planned, end["rows"])
        return [InputPartition((i, start["rows"], end["rows"])) for i in range(self.sources)]

    def read(self, span):
        index, first, stop = span.value
        for row in range(first, stop):
            value = random.Random(f"{self.seed}/{index}/{row}").randrange(100)
            yield (index, row, value, f"{index} --> {value}")

    def commit(self, end):
        pass


class RandomSource(DataSource):
    """Unbounded: random numbers in [0, 100) from parallel sources that name their index.

    Options: sources, rate (rows per second and source), seed, limit.
    """

    @classmethod
    def name(cls):
        return "tidemill_random"

    def schema(self):
        return "source int, row bigint, value int, line string"

    def streamReader(self, schema):
        return _RandomReader(self.options)


def register_sources(spark: SparkSession) -> None:
    """Make the custom formats known to the session."""
    from tidemill.sinks.files import LineSink
    from tidemill.sources.tail import TailSource

    for source in (CountSource, RandomSource, TailSource, LineSink):
        spark.dataSource.register(source)
