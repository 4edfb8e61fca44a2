"""A table replayed as a stream in several micro-batches, in the order of its arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import run_dir

SLICES = 3
#: Rows of a micro-batch where the number of slices is free: what a task holds of its keys does not grow with the table.
BATCH_ROWS = 1_000_000


def _edges(table: DataFrame, seq: str, slices: int) -> list[int]:
    low, high = table.agg(F.min(seq), F.max(seq)).first()
    if low is None:
        return []
    return [low + (high - low + 1) * k // slices for k in range(slices + 1)]


def _bounded_edges(table: DataFrame, seq: str, most_rows: int) -> list[int]:
    """The same for as many slices of equal numbers of rows, SLICES at least, as keep each at about `most_rows`."""
    rows, low, high = table.agg(F.count(seq), F.min(seq), F.max(seq)).first()
    slices = -(-rows // most_rows)
    if slices <= SLICES:
        return _edges(table, seq, SLICES)
    inner = table.agg(F.percentile_approx(seq, [k / slices for k in range(1, slices)], 100 * slices)).first()[0]
    return sorted({low, *(x + 1 for x in inner), high + 1})


def slice_bounds(table: DataFrame, seq: str, slices: int = SLICES) -> list[int]:
    """First `seq` of each slice: equal spans from the smallest value to the largest."""
    return _edges(table, seq, slices)[:-1]


def slice_sql(source: str, seq: str, slices: int = SLICES) -> str:
    """The number of each row's slice, as SQL over a subquery with `lo` and `hi`, the ends of `seq`."""
    return f"""(SELECT s.*, CAST((SELECT count(*) FROM range({slices}) r(k)
    WHERE s.{seq} >= s.lo + (s.hi - s.lo + 1) * r.k // {slices}) - 1 AS BIGINT) AS slice
  FROM (SELECT *, min({seq}) OVER () AS lo, max({seq}) OVER () AS hi FROM {source}) s)"""


def _span(seq: str, low: int, high: int, files: int) -> Column:
    """The number of a row's file: equal spans of its slice, in the order of arrival."""
    at = F.floor((F.col(seq) - low).cast("double") * files / (high - low))
    return F.least(at, F.lit(files - 1)).cast("int")


def slice_files(table: DataFrame, seq: str, edges: list[int]) -> int:
    """How many files a slice is written to: at least as many as tasks read the table, so that as many read a micro-batch.

    A micro-batch takes a number of files, so no file of any slice may stay unwritten; there are fewer, down to one,
    where the sequence has gaps as long as a file.
    """
    parts = table.rdd.getNumPartitions() if edges else 1
    if parts == 1:
        return 1
    files = 1 << (parts - 1).bit_length()
    slices = list(zip(edges, edges[1:]))
    spans = [F.when((F.col(seq) >= a) & (F.col(seq) < b), F.lit(k * files) + _span(seq, a, b, files)) for k, (a, b) in enumerate(slices) if a < b]
    filled = {x[0] for x in table.select(F.coalesce(*spans).alias("at")).filter("at IS NOT NULL").distinct().collect()}
    while files > 1 and len(filled) < len(slices) * files:
        files, filled = files // 2, {x // 2 for x in filled}
    return files


def replay(table: DataFrame, seq: str, slices: int = SLICES, most_rows: int | None = None) -> DataFrame:
    """`table` as a stream whose micro-batches are slices of the sequence, earlier ones first.

    With `most_rows` there are more slices where a table is so large that one would have more rows than that.

    A file stream takes files in the order of their writing, so the slices are written one after the other, each to the
    same number of files, which is what one micro-batch takes. A file holds a stretch of the sequence. A table that
    already lies in files of its arrival order needs none of this: `Tables.stream` with `files_per_batch` reads it as
    it is.
    """
    spark = table.sparkSession
    folder = run_dir(spark, "replay")
    edges = _edges(table, seq, slices) if most_rows is None else _bounded_edges(table, seq, most_rows)
    files = slice_files(table, seq, edges)
    table.limit(0).coalesce(1).write.parquet(f"{folder}/empty")
    for low, high in zip(edges, edges[1:]):
        part = table.filter((F.col(seq) >= low) & (F.col(seq) < high))
        dealt = part.repartitionById(files, _span(seq, low, high, files)) if files > 1 else part.repartition(1)
        dealt.write.mode("append").parquet(f"{folder}/rows")
    where = f"{folder}/rows" if edges else f"{folder}/empty"
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(where)
