"""Shared table helpers: input tables, staged tables, held-out split."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import prepare, run_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str, within: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors, gives true sizes to joins.

    With `within`, the folder of a `scratch`, the table goes with that.
    """
    spark = df.sparkSession
    path = run_dir(spark, name, within)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for staged tables that nothing reads after the block; it is deleted then."""
    folder = run_dir(spark, name)
    try:
        yield folder
    finally:
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 5, is 0. A null id is never trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def text_key(text: str = "text") -> list[Column]:
    """128 bits that stand for a text: rows with equal texts have equal keys."""
    value = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(value).alias("k1"), F.xxhash64(F.lit(7), value, F.length(value)).alias("k2")]


def ready(spark: SparkSession) -> SparkSession:
    return prepare(spark)


def labelled_sample(labels: DataFrame, column: str, rows_per_class: int) -> DataFrame:
    """doc_id and label of about `rows_per_class` trainable rows of each class, chosen by a hash of the id.

    A document with several labels has the largest. The result is staged, so its true size is known to joins.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(F.col(column).cast("int")).alias("label"))
    )
    known = stage(known, "labels-known")
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, min(1.0, rows_per_class / n)).otherwise(share)
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < share * 1_000_000)
    return stage(chosen, "labels-sample")
