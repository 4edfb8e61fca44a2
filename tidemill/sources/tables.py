"""The driver's Parquet tables with declared schemas, as batch and as stream."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class Tables:
    """Lazy access to the tables below one folder; no schema is inferred."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    def stream(self, name: str, files_per_batch: int | None = None) -> DataFrame:
        """The table as a file stream; `files_per_batch` bounds one micro-batch."""
        reader = self.spark.readStream.schema(SCHEMAS[name])
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        # Written as a glob, the path may be one file as well as a folder of files.
        return reader.parquet(f"{self.folder}/{name}[.]parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.table(name)

    @cached_property
    def event_width(self) -> Column:
        from tidemill.operators.scans import block_width

        return block_width(self.events, "event_id")

    @cached_property
    def order_width(self) -> Column:
        from tidemill.operators.scans import block_width

        return block_width(self.orders, "o_orderkey")


def event_time(ts: str = "ts") -> Column:
    """The stored wall-clock time as an instant, as watermarks require (UTC session)."""
    return F.col(ts).cast("timestamp")
