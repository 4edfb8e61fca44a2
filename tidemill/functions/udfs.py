"""Functions for use from SQL: scalar, aggregate and table functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_ip_number(spark: SparkSession) -> None:
    """`ip_number(ip)` as a SQL function of native expressions."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION ip_number(ip STRING) RETURNS BIGINT RETURN "
        "aggregate(split(ip, '[.]'), 0L, (acc, octet) -> shiftleft(acc, 8) | CAST(octet AS BIGINT))"
    )


def ip_locate(df: DataFrame, ip: str, rules: DataFrame, name: str) -> DataFrame:
    """Add `name` of the rule that holds the address; a name for the block join, for rule sets of any size."""
    from tidemill.operators.joins import ip_lookup

    return ip_lookup(df, ip, rules, [name])


def my_sum():
    """A sum as own aggregate function; made on demand, since it needs a session."""

    @F.pandas_udf("bigint")
    def sum_values(values: pd.Series) -> int:
        return int(values.sum())

    return sum_values


def two_step_sum(df: DataFrame, keys: list[str], value: str, seq: str, name: str, block_rows: int = 100_000) -> DataFrame:
    """`my_sum` per key without ever handing a whole key to one call.

    A Python aggregate gets all rows of its group at once.  So it first sums
    blocks of at most `block_rows` rows of a key, then the block sums.
    """
    from tidemill.operators.scans import block_start

    blocks = df.groupBy(*keys, block_start(seq, block_rows).alias("__block")).agg(my_sum()(F.col(value)).alias("__part"))
    return blocks.groupBy(*keys).agg(F.sum("__part").alias(name))


def register_functions(spark: SparkSession) -> None:
    """Make `ip_number`, `my_sum` and the table function `split_line` known to SQL."""
    from pyspark.sql.functions import udtf

    class SplitLine:
        """Fields of a line; the separator is a regular expression, trailing empty fields are dropped."""

        def eval(self, line: str, sep: str = ","):
            import re

            if line is None:
                return
            fields = re.split(sep, line) if line else [""]
            while len(fields) > 1 and not fields[-1]:
                fields.pop()
            if line and fields == [""]:
                return
            for field in fields:
                yield (field,)

    spark.udtf.register("split_line", udtf(SplitLine, returnType="word string"))
    spark.udf.register("my_sum", my_sum())
    register_ip_number(spark)
