"""Keys and distribution of rows over partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_columns(df: DataFrame, keys) -> list[Column]:
    """Keys given as positions, names or expressions."""
    keys = keys if isinstance(keys, (list, tuple)) else [keys]
    return [F.col(df.columns[k]) if isinstance(k, int) else F.col(k) if isinstance(k, str) else k for k in keys]


def concat_key(*columns: str) -> Column:
    """One string key.  Different tuples may collide ("ab"+"c", "a"+"bc"); prefer several key columns."""
    return F.concat(*[F.col(c).cast("string") for c in columns])


def key_by(df: DataFrame, keys, partitions: int | None = None) -> DataFrame:
    """Hash-distribute by key.  Only for writers that need it: groupBy and joins do it themselves."""
    columns = key_columns(df, keys)
    return df.repartition(partitions, *columns) if partitions else df.repartition(*columns)


def rebalance(df: DataFrame, partitions: int) -> DataFrame:
    """Even round-robin distribution."""
    return df.repartition(partitions)


def rescale(df: DataFrame, partitions: int, current: int | None = None) -> DataFrame:
    """Change the number of partitions, without a shuffle where it shrinks."""
    if current is not None and partitions <= current:
        return df.coalesce(partitions)
    return df.repartition(partitions)


def shuffled(df: DataFrame, partitions: int, by: str, seed: int = 0) -> DataFrame:
    """Random distribution, from a seeded hash of a unique column.

    The hash, unlike a random number, gives a retried task the same rows.
    """
    return df.repartition(partitions, F.xxhash64(F.col(by), F.lit(seed)))


def replicate(df: DataFrame, copies: int, name: str = "replica") -> DataFrame:
    """Every row once for each downstream partition; copy i goes to partition i.

    Meant for small control inputs: the output is `copies` times the input.
    """
    spread = df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return spread.repartitionById(copies, F.col(name))


def first_letter_partition(column: str, letters: dict[str, int], default: int = 0) -> Column:
    """Partition number from the first letter."""
    initial = F.substring(F.col(column), 1, 1)
    number = F.lit(default)
    for letter, partition in letters.items():
        number = F.when(initial == letter, partition).otherwise(number)
    return number.cast("int")


def partition_by_id(df: DataFrame, partitions: int, number: Column) -> DataFrame:
    """Send each row to exactly the partition `number` gives."""
    return df.repartitionById(partitions, number)
