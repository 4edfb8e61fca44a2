"""Streams whose micro-batches run the batch operators and carry a small table forward.

Each micro-batch is planned by Catalyst like any batch, so hot keys are spread by
the blocked scan.  What one batch leaves for the next is written under its batch
number; a replayed batch reads only lower numbers and overwrites its own.  A
batch is read several times, so it is kept while it is worked on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.joins import changing_dimension, keep_keys
from tidemill.operators.late import mark_late
from tidemill.operators.running import running_reduce
from tidemill.session import run_dir
from tidemill.sinks.upsert import UpsertTable
from tidemill.streaming.runner import ddl_of, read_batches, run_batches


def _write(rows: DataFrame, folder: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def _before(batch: DataFrame, seq: str) -> Column:
    """A place in front of all rows of the batch and next to them, so that blocks span the batch only."""
    return batch.agg((F.min(seq) - 1).alias("first")).scalar()


def _kept(step: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def _key_ddl(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {dict(df.dtypes)[k]}" for k in keys)


def stream_running_sum(
    df: DataFrame, keys: list[str], seq: str, value: str, name: str = "running", folder: str | None = None
) -> DataFrame:
    """The running sum after every row of the stream; totals per key are carried."""
    spark = df.sparkSession
    folder = folder or run_dir(spark, "running")
    kind = dict(df.groupBy(*keys).agg(F.sum(value).alias("t")).dtypes)["t"]
    totals = UpsertTable(spark, f"{folder}/totals", f"{_key_ddl(df, keys)}, total {kind}", keys)
    shape = f"{ddl_of(df)}, {name} {kind}"

    def step(batch: DataFrame, batch_id: int) -> None:
        before = keep_keys(totals.read(batch_id), batch, keys)
        # The carried total is one more row of its key, in front of all others.
        opening = before.select(*keys, F.col("total").alias(value)).withColumn("__opening", F.lit(True))
        rows = batch.withColumn("__opening", F.lit(False)).unionByName(opening, allowMissingColumns=True)
        rows = rows.withColumn("__seq", F.coalesce(F.col(seq), _before(batch, seq)))
        out = running_reduce(rows, keys, "__seq", value, "sum", name)
        _write(out.filter(~F.col("__opening")).drop("__opening", "__seq"), f"{folder}/out", batch_id)
        totals.merge(rows.groupBy(*keys).agg(F.sum(value).alias("total")), batch_id)

    run_batches(df, _kept(step), folder)
    return read_batches(spark, f"{folder}/out", shape)


def stream_split_late(
    df: DataFrame, ts: str, seq: str, size_seconds: int, delay_seconds: int = 0, folder: str | None = None
) -> DataFrame:
    """Every row of the stream with `is_late`; the largest event time seen is carried."""
    spark = df.sparkSession
    folder = folder or run_dir(spark, "late")
    seen = UpsertTable(spark, f"{folder}/seen", "k int, top bigint", ["k"])
    shape = f"{ddl_of(df)}, is_late boolean"

    def step(batch: DataFrame, batch_id: int) -> None:
        before = seen.log(batch_id).agg(F.max("top")).first()[0]
        marked = mark_late(batch, ts, seq, size_seconds, delay_seconds, seen_before=before)
        _write(marked, f"{folder}/out", batch_id)
        top = F.max(F.unix_micros(F.col(ts).cast("timestamp")))
        seen.merge(batch.agg(top.alias("top")).select(F.lit(0).alias("k"), "top"), batch_id)

    run_batches(df, _kept(step), folder)
    return read_batches(spark, f"{folder}/out", shape)


def stream_changing_dimension(
    tagged: DataFrame, key: str, seq: str, name: str, op: str, folder: str | None = None
) -> DataFrame:
    """Facts of a tagged stream with the name valid at their arrival.

    `tagged` holds facts (`op` null) and changes in one schema; the latest
    change per key is carried.
    """
    spark = tagged.sparkSession
    folder = folder or run_dir(spark, "dimension")
    kinds = dict(tagged.dtypes)
    state = UpsertTable(
        spark, f"{folder}/state", f"`{key}` {kinds[key]}, `{name}` {kinds[name]}, `{op}` {kinds[op]}", [key]
    )
    fact_ddl = ddl_of(tagged.drop(name, op))
    shape = f"{fact_ddl}, `{name}` {kinds[name]}"

    def step(batch: DataFrame, batch_id: int) -> None:
        carried = state.read(batch_id).withColumn(seq, _before(batch, seq).cast(kinds[seq]))
        changes = batch.filter(F.col(op).isNotNull()).select(key, seq, name, op)
        facts = batch.filter(F.col(op).isNull()).drop(name, op)
        out = changing_dimension(facts, changes.unionByName(carried.select(key, seq, name, op)), key, seq, name, op)
        _write(out, f"{folder}/out", batch_id)
        latest = changes.groupBy(key).agg(F.max_by(F.struct(name, op), F.col(seq)).alias("r"))
        state.merge(latest.select(key, "r.*"), batch_id)

    run_batches(tagged, _kept(step), folder)
    return read_batches(spark, f"{folder}/out", shape)
