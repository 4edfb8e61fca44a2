"""Iteration: apply a step to each value until it is done."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import run_dir, shared_dir


def iterate_until(
    df: DataFrame,
    value: str,
    body: Callable[[Column], Column],
    again: Callable[[Column], Column],
    steps_per_round: int = 64,
) -> DataFrame:
    """Apply `body` at least once and go on while `again` holds for the result.

    A round runs up to `steps_per_round` steps inside one JVM expression.  Values
    that need more go to the next round, whose input is checkpointed so that the
    plan does not grow and lost executors do not repeat earlier rounds.  Finished
    rows go to one written table.  A loop that never ends for some value never ends here.
    """
    shared_dir(df.sparkSession)

    def run(v: Column) -> Column:
        steps = F.sequence(F.lit(2), F.lit(steps_per_round))
        return F.aggregate(steps, body(v), lambda acc, _: F.when(again(acc), body(acc)).otherwise(acc))

    kind = dict(df.dtypes)[value]
    folder, open_rows = run_dir(df.sparkSession, "iterate"), df
    while True:
        stepped = open_rows.withColumn(value, run(F.col(value)).cast(kind)).checkpoint()
        stepped.filter(~F.coalesce(again(F.col(value)), F.lit(False))).write.mode("append").parquet(folder)
        open_rows = stepped.filter(again(F.col(value)))
        if open_rows.isEmpty():
            return df.sparkSession.read.schema(df.schema).parquet(folder)
