"""Enrichment of rows from an outside service, with a bound on calls in flight."""

from __future__ import annotations

import threading
import time
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def enrich(
    df: DataFrame,
    inputs: list[str],
    lookup: Callable[..., tuple | None],
    outputs: str,
    in_flight: int = 10,
    timeout_seconds: float = 2.0,
    open_client: Callable[[], object] | None = None,
) -> DataFrame:
    """Add the columns `outputs` (DDL) from `lookup(*inputs)`, called from each partition.

    Equal inputs of one Arrow batch are asked for once, by as many threads as calls
    may be in flight; rows keep their order within the partition.  An error, no answer or a call longer than the timeout,
    counted from its own start, gives null and frees its place for the next call.  With `open_client` one client per task is made and passed to
    `lookup` first.  Use a join instead where the service is a table.
    """
    added = StructType.fromDDL(outputs)
    names = added.fieldNames()
    schema = StructType(df.schema.fields + added.fields)
    nothing = (None,) * len(names)

    def ask(call: Callable, keys: pd.DataFrame) -> list[tuple]:
        rows = list(keys.itertuples(index=False, name=None))
        answers: list[tuple] = [nothing] * len(rows)
        todo = iter(range(len(rows)))
        started: dict[int, float] = {}  # calls in flight, in the order of their starts
        change = threading.Condition()

        def work() -> None:
            """Call after call until none is left or the last one was given up."""
            while True:
                with change:
                    at = next(todo, None)
                    if at is None:
                        change.notify()
                        return
                    begun = started[at] = time.monotonic()
                try:
                    answer = call(*rows[at]) or nothing
                except Exception:
                    answer = nothing
                with change:
                    if started.get(at) is None or time.monotonic() >= begun + timeout_seconds:
                        change.notify()
                        return
                    del started[at]
                    answers[at] = answer

        def place() -> None:
            # A hung call keeps only its own thread, which does not outlive the worker.
            threading.Thread(target=work, daemon=True).start()

        for _ in range(min(in_flight, len(rows))):
            place()
        with change:
            while len(rows) and (started or todo.__length_hint__()):
                oldest = next(iter(started.values()), None)
                left = timeout_seconds if oldest is None else oldest + timeout_seconds - time.monotonic()
                if left > 0:
                    change.wait(left)
                    continue
                late = [at for at, begun in started.items() if begun + timeout_seconds <= time.monotonic()]
                for at in late:
                    del started[at]
                    if todo.__length_hint__():
                        place()
        return answers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = (open_client(),) if open_client else ()
        for batch in batches:
            keys = batch[inputs].drop_duplicates()
            found = ask(lambda *row: lookup(*client, *row), keys)
            answers = pd.DataFrame(found, columns=names, index=keys.index).astype(object)
            answers[inputs] = keys
            merged = batch.merge(answers, on=inputs, how="left", sort=False)
            yield merged[schema.fieldNames()]

    return df.mapInPandas(run, schema)
