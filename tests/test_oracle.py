"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from compare import connect, differences  # noqa: E402
from tidemill.plans.registry import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, folder, duck, name):
    assert differences(queries()[name](spark, folder), duck, oracle_sql()[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["word", "n"] and not df.isEmpty()


def test_every_query_of_the_plans_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())
