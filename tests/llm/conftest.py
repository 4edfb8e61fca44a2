import glob
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture
def docs_of(spark):
    """Documents of (doc_id, text), with columns whose names clash with those the operators use."""

    def make(rows, parts=3):
        data = [(i, t, None, "s", len(t or ""), 1, "x", 2) for i, t in rows]
        ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, k1 string, score int"
        return spark.createDataFrame(data, ddl).repartition(parts)

    return make


@pytest.fixture
def labels_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")

    return make


@pytest.fixture(scope="session")
def duck():
    def connect(folder):
        import duckdb

        con = duckdb.connect()
        for path in glob.glob(f"{folder}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        return con

    return connect
