"""Every query has SQL, or a test that stands for it."""

import os

import pytest

from tidemill.llm import queries, registry  # noqa: F401

#: Queries that SQL can't express: where they are compared with a plain version or held-out labels.
TESTED = {
    "op2_mixing": "test_scores.py::test_rates_equal_plain_projected_gradient",
    "op4_bagminhash": "test_pairs.py::test_near_duplicates_equal_brute_force",
    "op5_toxicity": "test_scores.py::test_disguised_words_are_restored_and_scored",
    "op7_language_id": "test_scores.py::test_long_words_are_summed_whole",
    "op8_quality_cnn": "test_quality.py::test_responses_equal_plain_loops",
    "op12_alignment": "test_alignment.py::test_digests_equal_plain_loops",
    "op13_whitening": "test_whitening.py::test_whitened_rows_equal_numpy",
    "pipeline": "test_stages.py",
}


def test_every_query_has_sql_or_a_test():
    assert set(registry.QUERIES) - set(registry.ORACLES) == set(TESTED) - {"pipeline"}
    here = os.path.dirname(os.path.abspath(__file__))
    for place in TESTED.values():
        file, _, test = place.partition("::")
        assert f"def {test}" in open(f"{here}/{file}", encoding="utf-8").read()


@pytest.mark.parametrize("name", ["op9_substring_dedup"])
def test_same_rows_as_sql(spark, folder, duck, name):
    import collections

    rows = collections.Counter(tuple(r) for r in registry.QUERIES[name](spark, folder).collect())
    assert rows == collections.Counter(duck(folder).execute(registry.ORACLES[name]).fetchall())
