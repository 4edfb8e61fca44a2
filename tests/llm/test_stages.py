"""Stages of the pipeline against plain versions, each on its own input, with odd rows in it."""

import collections
import glob
import random
import tempfile
import time

import pytest
from test_pairs import classes_by_brute_force, leaks_by_brute_force

import corpus_pipeline
from tidemill.llm import language, stages, substring
from tidemill.llm.tables import held_out, read
from tidemill.llm.tables import stage as stage_table
from tidemill.session import shared_dir

SF = "/root/testdata/sf0.001"
ODD = [(801, None), (802, ""), (803, " \n"), (804, "one"), (804, "one"), (805, "x " * 2000), (806, "y" * 30_000), (None, "no id")]


@pytest.fixture
def docs(spark, docs_of):
    """Documents of four languages, copies, common passages, leaks, and odd rows; columns with clashing names go first."""
    rand = random.Random(11)
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").orderBy("doc_id").limit(120).collect()]
    items = [r.text for r in read(spark, SF, "benchmark").limit(5).collect()]
    passage = " ".join(f"p{rand.random()}" for _ in range(60))
    rows += [(900 + i, f"{' '.join(str(rand.random()) for _ in range(20))} {passage} tail {i}") for i in range(6)]
    rows += [(920 + i, f"before {t} after {i}") for i, t in enumerate(items)]
    return docs_of(rows + ODD)


def known(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "mixing"]


def test_language_stage_drops_what_has_no_language(spark, docs):
    out = stages.language_id(spark, docs.withColumn("lang", docs.source), SF)
    assert out.columns == list(stages.COLUMNS)
    model = language.fit(docs.withColumn("lang", docs.source).filter(~held_out()))
    want = language.identify(docs, model, keep=("doc_id", "text")).filter("lang_pred <> 'und' and score >= 0.5")
    assert collections.Counter(known(out)) == collections.Counter((r.doc_id, r.text) for r in want.collect())
    assert not {801, 802, 803} & {r.doc_id for r in out.collect()} and (806, "y" * 30_000) in known(out)


def test_the_words_of_a_small_sample_are_few_files(spark, docs):
    folders = lambda: set(glob.glob(f"{shared_dir(spark).removeprefix('file://')}/tidemill/language-words-*"))
    before = folders()
    language.fit(docs.withColumn("lang", docs.source).filter(~held_out()), rounds=1)
    (written,) = folders() - before
    assert len(glob.glob(f"{written}/part-*")) <= 2 * spark.sparkContext.defaultParallelism


def test_near_dedup_stage_keeps_one_of_each_class(spark, docs):
    rows = known(docs)
    classes = classes_by_brute_force([(n, t) for n, t in rows if n is not None])
    out = stages.near_dedup(spark, docs, SF)
    assert out.columns == list(stages.COLUMNS)
    ids = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert ids == sorted(set(classes.values()))


def test_substring_stage_removes_passages_and_emptied_texts(spark, docs):
    rows = known(docs)
    numbered = {i: t for i, (_, t) in enumerate(rows)}
    plain = substring.brute_force(numbered)
    out = collections.Counter((r.doc_id, len((r.text or "").split())) for r in stages.substring_dedup(spark, docs, SF).collect())
    want = collections.Counter(
        (rows[i][0], words - gone) for i, (words, gone, _) in plain.items() if not gone or gone < words
    )
    assert out == want and any(gone for _, gone, _ in plain.values())
    untouched = {rows[i] for i, (_, gone, _) in plain.items() if not gone}
    assert untouched <= set(known(stages.substring_dedup(spark, docs, SF)))


def test_decontamination_stage_drops_documents_with_leaks(spark, docs):
    rows = known(docs)
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    hit = {n for n, _, n_hit, _, _, bad in leaks_by_brute_force(rows, items) if bad}
    out = known(stages.decontamination(spark, docs, SF))
    assert collections.Counter(out) == collections.Counter(r for r in rows if r[0] not in hit)
    assert {920, 921, 922, 923, 924} <= hit


def test_mixing_stage_keeps_all_rows_and_their_columns(spark, docs):
    out = stages.mixing(spark, docs, SF)
    assert out.columns == [*stages.COLUMNS, "rate", "copies", "misfit"]
    assert collections.Counter(known(out)) == collections.Counter(known(docs))
    assert all(r.rate > 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in out.collect())


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_no_rows(spark, docs, stage):
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_shuffle_files_of_a_staged_table_do_not_stay(spark):
    files = lambda: set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data"))
    before = files()
    out = stage_table(spark.range(10_000).repartition(3, "id"), "shuffled")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and out.count() == 10_000
