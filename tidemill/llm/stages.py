"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame with the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import decontaminate, language, mixing as mixes, neardup, substring
from tidemill.llm.tables import held_out, read, stage, text_key
from tidemill.session import prepare

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents whose language has less than this posterior are of no known language.
LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language; those without letters, and those that could be of several, go."""
    prepare(spark)
    model = language.fit(docs.filter(~held_out()))
    found = language.identify(docs, model, keep=COLUMNS)
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LANGUAGE_SCORE)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near-duplicates."""
    prepare(spark)
    return neardup.keep_one(docs.select(*COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated 35-word passages; texts without any stay as they are, emptied ones go."""
    prepare(spark)
    out = substring.remove_repeats(docs, keep=COLUMNS)
    changed = F.col("n_removed") > 0
    return out.filter(~changed | (F.col("n_removed") < F.col("n_words"))).select(
        "doc_id",
        F.when(changed, F.col("kept_text")).otherwise(F.col("text")).alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words of a benchmark window. A row's verdict is found again by its id and text."""
    prepare(spark)
    keyed = docs.select(F.coalesce("doc_id", F.lit(-(1 << 62))).alias("_d"), *text_key(), *COLUMNS)
    named = keyed.select(F.struct("_d", "k1", "k2").alias("doc_id"), "text")
    verdicts = decontaminate.decontaminate(named, read(spark, sf_dir, "benchmark"))
    # Written, so that the join knows how few they are.
    leaked = stage(verdicts.filter("contaminated").select("doc_id._d", "doc_id.k1", "doc_id.k2").distinct(), "leaked-documents")
    return keyed.join(leaked, ["_d", "k1", "k2"], "left_anti").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the rate at which each enters the mix, its copies (none for some of low rate), and the misfit."""
    prepare(spark)
    return mixes.mixed(docs.select(*COLUMNS), read(spark, sf_dir, "labels"))
