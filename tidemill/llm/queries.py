"""The queries of the operators, registered by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tidemill.llm import (
    alignment,
    decontaminate,
    language,
    licenses,
    mixing,
    neardup,
    parity,
    quality,
    substring,
    topk,
    toxicity,
    urls,
    whitening,
)
from tidemill.llm.registry import query
from tidemill.llm.tables import read


@query("op9_substring_dedup", substring.ORACLE)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words outside repeated 35-word windows, per document."""
    return substring.digest(substring.remove_repeats(read(spark, sf_dir, "documents")))


@query("op3_exact_topk", topk.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector among all others."""
    return topk.exact_top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op10_url_filter", urls.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page urls."""
    return urls.judge_urls(read(spark, sf_dir, "pages"))


@query("op6_winnowing", decontaminate.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that lie in a 10-word window of a benchmark item."""
    return decontaminate.digest(decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


@query("op4_bagminhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return neardup.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "keep")


@query("op1_license_scan", licenses.ORACLE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that are the whole text or a whole line of each document."""
    return licenses.scan(read(spark, sf_dir, "documents"), licenses.known_digests(spark))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    return language.predict(read(spark, sf_dir, "documents"))


@query("op8_quality_cnn")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from labels that are not held out."""
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned from labels that are not held out."""
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents at which the domains' expected tokens match the targets."""
    return mixing.mix_rates(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight first components of all vectors, in units of their deviation."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query("op12_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document by two tokenizers, with the links' counts in the corpus."""
    return alignment.digest(read(spark, sf_dir, "documents"))


@query("op11_parity_join", parity.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 3-word shingle sets that are alike by nine tenths."""
    return parity.jaccard_components(read(spark, sf_dir, "documents"))
