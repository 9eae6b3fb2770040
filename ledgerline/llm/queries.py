"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (
    alignment,
    decontaminate,
    html_extract,
    line_dedup,
    oracles,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    token_files,
)
from ledgerline.llm.common import table

N_SHARDS = 40


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules with host verdicts over all documents."""
    out = quality_rules.judged(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc.doc_id", *[f"q.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "verdict.base_failed", "verdict.kept")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 contiguous shards of near equal bytes."""
    return sharding.byte_shards(table(spark, sf_dir, "documents"), N_SHARDS)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, radius 3."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), n=3, radius=3)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: base spans and those at learnt contexts."""
    return pii.found(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or with other numbers and names."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt from the labels that aren't held out."""
    return quality_classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-word passages that start in a smaller document."""
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"), window=50)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of all documents without the later copies of repeated runs of two or more lines, or of 50 words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(docs, min_lines=2).selectExpr("doc.doc_id", "n_lines", "n_removed", "rest AS text")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), capacity=1024, end_id=2)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequent words of all documents, each with the more frequent spelling that is one edit away."""
    return spelling.grouped(spelling.word_counts(table(spark, sf_dir, "documents"), min_length=6, min_count=5, slip=199), ratio=5)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of all documents, written to Re-Pair compressed files and read back from them."""
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' groups of byte-level and piece tokens, with the links' counts over the corpus."""
    return alignment.aligned(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_sharding": op2_sharding,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_html_extract": op9_html_extract,
    "op10_packing": op10_packing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_files": op12_token_files,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": oracles.OP1_QUALITY_RULES,
    "op7_substring_dedup": oracles.OP7_SUBSTRING_DEDUP,
    "op8_line_dedup": oracles.OP8_LINE_DEDUP,
}
