"""The corpus queries over the given tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsewatch.llm import host_rules as H
from pulsewatch.llm import source_audit as A
from pulsewatch.llm.brown_lm import brown_scores
from pulsewatch.llm.common import read_table
from pulsewatch.llm.decontaminate import matches
from pulsewatch.llm.html_text import main_texts
from pulsewatch.llm.jaccard_join import jaccard_components
from pulsewatch.llm.language_id import language_ids
from pulsewatch.llm.line_dedup import deduplicated
from pulsewatch.llm.quality_rank import quality_scores
from pulsewatch.llm.repeated_spans import without_repeats
from pulsewatch.llm.sentence_pieces import encoded
from pulsewatch.llm.sequence_packing import packed
from pulsewatch.llm.whitening import whitened


def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_scores(read_table(spark, sf_dir, "documents"), mod=7, held=2)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read_table(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(read_table(spark, sf_dir, "documents"), "doc_id", "text")


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.host_rules(read_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches: only documents that hold an item have rows."""
    found = matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", "similarity")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"), size=4, percent=85)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ids(read_table(spark, sf_dir, "documents"), mod=4, held=2)


def op8_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read_table(spark, sf_dir, "documents"), length=200)


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read_table(spark, sf_dir, "documents"), "doc_id")


def op10_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), mod=5, held=0)


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.divergences(read_table(spark, sf_dir, "documents"), least_docs=3, ranks=200)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"), count=16)


def op13_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of all pieces; their ids only go into the checksum."""
    return packed(read_table(spark, sf_dir, "documents"), capacity=2048, keep_ids=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_brown_lm, op2_html_text, op3_line_dedup, op4_host_rules, op5_decontaminate, op6_jaccard_join, op7_language_id,
                                    op8_repeated_spans, op9_sentence_pieces, op10_quality_rank, op11_source_audit, op12_whitening,
                                    op13_sequence_packing)}


def oracle_sql() -> dict[str, str]:
    """Statements for what SQL can express; the others are tested against plain versions, round trips or held-out rows."""
    return {"op4_host_rules": H.oracle(), "op11_source_audit": A.oracle()}
