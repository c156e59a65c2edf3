"""Queries of the operators, each over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_tree, decontamination, divergence, html_extraction, language_id, line_dedup, mixing, ngram_join, periodic_runs, pii, quality_rules, substring_dedup, toxicity
from .common import crc_mod, table

#: The made-up conversation: its texts are the template's own control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.found(docs, pii.fit(docs))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predicted(docs, language_id.fit(docs.where(crc_mod("doc_id", 3) != 1)))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], rows.schema)
    convs, packs = chat_tree.formatted(rows.unionByName(made))
    return convs.join(chat_tree.read_back(packs), "path_id").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_out(table(spark, sf_dir, "documents")).drop("kept")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, lines, gone = line_dedup.without_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", lines.alias("n_lines"), gone.alias("n_removed"), "text")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(table(spark, sf_dir, "documents"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extraction.extracted(pages, html_extraction.fit(pages))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.detected(table(spark, sf_dir, "documents"), periodic_runs.looped, texts=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii, op2_language_id, op3_decontamination, op4_chat_tree, op5_toxicity, op6_substring_dedup, op7_mixing, op8_ngram_join, op9_quality_rules, op10_line_dedup,
        op11_divergence, op12_html_extraction, op13_periodic_runs,
    )
}

ORACLES: dict[str, str] = {
    "op3_decontamination": decontamination.oracle(),
    "op4_chat_tree": chat_tree.oracle(f"values (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')"),
    "op7_mixing": mixing.oracle(),
    "op8_ngram_join": ngram_join.oracle(),
    "op9_quality_rules": quality_rules.oracle(),
    "op11_divergence": divergence.oracle(),
    "op12_html_extraction": html_extraction.oracle(),
}
