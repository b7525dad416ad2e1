"""The numbered training-data queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streetpulse.llm import adapt_join, audit_repair, blob_ledger, chat_masks, disclosure, dual_rank, lang_bloom, line_quality, qgram_decon, soft_mix, suffix_levels, warc, wrappers
from streetpulse.llm.tables import table


def op1_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_roundtrip(spark, table(spark, sf_dir, "pages"))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_frequency(table(spark, sf_dir, "documents"))


def op3_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.personal_data(spark, table(spark, sf_dir, "documents"))


def op4_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return soft_mix.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_ledger.document_findings(spark, table(spark, sf_dir, "documents"))


def op6_offset_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    formatted = chat_masks.format_conversations(spark, given.unionByName(more))
    return chat_masks.read_back(formatted).drop("n_tokens", "n_loss_tokens")


def op7_bitmask_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_bloom.identify(spark, table(spark, sf_dir, "documents"))


def op8_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(spark, table(spark, sf_dir, "pages"))


def op9_adaptive_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt_join.jaccard_components(spark, table(spark, sf_dir, "documents"))


def op10_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qgram_decon.find_matches(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_levels.deduplicated(spark, table(spark, sf_dir, "documents"))


def op12_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_rank.ranked(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_persistent_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_repair.damaged_and_repaired(spark, table(spark, sf_dir, "conversations"))


LLM_QUERIES = {f.__name__: f for f in (op1_warc_segments, op2_line_frequency, op3_disclosure, op4_soft_mixing, op5_blob_ledger, op6_offset_masks,
                                      op7_bitmask_filters, op8_wrapper_induction, op9_adaptive_prefix_join,
                                      op10_qgram_decontamination, op11_suffix_levels, op12_dual_tree, op13_persistent_audit)}

LLM_ORACLE = {
    "op1_warc_segments": warc.WARC_SQL,
    "op2_line_frequency": line_quality.LINE_FREQUENCY_SQL,
    "op5_blob_ledger": blob_ledger.BLOB_LEDGER_SQL,
    "op6_offset_masks": chat_masks.CHAT_SQL,
    "op11_suffix_levels": suffix_levels.SPANS_SQL,
    "op12_dual_tree": dual_rank.RANK_SQL,
    "op13_persistent_audit": audit_repair.AUDIT_SQL,
}
