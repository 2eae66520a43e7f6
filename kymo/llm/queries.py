"""The operators applied to the given tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from kymo.llm import conversation, divergence, hadamard, hamming, language, minmax_dedup, mixing, packing, page_text, pitman_yor, sanitise, sql, token_counts, toxicity
from kymo.llm.common import table

TOKENIZER = "word_bpe_49k.json"
COUNTED_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_id(table(spark, folder, "documents"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokenizer_path())


def op3_pitman_yor_lm(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor.language_model(table(spark, folder, "documents"))


def op4_sainte_lague_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents")).drop("cuts")


def op5_divergence_quality(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.quality(table(spark, folder, "documents"))


def op6_sanitise(spark: SparkSession, folder: str) -> DataFrame:
    return sanitise.personal_data(table(spark, folder, "documents"))


def op7_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest sign codes of every row whose id is divisible by 100, among all rows."""
    codes = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code"))
    return hamming.nearest(codes, codes.filter(F.col("id") % 100 == 0))


def op8_minmax_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, folder, "documents"))


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.main_text(table(spark, folder, "pages"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_hadamard_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    return hadamard.clustered(table(spark, folder, "embeddings"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation.repaired(table(spark, folder, "conversations"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer_path(COUNTED_TOKENIZER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_best_fit_packing,
        op3_pitman_yor_lm,
        op4_sainte_lague_mix,
        op5_divergence_quality,
        op6_sanitise,
        op7_multi_index_hashing,
        op8_minmax_near_dedup,
        op9_main_text,
        op10_toxicity,
        op11_hadamard_kmeans,
        op12_conversation_repair,
        op13_token_counts,
    )
}
ORACLES: dict[str, str] = {
    "op11_hadamard_kmeans": sql.kmeans_sql(),
}
