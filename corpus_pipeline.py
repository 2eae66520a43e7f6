"""A training corpus from documents: toxicity, near duplicates, personal data, mix, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kymo.llm import minmax_dedup, mixing, packing, sanitise, toxicity
from kymo.llm.common import ship, table, written
from kymo.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# Without a contract of its own, this stage takes five words and 80 percent, unlike the op8 query.
# 38 bands of 5: a pair at 0.80 is missed with probability below 1e-6, and the agreement is over
# five standard deviations below.
NEAR = minmax_dedup.Settings(shingle=5, percent=80, permutations=95, rows=5, agreement=0.63)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic.

    A null text is scored as an empty one. Rows that repeat an id go if any of them is rejected.
    Columns stay as they are; an empty table stays empty.
    """
    ship(spark)
    found = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    rejected = found.filter("predicted = 1").select(F.col("doc_id").alias("_doc")).distinct()
    return docs.join(rejected, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Of rows that repeat an id and a text one stays, the least by the other columns. Documents
    without words are near copies of nothing and stay, and so do texts without an id. Different
    texts under one id stay or go together. An empty table stays empty.
    """
    ship(spark)
    kept = minmax_dedup.near_duplicates(docs, NEAR).filter("kept").select(F.col("doc_id").alias("_doc")).distinct()
    left = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    repeat = F.row_number().over(Window.partitionBy("doc_id", F.md5("text")).orderBy(*(others or ["doc_id"])))
    return left.withColumn("_repeat", repeat).filter("_repeat = 1").drop("_repeat")


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data and the terms that give it away are replaced.

    A null text stays null; rows that repeat change alike; an empty table stays empty.
    """
    return sanitise.sanitised(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: whole documents once or twice, and cuts.

    Documents without words are taken by no source; a null source is one of its own, last in
    order. An empty table stays empty.
    """
    return mixing.applied(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix and their places in sequences.

    A null or empty text is one piece of the closing id; rows that repeat are packed each.
    """
    ship(spark)
    return packing.packed(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", hide_personal_data),
    ("mix", mix_sources),
    ("packing", pack),
]

# Compression, tokenisation and confirmed links are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each reading what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
