"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets follow the sources' weights, capped at a multiple of each source's size. Blocks of equal
token counts go to sources by highest quotients, and each source's blocks to its shards in the
same way. A shard is its documents in seeded order; its quota takes whole passes over the shard
and one seeded run of blocks. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kymo.llm.common import SPACE, WORD, written


@dataclass(frozen=True)
class Settings:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    cap: int = 2
    block: int = 16
    shard: int = 1_000_000
    seed: str = "mix-1"


def draw(*parts: Column) -> Column:
    """A seeded 32-bit number from the parts' digest."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("~")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, settings: Settings) -> DataFrame:
    """Adds rank (by code point, null last), weight and target to one row per source.

    Capping all sources whose cap falls short of their share of what is left raises the common
    level; the sources in order of cap per weight reach it in one pass.
    """
    every = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())))
    weights = F.array(*(F.lit(float(w)) for w in settings.weights))
    ranked = ranked.withColumn("weight", F.element_at(weights, (F.pmod(F.col("rank") - 1, F.lit(len(settings.weights))) + 1).cast("int")))
    ranked = ranked.withColumn("cap", settings.cap * F.col("source_size")).withColumn("level", F.col("cap") / F.col("weight"))
    line = Window.partitionBy(F.lit(0)).orderBy("level", "rank")
    before = F.coalesce(F.sum("cap").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("total", F.sum("source_size").over(every))
    ranked = ranked.withColumn("try", (settings.share * F.col("total") - before) / after).withColumn("place", F.row_number().over(line))
    found = F.min(F.when(F.col("try") <= F.col("level"), F.struct("place", "try"))).over(every)
    return (
        ranked.withColumn("common", found["try"])
        .withColumn("target", F.coalesce(F.least(F.col("common") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double")))
        .select("source", "rank", "source_size", "target")
    )


def apportion(frame: DataFrame, group: str, key: str, share: str, seats: str) -> DataFrame:
    """Adds ``quota``: the group's seats by highest quotients share / (2k + 1), ties by key.

    Rounding at the ideal divisor leaves d seats over or short among n rows. No row differs from
    its final quota by more than its part of d + n and one, so only those quotients are ranked:
    a number of rows that grows with n, not with the seats.
    """
    w = Window.partitionBy(group)
    part = F.when(F.col("_sum") > 0, F.col(share) / F.col("_sum")).otherwise(0.0)
    frame = frame.withColumn("_sum", F.sum(share).over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
    frame = frame.withColumn("_q", F.floor(part * F.col(seats) + 0.5)).withColumn("_d", F.when(F.col("_sum") > 0, F.col(seats) - F.sum("_q").over(w)).otherwise(0))
    steps = (F.ceil(part * (F.abs("_d") + F.col("_n"))) + 1).cast("long")
    over = F.col("_d") > 0
    tried = (
        frame.filter("_d <> 0")
        .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), steps)))
        .withColumn("_k", F.when(over, F.col("_q") + F.col("_i") - 1).otherwise(F.col("_q") - F.col("_i")))
        .filter("_k >= 0")
        .withColumn("_v", F.col(share) / (2 * F.col("_k") + 1))
    )
    first = Window.partitionBy(group).orderBy(
        F.when(over, -F.col("_v")).otherwise(F.col("_v")), F.when(over, F.col(key)).otherwise(-F.col(key)), "_k"
    )
    moved = (
        tried.withColumn("_r", F.row_number().over(first))
        .filter(F.col("_r") <= F.abs("_d"))
        .groupBy(group, key)
        .agg(F.sum(F.signum("_d")).cast("long").alias("_m"))
    )
    return (
        frame.join(moved, [group, key], "left")
        .withColumn("quota", (F.col("_q") + F.coalesce("_m", F.lit(0))).cast("long"))
        .drop("_sum", "_n", "_q", "_d", "_m")
    )


def _overlap(start: Column, end: Column) -> tuple[Column, Column]:
    low = F.greatest(start, F.col("first"))
    return low, F.greatest(low, F.least(end, F.col("last")))


def mixed(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, passes, cuts.

    ``passes`` counts whole copies; ``cuts`` are the word ranges [from, to) taken once more.
    Null texts have size 0 and are never taken; a null source is a source of its own, the last.
    Rows that repeat are taken each; equal draws fall back on doc_id and size. Quotas are capped
    at ``cap`` passes, so no document is taken more often. An empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = written(documents.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size")))
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), settings)
    blocks = F.floor(F.sum("target").over(Window.partitionBy("all")) / settings.block + 0.5)
    sources = apportion(sources.withColumn("all", F.lit(0)).withColumn("blocks", blocks), "all", "rank", "target", "blocks")
    sources = written(sources.select(F.col("source").alias("_source"), "rank", "source_size", "target", F.col("quota").alias("source_quota")))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / settings.shard))
    dealt = written(
        sized.join(sources, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("draw", draw(F.lit(settings.seed), F.col("doc_id"), F.col("size")))
        .withColumn("shard", F.pmod(draw(F.lit("shard"), F.lit(settings.seed), F.col("doc_id")), shards))
        .drop("source", "_source")
    )
    held = dealt.groupBy("rank", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
    held = apportion(held, "rank", "shard", "shard_size", "source_quota")
    length = F.ceil(F.col("shard_size") / settings.block)
    held = held.withColumn("n", length).withColumn("quota", F.least("quota", settings.cap * F.col("n")))
    held = held.withColumn("passes", F.when(F.col("n") > 0, F.floor(F.col("quota") / F.col("n"))).otherwise(0))
    held = held.withColumn("more", F.col("quota") - F.col("passes") * F.col("n"))
    held = held.withColumn("turn", F.when(F.col("n") > 0, F.pmod(draw(F.lit("turn"), F.lit(settings.seed), F.col("rank"), F.col("shard")), F.col("n"))).otherwise(0))
    held = held.select("rank", "shard", "n", "passes", "more", "turn")
    line = Window.partitionBy("rank", "shard").orderBy("draw", "doc_id", "size")
    placed = (
        dealt.join(written(held), ["rank", "shard"])
        .withColumn("last", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("first", F.col("last") - F.col("size"))
    )
    start = F.col("turn") * settings.block
    end = start + F.col("more") * settings.block
    ring = F.col("n") * settings.block
    a, b = _overlap(start, end)
    c, d = _overlap(start - ring, end - ring)
    word = "long"
    cuts = F.array(
        *(F.struct((x - F.col("first")).cast(word).alias("from"), (y - F.col("first")).cast(word).alias("to")) for x, y in ((c, d), (a, b)))
    )
    return (
        placed.withColumn("cuts", F.filter(cuts, lambda x: x["to"] > x["from"]))
        .withColumn("taken", (F.col("passes") * F.col("size") + F.aggregate("cuts", F.lit(0).cast("long"), lambda s, x: s + x["to"] - x["from"])).cast("long"))
        .select("doc_id", "size", "source_size", "target", "taken", F.col("passes").cast("long").alias("passes"), "cuts")
    )


def applied(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The mix itself, with the columns of the documents: whole copies, and the cuts of the others.

    A document that occurs twice in the input with one doc_id and size is one in the mix's plan
    for each of its rows; rows are matched by doc_id and size.
    """
    plan = mixed(documents, settings).filter("taken > 0")
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    plan = plan.select(F.col("doc_id").alias("_doc"), F.col("size").alias("_size"), "passes", "cuts")
    plan = plan.dropDuplicates(["_doc", "_size"])
    joined = documents.withColumn("_words", size).join(plan, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_words") == F.col("_size")))
    whole = F.array_repeat(F.col("text").cast("string"), F.col("passes").cast("int"))
    # words with the white space before them, so that a cut keeps the text's lines
    spaced = F.regexp_extract_all("text", F.lit(f"[{SPACE}]*{WORD}"), F.lit(0))
    part = F.transform("cuts", lambda c: F.array_join(F.slice(spaced, (c["from"] + 1).cast("int"), (c["to"] - c["from"]).cast("int")), ""))
    out = joined.withColumn("_text", F.explode(F.concat(whole, F.when(F.size("cuts") > 0, part).otherwise(F.array().cast("array<string>")))))
    found = {c: F.col(c) for c in documents.columns}
    found["text"] = F.col("_text")
    if "n_chars" in found:
        found["n_chars"] = F.length("_text").cast(dict(documents.dtypes)["n_chars"])
    return out.select(*(column.alias(name) for name, column in found.items()))
