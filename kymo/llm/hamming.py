"""Exact k nearest binary codes by incremental multi-index hashing.

Codes are cut into segments, each with its own index. Around every query's segments the search
radius grows ring by ring. After radius r, all codes up to distance segments * (r + 1) - 1 have
been met; a query ends when its kth verified distance is within that bound.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kymo.llm.common import written

BITS = 64


@dataclass(frozen=True)
class Settings:
    """``segments`` None: as many as make a segment's values about as many as the codes."""

    k: int = 10
    segments: int | None = None


def sign_code(vector: Column) -> Column:
    """Bit i is set if component i is above zero; missing and null components are not."""
    places = F.sequence(F.lit(0), F.lit(BITS - 1))
    return F.aggregate(
        places,
        F.lit(0).cast("long"),
        lambda code, i: code.bitwiseOR(
            F.when(F.coalesce(F.get(vector, i), F.lit(0.0)) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
        ),
    )


def _cuts(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of every segment."""
    edges = [round(i * BITS / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _segments(code: str, cuts: list[tuple[int, int]]) -> Column:
    def one(i: int, at: int, width: int) -> Column:
        mask = (1 << width) - 1 if width < 64 else -1
        part = F.shiftrightunsigned(F.col(code), at).bitwiseAND(F.lit(mask).cast("long"))
        return F.struct(F.lit(i).alias("segment"), F.lit(width).alias("width"), part.alias("value"))

    return F.array(*(one(i, at, width) for i, (at, width) in enumerate(cuts)))


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))).cast("int")


def nearest(codes: DataFrame, queries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest rows of (id, code) per query.

    A query's own id is no neighbour. Ties go to the smaller id. Null ids and codes are left
    out; ids that repeat count once per code. With fewer than k others, all are returned.

    Equal codes are one class. As ties go by id, a class can give a query only its k + 1
    smallest ids, so a code that a third of all rows share costs no more than another.
    """
    need = settings.k + 1
    known = codes.filter("id is not null and code is not null").select("id", "code").distinct()
    first = Window.partitionBy("code", "salt").orderBy("id")
    salted = known.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64))).withColumn("r", F.row_number().over(first))
    few = salted.filter(F.col("r") <= need).groupBy("code").agg(F.slice(F.array_sort(F.collect_list("id")), 1, need).alias("ids"))
    held = written(few)
    size = held.count()
    m = settings.segments or max(1, min(8, round(BITS / max(8.0, math.log2(max(2, size))))))
    cuts = _cuts(m)
    index = written(held.select("code", F.explode(_segments("code", cuts)).alias("s")).select("code", "s.segment", "s.value"))
    asked = written(queries.filter("id is not null and code is not null").select(F.col("id").alias("query_id"), F.col("code").alias("query")).distinct())
    ring = written(
        asked.select("query").distinct().select("query", F.explode(_segments("query", cuts)).alias("s")).select("query", "s.segment", "s.width", "s.value", F.lit(0).alias("next"))
    )
    found: DataFrame | None = None
    done: DataFrame | None = None
    counts = held.select("code", F.size("ids").alias("n"))
    least = min(need, size and held.agg(F.sum(F.size("ids"))).first()[0] or 0)
    radius = 0
    while not ring.isEmpty():
        met = ring.join(index, ["segment", "value"]).select("query", "code").distinct()
        met = met.join(counts, "code").withColumn("distance", distance("query", "code"))
        if found is not None:
            met = met.unionByName(found).distinct()
        met = written(met)
        # the distance at which k + 1 rows are reached, from counts per distance
        steps = met.groupBy("query", "distance").agg(F.sum("n").alias("n"))
        line = Window.partitionBy("query").orderBy("distance").rowsBetween(Window.unboundedPreceding, 0)
        reach = steps.withColumn("upto", F.sum("n").over(line)).filter(F.col("upto") >= least).groupBy("query").agg(F.min("distance").alias("reach"))
        state = written(met.join(reach, "query", "left"))
        covered = m * (radius + 1) - 1
        full = (F.col("reach") <= covered) if radius < max(w for _, w in cuts) else F.lit(True)
        finished = written(state.filter(full & (F.col("reach").isNull() | (F.col("distance") <= F.col("reach")))).select("query", "code", "distance"))
        done = finished if done is None else done.unionByName(finished)
        found = state.filter(F.col("reach").isNull() | (F.col("distance") <= F.col("reach"))).select("query", "code", "n", "distance").join(finished.select("query").distinct(), "query", "left_anti")
        place = F.explode(F.sequence(F.col("next"), F.col("width") - 1))
        ring = written(
            ring.join(finished.select("query").distinct(), "query", "left_anti")
            .filter(F.col("next") < F.col("width"))
            .withColumn("bit", place)
            .select(
                "query",
                "segment",
                "width",
                F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("value"),
                (F.col("bit") + 1).alias("next"),
            )
        )
        radius += 1
    if done is None:
        return asked.select("query_id", F.lit(0).alias("rank"), F.col("query_id").alias("neighbour_id"), F.lit(0).alias("distance"))
    pairs = (
        asked.join(done, "query")
        .join(held, "code")
        .select("query_id", "distance", F.explode("ids").alias("neighbour_id"))
        .filter("query_id <> neighbour_id")
    )
    order = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return (
        pairs.groupBy("query_id", "neighbour_id").agg(F.min("distance").alias("distance"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= settings.k)
        .select("query_id", "rank", "neighbour_id", "distance")
    )
