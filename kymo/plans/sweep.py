"""Boundary sweep: one pass over interval ends answers every set question."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymo.plans.lanes import LANE, Cuts, assign_lanes, measure, ordered


def _ends(df: DataFrame, keys: Sequence[str], a: int, b: int) -> DataFrame:
    edge = F.explode(
        F.array(
            F.struct(F.col("start").alias("t"), F.lit(1).alias("s")),
            F.struct(F.col("end").alias("t"), F.lit(-1).alias("s")),
        )
    )
    return df.filter(F.col("end") > F.col("start")).select(*keys, edge.alias("e_")).select(
        *keys,
        F.col("e_.t").alias("t"),
        (F.col("e_.s") * a).alias("da"),
        (F.col("e_.s") * b).alias("db"),
    )


def coverage_changes(
    a: DataFrame, b: DataFrame | None, keys: Sequence[str], cuts: Cuts | None = None
) -> DataFrame:
    """Cover counts of both sets from each boundary on, and just before it.

    Boundaries at one instant are summed first, so many equal ends shrink to one
    row before they are ordered.
    """
    ends = _ends(a, keys, 1, 0)
    if b is not None:
        ends = ends.unionByName(_ends(b, keys, 0, 1))
    if cuts is None:
        starts = a.select(*keys, "start")
        cuts = measure(
            starts if b is None else starts.unionByName(b.select(*keys, "start")), keys, "start"
        )
    steps = ends.groupBy(*keys, "t").agg(
        F.sum("da").cast("bigint").alias("da"), F.sum("db").cast("bigint").alias("db")
    )
    steps = assign_lanes(steps, keys, "t", cuts)
    covers = ordered(steps, keys, "t", sums={"cover_a": "da", "cover_b": "db"})
    return covers.withColumns(
        {
            "before_a": F.col("cover_a") - F.col("da"),
            "before_b": F.col("cover_b") - F.col("db"),
        }
    )


def sweep(
    a: DataFrame,
    b: DataFrame | None,
    keys: Sequence[str],
    inside: Callable[[Column, Column], Column],
    cuts: Cuts | None = None,
) -> DataFrame:
    """Pieces ``[start, end)`` where ``inside(cover_a, cover_b)`` holds.

    Result pieces are disjoint, sorted by construction, and merged where they
    touch. ``inside`` maps two cover-count columns to a boolean column.
    """
    keys = list(keys)
    covers = coverage_changes(a, b, keys, cuts)
    now: Column = inside(F.col("cover_a"), F.col("cover_b"))
    was: Column = inside(F.col("before_a"), F.col("before_b"))
    flips = covers.select(*keys, LANE, "t", now.alias("now_"), was.alias("was_")).filter(
        F.col("now_") != F.col("was_")
    )
    return (
        ordered(flips, keys, "t", following={"end": "t"})
        .filter("now_")
        .select(*keys, F.col("t").alias("start"), "end")
    )
