"""Interval algebra per recording.

Intervals are half-open ``[start, end)`` rows, bigint microseconds, under the key
columns. Set operations return disjoint pieces without attributes; pieces that
touch are merged and empty intervals vanish.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymo.plans.lanes import Cuts, measure, ordered, spread_range
from kymo.plans.sweep import sweep


def measure_times(frames: Sequence[tuple[DataFrame, str]], keys: Sequence[str]) -> Cuts:
    """Cuts for all of several frames together, each with its time column."""
    stacked = reduce(
        DataFrame.unionByName, [df.select(*keys, F.col(t).alias("t_")) for df, t in frames]
    )
    return measure(stacked, keys, "t_")


def interval_union(
    a: DataFrame, b: DataFrame | None, keys: Sequence[str], cuts: Cuts | None = None
) -> DataFrame:
    """Coverage of ``a`` or ``b``; with one argument, the merged form of ``a``."""
    both = a if b is None else a.select(*keys, "start", "end").unionByName(
        b.select(*keys, "start", "end")
    )
    return sweep(both, None, keys, lambda x, _: x > 0, cuts)


def interval_intersection(
    a: DataFrame, b: DataFrame, keys: Sequence[str], cuts: Cuts | None = None
) -> DataFrame:
    """Coverage of ``a`` and ``b``."""
    return sweep(a, b, keys, lambda x, y: (x > 0) & (y > 0), cuts)


def interval_difference(
    a: DataFrame, b: DataFrame, keys: Sequence[str], cuts: Cuts | None = None
) -> DataFrame:
    """Coverage of ``a`` without ``b``."""
    return sweep(a, b, keys, lambda x, y: (x > 0) & (y == 0), cuts)


def interval_dilate(a: DataFrame, keys: Sequence[str], by: int) -> DataFrame:
    """Widen every interval on both sides, then merge."""
    wide = a.withColumns({"start": F.col("start") - by, "end": F.col("end") + by})
    return interval_union(wide, None, keys)


def interval_subdivide(df: DataFrame, step: int, keep_short: bool = False) -> DataFrame:
    """Cut intervals into steps; the short rest is dropped unless asked for.

    Attributes are copied to each step.
    """
    length = F.col("end") - F.col("start")
    pieces = F.ceil(length / F.lit(step)) if keep_short else F.floor(length / F.lit(step))
    first = F.col("start")
    steps = spread_range(df, ["start", "end"], pieces, "step_")
    return steps.withColumns(
        {
            "start": first + F.col("step_") * step,
            "end": F.least(first + (F.col("step_") + 1) * step, F.col("end")),
        }
    ).drop("step_")


def interval_select(df: DataFrame, mask: Column) -> DataFrame:
    """Intervals where the mask holds, attributes kept."""
    return df.filter(mask)


def interval_min_duration(df: DataFrame, longer_than: int) -> DataFrame:
    """Intervals strictly longer than the limit."""
    return df.filter(F.col("end") - F.col("start") > longer_than)


def interval_sort(
    df: DataFrame, keys: Sequence[str], ties: Sequence[str] = (), number: str = "idx"
) -> DataFrame:
    """Order by start within the recording; ``number`` counts from 0."""
    numbered = ordered(df, keys, "start", ["start", "end", *ties], number=number)
    return numbered.withColumn(number, F.col(number) - 1).orderBy(*keys, number)


def interval_checks(
    df: DataFrame, keys: Sequence[str], pos: str, order: Sequence[str]
) -> DataFrame:
    """Per recording: are starts non-decreasing in source order, are pieces disjoint."""
    in_source = ordered(
        df.select(*keys, *dict.fromkeys([pos, *order, "start", "end"])),
        keys,
        pos,
        order,
        prev={"prev_start_": "start"},
    ).groupBy(*keys).agg(
        F.coalesce(F.bool_and(F.col("prev_start_") <= F.col("start")), F.lit(True)).alias(
            "is_sorted"
        )
    )
    in_time = ordered(
        df.select(*keys, "start", "end"),
        keys,
        "start",
        ["start", "end"],
        earlier_max={"reach_": "end"},
    ).groupBy(*keys).agg(
        F.coalesce(F.bool_and(F.col("reach_") <= F.col("start")), F.lit(True)).alias(
            "is_disjoint"
        )
    )
    return in_source.join(in_time, list(keys))


def interval_linspace(df: DataFrame, n: int, number: str = "block") -> DataFrame:
    """``n`` equal blocks from start to end of every row."""
    length = F.col("end") - F.col("start")

    def cut(i: Column) -> Column:
        return F.col("start") + F.floor(length * i / F.lit(n)).cast("bigint")

    return df.withColumn(number, F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(
        *[c for c in df.columns if c not in ("start", "end")],
        number,
        cut(F.col(number)).alias("start"),
        cut(F.col(number) + 1).alias("end"),
    )


def interval_stab(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str = "t",
    cuts: Cuts | None = None,
) -> DataFrame:
    """The interval holding each point: ``start <= t < end``, smallest start first.

    Adds ``hit_start``/``hit_end``, null when there is none. An interval that starts
    later and ends no later than another is never the answer; without those, starts
    and ends rise together, so the answer is the first end after the point. That is
    one ordered scan instead of a range join.
    """
    keys = list(keys)
    cuts = measure_times([(points, at), (intervals, "end")], keys) if cuts is None else cuts
    spans = (
        intervals.filter(F.col("end") > F.col("start"))
        .groupBy(*keys, "start")
        .agg(F.max("end").alias("end"))
    )
    spans = ordered(spans, keys, "start", earlier_max={"reach_": "end"}, cuts=cuts).filter(
        F.col("reach_").isNull() | (F.col("end") > F.col("reach_"))
    )
    data = [c for c in points.columns if c not in keys]
    marks = points.select(
        *keys,
        F.col(at).alias("at_"),
        F.lit(1).alias("is_point_"),
        F.struct(*data).alias("row_"),
        F.lit(None).cast("struct<start:bigint,end:bigint>").alias("span_"),
    ).unionByName(
        spans.select(
            *keys,
            F.col("end").alias("at_"),
            F.lit(0).alias("is_point_"),
            F.struct("start", "end").alias("span_"),
        ),
        allowMissingColumns=True,
    )
    scanned = ordered(
        marks, keys, "at_", ["at_", "is_point_"], next_known={"next_": "span_"}, cuts=cuts
    ).filter("is_point_ = 1")
    holds = F.col("next_.start") <= F.col("at_")
    return scanned.select(
        *keys,
        "row_.*",
        F.when(holds, F.col("next_.start")).alias("hit_start"),
        F.when(holds, F.col("next_.end")).alias("hit_end"),
    )


def covered_points(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str = "t",
    closed: bool = False,
    out: str = "covered",
) -> DataFrame:
    """Flag the points that lie in any interval (``closed``: the end counts too)."""
    keys = list(keys)
    cuts = measure_times([(points, at), (intervals, "start")], keys)
    data = [c for c in points.columns if c not in keys]
    edge = F.explode(
        F.array(
            F.struct(F.col("start").alias("at_"), F.lit(0).alias("kind_"), F.lit(1).alias("step_")),
            F.struct(
                F.col("end").alias("at_"),
                F.lit(2 if closed else 0).alias("kind_"),
                F.lit(-1).alias("step_"),
            ),
        )
    )
    edges = (
        intervals.select(*keys, edge.alias("e_"))
        .select(*keys, "e_.*")
        .groupBy(*keys, "at_", "kind_")
        .agg(F.sum("step_").alias("step_"))
    )
    marks = points.select(
        *keys,
        F.col(at).alias("at_"),
        F.lit(1).alias("kind_"),
        F.lit(0).cast("bigint").alias("step_"),
        F.struct(*data).alias("row_"),
    ).unionByName(edges, allowMissingColumns=True)
    return (
        ordered(marks, keys, "at_", ["at_", "kind_"], sums={"cover_": "step_"}, cuts=cuts)
        .filter("kind_ = 1")
        .select(*keys, "row_.*", (F.col("cover_") > 0).alias(out))
    )


def interval_coverage(
    blocks: DataFrame,
    domain: DataFrame,
    keys: Sequence[str],
    ids: Sequence[str],
    out: str = "covered_us",
    cuts: Cuts | None = None,
) -> DataFrame:
    """Covered time of each block (``ids`` name a block within its recording).

    The covered time up to ``t`` is (ends passed - starts passed + t while inside),
    so a block needs two readings of one running sum and no join with the domain.
    """
    keys, ids = list(keys), list(ids)
    if cuts is None:
        cuts = measure_times([(blocks, "start"), (domain, "start")], keys)
    pieces = interval_union(domain, None, keys, cuts)
    wide = "decimal(20,0)"
    readings = blocks.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("start").alias("t"), F.lit(-1).alias("sign_")),
                F.struct(F.col("end").alias("t"), F.lit(1).alias("sign_")),
            )
        ).alias("p_"),
        F.struct(*ids, "start", "end").alias("block_"),
    ).select(
        *keys,
        "p_.*",
        "block_",
        F.lit(0).alias("open_"),
        F.lit(0).cast(wide).alias("passed_"),
    )
    edges = pieces.select(
        *keys,
        F.explode(
            F.array(
                F.struct(
                    F.col("start").alias("t"),
                    F.lit(1).alias("open_"),
                    (-F.col("start")).cast(wide).alias("passed_"),
                ),
                F.struct(
                    F.col("end").alias("t"),
                    F.lit(-1).alias("open_"),
                    F.col("end").cast(wide).alias("passed_"),
                ),
            )
        ).alias("p_"),
    ).select(*keys, "p_.*", F.lit(0).alias("sign_"))
    scanned = ordered(
        readings.unionByName(edges, allowMissingColumns=True),
        keys,
        "t",
        ["t", "sign_"],
        sums={"inside_": "open_", "passed_sum_": "passed_"},
        cuts=cuts,
    ).filter("sign_ <> 0")
    upto = F.col("passed_sum_") + (F.col("inside_") * F.col("t")).cast(wide)
    return (
        scanned.groupBy(*keys, "block_")
        .agg(F.sum(upto * F.col("sign_")).cast("bigint").alias(out))
        .select(*keys, "block_.*", out)
    )


def data_auto_domain(members: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Domain of a bundle: the union of its members' domains."""
    stacked = reduce(
        DataFrame.unionByName, [m.select(*keys, "start", "end") for m in members]
    )
    return interval_union(stacked, None, keys)
