"""Irregular and regular time series, long form, keyed by recording.

Times are bigint microseconds. ``pos`` is the bigint column rows are ordered by and
``order`` the total order consistent with it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kymo.functions.signal import any_nan
from kymo.operators.intervals import covered_points
from kymo.plans.lanes import (
    LANE,
    LANE_ROWS,
    Cuts,
    assign_lanes,
    attach,
    exact_median,
    matched,
    measure,
    ordered,
    spread_range,
)
from kymo.sources.store import kept

SECOND = 1_000_000


def _tie(pos: str, order: Sequence[str]) -> str | None:
    """The column that orders rows of one position."""
    return next((c for c in order if c != pos), None)


def _steps(
    df: DataFrame, keys: Sequence[str], pos: str, order: Sequence[str], t: str, cuts: Cuts
) -> DataFrame:
    return ordered(df, keys, pos, order, prev={"prev_t_": t}, cuts=cuts).withColumn(
        "step_", F.col(t) - F.col("prev_t_")
    )


def sampling_rate(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    pos: str,
    order: Sequence[str],
    rtol: float = 1e-3,
) -> DataFrame:
    """Rate in Hz from the median step, or the reason there is none.

    Status: ``too_few`` samples, ``not_increasing``, ``irregular`` (spread of the
    steps beyond ``rtol`` of the median), ``ok``.
    """
    cuts = measure(df, keys, pos, tie=_tie(pos, order))
    steps = _steps(df.select(*dict.fromkeys([*keys, t, pos, *order])), keys, pos, order, t, cuts)
    facts = [
        F.count(F.lit(1)).alias("n_samples"),
        F.min("step_").alias("least_"),
        F.max("step_").alias("most_"),
    ]
    if cuts.levels:
        steps = kept(steps.select(*keys, "step_"))
        stats = matched(steps.groupBy(*keys).agg(*facts), exact_median(steps, keys, "step_", "median_", cuts), keys)
    else:
        stats = steps.groupBy(*keys).agg(*facts, F.percentile("step_", F.lit(0.5)).alias("median_"))
    status = (
        F.when(F.col("n_samples") < 2, "too_few")
        .when(F.col("least_") <= 0, "not_increasing")
        .when((F.col("most_") - F.col("least_")) / F.col("median_") > rtol, "irregular")
        .otherwise("ok")
    )
    return (
        stats.withColumn("status", status)
        .withColumn("rate_hz", F.when(F.col("status") == "ok", F.lit(SECOND) / F.col("median_")))
        .drop("least_", "most_", "median_")
    )


def uniformity_check(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    pos: str,
    order: Sequence[str],
    atol: float = 0.01 * SECOND,
    rtol: float = 1e-3,
    period: float | None = None,
) -> DataFrame:
    """Are all steps close to the mean step (or to a fixed period)?

    The extremes decide for all steps, so one aggregate over them is enough.
    """
    cuts = measure(df, keys, pos, tie=_tie(pos, order))
    steps = _steps(df.select(*dict.fromkeys([*keys, t, pos, *order])), keys, pos, order, t, cuts)
    stats = steps.groupBy(*keys).agg(
        F.min("step_").alias("least_"),
        F.max("step_").alias("most_"),
        (F.sum("step_") / F.count("step_")).alias("mean_step"),
    )
    target = F.col("mean_step") if period is None else F.lit(float(period))
    allowed = F.lit(atol) + (F.lit(rtol) * target if period is None else F.lit(0.0))
    far = F.greatest(F.abs(F.col("least_") - target), F.abs(F.col("most_") - target))
    return stats.select(*keys, "mean_step", (far <= allowed).alias("is_uniform"))


def regular_time_axis(
    df: DataFrame, samples: str, rate: float, start: Column, out: str = "v"
) -> DataFrame:
    """Sample k of a regular series at start + k/rate; domain end at start + n/rate."""
    others = [c for c in df.columns if c != samples]
    period = SECOND / rate
    k = F.col("sample")
    return df.select(
        *others,
        start.alias("domain_start"),
        (start + F.floor(F.size(samples) * F.lit(period)).cast("bigint")).alias("domain_end"),
        F.posexplode(samples).alias("sample", out),
    ).withColumn("t", F.col("domain_start") + F.floor(k * F.lit(period)).cast("bigint"))


def auto_domain(df: DataFrame, keys: Sequence[str], t: str) -> DataFrame:
    """Domain of an irregular series: first to last stamp."""
    return df.groupBy(*keys).agg(F.min(t).alias("start"), F.max(t).alias("end"))


def sort_events(
    df: DataFrame, keys: Sequence[str], pos: str, order: Sequence[str], number: str = "idx"
) -> DataFrame:
    """Time order with attributes; ``number`` is the place in the recording from 0."""
    numbered = ordered(df, keys, pos, order, number=number)
    return numbered.withColumn(number, F.col(number) - 1).orderBy(*keys, number)


def _segments(flagged: DataFrame, keys: list[str], t: str, extra: Sequence[Column]) -> DataFrame:
    numbered = ordered(flagged, keys, t, sums={"segment": F.col("new_").cast("bigint")})
    return numbered.groupBy(*keys, "segment").agg(
        F.min(t).alias("start"), F.max(t).alias("last_"), *extra
    )


def segment_by_median_gap(
    df: DataFrame, keys: Sequence[str], t: str, factor: float = 2.0, single: int = 10_000
) -> DataFrame:
    """Split where a step exceeds twice the median; segments end one median later."""
    keys = list(keys)
    cuts = measure(df, keys, t)
    laned = assign_lanes(df.select(*keys, t), keys, t, cuts)
    steps = ordered(laned, keys, t, prev={"prev_t_": t}).withColumn(
        "step_", F.col(t) - F.col("prev_t_")
    )
    medians = exact_median(steps, keys, "step_", "median_", cuts)
    flagged = attach(steps, medians, keys, cuts).withColumn(
        "new_", F.coalesce(F.col("step_") > F.lit(factor) * F.col("median_"), F.lit(False))
    )
    pieces = _segments(flagged, keys, t, [F.first("median_").alias("median_")])
    tail = F.coalesce(F.floor(F.col("median_")).cast("bigint"), F.lit(single))
    return pieces.select(*keys, "segment", "start", (F.col("last_") + tail).alias("end"))


def segment_by_period(
    df: DataFrame, keys: Sequence[str], t: str, period: int, tolerance: int = 100
) -> DataFrame:
    """Split where a step exceeds the period by more than the tolerance."""
    keys = list(keys)
    laned = assign_lanes(df.select(*keys, t), keys, t)
    flagged = ordered(laned, keys, t, prev={"prev_t_": t}).withColumn(
        "new_",
        F.coalesce(F.col(t) - F.col("prev_t_") - F.lit(period) > tolerance, F.lit(False)),
    )
    pieces = _segments(flagged, keys, t, [])
    return pieces.select(*keys, "segment", "start", (F.col("last_") + tolerance).alias("end"))


def gradient(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    value: str,
    out: str,
    order: Sequence[str] | None = None,
    unit: float = SECOND,
    cuts: Cuts | None = None,
) -> DataFrame:
    """First derivative on uneven steps: second order inside, one-sided at the ends.

    ``keys`` name the segment. A lone sample has no derivative.
    """
    order = list(order or [t])
    seen = ordered(
        df,
        keys,
        t,
        order,
        prev={"pt_": t, "pv_": value},
        following={"nt_": t, "nv_": value},
        cuts=cuts,
    )
    behind = (F.col(t) - F.col("pt_")) / F.lit(float(unit))
    ahead = (F.col("nt_") - F.col(t)) / F.lit(float(unit))
    hs, hd = F.nullif(behind, F.lit(0.0)), F.nullif(ahead, F.lit(0.0))
    y = F.col(value)
    inner = (
        hs * hs * F.col("nv_") + (hd * hd - hs * hs) * y - hd * hd * F.col("pv_")
    ) / (hs * hd * (hd + hs))
    first = (F.col("nv_") - y) / hd
    last = (y - F.col("pv_")) / hs
    slope = F.when(F.col("pt_").isNull(), first).when(F.col("nt_").isNull(), last).otherwise(inner)
    return seen.withColumn(out, slope).drop("pt_", "pv_", "nt_", "nv_")


def _runs(df: DataFrame, keys: Sequence[str], pos: str, order: Sequence[str], mask: str, value: bool) -> DataFrame:
    """Number of every sample, of all samples, and of the nearest at or before and at or after it
    that has the value: what a run's ends say of all samples around them."""
    laned = df if LANE in df.columns else assign_lanes(df, keys, pos, tie=_tie(pos, order))
    numbered = ordered(laned, keys, pos, order, number="rn_", totals={"all_": F.lit(1)})
    mark = F.when(F.col(mask) == value, F.col("rn_"))
    return ordered(numbered, keys, pos, order, last_known={"before_": mark}, next_known={"after_": mark})


def dilate_mask(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    mask: str,
    k: int,
    out: str,
) -> DataFrame:
    """True if any of the ``k`` samples around is true; an unknown sample is not.

    Runs of true are widened at their ends, so the cost does not depend on ``k``.
    """
    before, after = (k - 1) // 2, k // 2
    near = _runs(df, keys, pos, order, mask, True)
    held = F.coalesce(F.col("rn_") - F.col("before_") <= before, F.lit(False))
    held = held | F.coalesce(F.col("after_") - F.col("rn_") <= after, F.lit(False))
    return near.withColumn(out, held).select(*df.columns, out)


def erode_mask(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    mask: str,
    k: int,
    out: str,
) -> DataFrame:
    """True if none of the ``k`` samples around is false; outside the series is false.

    Runs of false are widened at their ends, so the cost does not depend on ``k``.
    """
    before, after = k // 2, (k - 1) // 2
    near = _runs(df, keys, pos, order, mask, False)
    whole = F.coalesce(F.col("rn_") - F.col("before_") > before, F.lit(True))
    whole = whole & F.coalesce(F.col("after_") - F.col("rn_") > after, F.lit(True))
    whole = whole & (F.col("rn_") > before) & (F.col("rn_") + after <= F.col("all_"))
    return near.withColumn(out, whole).select(*df.columns, out)


def mask_to_intervals(df: DataFrame, keys: Sequence[str], t: str, mask: str) -> DataFrame:
    """Runs of true as intervals: from the sample before the run to its last sample."""
    keys = list(keys)
    laned = assign_lanes(df.select(*keys, t, mask), keys, t)
    seen = ordered(
        laned, keys, t, prev={"pt_": t, "pm_": mask}, following={"nm_": mask}
    ).filter(F.col(mask))
    edges = seen.withColumns(
        {
            "opens_": ~F.coalesce(F.col("pm_"), F.lit(False)),
            "closes_": ~F.coalesce(F.col("nm_"), F.lit(False)),
        }
    ).filter("opens_ or closes_")
    paired = ordered(edges, keys, t, following={"next_t_": t}).filter("opens_")
    return paired.select(
        *keys,
        F.coalesce("pt_", t).alias("start"),
        F.when(F.col("closes_"), F.col(t)).otherwise(F.col("next_t_")).alias("end"),
    )


def regularize_grid(
    df: DataFrame, keys: Sequence[str], t: str, value: str, period: int, tolerance: int
) -> DataFrame:
    """Full regular grid per recording, NaN where no sample falls.

    The first sample of a slot gives its value. ``n_samples`` above one and
    ``off_grid`` mark what strict callers reject.
    """
    keys = list(keys)
    cuts = measure(df, keys, t)
    laned = assign_lanes(df.select(*keys, t, value), keys, t, cuts)
    spans = laned.groupBy(*keys).agg(F.min(t).alias("t0_"), F.max(t).alias("tn_"))
    since = F.col(t) - F.col("t0_")
    placed = attach(laned, spans, keys, cuts).withColumn(
        "idx", F.bround(since / F.lit(period), 0).cast("bigint")
    )
    slots = placed.groupBy(*keys, "idx").agg(
        F.min_by(value, t).alias("found_"),
        F.count(F.lit(1)).alias("n_samples"),
        F.bool_or(F.abs(since - F.col("idx") * period) > tolerance).alias("off_grid"),
    )
    n = F.bround((F.col("tn_") - F.col("t0_")) / F.lit(period), 0).cast("bigint") + 1
    grid = spread_range(spans, keys, n, "idx")
    return grid.join(slots, [*keys, "idx"], "left").select(
        *keys,
        "idx",
        (F.col("t0_") + F.col("idx") * period).alias("t"),
        F.coalesce("found_", F.lit(float("nan"))).alias(value),
        F.coalesce("n_samples", F.lit(0)).alias("n_samples"),
        F.coalesce("off_grid", F.lit(False)).alias("off_grid"),
    )


def clock_resets(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    t: str,
    end: str | None = None,
    out: str = "block",
) -> DataFrame:
    """Block number: how often the clock ran backwards so far, in source order.

    For trials a start before the previous ``end`` counts as backwards.
    """
    laned = df if LANE in df.columns else assign_lanes(df, keys, pos, tie=_tie(pos, order))
    seen = ordered(laned, keys, pos, order, prev={"prev_": end or t})
    back = F.coalesce(F.col(t) < F.col("prev_"), F.lit(False)).cast("bigint")
    numbered = ordered(seen.withColumn("back_", back), keys, pos, order, sums={out: "back_"})
    dropped = ["prev_", "back_"] + ([] if LANE in df.columns else [LANE])
    return numbered.drop(*dropped)


def restitch_blocks(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    t: str,
    times: Sequence[str],
    gap: int = 60 * SECOND,
) -> DataFrame:
    """Shift block i to start ``gap`` after the shifted end of block i-1."""
    keys = list(keys)
    cuts = measure(df, keys, pos, tie=_tie(pos, order))
    laned = assign_lanes(df, keys, pos, cuts)
    blocks = clock_resets(laned, keys, pos, order, t)
    at = F.struct(*order)
    spans = blocks.groupBy(*keys, "block").agg(
        F.min_by(t, at).alias("first_"), F.max_by(t, at).alias("last_")
    )
    lengths = spans.withColumn("room_", F.col("last_") - F.col("first_") + gap)
    placed = ordered(
        lengths,
        keys,
        "block",
        sums={"upto_": "room_"},
        last_known={"origin_": F.when(F.col("block") == 0, F.col("first_"))},
        cuts=cuts.along(0, LANE_ROWS),
    )
    shift = F.col("origin_") + F.col("upto_") - F.col("room_") - F.col("first_")
    shifts = placed.select(*keys, "block", shift.alias("shift_"))
    moved = attach(blocks, shifts, [*keys, "block"])
    return moved.withColumns({c: F.col(c) + F.col("shift_") for c in times}).drop("shift_", LANE)


def drop_overlap_blocks(
    samples: DataFrame,
    skips: DataFrame,
    keys: Sequence[str],
    t: str,
    before_reset: Column | None = None,
) -> DataFrame:
    """Drop samples inside a skip interval (both ends count) that precede the reset."""
    flagged = covered_points(samples, skips, keys, t, closed=True, out="skip_")
    dropped = F.col("skip_") if before_reset is None else F.col("skip_") & before_reset
    return flagged.filter(~dropped).drop("skip_")


def exclude_misaligned_units(
    spikes: DataFrame, bounds: DataFrame, keys: Sequence[str], unit: str, t: str
) -> DataFrame:
    """Units whose every block lies inside the trial block of the same number."""
    extents = spikes.groupBy(*keys, unit, "block").agg(
        F.min(t).alias("first_"), F.max(t).alias("last_")
    )
    inside = (F.col("first_") >= F.col("start")) & (F.col("last_") <= F.col("end"))
    return (
        extents.join(bounds.select(*keys, "block", "start", "end"), [*keys, "block"], "left")
        .groupBy(*keys, unit)
        .agg(F.bool_and(F.coalesce(inside, F.lit(False))).alias("kept_"))
        .filter("kept_")
        .drop("kept_")
    )


def frame_to_time(
    df: DataFrame, stamps: DataFrame, keys: Sequence[str], t: str, columns: Sequence[str]
) -> DataFrame:
    """Replace frame numbers (from 0) by the stamp of that frame; unknown is null."""
    keys = list(keys)
    frames = ordered(stamps.select(*keys, t), keys, t, number="rn_").select(
        *keys, (F.col("rn_") - 1).alias("frame_"), F.col(t).alias("stamp_")
    )
    for c in columns:
        named = frames.withColumnsRenamed({"frame_": c, "stamp_": f"{c}_at_"})
        df = df.withColumn(c, F.col(c).cast("bigint")).join(named, [*keys, c], "left")
    for c in columns:
        df = df.drop(c).withColumnRenamed(f"{c}_at_", c)
    return df


def decimate_mean(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    value: str,
    factor: int = 4,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Mean of consecutive groups, tail dropped, first stamp kept."""
    numbered = ordered(df, keys, t, order, number="rn_")
    group = F.floor((F.col("rn_") - 1) / factor)
    return (
        numbered.groupBy(*keys, group.alias("group"))
        .agg(
            F.count(F.lit(1)).alias("n_"),
            F.min(t).alias(t),
            F.avg(value).alias(value),
        )
        .filter(F.col("n_") == factor)
        .drop("n_")
    )


def resample_linear(
    df: DataFrame, keys: Sequence[str], t: str, value: str, step: int
) -> DataFrame:
    """Linear interpolation on the grid t0, t0 + step, ... before the last stamp.

    Grid points and samples are scanned together; the nearest sample on each side
    is the last or next known one.
    """
    keys = list(keys)
    samples = df.select(*keys, F.col(t).alias("t"), F.col(value).alias("v_"))
    spans = samples.groupBy(*keys).agg(
        F.min("t").alias("t0_"), F.max("t").alias("tn_"), F.count(F.lit(1)).alias("n_")
    )
    n = F.ceil((F.col("tn_") - F.col("t0_")) / F.lit(step))
    sizes = spans.select(*keys, (F.col("n_") + F.greatest(n, F.lit(0))).alias("n_"))
    grid = spread_range(spans, keys, n, "idx").select(
        *keys, "idx", (F.col("t0_") + F.col("idx") * step).alias("t"), F.lit(1).alias("is_grid_")
    )
    marks = samples.select(
        *keys, "t", F.lit(0).alias("is_grid_"), F.struct("t", F.col("v_").alias("v")).alias("s_")
    ).unionByName(grid, allowMissingColumns=True)
    cuts = measure(marks, keys, "t", tie="is_grid_", stats=sizes)
    seen = ordered(
        marks,
        keys,
        "t",
        ["t", "is_grid_"],
        last_known={"a_": "s_"},
        next_known={"b_": "s_"},
        cuts=cuts,
    ).filter("is_grid_ = 1")
    slope = (F.col("b_.v") - F.col("a_.v")) / (F.col("b_.t") - F.col("a_.t"))
    between = F.col("a_.v") + slope * (F.col("t") - F.col("a_.t"))
    return seen.select(
        *keys,
        "idx",
        "t",
        F.when(F.col("a_.t") == F.col("t"), F.col("a_.v")).otherwise(between).alias(value),
    )


def drop_nan_samples(
    df: DataFrame, scalars: Sequence[str] = (), vectors: Sequence[str] = ()
) -> DataFrame:
    """Remove samples whose value, or any vector element, is NaN."""
    for c in scalars:
        df = df.filter(~F.isnan(c))
    for c in vectors:
        df = df.filter(~any_nan(F.col(c)))
    return df


def nan_pad_schema(
    frames: Sequence[DataFrame],
    base: Sequence[str],
    scalars: Sequence[str],
    planar: Sequence[str] = (),
) -> DataFrame:
    """Same columns for every session: absent or ill-sized fields become NaN.

    A planar array becomes two columns with suffixes ``_x`` and ``_y``.
    """
    nan = F.lit(float("nan"))

    def padded(frame: DataFrame) -> DataFrame:
        columns = [F.col(c) for c in base]
        for c in scalars:
            columns.append((F.col(c) if c in frame.columns else nan).cast("double").alias(c))
        for c in planar:
            for i, suffix in enumerate(("_x", "_y")):
                if c in frame.columns:
                    found = F.when(F.size(c) == 2, F.col(c)[i]).otherwise(nan)
                else:
                    found = nan
                columns.append(found.cast("double").alias(c + suffix))
        return frame.select(*columns)

    return reduce(DataFrame.unionByName, [padded(f) for f in frames])


def signal_wide(
    df: DataFrame,
    keys: Sequence[str],
    channel: str,
    samples: str,
    channels: Sequence[str],
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Channel-major arrays to sample-major rows, one column per kept channel."""
    kept = [c for c in channels if c not in set(ignore)]
    long = df.filter(F.col(channel).isin(kept)).select(
        *keys, channel, F.posexplode(samples).alias("sample", "v_")
    )
    return long.groupBy(*keys, "sample").pivot(channel, kept).agg(F.max("v_"))


def signal_long(
    df: DataFrame, keys: Sequence[str], channels: Sequence[str], value: str = "v"
) -> DataFrame:
    """Sample-major rows back to one row per sample and channel."""
    return df.unpivot([*keys, "sample"], list(channels), "channel", value)


def concat_recordings(
    parts: DataFrame,
    keys: Sequence[str],
    pos: str,
    started: str,
    n_samples: str,
    rate: float,
    channels: str,
    max_gap: int,
) -> DataFrame:
    """Place parts one after another by start time, with what a policy may reject.

    Any unknown start puts the whole group in input order and skips the time checks.
    ``gap_us`` is the pause since the previous part's end.
    """
    keys = list(keys)
    day = F.floor(F.col(started) / F.lit(86_400 * SECOND))
    facts = parts.groupBy(*keys).agg(
        F.bool_or(F.col(started).isNull()).alias("missing_date"),
        (F.min(day) != F.max(day)).alias("days_"),
        (F.min(channels) != F.max(channels)).alias("channel_mismatch"),
    )
    sizes = measure(parts, keys, pos)
    laned = assign_lanes(parts, keys, pos, sizes)
    known = attach(laned, facts, keys, sizes).drop(LANE)
    known = known.withColumn(
        "at_", F.when(F.col("missing_date"), F.col(pos)).otherwise(F.col(started))
    )
    cuts = measure(known, keys, "at_", tie=pos) if sizes.levels else sizes
    length = F.floor(F.col(n_samples) * F.lit(SECOND / rate)).cast("bigint")
    placed = ordered(
        known,
        keys,
        "at_",
        ["at_", pos],
        prev={"prev_end_": F.col(started) + length},
        sums={"upto_": n_samples},
        cuts=cuts,
    )
    gap = F.when(~F.col("missing_date"), F.col(started) - F.col("prev_end_"))
    return placed.select(
        *keys,
        pos,
        started,
        n_samples,
        (F.col("upto_") - F.col(n_samples)).alias("sample_offset"),
        gap.alias("gap_us"),
        F.coalesce(gap > max_gap, F.lit(False)).alias("gap_exceeded"),
        (F.coalesce("days_", F.lit(False)) & ~F.col("missing_date")).alias("day_mismatch"),
        "missing_date",
        "channel_mismatch",
    )


def fixed_width_distribution(
    df: DataFrame, keys: Sequence[str], vectors: Sequence[str], width: int
) -> DataFrame:
    """One row per cycle and bin of equally wide vectors; ill-sized cycles drop out.

    An absent source is an empty frame of the same schema and gives an empty result.
    """
    sized = df
    for c in vectors:
        sized = sized.filter(F.size(c) == width)
    zipped = F.arrays_zip(*[F.col(c) for c in vectors])
    return sized.select(*keys, F.posexplode(zipped).alias("bin", "b_")).select(
        *keys, "bin", *[F.col(f"b_.{c}").alias(c) for c in vectors]
    )
