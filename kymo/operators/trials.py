"""Trials, stimuli and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymo.operators.intervals import interval_difference
from kymo.operators.series import frame_to_time
from kymo.plans.lanes import ordered

SECOND = 1_000_000

# Stimuli of each session type, class ids of grating values, pixel
# sizes of the two sparse-noise tables, and stage codes.
SESSION_STIMULI = {
    "three_session_A": ("drifting_gratings", "natural_movie_one", "natural_movie_three"),
    "three_session_B": ("natural_movie_one", "natural_scenes", "static_gratings"),
    "three_session_C": ("natural_movie_one", "natural_movie_two", "locally_sparse_noise"),
    "three_session_C2": ("natural_movie_one", "natural_movie_two", "locally_sparse_noise"),
}
ORIENTATION_STEP_8, ORIENTATION_STEP_12 = 45.0, 30.0
TEMPORAL_FREQUENCIES = (1.0, 2.0, 4.0, 8.0, 15.0)
SPATIAL_FREQUENCIES = (0.02, 0.04, 0.08, 0.16, 0.32)
PHASES = (0.0, 90.0, 180.0, 270.0)
PIXEL_SIZES = (4.65, 9.3)
STAGE_CODES = {
    "Sleep stage W": 0,
    "Sleep stage 1": 1,
    "Sleep stage 2": 2,
    "Sleep stage 3": 3,
    "Sleep stage 4": 4,
    "Sleep stage R": 5,
    "Sleep stage ?": 6,
    "Movement time": 7,
}


def trials_from_table(
    df: DataFrame, start: str, end: str, time_columns: Sequence[str] = ()
) -> DataFrame:
    """Source columns renamed to start/end; all time columns marked as such."""
    out = df.withColumnsRenamed({start: "start", end: "end"})
    for c in ("start", "end", *time_columns):
        out = out.withMetadata(c, {"time": True})
    return out


def shift_times(df: DataFrame, by: Column | int) -> DataFrame:
    """Shift every column that is marked as time."""
    by = F.lit(by) if isinstance(by, int) else by
    marked = [f.name for f in df.schema.fields if f.metadata.get("time")]
    out = df.withColumns({c: F.col(c) + by for c in marked})
    for c in marked:
        out = out.withMetadata(c, {"time": True})
    return out


def success_validity(discarded: Column, success: Column) -> Column:
    """Not discarded and successful."""
    return (discarded == 0) & (success == 1)


def center_out_validity(result: Column, target: Column, length: Column) -> Column:
    """Rewarded, target known, longer than 0.5 s and shorter than 6 s."""
    known = target.isNotNull()
    return (result == "R") & known & (length > SECOND // 2) & (length < 6 * SECOND)


def random_target_validity(result: Column, attempts: Column, length: Column) -> Column:
    """Rewarded, four attempts, longer than 2 s and shorter than 10 s."""
    return (result == "R") & (attempts == 4) & (length > 2 * SECOND) & (length < 10 * SECOND)


def trial_bounds_from_next(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    target_on: str,
    start: str,
    stop: str,
    domain_end: str,
) -> DataFrame:
    """A trial runs from its target onset to the next one.

    A missing onset falls back to the first start, or to one second after the
    previous stop but not past its own stop; the last trial ends one second after
    its stop but not past the domain. A bound that rests on an unknown stop is null.
    One pass: both neighbours are read together.
    """
    seen = ordered(
        df,
        keys,
        pos,
        order,
        prev={"before_": stop, "earlier_": F.lit(True)},
        following={"next_on_": target_on, "next_stop_": stop, "later_": F.lit(True)},
    )

    def smaller(a: Column, b: Column) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))

    later = smaller(F.col("before_") + SECOND, F.col(stop))
    own = F.when(F.col("earlier_").isNull(), F.col(start)).otherwise(later)
    following = F.coalesce(
        F.col("next_on_"), smaller(F.col(stop) + SECOND, F.col("next_stop_"))
    )
    last = smaller(F.col(stop) + SECOND, F.col(domain_end))
    return seen.withColumns(
        {
            "trial_start": F.coalesce(F.col(target_on), own),
            "trial_end": F.when(F.col("later_").isNull(), last).otherwise(following),
        }
    ).drop("before_", "earlier_", "next_on_", "next_stop_", "later_")


def movement_phases(
    df: DataFrame,
    keys: Sequence[str],
    valid: str,
    phases: Mapping[str, tuple[str, str]],
    start: str = "start",
    end: str = "end",
) -> DataFrame:
    """Phases of valid trials, and whole invalid trials, as one long table."""
    def piece(name: str, a: str, b: str) -> Column:
        return F.struct(
            F.lit(name).alias("phase"), F.col(a).alias("start"), F.col(b).alias("end")
        )

    good = F.array(*[piece(name, a, b) for name, (a, b) in phases.items()])
    pieces = F.when(F.col(valid), good).otherwise(F.array(piece("invalid", start, end)))
    return df.select(*keys, F.explode(pieces).alias("p_")).select(*keys, "p_.*")


def random_period(domain: DataFrame, phases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What no phase covers."""
    return interval_difference(domain, phases.select(*keys, "start", "end"), keys)


def phases_minus_outliers(
    phases: DataFrame, outliers: DataFrame, keys: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Every phase without the outlier intervals; ``names`` lists the phases."""
    each = outliers.select(
        *keys, F.explode(F.array(*map(F.lit, names))).alias("phase"), "start", "end"
    )
    kept = phases.filter(F.col("phase").isin(list(names)))
    return interval_difference(kept, each, [*keys, "phase"])


def stimuli_by_session_type(df: DataFrame, session_type: str) -> DataFrame:
    """One row per session and applicable stimulus; an unknown type keeps a null row."""
    entries = [
        x for k, v in SESSION_STIMULI.items() for x in (F.lit(k), F.array(*map(F.lit, v)))
    ]
    known = F.create_map(*entries)[F.col(session_type)]
    return df.withColumn("stimulus", F.explode_outer(known)).withColumn(
        "is_known", F.col("stimulus").isNotNull()
    )


def class_of(value: Column, classes: Sequence[float]) -> Column:
    """Place of a value in a list of classes, null when it is none of them."""
    found = F.lit(None).cast("bigint")
    for i, known in enumerate(classes):
        found = F.when(value == known, F.lit(i).cast("bigint")).otherwise(found)
    return found


def orientation_class(degrees: Column, step: float) -> Column:
    return class_of(degrees, [step * i for i in range(round(360 / step))])


def drifting_labels(df: DataFrame, blank: str, orientation: str, frequency: str) -> DataFrame:
    """Drop blank sweeps; class ids of orientation and whole temporal frequency."""
    return df.filter(F.col(blank) == 0).withColumns(
        {
            "orientation_id": orientation_class(F.col(orientation), ORIENTATION_STEP_8),
            "temporal_frequency_id": class_of(F.bround(frequency, 0), TEMPORAL_FREQUENCIES),
        }
    )


def static_labels(df: DataFrame, orientation: str, frequency: str, phase: str) -> DataFrame:
    """Drop sweeps without orientation; class ids of orientation, frequency and phase."""
    return df.filter(F.col(orientation).isNotNull()).withColumns(
        {
            "orientation_id": orientation_class(F.col(orientation), ORIENTATION_STEP_12),
            "spatial_frequency_id": class_of(F.bround(frequency, 2), SPATIAL_FREQUENCIES),
            "phase_id": class_of(F.col(phase) * 360, PHASES),
        }
    )


def interval_midpoint(df: DataFrame, out: str = "timestamps") -> DataFrame:
    """Label time in the middle of each interval, marked as a time column."""
    middle = (F.col("start") + F.col("end")) / F.lit(2)
    return df.withColumn(out, middle).withMetadata(out, {"time": True})


def movie_frames(
    table: DataFrame, stamps: DataFrame, keys: Sequence[str], t: str, columns: Sequence[str]
) -> DataFrame:
    """Frame numbers to times, the listed columns kept, midpoint added."""
    timed = frame_to_time(table, stamps, keys, t, ["start", "end"])
    return interval_midpoint(timed.select(*keys, *columns, "start", "end"))


def natural_scenes(
    table: DataFrame, stamps: DataFrame, keys: Sequence[str], t: str, frame: str
) -> DataFrame:
    """Scenes count from one after the blank; repeats are not kept."""
    timed = movie_frames(table, stamps, keys, t, [frame])
    return timed.withColumn(frame, (F.col(frame) + 1).cast("bigint"))


def sparse_noise_union(
    tables: Sequence[DataFrame],
    stamps: DataFrame,
    keys: Sequence[str],
    t: str,
    columns: Sequence[str],
    ties: Sequence[str] = (),
) -> DataFrame:
    """One or two tables tagged with their pixel size, stacked in time order."""
    tagged = [
        table.withColumn("pixel_size", F.lit(size)) for table, size in zip(tables, PIXEL_SIZES)
    ]
    stacked = tagged[0]
    for more in tagged[1:]:
        stacked = stacked.unionByName(more)
    timed = movie_frames(stacked, stamps, keys, t, [*columns, "pixel_size"]).filter(
        F.col("start").isNotNull()
    )
    ordering = ["start", "end", "pixel_size", *ties]
    return ordered(timed, keys, "start", ordering, number="idx").withColumn(
        "idx", F.col("idx") - 1
    )


def stimulus_epochs(
    df: DataFrame, keys: Sequence[str], stimulus: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Epochs in order under ``<stimulus>_domain``; lists stay rows."""
    named = df.withColumn(stimulus, F.concat(F.col(stimulus), F.lit("_domain")))
    numbered = ordered(named, [*keys, stimulus], "start", ["start", "end", *ties], number="epoch")
    return numbered.withColumn("epoch", F.col("epoch") - 1)


def stage_intervals(
    df: DataFrame, onset: str, duration: str, text: str, codes: Mapping[str, int] = STAGE_CODES
) -> DataFrame:
    """Onset and duration to interval; text to its code, null (a violation) if unknown."""
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return df.withColumns(
        {
            "start": F.col(onset),
            "end": F.col(onset) + F.col(duration),
            "id": table[F.col(text)].cast("bigint"),
        }
    )


def union_epoch_domain(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two epoch sets stacked by start; ``overlaps`` marks what breaks disjointness."""
    stacked = first.select(*keys, "start", "end").unionByName(
        second.select(*keys, "start", "end")
    )
    seen = ordered(
        stacked, keys, "start", ["start", "end"], earlier_max={"reach_": "end"}, number="idx"
    )
    return seen.withColumns(
        {
            "idx": F.col("idx") - 1,
            "overlaps": F.coalesce(F.col("reach_") > F.col("start"), F.lit(False)),
        }
    ).drop("reach_")


def trial_extent(df: DataFrame, trial: Sequence[str], t: str) -> DataFrame:
    """Trial interval from its first to its last behaviour stamp."""
    return df.groupBy(*trial).agg(F.min(t).alias("start"), F.max(t).alias("end"))


def trial_series_concat(
    trials: DataFrame, keys: Sequence[str], trial: str, samples: str, out: str = "v"
) -> DataFrame:
    """Per-trial series end to end in trial order; ``idx`` counts in the recording."""
    sized = trials.select(*keys, trial, samples, F.size(samples).cast("bigint").alias("n_"))
    placed = ordered(
        sized.select(*keys, trial, "n_"), keys, trial, sums={"upto_": "n_"}
    ).select(*keys, trial, (F.col("upto_") - F.col("n_")).alias("offset_"))
    return (
        sized.join(placed, [*keys, trial])
        .select(*keys, trial, "offset_", F.posexplode(samples).alias("at_", out))
        .select(*keys, trial, (F.col("offset_") + F.col("at_")).alias("idx"), out)
    )


def event_window(
    df: DataFrame, t: str, before: int = 50_000, after: int = 650_000
) -> DataFrame:
    """Fixed window around each event."""
    return df.withColumns({"start": F.col(t) - before, "end": F.col(t) + after})


def windows_to_intervals(
    df: DataFrame, first: str, last: str, rate: float
) -> DataFrame:
    """Sample windows to seconds; an empty source keeps the schema."""
    return df.withColumns(
        {"start": F.col(first) / F.lit(float(rate)), "end": F.col(last) / F.lit(float(rate))}
    )
