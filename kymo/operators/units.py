"""Units, spikes and channels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kymo.plans.lanes import LANE, Cuts, assign_lanes, dealt, is_cut, measure, ordered

# Waveform points kept, and the order of recorded regions.
WAVEFORM_POINTS = 48
REGIONS = ("mec", "hc")


def _lookup(table: Mapping[str, str], name: Column) -> Column:
    """Value of a name in a small literal map, null when absent."""
    if not table:
        return F.lit(None).cast("string")
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[name]


def explode_spikes(
    units: DataFrame, keys: Sequence[str], unit: str, times: str
) -> tuple[DataFrame, DataFrame]:
    """Ragged spike times to sorted long form, and the unit table with counts.

    Units without spikes keep their row in the unit table.
    """
    long = units.select(*keys, unit, F.explode(times).alias("t"))
    spikes = ordered(long, keys, "t", ["t", unit], number="idx").withColumn(
        "idx", F.col("idx") - 1
    )
    table = units.select(
        *keys, unit, F.coalesce(F.size(times), F.lit(0)).cast("bigint").alias("count")
    )
    return spikes, table


def threshold_unit_name(group: Column, electrode: Column) -> Column:
    return F.format_string("group_%s/elec%s/multiunit_0", group, electrode)


def sorted_unit_name(group: Column, electrode: Column, index: Column) -> Column:
    return F.format_string("group_%s/elec%s/unit_%s", group, electrode, index)


def channel_unit_name(channel: Column, row: Column) -> Column:
    """Row 0 holds unsorted crossings, later rows sorted units."""
    suffix = F.when(row == 0, "unsorted").otherwise(F.format_string("sorted_%02d", row))
    return F.concat(channel, F.lit("/"), suffix)


def region_unit_name(region: Column, index: Column) -> Column:
    return F.concat(region, F.lit("_"), index.cast("string"))


def duplicate_names(units: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Names given to more than one unit of a recording."""
    return (
        units.groupBy(*keys, name)
        .agg(F.count(F.lit(1)).alias("n_units"))
        .filter(F.col("n_units") > 1)
    )


def dense_unit_index(
    units: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    out: str = "unit_index",
    cuts: Cuts | None = None,
) -> DataFrame:
    """Retained units numbered 0..n-1 in source order, regions in their fixed order."""
    numbered = ordered(units, keys, pos, order, number=out, cuts=cuts)
    return numbered.withColumn(out, F.col(out) - 1)


def units_and_spikes_by_region(
    regions: Mapping[str, tuple[DataFrame, DataFrame]], keys: Sequence[str], unit: str
) -> tuple[DataFrame, DataFrame]:
    """Unit tables and spikes of several regions as one table each.

    ``regions`` maps a region to its units and its long spikes; an absent region
    contributes nothing and a unit without spikes keeps its index.
    """
    tables, spikes = [], []
    for rank, (region, (found, fired)) in enumerate(regions.items()):
        place = {"location": F.lit(region), "region_rank": F.lit(rank)}
        tables.append(found.withColumns(place))
        spikes.append(fired.withColumn("location", F.lit(region)))
    keys = list(keys)
    stacked = reduce(DataFrame.unionByName, tables).withColumn("pos_", F.col("region_rank").cast("bigint"))
    indexed = dense_unit_index(stacked, keys, "pos_", ["pos_", unit])
    within = ordered(
        indexed.withColumn("at_", F.col("unit_index")), [*keys, "location"], "at_", number="in_"
    )
    named = within.withColumn(
        "id", region_unit_name(F.col("location"), F.col("in_") - 1)
    ).drop("pos_", "at_", "in_", "region_rank")
    fired = reduce(DataFrame.unionByName, spikes).join(
        named.select(*keys, "location", unit, "unit_index", "id"), [*keys, "location", unit]
    )
    merged = ordered(fired, keys, "t", ["t", "unit_index"], number="idx")
    return named, merged.withColumn("idx", F.col("idx") - 1)


def average_waveform(
    waveforms: DataFrame, keys: Sequence[str], samples: str, points: int = WAVEFORM_POINTS
) -> DataFrame:
    """Mean of every waveform point over a unit's spikes, leading points only."""
    return (
        waveforms.select(*keys, F.posexplode(F.slice(samples, 1, points)).alias("sample", "v"))
        .groupBy(*keys, "sample")
        .agg(F.avg(F.col("v").cast("double")).alias("v"))
    )


def spike_trial_domain(spikes: DataFrame, trial: Sequence[str], t: str) -> DataFrame:
    """First and last spike of all units per trial."""
    return spikes.groupBy(*trial).agg(F.min(t).alias("start"), F.max(t).alias("end"))


def cube_to_long(
    bins: DataFrame, trial: Sequence[str], t: str, channel: str, n: str
) -> DataFrame:
    """``n`` copies of a bin's stamp for a count of ``n``, in time order per trial.

    Bins are put in order, not copies: a bin's first index is the sum of the counts before it.
    Negative or fractional counts raise when they are read.
    """
    count = F.col(n).cast("bigint")
    valid = (F.col(n) >= 0) & (count == F.col(n))
    checked = F.when(valid, count).otherwise(F.raise_error(F.lit("counts must be whole")))
    counted = bins.withColumn("count_", checked).filter(F.col("count_") > 0).select(*trial, t, channel, "count_")
    counted = counted if trial else counted.withColumn("all_", F.lit(0))
    keys = list(trial) or ["all_"]
    cuts = measure(counted, keys, t, tie=channel)
    rows = assign_lanes(counted, keys, t, cuts)
    at = [*keys, LANE] if is_cut(rows) else keys
    # Bins of one stamp and channel, smallest first: each adds the copies that the one before it
    # lacks, once for itself and once for each larger bin.
    upwards = Window.partitionBy(*at, t, channel).orderBy("count_")
    same = upwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # dealt by trial, so that what follows moves no row again
    sized = dealt(rows, at, cuts).withColumns(
        {
            "below_": F.coalesce(F.lag("count_").over(upwards), F.lit(0).cast("bigint")),
            "times_": (F.count(F.lit(1)).over(same) - F.row_number().over(upwards) + 1).cast("bigint"),
        }
    ).withColumn("made_", (F.col("count_") - F.col("below_")) * F.col("times_"))
    summed = ordered(sized, keys, t, [t, channel, "count_"], sums={"upto_": "made_"}).filter(F.col("made_") > 0)
    each = summed.withColumn("j_", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("made_") - 1)))
    return each.select(
        *trial,
        t,
        channel,
        (F.col("below_") + F.expr("j_ div times_") + 1).alias("copy"),
        (F.col("upto_") - F.col("made_") + F.col("j_")).alias("idx"),
    )


def cube_units(bins: DataFrame, channel: str, n: str, prefix: str = "chan") -> DataFrame:
    """One unit per channel with its total count, id and padded name."""
    number = F.col(channel).cast("string")
    return (
        bins.groupBy(channel)
        .agg(F.sum(F.col(n).cast("bigint")).alias("count"))
        .withColumns(
            {
                "id": F.concat(F.lit(prefix), number),
                "channel_name": F.concat(
                    F.lit(prefix), F.lpad(number, F.greatest(F.lit(3), F.length(number)), F.lit("0"))
                ),
                "unit_number": F.lit(0),
            }
        )
    )


def rename_channel(names: Mapping[str, str], channel: Column) -> Column:
    """New name, or the name itself when it is not listed."""
    return F.coalesce(_lookup(names, channel), channel)


def resolve_type(types: Mapping[str, str], original: Column, renamed: Column, native: Column) -> Column:
    """Type by original name, else by new name, else the native one."""
    return F.coalesce(_lookup(types, original), _lookup(types, renamed), native)


def channel_table(
    channels: DataFrame,
    channel: str,
    native_type: str,
    names: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
    positions: Mapping[str, Sequence[float]] | None = None,
    ignore: Sequence[str] = (),
    bad: Sequence[str] = (),
) -> DataFrame:
    """Channel rows: new id, lower-case type, position and bad flag where given."""
    names, types = names or {}, types or {}
    old = F.col(channel)
    new = rename_channel(names, old)
    columns = {"id": new, "type": F.lower(resolve_type(types, old, new, F.col(native_type)))}
    if positions:
        pairs = [
            x
            for k, xyz in positions.items()
            for x in (F.lit(k), F.array(*[F.lit(float(v)) for v in xyz]))
        ]
        table = F.create_map(*pairs)
        columns["pos"] = F.coalesce(table[old], table[new], _unknown_position())
    if bad:
        columns["bad"] = old.isin(list(bad))
    kept = channels.filter(~old.isin(list(ignore))) if ignore else channels
    return kept.withColumns(columns)


def _unknown_position() -> Column:
    nan = F.lit(float("nan"))
    return F.array(nan, nan, nan)


def validate_rename_map(
    entries: DataFrame, keys: Sequence[str], source: str, target: str, pos: str
) -> DataFrame:
    """Per map: names that are a source and a target in different places, and repeated targets.

    Both roles are counted per name; no pairs are formed.
    """
    roles = F.explode(
        F.array(
            F.struct(F.col(source).alias("name_"), F.lit(1).alias("from_"), F.lit(0).alias("to_")),
            F.struct(F.col(target).alias("name_"), F.lit(0).alias("from_"), F.lit(1).alias("to_")),
        )
    )
    names = (
        entries.select(*keys, pos, roles.alias("r_"))
        .select(*keys, pos, "r_.*")
        .groupBy(*keys, "name_")
        .agg(
            F.sum("from_").alias("from_"),
            F.sum("to_").alias("to_"),
            (F.min(pos) != F.max(pos)).alias("apart_"),
        )
    )
    overlap = (F.col("from_") > 0) & (F.col("to_") > 0) & F.col("apart_")
    return (
        names.groupBy(*keys)
        .agg(
            F.count_if(overlap).alias("n_overlaps"),
            F.count_if(F.col("to_") > 1).alias("n_repeated"),
        )
        .withColumn("is_valid", (F.col("n_overlaps") == 0) & (F.col("n_repeated") == 0))
    )


def resolve_positions(
    channels: DataFrame,
    positions: DataFrame | None,
    original: str,
    renamed: str,
    montage: str | None = None,
) -> DataFrame:
    """Position by original name, else by new name, else NaN; without a table, the montage's."""
    if positions is None:
        known = F.col(montage) if montage else _unknown_position()
        return channels.withColumn("pos", F.coalesce(known, _unknown_position()))
    by_old = positions.select(F.col("name").alias(original), F.col("pos").alias("old_"))
    by_new = positions.select(F.col("name").alias(renamed), F.col("pos").alias("new_"))
    return (
        channels.join(by_old, original, "left")
        .join(by_new, renamed, "left")
        .withColumn("pos", F.coalesce("old_", "new_", _unknown_position()))
        .drop("old_", "new_")
    )


def invert_type_map(types: DataFrame, pos: str, kind: str, channels: str) -> DataFrame:
    """Type with its channels to channel with its type; a later type wins.

    Only positions are compared over the exploded lists; the type is looked up for
    the one position left per channel.
    """
    latest = (
        types.select(pos, F.explode(channels).alias("channel"))
        .groupBy("channel")
        .agg(F.max(pos).alias(pos))
    )
    return latest.join(types.select(pos, F.col(kind).alias("type")), pos).select("channel", "type")


def per_recording_map(
    recording: Column,
    channel: Column,
    variants: Mapping[str, Mapping[str, str]],
    default: Mapping[str, str],
) -> Column:
    """New channel name by the map of the first marker found in the recording id."""
    chosen = rename_channel(default, channel)
    for marker, names in reversed(list(variants.items())):
        chosen = F.when(recording.contains(marker), rename_channel(names, channel)).otherwise(chosen)
    return chosen


def probe_channels(
    probes: DataFrame, keys: Sequence[str], pos: str, arrays: Sequence[str]
) -> DataFrame:
    """One row per channel of each probe: probes count from 1, channels from 0."""
    numbered = ordered(probes, keys, pos, number="probe")
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    return numbered.select(*keys, "probe", F.posexplode(zipped).alias("channel", "c_")).select(
        *keys, "probe", "channel", *[F.col(f"c_.{a}").alias(a) for a in arrays]
    )


def roi_geometry(
    pixels: DataFrame, roi: Sequence[str], row: str, col: str, weight: str
) -> DataFrame:
    """Centroid, area, height and width of the non-zero pixels of each region."""
    return (
        pixels.filter(F.col(weight) != 0)
        .groupBy(*roi)
        .agg(
            F.avg(row).alias("centroid_row"),
            F.avg(col).alias("centroid_col"),
            F.count(F.lit(1)).alias("area"),
            (F.max(row) - F.min(row) + 1).alias("height"),
            (F.max(col) - F.min(col) + 1).alias("width"),
        )
    )


def channel_localization(
    channels: DataFrame,
    localization: DataFrame,
    keys: Sequence[str],
    name: str,
    pos: str,
    texts: Sequence[str],
    numbers: Sequence[str],
    allowed: DataFrame,
) -> DataFrame:
    """Localization rows in channel order: missing text is empty, missing number NaN."""
    numbered = ordered(channels, keys, pos, number="id").withColumn("id", F.col("id") - 1)
    flagged = numbered.join(
        allowed.select(name).distinct().withColumn("allowed_", F.lit(True)), name, "left"
    )
    joined = flagged.join(localization.select(name, *texts, *numbers), name, "left")
    filled = {c: F.coalesce(F.col(c), F.lit("")) for c in texts}
    filled |= {
        c: F.coalesce(F.col(c), F.lit(float("nan"))).cast("float") for c in numbers
    }
    filled["included"] = F.coalesce("allowed_", F.lit(False))
    return joined.withColumns(filled).drop("allowed_")


def split_channel_mask(
    channels: DataFrame, selectors: Sequence, used: DataFrame, on: Sequence[str]
) -> DataFrame:
    """For every selector, which channels of a recording the split uses.

    ``selectors`` is the short list of keys; each channel unfolds it.
    """
    each = channels.withColumn("selector", F.explode(F.array(*map(F.lit, selectors))))
    hit = used.select(*on, "selector").distinct().withColumn("used_", F.lit(True))
    return each.join(hit, [*on, "selector"], "left").withColumn(
        "used", F.coalesce("used_", F.lit(False))
    ).drop("used_")


def with_split_mask(channels: DataFrame, masks: DataFrame, selector, on: Sequence[str]) -> DataFrame:
    """Channel table whose ``included`` flag is the active split's mask."""
    active = masks.filter(F.col("selector") == selector).select(
        *on, F.col("used").alias("included")
    )
    return channels.drop("included").join(active, list(on))


def channel_metadata(
    channels: DataFrame, keys: Sequence[str], pos: str, axes: tuple[str, str, str]
) -> DataFrame:
    """Index, mask and stacked coordinates; ``is_complete`` is false if a field is missing."""
    numbered = ordered(channels, keys, pos, number="index").withColumn("index", F.col("index") - 1)
    known = reduce(lambda a, b: a & b, [F.col(a).isNotNull() for a in axes])
    return numbered.withColumns(
        {"coordinates": F.array(*[F.col(a) for a in axes]), "is_complete": known}
    )
