"""Reading back the intervals of a split.

``domains`` holds intervals per recording, ``splits`` intervals per recording and
split, ``assignments`` one part name per recording, scheme and fold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.functions.hashing import TEST, TRAIN, VALID, hash_three_way
from kymo.operators.intervals import interval_intersection, measure_times
from kymo.operators.splits import causal_ratio_split

# Accepted names of the parts; ``val`` is read as ``valid``.
SPLIT_NAMES = {"train": TRAIN, "valid": VALID, "val": VALID, "test": TEST}
LEGACY_SCHEME = "any"


def split_name(split: str) -> str:
    if split not in SPLIT_NAMES:
        raise ValueError(f"invalid split {split!r}, expected one of {sorted(SPLIT_NAMES)}")
    return SPLIT_NAMES[split]


def sampling_intervals(
    domains: DataFrame, splits: DataFrame, keys: Sequence[str], split: str | None = None
) -> DataFrame:
    """Intervals of a split, or whole domains without one."""
    source = domains if split is None else splits.filter(F.col("split") == split_name(split))
    return source.select(*keys, "start", "end")


def sampling_intervals_joint(
    domains: DataFrame,
    splits: DataFrame,
    others: Sequence[DataFrame],
    keys: Sequence[str],
    split: str | None = None,
) -> DataFrame:
    """Same, where every other series (behaviour, spikes) is present too."""
    found = sampling_intervals(domains, splits, keys, split)
    cuts = measure_times([(df, "start") for df in (found, *others)], keys)
    for other in others:
        found = interval_intersection(found, other.select(*keys, "start", "end"), keys, cuts)
    return found


def sampling_intervals_fold(
    domains: DataFrame,
    folds: DataFrame,
    assignments: DataFrame,
    keys: Sequence[str],
    scheme: str,
    fold: int,
    split: str | None = None,
) -> DataFrame:
    """By fold: stored intervals within sessions, whole domains of members across them.

    An assignment stored under the older scheme name counts when the newer is absent.
    """
    keys = list(keys)
    if split is None:
        return domains.select(*keys, "start", "end")
    name = split_name(split)
    if scheme == "intrasession":
        wanted = (F.col("fold") == fold) & (F.col("split") == name)
        return folds.filter(wanted).select(*keys, "start", "end")
    known = assignments.filter(
        (F.col("fold") == fold) & F.col("scheme").isin(scheme, LEGACY_SCHEME)
    )
    members = (
        known.groupBy(*keys)
        .agg(F.max_by("split", F.col("scheme") == scheme).alias("part_"))
        .filter(F.col("part_") == name)
    )
    return domains.select(*keys, "start", "end").join(members.select(*keys), keys, "left_semi")


def sampling_intervals_ratio(
    domains: DataFrame,
    keys: Sequence[str],
    split: str,
    scheme: str,
    ratios: tuple[float, float, float],
    ident: str,
    seed: int = 42,
) -> DataFrame:
    """Split worked out while reading; recordings outside it stay with no interval."""
    name = split_name(split)
    if scheme == "intrasession":
        cut = causal_ratio_split(domains, ratios)
        return cut.filter(F.col("split") == name).select(*keys, "start", "end")
    member = F.coalesce(
        hash_three_way(F.col(ident).cast("string"), ratios, seed) == name, F.lit(False)
    )
    inside = domains.filter(member).select(*keys, "start", "end")
    none = [F.lit(None).cast(domains.schema[c].dataType).alias(c) for c in ("start", "end")]
    return inside.union(domains.filter(~member).select(*keys).distinct().select(*keys, *none))


def sampling_intervals_selector(
    requests: DataFrame, splits: DataFrame, masks: DataFrame, on: Sequence[str]
) -> DataFrame:
    """Intervals of a selector with the size of its active channel mask.

    Interval and mask must both exist; ``missing`` names what a request lacks.
    """
    on = list(on)
    active = masks.groupBy(*on).agg(F.count_if("used").alias("n_channels"))
    found = (
        requests.join(splits.select(*on, "start", "end"), on, "left")
        .join(active, on, "left")
    )
    missing = F.concat_ws(
        ",",
        F.when(F.col("start").isNull(), "intervals"),
        F.when(F.col("n_channels").isNull(), "mask"),
    )
    return found.withColumn("missing", missing)


def user_transform(df: DataFrame, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply the caller's function to what was read."""
    return df.transform(transform)
