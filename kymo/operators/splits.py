"""Reproducible train/valid/test assignment.

Random order is the order of an MD5 digest of the row's id and a seed, so an
assignment depends on nothing but the ids. Ranks within a large class or
recording are taken lane by lane over the digest's leading bits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kymo.functions.hashing import (
    TEST,
    TRAIN,
    VALID,
    DIGEST_RANGE,
    digest_position,
    hash_three_way,
    shuffle_digest,
    string_kfold,
)
from kymo.operators import intervals as iv
from kymo.plans.lanes import BROADCAST_BYTES, Cuts, attach, dealt, looked_up, matched, measure, no_cuts, ordered
from kymo.sources.store import kept


def shuffled_rank(
    df: DataFrame,
    keys: Sequence[str],
    ident: Column,
    seed: int | str | Column = 42,
    rank: str = "rank",
    total: str | None = "total",
    cuts: Cuts | None = None,
) -> DataFrame:
    """Rank from 1 in shuffled order within the keys, and the size of the group if asked for."""
    if isinstance(seed, Column):
        digest = F.md5(F.concat(ident.cast("string"), F.lit("_"), seed.cast("string")))
    else:
        digest = shuffle_digest(ident, seed)
    marked = df.withColumn("digest_", digest).withColumns(
        {"at_": digest_position(F.col("digest_")), "ident_": ident}
    )
    if cuts is None:
        cuts = measure_groups(df, keys)
    return ordered(
        marked,
        keys,
        "at_",
        ["at_", "digest_", "ident_"],
        number=rank,
        totals={total: F.lit(1)} if total else None,
        cuts=cuts,
    ).drop("at_", "digest_", "ident_")


def measure_groups(df: DataFrame, keys: Sequence[str]) -> Cuts:
    """Cuts for shuffled ranks: digests spread evenly over their known range."""
    if not keys:
        df, keys = df.withColumn("all_", F.lit(0)), ["all_"]
    return measure(df, keys, "", bounds=DIGEST_RANGE)


def _half_up(x: Column) -> Column:
    return F.floor(x + F.lit(0.5))


def part_by_rank(rank: Column, total: Column, ratios: Sequence[float]) -> Column:
    """Part name from a rank, cut at the rounded cumulative ratios (normalised)."""
    whole = float(sum(ratios))
    first = float(ratios[0]) / whole
    second = float(ratios[0] + ratios[1]) / whole if len(ratios) == 3 else 1.0
    upto = F.when(rank <= _half_up(total * F.lit(first)), TRAIN)
    if len(ratios) == 2:
        return upto.otherwise(TEST)
    return upto.when(rank <= _half_up(total * F.lit(second)), VALID).otherwise(TEST)


def kfold_table(df: DataFrame, ident: str, n_folds: int, val_ratio: float, seed: int) -> DataFrame:
    """One row per id and fold with its part."""
    parts = F.posexplode(string_kfold(F.col(ident).cast("string"), n_folds, val_ratio, seed))
    return df.select("*", parts.alias("fold", "split"))


def hash_assignment(
    recordings: DataFrame, ident: str, ratios: tuple[float, float, float], seed: int
) -> DataFrame:
    """Part of each recording by its own hash; no data moves."""
    return recordings.withColumn("split", hash_three_way(F.col(ident).cast("string"), ratios, seed))


def causal_ratio_split(domain: DataFrame, ratios: tuple[float, float, float]) -> DataFrame:
    """Cut each interval in time order; three rows per interval."""
    length = F.col("end") - F.col("start")
    one = F.col("start") + F.floor(length * F.lit(ratios[0])).cast("bigint")
    two = one + F.floor(length * F.lit(ratios[1])).cast("bigint")
    three = two + F.floor(length * F.lit(ratios[2])).cast("bigint")
    parts = F.array(
        F.struct(F.lit(TRAIN).alias("split"), F.col("start").alias("start"), one.alias("end")),
        F.struct(F.lit(VALID).alias("split"), one.alias("start"), two.alias("end")),
        F.struct(F.lit(TEST).alias("split"), two.alias("start"), three.alias("end")),
    )
    others = [c for c in domain.columns if c not in ("start", "end")]
    return domain.select(*others, F.explode(parts).alias("p_")).select(*others, "p_.*")


def _class_shares(
    counts: DataFrame, keys: Sequence[str], label: str, n_folds: int, val_ratio: float
) -> DataFrame:
    """Per class of ``n_`` items: items in the classes before it, its valid items in every fold.

    Test items follow the running number over all classes, so folds differ by one
    item at most. In each fold ``ceil(ratio * rest)`` items are valid; classes get
    their whole part of the train items and the largest remainders one more. Works
    on one row per class and fold.
    """
    keys = list(keys)
    in_order = Window.partitionBy(*keys).orderBy(label)
    classes = (
        counts.select(*keys, label, F.col("n_").alias("c_"))
        .withColumn("before_", F.sum("c_").over(in_order) - F.col("c_"))
        .withColumn("fold_", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))))
    )
    first = F.pmod(F.col("fold_") - F.col("before_"), F.lit(n_folds))
    tested = F.greatest(F.floor((F.col("c_") - 1 - first) / n_folds) + 1, F.lit(0))
    fold = Window.partitionBy(*keys, "fold_")
    counted = classes.withColumn("rest_", F.col("c_") - tested).withColumn(
        "all_rest_", F.sum("rest_").over(fold)
    )
    n_train = F.col("all_rest_") - F.ceil(F.col("all_rest_") * F.lit(val_ratio))
    drawn = counted.withColumn("drawn_", F.col("rest_") * n_train).withColumns(
        {
            "whole_": F.expr("drawn_ div all_rest_"),
            "part_": F.col("drawn_") % F.col("all_rest_"),
            "n_train_": n_train,
        }
    )
    short = F.col("n_train_") - F.sum("whole_").over(fold)
    by_part = fold.orderBy(F.desc("part_"), label)
    extra = F.when(F.row_number().over(by_part) <= short, 1).otherwise(0)
    valid = F.col("rest_") - F.col("whole_") - extra
    return (
        drawn.withColumn("valid_", F.coalesce(valid, F.lit(0)).cast("bigint"))
        .groupBy(*keys, label)
        .agg(
            F.first("before_").alias("before_"),
            F.map_from_entries(F.collect_list(F.struct("fold_", "valid_"))).alias("n_valid_"),
        )
    )


def stratified_folds(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    ident: str,
    n_folds: int = 5,
    val_ratio: float = 0.2,
    seed: int = 42,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Each item once in test over the folds, classes spread evenly.

    One row per item and fold: the item's shuffled rank in its class picks its test
    fold; in the other folds the rest of the class is shuffled again and its leading
    share is valid. ``counts`` gives the items per class (``n_``) where they are known
    without reading ``df``.

    Items unfold into folds last. A class is shuffled once and ranked fold by fold where it lies; in
    one that is cut into lanes, counts per lane of a fold's digests tell which lane the last
    valid item is in, and only that lane is ranked.
    """
    if counts is None:
        counts = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n_"))
    group = [*keys, label]
    cuts = measure(df, group, "", bounds=DIGEST_RANGE, stats=counts)
    shares = _class_shares(counts, keys, label, n_folds, val_ratio)
    if not cuts.levels:
        return _folds_by_rank(df, shares, group, ident, n_folds, seed, cuts)
    [level] = cuts.levels
    met = looked_up(df, level.table, group, level.n_bytes)
    few = met.filter("width_ is null").drop("lo_", "width_")
    many = met.filter("width_ is not null").drop("lo_", "width_")
    return _folds_by_rank(few, shares, group, ident, n_folds, seed, replace(cuts, levels=())).unionByName(
        _folds_by_lane(many, shares, group, ident, n_folds, seed, cuts)
    )


def _home(n_folds: int) -> Column:
    """The test fold of an item, from its rank in its class and the items in the classes before."""
    return ((F.col("before_") + F.col("rank_") - 1) % n_folds).cast("int")


def _fold_digest(ident: str, fold: int, seed: int) -> Column:
    return shuffle_digest(F.col(ident), fold + seed)


def _folds_by_rank(
    df: DataFrame, shares: DataFrame, group: list[str], ident: str, n_folds: int, seed: int, cuts: Cuts
) -> DataFrame:
    """Folds of classes that fit into a task: one shuffle by class, a sort for each fold."""
    names = df.columns
    placed = shuffled_rank(dealt(df, group, cuts), group, F.col(ident), seed, "rank_", None, cuts)
    valid = [F.element_at("n_valid_", F.lit(k)).alias(f"valid_{k}_") for k in range(n_folds)]
    known = attach(placed, shares.select(*group, "before_", *valid), group, cuts, 16)
    rows = known.withColumn("home_", _home(n_folds)).drop("rank_", "before_")
    for k in range(n_folds):
        order = [F.unhex(_fold_digest(ident, k, seed)), F.col(ident)]
        rank = F.row_number().over(Window.partitionBy(*group, F.col("home_") == k).orderBy(*order))
        rows = rows.withColumn(f"valid_{k}_", rank <= F.col(f"valid_{k}_"))
    part = lambda k: F.when(F.col("home_") == k, TEST).when(F.col(f"valid_{k}_"), VALID).otherwise(TRAIN)
    parts = F.array(*[F.struct(F.lit(k).alias("fold"), part(k).alias("split")) for k in range(n_folds)])
    return rows.select(*names, F.explode(parts).alias("p_")).select(*names, "p_.*")


def _folds_by_lane(
    df: DataFrame, shares: DataFrame, group: list[str], ident: str, n_folds: int, seed: int, cuts: Cuts
) -> DataFrame:
    """Folds of classes cut into lanes: those before the lane of the last valid item are valid."""
    names, [level] = df.columns, cuts.levels
    on = [*group, "fold"]
    size = level.n_bytes * n_folds
    hot = matched(shares, F.broadcast(level.table) if level.n_bytes <= BROADCAST_BYTES else level.table, group, "inner")
    hot = kept(hot.select(*group, "before_", "n_valid_", "lo_", "width_"))
    placed = shuffled_rank(df, group, F.col(ident), seed, "rank_", None, cuts)
    placed = looked_up(placed, hot.select(*group, "before_"), group, size)
    items = kept(placed.withColumn("home_", _home(n_folds)).select(*names, "home_"))

    met = looked_up(items, hot.select(*group, "lo_", "width_"), group, size)
    at = lambda k: F.floor((digest_position(_fold_digest(ident, k, seed)) - F.col("lo_")) / F.col("width_"))
    folds = F.array(*[F.struct(F.lit(k).alias("fold"), at(k).cast("bigint").alias("step_")) for k in range(n_folds)])
    each = met.select(*names, "home_", F.explode(folds).alias("f_")).select(*names, "home_", "f_.*")
    rest = each.filter(F.col("home_") != F.col("fold"))
    counts = rest.groupBy(*on, "step_").agg(F.count(F.lit(1)).alias("n_"))
    running = ordered(counts, on, "step_", sums={"upto_": "n_"}, cuts=no_cuts(on))
    asked = hot.select(*group, F.explode("n_valid_").alias("fold", "valid_"))
    last = matched(running, asked, on, "inner").filter("valid_ > upto_ - n_ and valid_ <= upto_")
    last = kept(last.select(*on, F.col("step_").alias("last_"), (F.col("valid_") - F.col("upto_") + F.col("n_")).alias("left_")))

    placed = looked_up(each, last, on, 2 * size)
    home, open_ = F.col("home_") == F.col("fold"), F.col("step_") == F.col("last_")
    known = F.when(home, TEST).when(F.col("step_") < F.col("last_"), VALID).otherwise(TRAIN)
    told = placed.filter(home | ~F.coalesce(open_, F.lit(False))).withColumn("split", known)
    order = [F.unhex(F.md5(F.concat(F.col(ident).cast("string"), F.lit("_"), (F.col("fold") + seed).cast("string")))), F.col(ident)]
    rank = F.row_number().over(Window.partitionBy(*on).orderBy(*order))
    edge = placed.filter(~home & open_).withColumn("split", F.when(rank <= F.col("left_"), VALID).otherwise(TRAIN))
    return told.select(*names, "fold", "split").unionByName(edge.select(*names, "fold", "split"))


def rare_class_filter(
    df: DataFrame, keys: Sequence[str], label: str, at_least: int, unknown: Sequence = ()
) -> DataFrame:
    """Drop unknown classes and those with fewer items than folds.

    Counts are combined before the join back; the class table is small.
    """
    known = df.filter(~F.col(label).isin(list(unknown))) if unknown else df
    kept = (
        known.groupBy(*keys, label)
        .agg(F.count(F.lit(1)).alias("n_"))
        .filter(F.col("n_") >= at_least)
        .drop("n_")
    )
    return known.join(kept, [*keys, label], "left_semi")


def sleep_splits(
    stages: DataFrame,
    recording: str,
    subject: str,
    session: str,
    ident: str,
    label: str,
    unknown: Sequence[int],
    epoch: int,
    n_folds: int = 3,
    val_ratio: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Epochs per fold and part, with the subject's and the session's assignment.

    Stages are cut into epochs, unknown and rare stages dropped, the rest folded by
    stage; the string folds of the subject and of subject_session stand beside. Epochs
    are counted per stage from the lengths, so only those that stay are unfolded.
    """
    pieces = F.greatest(F.floor((F.col("end") - F.col("start")) / epoch), F.lit(0))
    known = stages.filter(~F.col(label).isin(list(unknown))) if unknown else stages
    counts = kept(
        known.groupBy(recording, label)
        .agg(F.sum(pieces).cast("bigint").alias("n_"))
        .filter(F.col("n_") >= n_folds)
    )
    person = F.col(subject).cast("string")
    both = F.concat_ws("_", person, F.col(session).cast("string"))
    names = F.array(F.lit(TRAIN), F.lit(VALID), F.lit(TEST))

    def letters(parts: Column) -> Column:
        """A digit for each fold's part: shorter in every epoch than the names."""
        return F.array_join(F.transform(parts, lambda p: F.array_position(names, p).cast("string")), "")

    common = known.join(counts.drop("n_"), [recording, label], "left_semi").withColumns(
        {
            "person_parts_": letters(string_kfold(person, n_folds, val_ratio, seed)),
            "both_parts_": letters(string_kfold(both, n_folds, val_ratio, seed)),
        }
    )
    epochs = iv.interval_subdivide(common, epoch).withColumn(
        "epoch_", F.concat_ws("_", F.col(ident).cast("string"), F.col("start").cast("string"))
    )
    folds = stratified_folds(epochs, [recording], label, "epoch_", n_folds, val_ratio, seed, counts)
    part = lambda of: F.element_at(names, F.substring(of, F.col("fold") + 1, 1).cast("int"))
    return folds.withColumns(
        {
            "intersubject": part(F.col("person_parts_")),
            "intersession": part(F.col("both_parts_")),
        }
    ).drop("epoch_", "person_parts_", "both_parts_")


def interval_split_shuffled(
    df: DataFrame, keys: Sequence[str], ident: str, ratios: Sequence[float], seed: int = 42
) -> DataFrame:
    """Shuffled split by ratios within each recording."""
    ranked = shuffled_rank(df, keys, F.col(ident), seed, "rank_", "total_")
    split = part_by_rank(F.col("rank_"), F.col("total_"), ratios)
    return ranked.withColumn("split", split).drop("rank_", "total_")


def interval_split_ordered(
    df: DataFrame, keys: Sequence[str], ratios: Sequence[float], ties: Sequence[str] = ()
) -> DataFrame:
    """Split by ratios in time order within each recording."""
    ranked = ordered(
        df, keys, "start", ["start", "end", *ties], number="rank_", totals={"total_": F.lit(1)}
    )
    split = part_by_rank(F.col("rank_"), F.col("total_"), ratios)
    return ranked.withColumn("split", split).drop("rank_", "total_")


def two_stage_trial_split(
    df: DataFrame,
    keys: Sequence[str],
    ident: str,
    test_size: float = 0.2,
    valid_size: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Hold out test first (rounded up), then valid from what is left (rounded up)."""
    whole = df if keys else df.withColumn("all_", F.lit(0))
    keys = list(keys) or ["all_"]
    cuts = measure_groups(whole, keys)
    first = shuffled_rank(whole, keys, F.col(ident), seed, "rank_", "total_", cuts)
    held = F.ceil(F.col("total_") * F.lit(test_size))
    first = first.withColumn("held_", F.col("rank_") <= held).drop("rank_", "total_")
    cuts = cuts.refined("held_")
    second = shuffled_rank(
        first, [*keys, "held_"], F.col(ident), f"{seed}b", "rank_", "total_", cuts
    )
    train_size = 1.0 - test_size - valid_size
    share = F.ceil(F.col("total_") * F.lit(valid_size / (train_size + valid_size)))
    split = F.when(F.col("held_"), TEST).when(F.col("rank_") <= share, VALID).otherwise(TRAIN)
    return second.withColumn("split", split).drop("rank_", "total_", "held_", "all_")


def train_is_rest_dilated(
    domain: DataFrame, held_out: DataFrame, keys: Sequence[str], by: int
) -> DataFrame:
    """Train coverage: the domain minus the widened valid and test intervals."""
    wide = held_out.select(
        *keys, (F.col("start") - by).alias("start"), (F.col("end") + by).alias("end")
    )
    return iv.interval_difference(domain, wide, keys)


def invalid_trials_to_train(
    df: DataFrame,
    keys: Sequence[str],
    ident: str,
    valid_flag: str,
    ratios: Sequence[float] = (0.7, 0.1, 0.2),
    seed: int = 42,
) -> DataFrame:
    """Split the valid trials by ratios; every invalid trial goes to train."""
    ranked = shuffled_rank(df, [*keys, valid_flag], F.col(ident), seed, "rank_", "total_")
    split = F.when(~F.col(valid_flag), TRAIN).otherwise(
        part_by_rank(F.col("rank_"), F.col("total_"), ratios)
    )
    return ranked.withColumn("split", split).drop("rank_", "total_")


def predefined_split(
    df: DataFrame,
    keys: Sequence[str],
    ident: str,
    source_split: str,
    held_name: str = "val",
    ratios: Sequence[float] = (0.8, 0.2),
    seed: int = 42,
) -> DataFrame:
    """The source's held-out part is test; its train part is split again."""
    marked = df.withColumn("held_", F.col(source_split) == held_name)
    ranked = shuffled_rank(marked, [*keys, "held_"], F.col(ident), seed, "rank_", "total_")
    inner = part_by_rank(F.col("rank_"), F.col("total_"), ratios)
    split = F.when(F.col("held_"), TEST).otherwise(F.when(inner == TEST, VALID).otherwise(TRAIN))
    return ranked.withColumn("split", split).drop("rank_", "total_", "held_")


def snap_to_grid(
    points: DataFrame,
    grid: DataFrame,
    keys: Sequence[str],
    at: str = "t",
    out: str = "snapped",
    cuts: Cuts | None = None,
) -> DataFrame:
    """Move a time inside a grid interval to its nearer edge, the start on a tie."""
    hit = iv.interval_stab(points, grid, keys, at, cuts)
    nearer_end = F.col(at) - F.col("hit_start") > F.col("hit_end") - F.col(at)
    moved = F.when(nearer_end, F.col("hit_end")).otherwise(F.col("hit_start"))
    return hit.withColumn(
        out, F.when(F.col("hit_start").isNull(), F.col(at)).otherwise(moved)
    ).drop("hit_start", "hit_end")


# How many epochs, which of them is cut, and at which share of it.
# The last field says what the epochs before and after the cut one become.
EPOCH_CUTS = {
    1: (1, (0.6, 0.1)),
    2: (1, (0.5,)),
    3: (2, (0.7,)),
    4: (3, (0.5,)),
    5: (3, (0.5,)),
}
MANY_EPOCHS_RATIOS = (0.6, 0.1, 0.3)


def _within(rows: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are among the chosen ones, nulls included."""
    there = chosen.select(*[F.col(k).alias(f"{k}_chosen_") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"{k}_chosen_")) for k in keys]
    return rows.join(there, same, "left_semi")


def _checked_ratios(ratios: Sequence[float]) -> tuple[float, float, float]:
    if len(ratios) != 3 or any(r < 0 for r in ratios) or abs(sum(ratios) - 1) > 1e-6:
        raise ValueError(f"three shares of one are needed, not {ratios}")
    train, valid, test = ratios
    return train, valid, test


def epoch_split(
    epochs: DataFrame,
    grid: DataFrame,
    keys: Sequence[str],
    grid_keys: Sequence[str],
    only: int | None = None,
    ratios: Sequence[float] = MANY_EPOCHS_RATIOS,
) -> DataFrame:
    """Split every group of epochs by the rule for its size, cuts snapped to the grid.

    ``keys`` name a group (recording and stimulus), ``grid_keys`` the recording.
    All sizes run in one plan: each epoch knows its place and the group's size, at
    most two cut times per group are snapped, and pieces follow by case. ``only`` takes
    groups of one size, and of the grid what belongs to them. ``ratios`` are the shares
    of a lone epoch.
    """
    keys, grid_keys = list(keys), list(grid_keys)
    rules = EPOCH_CUTS | {1: (1, _checked_ratios(ratios)[:2])}
    group_cuts = None
    if only is not None:
        sizes = epochs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_"))
        chosen = kept(sizes.filter(F.col("n_") == only).select(*keys))
        epochs = _within(epochs, chosen, keys)
        grid = _within(grid, chosen, grid_keys)
        if only <= max(EPOCH_CUTS):
            group_cuts = no_cuts(keys)
    cuts = iv.measure_times([(epochs, "start"), (grid, "start")], grid_keys)
    placed = ordered(
        epochs.select(*keys, "start", "end"),
        keys,
        "start",
        ["start", "end"],
        number="i_",
        totals={"n_": F.lit(1)},
        cuts=group_cuts,
    )
    length = F.col("end") - F.col("start")
    one, two = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    for n, (which, shares) in rules.items():
        here = (F.col("n_") == n) & (F.col("i_") == which)
        cut = F.col("start") + F.floor(length * F.lit(shares[0])).cast("bigint")
        if n > 2:
            # measured from the end of the epoch
            cut = F.col("end") - F.floor(length * F.lit(round(1 - shares[0], 6))).cast("bigint")
        one = F.when(here, cut).otherwise(one)
        if len(shares) == 2:
            later = cut + F.floor(length * F.lit(shares[1])).cast("bigint")
            two = F.when(here, later).otherwise(two)
    placed = placed.withColumns({"one_": one, "two_": two})
    points = placed.filter(F.col("one_").isNotNull()).select(
        *keys,
        "i_",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("which_"), F.col("one_").alias("t")),
                F.struct(F.lit(2).alias("which_"), F.col("two_").alias("t")),
            )
        ).alias("p_"),
    ).select(*keys, "i_", "p_.*").filter(F.col("t").isNotNull())
    cuts = (
        snap_to_grid(points, grid, grid_keys, cuts=cuts)
        .groupBy(*keys, "i_")
        .agg(
            F.max(F.when(F.col("which_") == 1, F.col("snapped"))).alias("cut_one_"),
            F.max(F.when(F.col("which_") == 2, F.col("snapped"))).alias("cut_two_"),
        )
    )
    whole = placed.join(cuts, [*keys, "i_"], "left")

    def piece(split: Column | str, start: Column, end: Column) -> Column:
        name = F.lit(split) if isinstance(split, str) else split
        return F.struct(name.alias("split"), start.alias("start"), end.alias("end"))

    start, end, i, n = F.col("start"), F.col("end"), F.col("i_"), F.col("n_")
    ends_test = F.when((n == 2) | (n == 3) | (n == 4), i == n).otherwise(i > 3)
    uncut = F.when(
        n > 5, part_by_rank(i, n, MANY_EPOCHS_RATIOS)
    ).otherwise(F.when(ends_test, TEST).otherwise(TRAIN))
    pieces = (
        F.when(
            n == 1,
            F.array(
                piece(TRAIN, start, F.col("cut_one_")),
                piece(VALID, F.col("cut_one_"), F.col("cut_two_")),
                piece(TEST, F.col("cut_two_"), end),
            ),
        )
        .when(
            F.col("cut_one_").isNotNull(),
            F.array(
                piece(TRAIN, start, F.col("cut_one_")), piece(VALID, F.col("cut_one_"), end)
            ),
        )
        .otherwise(F.array(piece(uncut, start, end)))
    )
    return whole.select(*keys, n.alias("n_epochs"), F.explode(pieces).alias("p_")).select(
        *keys, "n_epochs", "p_.*"
    )


def epoch_split_dispatch(
    epochs: DataFrame,
    grid: DataFrame,
    recording: Sequence[str],
    stimulus: str,
    skip: Sequence[str] = ("invalid_presentation_epochs",),
) -> DataFrame:
    """Split all stimuli of a recording and unite the parts over stimuli."""
    kept = epochs.filter(~F.col(stimulus).isin(list(skip)))
    pieces = epoch_split(kept, grid, [*recording, stimulus], recording)
    cuts = measure(kept, recording, "start").refined("split")
    return iv.interval_union(pieces, None, [*recording, "split"], cuts)


def coverage_ranked_split(
    domain: DataFrame,
    pauses: DataFrame,
    keys: Sequence[str],
    blocks: int = 10,
    longer_than: int = 10_000_000,
    seed: int = 42,
) -> DataFrame:
    """Blocks ranked by how much active time they hold: least covered train, best test.

    Eight tenths of the blocks train, one tenth valid, the best covered tenth test,
    ties in shuffled order. Pauses are then cut out and pieces must be longer than
    the limit. A recording without pauses is split in shuffled order instead.
    """
    keys = list(keys)
    paused = pauses.select(*keys).distinct().withColumn("paused_", F.lit(True))

    def long_enough(pieces: DataFrame) -> DataFrame:
        length = F.col("end") - F.col("start")
        return pieces.join(paused, keys, "left").filter(
            F.col("paused_").isNull() | (length > longer_than)
        )

    cuts = iv.measure_times([(domain, "start"), (pauses, "start")], keys)
    active = long_enough(iv.interval_difference(domain, pauses, keys, cuts))
    span = active.groupBy(*keys).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    parts = iv.interval_linspace(span, blocks)
    covered = iv.interval_coverage(parts, active, keys, ["block"], cuts=cuts)
    covered = covered.join(paused, keys, "left")
    ratio = F.col("covered_us") / (F.col("end") - F.col("start"))
    # parts per million, so that rank order does not hang on the last float digit
    share = F.when(F.col("paused_"), F.floor(ratio * 1_000_000)).otherwise(F.lit(0))
    ident = F.concat_ws("_", *[F.col(k).cast("string") for k in keys], F.col("block"))
    ranked = ordered(
        covered.withColumns({"share_": share.cast("bigint"), "tie_": shuffle_digest(ident, seed)}),
        keys,
        "share_",
        ["share_", "tie_", "block"],
        number="rank_",
        totals={"total_": F.lit(1)},
        cuts=no_cuts(keys),
    )
    tagged = ranked.withColumn("split", part_by_rank(F.col("rank_"), F.col("total_"), (8, 1, 1)))
    pieces = iv.interval_difference(
        tagged.select(*keys, "split", "start", "end"),
        pauses.select(
            *keys,
            "start",
            "end",
            F.explode(F.array(*map(F.lit, (TRAIN, VALID, TEST)))).alias("split"),
        ),
        [*keys, "split"],
        cuts.refined("split"),
    )
    return long_enough(pieces).drop("paused_")


def half_role_split(df: DataFrame, keys: Sequence[str], pos: str, order: Sequence[str]) -> DataFrame:
    """Train is everything, valid the first half (rounded down), test the rest."""
    ranked = ordered(df, keys, pos, order, number="rank_", totals={"total_": F.lit(1)})
    role = F.when(F.col("rank_") <= F.floor(F.col("total_") / 2), VALID).otherwise(TEST)
    return ranked.withColumn("split", F.explode(F.array(F.lit(TRAIN), role))).drop(
        "rank_", "total_"
    )
