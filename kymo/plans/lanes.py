"""Ordered scans over a key that stay parallel when one key holds most rows.

A plain ``Window.partitionBy(recording)`` puts a recording into one task. Here a
recording that is too large for that is cut along its order into *lanes*, and the
window runs per ``(recording, lane)``. What a lane needs from its neighbours (the
previous row, the running sum so far, ...) is first computed on one row per lane,
handed on within groups of lanes and then from group to group, and joined back, so
results equal those of the plain window.

Lanes hold about equally many rows however these bunch up: their borders are quantiles
from mergeable sketches, and rows at one position are cut along a second column.
Ordinary recordings form a single lane (``-1``). When a count per key finds no
large recording at all, the plan is the plain window and nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kymo.sources.store import kept

LANE = "lane_"
_ALL = "all_"

HOT_ROWS_CONF = "spark.kymo.hotRows"
LANE_ROWS_CONF = "spark.kymo.laneRows"
HOT_ROWS = 1_000_000
LANE_ROWS = 65_536

# One level of cuts makes at most FAN parts of a key or lane, and a mark more for every
# position that fills parts on its own; SKETCH keeps ranks exact to a fifth of such a part.
FAN, SKETCH = 512, 16_384
STRIDE = 2 * FAN
# Lanes are handed on in groups of so many.
SCAN = 1024
# A table is broadcast up to this many bytes; beyond, both sides of a join are salted.
BROADCAST_BYTES = 64 << 20
SALTS = 256
# Rows that a task sorts, where their number is known beforehand.
TASK_ROWS = 1 << 18
# A table of up to so many rows of known width is held by the driver instead of being written.
FEW = 1000


def _setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(name, str(default)))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _pack(columns: Mapping[str, Column | str]) -> Column:
    return F.struct(*[_col(c).alias(name) for name, c in columns.items()])


def matched(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on columns of both sides in which null equals null."""
    named = table.select(*[F.col(c).alias(f"{c}_of_table_") if c in on else F.col(c) for c in table.columns])
    same = [F.col(c).eqNullSafe(F.col(f"{c}_of_table_")) for c in on]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return rows.join(named, condition, how).drop(*[f"{c}_of_table_" for c in on])


def looked_up(rows: DataFrame, table: DataFrame, on: Sequence[str], n_bytes: int) -> DataFrame:
    """Left join of a table of one row per ``on`` with rows of which one key may hold many."""
    if n_bytes <= BROADCAST_BYTES:
        return matched(rows, F.broadcast(table), on)
    salted = rows.withColumn("salt_", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    spread = table.withColumn("salt_", F.explode(salts))
    return matched(salted, spread, [*on, "salt_"]).drop("salt_")


def _axis(df: DataFrame, column: str) -> Column:
    """A bigint that never decreases along the column; null comes first."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.StringType):
        # the first seven bytes
        leading = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 7)), 14, "0")
        value = F.conv(leading, 16, 10).cast("bigint")
    elif isinstance(kind, T.DoubleType | T.FloatType | T.DecimalType):
        # by size of the exponent; NaN sorts last
        number = value.cast("double")
        grown = F.least(F.log2(F.abs(number) + F.lit(2.0**-60)) + F.lit(61.0), F.lit(2000.0))
        ordered_ = (F.signum(number) * F.greatest(grown, F.lit(0.0)) * F.lit(float(1 << 40))).try_cast("bigint")
        value = F.when(F.isnan(number), F.lit(1 << 62)).otherwise(ordered_)
    elif isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType):
        value = F.unix_micros(value.cast("timestamp"))
    else:
        value = value.try_cast("bigint")
    return F.coalesce(value, F.lit(-(1 << 62)))


@dataclass(frozen=True)
class Level:
    """One level of cuts: a table of one row per key, and per lane so far (``lane_so_far_``) after the
    first level, with ``marks_`` on the axis, or with the lowest value and width of even steps."""

    table: DataFrame
    n_bytes: int
    tie: str | None = None
    even: bool = False


@dataclass(frozen=True)
class Cuts:
    """Keys to cut along one axis, and by how many levels of a table.

    Lanes are a function of key and position (and of the column that cuts ties) alone, so cuts
    measured on an operator's input also serve every result it derives with the same keys.
    ``on`` are the measured keys. ``key_bytes`` sums the text in all keys, ``n_rows`` counts the rows.
    """

    keys: tuple[str, ...]
    on: tuple[str, ...] = ()
    levels: tuple[Level, ...] = ()
    n_keys: int | None = None
    key_bytes: int = 0
    n_rows: int | None = None

    def along(self, lowest: int, width: int) -> Cuts:
        """The same keys on an axis with a known range."""
        if not self.levels:
            return self
        first = self.levels[0]
        steps = first.table.select(*self.on, F.lit(lowest).cast("bigint").alias("lo_"), F.lit(width).cast("bigint").alias("width_"))
        return replace(self, levels=(Level(steps, first.n_bytes, even=True),))

    def refined(self, *names: str) -> Cuts:
        """Keys extended by columns; a key's lanes serve all its parts."""
        return replace(self, keys=(*self.keys, *names), n_keys=None)


def no_cuts(keys: Sequence[str]) -> Cuts:
    """For groups whose size has a small fixed bound."""
    return Cuts(tuple(keys), tuple(keys))


def measure(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    bounds: tuple[int, int] | None = None,
    tie: str | None = None,
    stats: DataFrame | None = None,
) -> Cuts:
    """Count rows per key and decide which keys to cut: one narrow, combined pass.

    ``bounds`` gives the range of ``pos`` where it is known beforehand and evenly filled. Else
    the keys that are too large get a sketch of their positions in a second pass. ``tie`` cuts
    what is left at one position. ``stats`` gives the rows per key (``n_``) where they are known
    without reading ``df``.
    """
    keys = list(keys)
    if stats is None:
        stats = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_"))
    cuts, found = _hot(stats, keys)
    if found is None:
        return cuts
    hot, size = found
    if bounds:
        steps = F.ceil(F.col("n_") / _setting(df, LANE_ROWS_CONF, LANE_ROWS))
        span = bounds[1] - bounds[0] + 1
        width = F.greatest(F.ceil(F.lit(span) / steps), F.lit(1)).cast("bigint")
        table = hot.select(*keys, F.lit(bounds[0]).cast("bigint").alias("lo_"), width.alias("width_"))
        return replace(cuts, levels=(Level(table, size, even=True),))
    tie = tie if tie in df.columns and tie != pos and tie not in keys else None
    axes = [F.col(pos).cast("bigint").alias("axis_pos_")]
    if tie:
        axes.append(_axis(df, tie).alias("axis_tie_"))
    rows = looked_up(df.select(*keys, *axes), hot, keys, size).filter("n_ is not null").drop("n_")
    return replace(cuts, levels=tuple(_levels(rows, hot, size, keys, tie)))


def _hot(stats: DataFrame, keys: list[str]) -> tuple[Cuts, tuple[DataFrame, int] | None]:
    """What is known of all keys, and a table of those to cut with its size, or None."""
    text = [F.octet_length(k) for k in keys if isinstance(stats.schema[k].dataType, T.StringType)]
    long = sum((F.coalesce(c, F.lit(0)) for c in text), F.lit(0)).cast("bigint")
    n_keys, most, held, n_rows = stats.agg(F.count(F.lit(1)), F.max("n_"), F.sum(long), F.sum("n_")).first()
    cuts = Cuts(tuple(keys), tuple(keys), (), n_keys, int(held or 0), int(n_rows or 0))
    limit = _setting(stats, HOT_ROWS_CONF, HOT_ROWS)
    if most is None or most <= limit:
        return cuts, None
    return cuts, _held(stats.filter(F.col("n_") > limit))


def _held(df: DataFrame) -> tuple[DataFrame, int]:
    """A table of keys, computed once, and its size in bytes."""
    rows = df.limit(FEW + 1).collect()
    if len(rows) <= FEW:
        sizes = (
            4 * len(x) if isinstance(x, str) else 8 * len(x) if isinstance(x, list) else 16 for row in rows for x in row
        )
        return df.sparkSession.createDataFrame(rows, df.schema), sum(sizes)
    table = kept(df)
    text = [F.octet_length(f.name) for f in table.schema if isinstance(f.dataType, T.StringType)]
    text += [F.size(f.name) * 8 for f in table.schema if isinstance(f.dataType, T.ArrayType)]
    each = sum((F.coalesce(c, F.lit(0)) for c in text), F.lit(16 * len(table.columns))).cast("bigint")
    return table, int(table.agg(F.sum(each)).first()[0] or 0)


def _levels(rows: DataFrame, hot: DataFrame, size: int, keys: list[str], tie: str | None) -> list[Level]:
    """Quantile cuts until no part holds more than two lanes' rows, or nothing parts it.

    Counting again is needed only where a part may be too large: where a key wants more parts
    than one level gives, or a position fills more than one of them.
    """
    lane_rows = _setting(rows, LANE_ROWS_CONF, LANE_ROWS)
    levels: list[Level] = []
    parts, here, axis = hot, list(keys), "axis_pos_"
    for depth in range(8):
        wanted = F.ceil(F.col("n_") / lane_rows)
        part = F.least(wanted, F.lit(FAN)).cast("int")
        met = looked_up(rows, parts.select(*here, "n_"), here, size).filter("n_ is not null")
        sketch = met.groupBy(*here).agg(
            F.kll_sketch_agg_bigint(axis, F.lit(SKETCH)).alias("sketch_"), F.first("n_").alias("n_")
        )
        # all the quantiles a level may need, and of these as many as a key has parts
        ranks = ", ".join(f"{i / FAN!r}D" for i in range(1, FAN))
        grid = F.kll_sketch_get_quantile_bigint("sketch_", F.expr(f"array({ranks})"))
        chosen = F.transform(
            F.sequence(F.lit(1), part - 1), lambda i: F.get("grid_", F.floor(i * FAN / part).cast("int") - 1)
        )
        found = F.when(part > 1, chosen).otherwise(F.array())
        # a position that fills more than a part of its own ends with a mark, too
        before = F.concat(F.array(F.lit(None).cast("bigint")), F.slice("found_", 1, F.size("found_") - 1))
        twice = F.filter(
            F.zip_with("found_", before, lambda q, r: F.when(q == r, q + 1)), lambda q: q.isNotNull()
        )
        cut = sketch.withColumn("grid_", grid).withColumn("found_", found.cast("array<bigint>"))
        marked = cut.select(
            *here,
            F.array_sort(F.array_distinct(F.concat("found_", twice))).alias("marks_"),
            ((F.size(twice) > 0) | (wanted > FAN)).alias("more_"),
        )
        table, n_bytes = _held(marked)
        more = not table.filter("more_").isEmpty()
        levels.append(Level(table.drop("more_"), n_bytes, tie if axis == "axis_tie_" else None))
        rows = _stepped(rows, levels[-1], here, axis)
        if not depth and not more:
            break
        here = [*keys, "lane_so_far_"]
        one = F.min("axis_pos_") == F.max("axis_pos_")
        same = F.min("axis_tie_") == F.max("axis_tie_") if tie else F.lit(True)
        counted = rows.groupBy(*here).agg(F.count(F.lit(1)).alias("n_"), one.alias("one_"), same.alias("same_"))
        # rows equal in both columns are not parted
        left, size = _held(counted.filter((F.col("n_") > 2 * lane_rows) & ~(F.col("one_") & F.col("same_"))))
        parts, axis = left.filter(~F.col("one_")), "axis_pos_"
        if parts.isEmpty():
            parts, axis = left, "axis_tie_"
        if parts.isEmpty():
            break
    return levels


def _place(marks: Column, value: Column) -> Column:
    """How many of the sorted marks are at most the value, by halving."""
    steps = F.array(*[F.lit(1 << i) for i in range(STRIDE.bit_length() - 1, -1, -1)])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.get(marks, at + step - 1) <= value, step).otherwise(F.lit(0))
    )


def _stepped(rows: DataFrame, level: Level, on: Sequence[str], axis: str) -> DataFrame:
    """Add the level's step to ``lane_so_far_``, the lane so far; null for keys that are not cut."""
    first = "lane_so_far_" not in rows.columns
    met = looked_up(rows, level.table, on, level.n_bytes)
    if level.even:
        step = F.floor((F.col(axis) - F.col("lo_")) / F.col("width_")).cast("bigint")
        return met.withColumn("lane_so_far_", F.greatest(step, F.when(step.isNotNull(), F.lit(0)))).drop("lo_", "width_")
    place = F.when(F.col("marks_").isNotNull(), _place(F.col("marks_"), F.col(axis))).cast("bigint")
    if not first:
        place = F.col("lane_so_far_") * STRIDE + F.coalesce(place, F.lit(0))
    return met.withColumn("lane_so_far_", place).drop("marks_")


def assign_lanes(
    df: DataFrame, keys: Sequence[str], pos: str, cuts: Cuts | None = None, tie: str | None = None
) -> DataFrame:
    """Add the lane number of every row.

    ``pos`` is a non-null bigint column that never decreases along the order used
    later, ``tie`` the next column of that order. Only keys above the row limit are cut.
    With none, the plan that follows is the plain window.
    """
    keys = list(keys)
    cuts = measure(df, keys, pos, tie=tie) if cuts is None else cuts
    if sorted(cuts.keys) != sorted(keys):
        raise ValueError(f"cuts for {cuts.keys} do not fit keys {keys}")
    if not cuts.levels:
        plain = df.withColumn(LANE, F.lit(-1).cast("bigint"))
        return plain.withMetadata(LANE, {"cut": False})
    rows = df.withColumn("axis_pos_", F.col(pos).cast("bigint"))
    on = list(cuts.on)
    for i, level in enumerate(cuts.levels):
        if level.tie and level.tie not in df.columns:
            continue
        axis = "axis_pos_" if level.tie is None else "axis_tie_"
        if level.tie:
            rows = rows.withColumn("axis_tie_", _axis(df, level.tie))
        rows = _stepped(rows, level, [*on, "lane_so_far_"] if i else on, axis)
    return rows.withColumn(LANE, F.coalesce("lane_so_far_", F.lit(-1).cast("bigint"))).drop("axis_pos_", "axis_tie_", "lane_so_far_")


def dealt(rows: DataFrame, on: Sequence[str], cuts: Cuts) -> DataFrame:
    """Rows dealt to as many tasks as their number asks for, so that no task sorts more as a table grows."""
    return rows.repartition(max(1, -(-(cuts.n_rows or 0) // TASK_ROWS)), *on) if cuts.n_rows is not None else rows.repartition(*on)


def is_cut(df: DataFrame) -> bool:
    """False when no key of ``df`` was large enough to be cut into lanes."""
    return bool(df.schema[LANE].metadata.get("cut", True))


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str] | None = None,
    *,
    prev: Mapping[str, Column | str] | None = None,
    following: Mapping[str, Column | str] | None = None,
    sums: Mapping[str, Column | str] | None = None,
    earlier_max: Mapping[str, Column | str] | None = None,
    totals: Mapping[str, Column | str] | None = None,
    last_known: Mapping[str, Column | str] | None = None,
    next_known: Mapping[str, Column | str] | None = None,
    number: str | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Window values along ``order`` within ``keys``, without one task per key.

    ``prev``/``following``: the value one row before/after. ``sums``: running sum
    including the row. ``earlier_max``: largest value on earlier rows. ``totals``:
    sum over the whole key. ``last_known``/``next_known``: nearest non-null value
    at or before/after the row. ``number``: position from 1. Without ``cuts`` the
    frame itself is measured, unless it carries lanes already.
    """
    prev, following = dict(prev or {}), dict(following or {})
    sums, totals = dict(sums or {}), dict(totals or {})
    earlier_max = dict(earlier_max or {})
    last_known, next_known = dict(last_known or {}), dict(next_known or {})
    order = list(order or [pos])
    out = list(df.columns)
    if not keys:
        df = df.withColumn(_ALL, F.lit(0))
        keys = [_ALL]
    keys = list(keys)
    tie = next((c for c in order if c != pos), None)
    rows = df if LANE in df.columns else assign_lanes(df, keys, pos, cuts, tie)

    cut = is_cut(rows)
    if cut:
        edges = _lane_edges(
            rows, keys, order, prev, following, sums, earlier_max, totals, last_known, next_known
        )
        rows = matched(rows, edges.drop("rows_"), [*keys, LANE])

    def handed(here: Column, edge: str, join=F.coalesce) -> Column:
        return join(here, F.col(edge)) if cut else here

    lane = Window.partitionBy(*keys, LANE) if cut else Window.partitionBy(*keys)
    along = lane.orderBy(*order)
    back = lane.orderBy(*[F.desc(c) for c in order])
    to_here = along.rowsBetween(Window.unboundedPreceding, 0)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)

    def plus(here: Column, before: Column) -> Column:
        return here + F.coalesce(before, F.lit(0))

    made: dict[str, Column] = {}
    if prev:
        made["prev_"] = handed(F.lag(_pack(prev)).over(along), "edge_prev_")
    if following:
        made["following_"] = handed(F.lead(_pack(following)).over(along), "edge_following_")
    for name, value in sums.items():
        made[name] = handed(F.sum(_col(value)).over(to_here), f"edge_sum_{name}", plus)
    for name, value in earlier_max.items():
        made[name] = handed(F.max(_col(value)).over(earlier), f"edge_max_{name}", F.greatest)
    for name, value in totals.items():
        whole = F.sum(_col(value)).over(lane)
        made[name] = F.coalesce(F.col(f"edge_total_{name}"), whole) if cut else whole
    for name, value in last_known.items():
        here = F.last(_col(value), ignorenulls=True).over(to_here)
        made[name] = handed(here, f"edge_last_{name}")
    for name, value in next_known.items():
        here = F.last(_col(value), ignorenulls=True).over(
            back.rowsBetween(Window.unboundedPreceding, 0)
        )
        made[name] = handed(here, f"edge_next_{name}")
    if number:
        here = F.row_number().over(along).cast("bigint")
        made[number] = handed(here, "edge_rows_", plus)
    result = rows.select(*[c for c in out], *[c.alias(name) for name, c in made.items()])
    unpacked = [F.col(f"prev_.{n}").alias(n) for n in prev]
    unpacked += [F.col(f"following_.{n}").alias(n) for n in following]
    direct = [n for n in made if n not in ("prev_", "following_")]
    return result.select(*out, *unpacked, *direct)


def _lane_edges(
    rows, keys, order, prev, following, sums, earlier_max, totals, last_known, next_known
) -> DataFrame:
    """One row per lane of the cut keys: what its neighbours hand over."""
    at = F.struct(*[F.col(c) for c in order])
    aggs = [F.count(F.lit(1)).alias("rows_")]
    if prev:
        aggs.append(F.max_by(_pack(prev), at).alias("last_"))
    if following:
        aggs.append(F.min_by(_pack(following), at).alias("first_"))
    aggs += [F.sum(_col(v)).alias(f"sum_{n}") for n, v in sums.items()]
    aggs += [F.max(_col(v)).alias(f"max_{n}") for n, v in earlier_max.items()]
    aggs += [F.sum(_col(v)).alias(f"total_{n}") for n, v in totals.items()]
    for n, v in last_known.items():
        aggs.append(F.max_by(_col(v), F.when(_col(v).isNotNull(), at)).alias(f"last_{n}"))
    for n, v in next_known.items():
        aggs.append(F.min_by(_col(v), F.when(_col(v).isNotNull(), at)).alias(f"next_{n}"))
    lanes = rows.filter(F.col(LANE) >= 0).groupBy(*keys, LANE).agg(*aggs)
    names = {
        "sum": [*sums], "max": [*earlier_max], "total": [*totals], "last": [*last_known], "next": [*next_known],
        "prev": bool(prev), "following": bool(following),
    }
    return _handed_on(lanes, list(keys), LANE, names, 2)


def _handed_on(lanes: DataFrame, keys: list[str], lane: str, names: dict, depth: int) -> DataFrame:
    """What every lane gets from those before and after it.

    Lanes are scanned in groups of successive numbers, the groups likewise one level up, and
    what a group gets is joined back to its lanes. No window holds all lanes of a key.
    """
    group = f"group{depth}_"
    inner = lanes.withColumn(group, F.floor(F.col(lane) / SCAN).cast("bigint")) if depth else lanes.withColumn(group, F.lit(0).cast("bigint"))
    within = Window.partitionBy(*keys, group)
    along, back = within.orderBy(lane), within.orderBy(F.desc(lane))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    got = {"edge_rows_": F.sum("rows_").over(earlier)}
    if names["prev"]:
        got["edge_prev_"] = F.lag("last_").over(along)
    if names["following"]:
        got["edge_following_"] = F.lead("first_").over(along)
    got |= {f"edge_sum_{n}": F.sum(f"sum_{n}").over(earlier) for n in names["sum"]}
    got |= {f"edge_max_{n}": F.max(f"max_{n}").over(earlier) for n in names["max"]}
    got |= {f"edge_total_{n}": F.sum(f"total_{n}").over(within) for n in names["total"]}
    got |= {f"edge_last_{n}": F.last(f"last_{n}", ignorenulls=True).over(earlier) for n in names["last"]}
    got |= {f"edge_next_{n}": F.last(f"next_{n}", ignorenulls=True).over(later) for n in names["next"]}
    here = inner.select(*keys, lane, group, "rows_", *[c.alias(n) for n, c in got.items()])
    if not depth:
        return here.drop(group)
    up = [F.sum("rows_").alias("rows_")]
    if names["prev"]:
        up.append(F.max_by("last_", lane).alias("last_"))
    if names["following"]:
        up.append(F.min_by("first_", lane).alias("first_"))
    up += [F.sum(f"sum_{n}").alias(f"sum_{n}") for n in names["sum"]]
    up += [F.max(f"max_{n}").alias(f"max_{n}") for n in names["max"]]
    up += [F.sum(f"total_{n}").alias(f"total_{n}") for n in names["total"]]
    up += [F.max_by(f"last_{n}", F.when(F.col(f"last_{n}").isNotNull(), F.col(lane))).alias(f"last_{n}") for n in names["last"]]
    up += [F.min_by(f"next_{n}", F.when(F.col(f"next_{n}").isNotNull(), F.col(lane))).alias(f"next_{n}") for n in names["next"]]
    groups = _handed_on(inner.groupBy(*keys, group).agg(*up), keys, group, names, depth - 1).drop("rows_")
    renamed = groups.select(*keys, group, *[F.col(n).alias(f"of_{n}") for n in got])
    both = matched(here, renamed, [*keys, group])

    def combined(name: str) -> Column:
        mine, far = F.col(name), F.col(f"of_{name}")
        if name.startswith("edge_total_"):
            return far
        if name == "edge_rows_" or name.startswith("edge_sum_"):
            return F.coalesce(mine + far, mine, far)
        return F.greatest(mine, far) if name.startswith("edge_max_") else F.coalesce(mine, far)

    return both.select(*keys, lane, "rows_", *[combined(n).alias(n) for n in got])


def with_halo(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    before: int,
    after: int,
    flag: str = "halo_",
    cuts: Cuts | None = None,
) -> DataFrame:
    """Give every lane copies of the ``before``/``after`` rows around it.

    Row frames no wider than that, taken over ``(keys, LANE)``, then equal frames
    over the whole key. Copies carry ``flag`` = true; drop them after the window.

    Rows are numbered along the key; a lane asks for the numbers around its own, and both
    meet by blocks of numbers.
    """
    tie = next((c for c in order if c != pos), None)
    rows = df if LANE in df.columns else assign_lanes(df, keys, pos, cuts, tie)
    if not is_cut(rows):
        return rows.withColumn(flag, F.lit(False))
    keys, names = list(keys), rows.columns
    inside = rows.filter(F.col(LANE) >= 0)
    lanes = _lane_edges(inside, keys, order, {}, {}, {}, {}, {}, {}, {})
    lane = Window.partitionBy(*keys, LANE)
    head = F.row_number().over(lane.orderBy(*order)).cast("bigint")
    spans = lanes.select(*keys, LANE, "rows_", F.coalesce("edge_rows_", F.lit(0)).cast("bigint").alias("ahead_"))
    borders = (
        matched(inside.withColumn("head_", head), spans, [*keys, LANE], "inner")
        .filter((F.col("head_") <= after) | (F.col("head_") > F.col("rows_") - before))
        .withColumn("number_", F.col("ahead_") + F.col("head_"))
    )
    width = max(before, after, 1)
    end = F.col("ahead_") + F.col("rows_")
    sides = F.array(
        F.struct((F.col("ahead_") - before + 1).alias("from_"), F.col("ahead_").alias("to_")),
        F.struct((end + 1).alias("from_"), (end + after).alias("to_")),
    )
    asked = spans.select(*keys, F.col(LANE).alias("for_"), F.explode(sides).alias("side_")).select(*keys, "for_", "side_.*")
    asked = asked.filter("to_ >= from_").withColumn(
        "block_", F.explode(F.sequence(F.floor(F.col("from_") / width), F.floor(F.col("to_") / width)))
    )
    given = borders.withColumn("block_", F.floor(F.col("number_") / width))
    met = matched(given, asked, [*keys, "block_"], "inner").filter(F.col("number_").between(F.col("from_"), F.col("to_")))
    copies = met.withColumn(LANE, F.col("for_")).select(*names)
    return rows.withColumn(flag, F.lit(False)).unionByName(copies.withColumn(flag, F.lit(True)))


def attach(
    rows: DataFrame, table: DataFrame, on: Sequence[str], cuts: Cuts | None = None, row_bytes: int = 0
) -> DataFrame:
    """Left join of a one-row-per-``on`` table that never moves a hot key as a whole.

    A table whose bytes are known to be few is broadcast: ``cuts`` of the same keys tell how
    many these are and how long, ``row_bytes`` bounds its columns of no fixed width. Otherwise
    its row is repeated for each lane of a cut key, so the join spreads as the rows do.
    """
    on = list(on)
    open_ended = [f for f in table.schema if f.name not in on and isinstance(f.dataType, T.StringType | T.ArrayType | T.MapType | T.BinaryType)]
    if cuts is not None and cuts.n_keys is not None and sorted(cuts.keys) == sorted(on) and (row_bytes or not open_ended):
        if cuts.key_bytes + cuts.n_keys * (16 * len(table.columns) + row_bytes) <= BROADCAST_BYTES:
            return rows.join(F.broadcast(table), on, "left")
    if LANE not in rows.columns or not is_cut(rows):
        return rows.join(table, on, "left")
    lanes = rows.filter(F.col(LANE) >= 0).select(*on, LANE).distinct().join(table, on)
    spread = table.withColumn(LANE, F.lit(-1).cast("bigint")).unionByName(lanes)
    return rows.join(spread, [*on, LANE], "left")


def spread_range(df: DataFrame, keys: Sequence[str], n: Column, out: str) -> DataFrame:
    """One row per number 0..n-1 of each input row, made in parallel.

    Numbers are produced in blocks that are shuffled before they are unfolded, so
    one long recording does not become one long array in one task.
    """
    last = n.cast("bigint") - 1
    block = F.lit(LANE_ROWS).cast("bigint")
    blocks = (
        df.withColumn("last_", last)
        .filter(F.col("last_") >= 0)
        .withColumn(
            "block_",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("last_") / block))),
        )
        .repartition(*keys, "block_")
    )
    first = F.col("block_") * block
    return blocks.withColumn(
        out, F.explode(F.sequence(first, F.least(first + block - 1, F.col("last_"))))
    ).drop("last_", "block_")


# Bits of a value that one pass of a median looks at.
DIGIT = 16


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str = "median",
    cuts: Cuts | None = None,
) -> DataFrame:
    """Exact median of a bigint column per key, null when the key has no value.

    ``cuts`` are those of the rows, on any axis; where they find no large key, the built-in
    percentile holds a key's values. Else the median's bits are found from the highest on: a
    pass counts rows per next digit among those that share the bits so far. A key has at most
    2^16 counts in a pass, however many values it has.
    """
    keys = list(keys)
    known = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("bigint").alias("v_"))
    cuts = measure(known, keys, "v_", bounds=(0, 1)) if cuts is None else cuts
    if not cuts.levels:
        return known.groupBy(*keys).agg(F.percentile("v_", F.lit(0.5)).alias(out))
    rows = kept(known)
    least, most = rows.agg(F.min("v_"), F.max("v_")).first()
    if least is None:
        return known.groupBy(*keys).agg(F.percentile("v_", F.lit(0.5)).alias(out))
    # unsigned order: the sign bit turned over
    sign = -(1 << 63)
    bits = F.col("v_").bitwiseXOR(F.lit(sign))
    unsigned = [(v + (1 << 63)) for v in (least, most)]
    shift = -(-(unsigned[0] ^ unsigned[1]).bit_length() // DIGIT) * DIGIT
    lead = unsigned[0] >> shift
    lead -= (lead >> 63) << 64  # as a long
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_"))
    ranks = F.array(F.floor((F.col("n_") + 1) / 2), F.floor(F.col("n_") / 2) + 1)
    state = kept(counts.select(*keys, F.posexplode(ranks).alias("which_", "rank_")).withColumn("bits_", F.lit(lead).cast("bigint")))
    while shift:
        shift -= DIGIT
        asked = state.select(*keys, "bits_").distinct()
        size = (cuts.key_bytes + (cuts.n_keys or 0) * 16 * (len(keys) + 2)) * 2
        size = size if cuts.n_keys is not None else BROADCAST_BYTES + 1
        above = F.shiftrightunsigned(bits, shift + DIGIT) if shift + DIGIT < 64 else F.lit(0).cast("bigint")
        near = looked_up(rows.withColumn("bits_", above), asked.withColumn("met_", F.lit(True)), [*keys, "bits_"], size)
        digit = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << DIGIT) - 1)) if shift else bits.bitwiseAND(F.lit((1 << DIGIT) - 1))
        found = near.filter("met_").groupBy(*keys, "bits_", digit.alias("digit_")).agg(F.count(F.lit(1)).alias("c_"))
        joined = matched(found, state, [*keys, "bits_"], "inner")
        upto = F.sum("c_").over(Window.partitionBy(*keys, "which_").orderBy("digit_"))
        placed = joined.withColumn("upto_", upto).filter((F.col("upto_") >= F.col("rank_")) & (F.col("upto_") - F.col("c_") < F.col("rank_")))
        longer = F.shiftleft("bits_", DIGIT).bitwiseOR(F.col("digit_"))
        state = kept(placed.select(*keys, "which_", (F.col("rank_") - F.col("upto_") + F.col("c_")).alias("rank_"), longer.alias("bits_")))
    whole = F.col("bits_").bitwiseXOR(F.lit(sign)).cast("double")
    return state.groupBy(*keys).agg((F.sum(whole) / F.lit(2.0)).alias(out))
