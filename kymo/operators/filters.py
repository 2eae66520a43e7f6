"""Filters over long series, block by block.

Samples are numbered along a recording and gathered into blocks of a bounded number of samples,
so that a recording of any length is spread over tasks by (recording, block number). What a block
needs of others comes from joins on block numbers; nothing runs over all blocks of a recording.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymo.functions.design import butterworth, designed, notch, state_space
from kymo.operators.series import SECOND, decimate_mean, resample_linear
from kymo.plans.lanes import matched, ordered
from kymo.sources.store import kept

BLOCK = 8192
DIRECT = 64  # taps up to which sums are cheaper than transforms


def _blocks(df: DataFrame, keys: Sequence[str], pos: str, order: Sequence[str], value: str, size: int) -> DataFrame:
    """One row per block: its rows in order, their values (unknown: zero) as an array."""
    numbered = ordered(df, keys, pos, order, number="rn_")
    row = F.struct("rn_", *[F.col(c) for c in df.columns])
    block = F.floor((F.col("rn_") - 1) / size).cast("bigint").alias("block_")
    gathered = numbered.groupBy(*keys, block).agg(F.array_sort(F.collect_list(row)).alias("rows_"))
    values = F.transform("rows_", lambda r: F.coalesce(r[value].cast("double"), F.lit(0.0)))
    return gathered.withColumn("v_", values)


def _with_sides(blocks: DataFrame, keys: Sequence[str], halo: int) -> DataFrame:
    """Add the last ``halo`` values before each block and the first after it; blocks are no
    shorter than the halo, but for a recording's last one."""
    n = F.size("v_")
    tail = F.slice("v_", F.greatest(n - halo + 1, F.lit(1)), F.lit(halo))
    sides = blocks.select(*keys, "block_", tail.alias("ahead_"), F.slice("v_", 1, halo).alias("behind_"))
    on = [*keys, "block_"]
    ahead = sides.select(*keys, (F.col("block_") + 1).alias("block_"), "ahead_")
    behind = sides.select(*keys, (F.col("block_") - 1).alias("block_"), "behind_")
    return matched(matched(blocks, ahead, on), behind, on)


def same(values: np.ndarray, taps: np.ndarray) -> np.ndarray:
    """Centred convolution, zero outside."""
    half = len(taps) // 2
    if len(taps) <= DIRECT:
        padded = np.concatenate([np.zeros(len(taps) - 1 - half), values, np.zeros(half)])
        return np.convolve(padded, taps, "valid")
    n = 1 << (len(values) + len(taps) - 2).bit_length()
    spectrum = np.fft.rfft(values, n) * np.fft.rfft(taps, n)
    return np.fft.irfft(spectrum, n)[half : half + len(values)]


def _side(values) -> np.ndarray:
    return np.zeros(0) if values is None else np.asarray(values, float)


def fir_filter(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    value: str,
    taps: Sequence[float],
    out: str,
) -> DataFrame:
    """Convolve with fixed taps along the order; outside the series and unknown samples are zero.

    Overlap-save: a block and the taps' half length on both sides are transformed together, so
    the plan does not grow with the taps. An even number of taps looks one sample further ahead.
    """
    given = np.asarray(taps, float)
    half = len(given) // 2
    size = max(BLOCK, half)

    @F.pandas_udf("array<double>")
    def run(v: pd.Series, ahead: pd.Series, behind: pd.Series) -> pd.Series:
        made = []
        for mine, before, after in zip(v, ahead, behind, strict=True):
            before = _side(before)
            whole = np.concatenate([before, _side(mine), _side(after)])
            made.append(same(whole, given)[len(before) : len(before) + len(mine)])
        return pd.Series(made)

    sided = _with_sides(_blocks(df, keys, pos, order, value, size), keys, max(half, 1))
    done = sided.select("rows_", run("v_", "ahead_", "behind_").alias("o_"))
    each = done.select(F.explode(F.arrays_zip("rows_", "o_")).alias("e_"))
    return each.select(*[F.col(f"e_.rows_.{c}").alias(c) for c in df.columns], F.col("e_.o_").alias(out))


# Band limits in Hz, the unsquared band, the high-pass of the squares, the output rate.
BANDS = {
    "delta": (1, 4),
    "theta": (3, 10),
    "alpha": (12, 23),
    "beta": (27, 38),
    "gamma": (50, 300),
}
LMP_BAND = (0.1, 20)
POWER_HIGH_PASS = 18
BAND_RATE = 50
LINE = 60


def band_power(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    value: str,
    rate: int,
    bands: Mapping[str, tuple[float, float]] | None = None,
    line: float | None = LINE,
    smooth: tuple[float | None, float | None] = (POWER_HIGH_PASS, None),
) -> DataFrame:
    """Power per band and output slot of 1/50 s: notch, band-pass, square, ``smooth``, decimate.

    The unsquared low band ``lmp`` is always added. One row per recording, slot and band; the
    slot's stamp and value are those of its middle sample, a slot without one is left out. Bands
    open at half the rate; one that starts there has no samples to show and is an error.
    ``smooth`` passes above 18 Hz of the squares, as the definition has it; ``(None, 18)`` gives
    their slow course instead. All filters are centred windowed sincs, so phases stay.
    """
    if rate % BAND_RATE:
        raise ValueError(f"sampling rate must be a multiple of {BAND_RATE}, got {rate}")
    bands = dict(BANDS if bands is None else bands)
    if any(low >= rate / 2 for low, _ in bands.values()):
        raise ValueError(f"a band starts beyond half the rate {rate}")
    per_slot = rate // BAND_RATE
    keys = list(keys)
    clean = np.ones(1) if line is None else notch(line, rate)
    first = {n: np.convolve(clean, designed(low, high, rate)) for n, (low, high) in [*bands.items(), ("lmp", LMP_BAND)]}
    # below half the output rate only, else slots would fold faster changes back
    fold = designed(None, 0.8 * BAND_RATE / 2, rate) if per_slot > 1 else np.ones(1)
    last = {n: np.convolve(designed(*smooth, rate), fold) for n in bands} | {"lmp": fold}
    names = list(first)
    near = max(len(x) // 2 for x in last.values())
    halo = near + max(len(x) // 2 for x in first.values())
    size = -(-max(BLOCK, halo) // per_slot) * per_slot

    @F.pandas_udf(", ".join(f"{n} array<double>" for n in names))
    def run(v: pd.Series, ahead: pd.Series, behind: pd.Series) -> pd.DataFrame:
        made: dict[str, list] = {n: [] for n in names}
        for mine, before, after in zip(v, ahead, behind, strict=True):
            before, after = _side(before), _side(after)
            whole = np.concatenate([before, _side(mine), after])
            # what the second filter sees of the first, inside the series
            lead, trail = min(near, len(before)), min(near, len(after))
            upto = len(whole) - (len(after) - trail)
            at = np.arange(lead + per_slot // 2, lead + len(mine), per_slot)
            for n in names:
                stage = same(whole, first[n])[len(before) - lead : upto]
                stage = stage if n == "lmp" else stage * stage
                made[n].append(same(stage, last[n])[at])
        return pd.DataFrame(made)

    slim = df.select(*dict.fromkeys([*keys, t, value]))
    sided = _with_sides(_blocks(slim, keys, t, [t], value, size), keys, max(halo, 1))
    done = sided.select(*keys, "block_", "rows_", run("v_", "ahead_", "behind_").alias("o_"))
    slot = F.posexplode(F.arrays_zip(*[F.col(f"o_.{n}").alias(n) for n in names])).alias("slot_", "s_")
    each = done.select(*keys, "block_", "rows_", slot)
    middle = F.get("rows_", F.col("slot_") * per_slot + per_slot // 2)
    slots = each.select(
        *keys,
        (F.col("block_") * (size // per_slot) + F.col("slot_")).alias("slot"),
        middle[t].alias("t"),
        *[F.col(f"s_.{n}").alias(n) for n in names],
    )
    return slots.unpivot([*keys, "slot", "t"], names, "band", "power")


def _power(a: np.ndarray, n: int) -> np.ndarray:
    return np.linalg.matrix_power(a, n)


def _both_ways(blocks: DataFrame, keys: list[str], cut: float, rate: float, size: int) -> DataFrame:
    """The recursion forward and backward over ``(keys, block_, last_, x_)``; ``x_`` becomes the output.

    A block is run from a zero state. Its end state then is ``A^n s + e`` for any start ``s``, and
    such maps are put together two by two: after p passes a block knows what the 2^p blocks
    before it leave behind. As the recursion is stable, ``A^n`` of that many samples vanishes,
    and no more passes are needed. A stage has one Python function, so a core needs one worker; it
    reads and returns Arrow arrays, without an object per sample or block.
    """
    a, b, c, d = state_space(butterworth(cut, rate))
    order = len(b)
    # the state in which a constant input of one gives a constant output
    rest = np.linalg.solve(np.eye(order) - a, b)

    longest = size + 2 * PAD
    kicks, seen = np.empty((longest, order)), np.empty((longest, order))  # A^k B and C A^k
    kicks[0], seen[0] = b, c
    for k in range(1, longest):
        kicks[k], seen[k] = a @ kicks[k - 1], seen[k - 1] @ a
    impulse = np.concatenate([[d], kicks[:-1] @ c])

    # what runs in workers refers to no other function of this module, whose imports take memory there
    def views(lists: pa.Array) -> Iterator[np.ndarray]:
        flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        return (flat[i:j] for i, j in zip(at[:-1], at[1:], strict=True))

    def listed(like: pa.Array, flat: np.ndarray, at: np.ndarray) -> pa.Array:
        return type(like).from_arrays(pa.array(at, like.offsets.type), pa.array(flat))

    def from_rest(like: pa.Array, inputs: Iterator[np.ndarray], numbers: pa.Array) -> pa.Array:
        at = like.offsets.to_numpy()
        at = at - at[0]
        out, ends = np.empty(at[-1]), np.empty((len(like), order))
        for i, (v, number) in enumerate(zip(inputs, numbers.to_numpy(zero_copy_only=False), strict=True)):
            n = len(v)
            width = 1 << (2 * n - 1).bit_length()
            y = np.fft.irfft(np.fft.rfft(v, width) * np.fft.rfft(impulse[:n], width), width)[:n]
            e = v[::-1] @ kicks[:n]
            if number == 0:
                start = rest * v[0]
                y, e = y + seen[:n] @ start, e + np.linalg.matrix_power(a, n) @ start
            out[at[i] : at[i + 1]], ends[i] = y, e
        return pa.StructArray.from_arrays(
            [listed(like, out, at), listed(like, ends.ravel(), np.arange(len(like) + 1) * order)], names=["y", "e"]
        )

    def with_start(y: pa.Array, starts: pa.Array) -> Iterator[np.ndarray]:
        # a null start is an empty view
        return (v + seen[: len(v)] @ s if len(s) else v for v, s in zip(views(y), views(starts), strict=True))

    @F.arrow_udf("struct<y:array<double>,e:array<double>>")
    def alone(x: pa.Array, block: pa.Array) -> pa.Array:
        return from_rest(x, views(x), block)

    @F.arrow_udf("struct<y:array<double>,e:array<double>>")
    def back(y: pa.Array, starts: pa.Array, block: pa.Array) -> pa.Array:
        return from_rest(y, (v[::-1] for v in with_start(y, starts)), block)

    @F.arrow_udf("array<double>")
    def added(y: pa.Array, starts: pa.Array) -> pa.Array:
        at = y.offsets.to_numpy()
        at = at - at[0]
        out = np.empty(at[-1])
        for i, v in enumerate(with_start(y, starts)):
            out[at[i] : at[i + 1]] = v
        return listed(y, out, at)

    def started(run: DataFrame) -> DataFrame:
        """With the state ``start_`` that the blocks before leave behind."""
        left = run.select(*keys, "block_", F.col("e").alias("carry_"))
        reach = 1
        while np.abs(_power(a, size * reach)).max() > 1e-18:
            far = left.select(*keys, (F.col("block_") + reach).alias("block_"), F.col("carry_").alias("far_"))
            left = kept(matched(left, far, [*keys, "block_"]).select(*keys, "block_", _plus("carry_", _times(_power(a, size * reach), "far_")).alias("carry_")))
            reach *= 2
        start = left.select(*keys, (F.col("block_") + 1).alias("block_"), F.col("carry_").alias("start_"))
        return matched(run, start, [*keys, "block_"])

    turned = (F.col("last_") - F.col("block_")).alias("block_")
    run = kept(blocks.withColumn("r_", alone("x_", "block_")).select(*keys, "block_", "last_", "r_.y", "r_.e"))
    again = started(run).select(*keys, turned, "last_", back("y", "start_", turned).alias("r_"))
    run = kept(again.select(*keys, "block_", "last_", "r_.y", "r_.e"))
    return started(run).select(*keys, turned, F.reverse(added("y", "start_")).alias("x_"))


def _times(matrix: np.ndarray, column: str) -> Column:
    """A matrix of numbers times an array column; null stays null."""
    rows = [sum((F.get(column, F.lit(j)) * F.lit(float(m)) for j, m in enumerate(line)), F.lit(0.0)) for line in matrix]
    return F.when(F.col(column).isNotNull(), F.array(*rows))


def _plus(column: str, other: Column) -> Column:
    return F.when(other.isNull(), F.col(column)).otherwise(F.zip_with(column, other, lambda p, q: p + q))


PAD = 15


def zero_phase_low_pass(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    value: str,
    cut: float,
    rate: float,
    out: str,
    size: int = BLOCK,
) -> DataFrame:
    """Fourth-order recursive low-pass, forward and backward, so that phases stay.

    Series are continued at both ends by up to 15 samples turned about the end sample, and start
    in the state of a constant input. Unknown samples count as zero; a series of one sample is
    its own result.
    """
    keys = list(keys)
    size = max(size, PAD + 1)
    blocks = kept(_blocks(df, keys, pos, order, value, size))
    ends = blocks.groupBy(*keys).agg(F.max("block_").alias("last_"))
    # the continuation behind a short last block looks into the block before it
    slim = matched(blocks.select(*keys, "block_", "v_"), ends, keys)
    on = [*keys, "block_"]
    n = F.size("v_")
    tails = slim.select(*keys, (F.col("block_") + 1).alias("block_"), F.slice("v_", F.greatest(n - PAD, F.lit(1)), F.lit(PAD + 1)).alias("ahead_"))
    known = matched(slim, tails, on)
    turned = lambda around, values: F.transform(values, lambda x: F.lit(2.0) * around - x)
    pad = F.least(F.lit(PAD), n - 1)
    front = turned(F.get("v_", F.lit(0)), F.reverse(F.slice("v_", 2, F.when(n > 1, pad).otherwise(0))))
    recent = F.concat(F.coalesce("ahead_", F.array().cast("array<double>")), F.col("v_"))
    size_r = F.size(recent)
    behind = F.least(F.lit(PAD), size_r - 1)
    back = turned(F.element_at(recent, -1), F.reverse(F.slice(recent, F.greatest(size_r - behind, F.lit(1)), behind)))
    none = F.array().cast("array<double>")
    x = F.concat(
        F.when(F.col("block_") == 0, front).otherwise(none),
        F.col("v_"),
        F.when(F.col("block_") == F.col("last_"), back).otherwise(none),
    )
    lengths = slim.select(*keys, "block_", n.alias("n_"), F.when(F.col("block_") == 0, F.when(n > 1, pad).otherwise(0)).otherwise(0).alias("lead_"))
    result = _both_ways(known.select(*keys, "block_", "last_", x.alias("x_")), keys, cut, rate, size)
    result = result.withColumnRenamed("x_", "y_")
    placed = matched(matched(blocks.select(*keys, "block_", "rows_"), lengths, on), result, on)
    each = placed.select(F.explode(F.arrays_zip("rows_", F.slice("y_", F.col("lead_") + 1, F.col("n_")).alias("o_"))).alias("e_"))
    return each.select(*[F.col(f"e_.rows_.{c}").alias(c) for c in df.columns], F.col("e_.o_").alias(out))


def reduce_wideband(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    value: str,
    rate: float,
    target: float = 1000.0,
    factor: int = 4,
) -> DataFrame:
    """Wideband samples at the rate of field potentials: means of ``factor`` samples, zero-phase
    low-pass at a third of the target rate, linear interpolation on the target's grid."""
    # fixed values: the cut-off as a part of the target rate
    cut = 0.333 * target
    fewer = decimate_mean(df.select(*keys, t, value), keys, t, value, factor)
    smooth = zero_phase_low_pass(fewer, keys, t, [t], value, cut, rate / factor, "low_")
    slim = smooth.select(*keys, t, F.col("low_").alias(value))
    return resample_linear(slim, keys, t, value, round(SECOND / target))
