"""Time-series operators on small literal inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kymo.operators import series as ts

S = 1_000_000


def stamps(spark, seconds, key="r"):
    rows = [(key, i, round(t * S)) for i, t in enumerate(seconds)]
    return spark.createDataFrame(rows, "k string, pos bigint, t bigint")


def segments(spark, seconds):
    got = ts.segment_by_median_gap(stamps(spark, seconds).drop("pos"), ["k"], "t")
    return [(r.start / S, r.end / S) for r in got.orderBy("start").collect()]


def test_segments(spark, cutting):
    step = [i / 100 for i in range(100)]
    assert segments(spark, step) == [(0.0, 1.0)]
    gapped = step[:50] + [1 + t for t in step[:50]]
    assert segments(spark, gapped) == [(0.0, 0.5), (1.0, 1.5)]
    assert segments(spark, [5.0]) == [(5.0, 5.01)]
    assert segments(spark, []) == []


@pytest.mark.parametrize(
    "seconds,status,rate",
    [
        ([k / 1000 for k in range(100)], "ok", 1000.0),
        ([k / 250 for k in range(100)], "ok", 250.0),
        ([0.0, 0.1, 0.2, 0.4, 0.5], "irregular", None),
        ([1.0, 1.0, 1.0], "not_increasing", None),
        ([0.0, 0.2, 0.1], "not_increasing", None),
        ([0.0], "too_few", None),
    ],
)
def test_sampling_rate(spark, cutting, seconds, status, rate):
    got = ts.sampling_rate(stamps(spark, seconds), ["k"], "t", "pos", ["pos"]).collect()
    assert [(r.status, r.rate_hz) for r in got] == [(status, rate)]


def test_segment_by_period(spark, cutting):
    got = ts.segment_by_period(stamps(spark, [0, 0.001, 0.002, 0.01]), ["k"], "t", 1000)
    assert sorted((r.start, r.end) for r in got.collect()) == [(0, 2100), (10_000, 10_100)]


def test_gradient_equals_numpy(spark, cutting):
    rng = np.random.default_rng(0)
    t = np.cumsum(rng.uniform(0.5, 2, 30)).round(3)
    v = rng.normal(size=30)
    rows = [("a", int(round(x * S)), float(y)) for x, y in zip(t, v)] + [("lone", 5, 1.0)]
    df = spark.createDataFrame(rows, "k string, t bigint, v double")
    got = ts.gradient(df, ["k"], "t", "v", "d").orderBy("k", "t").collect()
    want = np.gradient(v, t)
    assert np.allclose([r.d for r in got if r.k == "a"], want)
    assert [r.d for r in got if r.k == "lone"] == [None]


def masks(spark, bits):
    rows = [("r", i, bool(int(b))) for i, b in enumerate(bits)]
    return spark.createDataFrame(rows, "k string, t bigint, m boolean")


def bits(df, column):
    return "".join(str(int(r[column])) for r in df.orderBy("t").collect())


@pytest.mark.parametrize(
    "given,k,wide,narrow",
    [
        ("0001000", 3, "0011100", "0000000"),
        ("0001000", 2, "0011000", "0000000"),
        ("1111100", 3, "1111110", "0111000"),
        ("0111110", 4, "1111111", "0001100"),
    ],
)
def test_dilate_and_erode(spark, cutting, given, k, wide, narrow):
    df = masks(spark, given)
    assert bits(ts.dilate_mask(df, ["k"], "t", ["t"], "m", k, "o"), "o") == wide
    assert bits(ts.erode_mask(df, ["k"], "t", ["t"], "m", k, "o"), "o") == narrow


@pytest.mark.parametrize(
    "given,want",
    [
        ("0110010", [(0, 2), (4, 5)]),
        ("1100001", [(0, 1), (5, 6)]),
        ("0000", []),
        ("1111111111", [(0, 9)]),
    ],
)
def test_mask_to_intervals(spark, cutting, given, want):
    got = ts.mask_to_intervals(masks(spark, given), ["k"], "t", "m").collect()
    assert sorted((r.start, r.end) for r in got) == want


def test_regularize_grid(spark, cutting):
    rows = [("r", t, float(t)) for t in (0, 10, 11, 40, 54)]
    df = spark.createDataFrame(rows, "k string, t bigint, v double")
    got = ts.regularize_grid(df, ["k"], "t", "v", 10, 2).orderBy("idx").collect()
    assert [r.n_samples for r in got] == [1, 2, 0, 0, 1, 1]
    assert [r.off_grid for r in got] == [False, False, False, False, False, True]
    assert np.isnan(got[2].v) and got[1].v == 10.0


def test_resets_and_restitch(spark, cutting):
    t = [5, 8, 2, 4, 9, 1, 3]
    rows = [("r", i, x * S) for i, x in enumerate(t)]
    df = spark.createDataFrame(rows, "k string, pos bigint, t bigint")
    blocks = ts.clock_resets(df, ["k"], "pos", ["pos"], "t").orderBy("pos").collect()
    assert [r.block for r in blocks] == [0, 0, 1, 1, 1, 2, 2]
    got = ts.restitch_blocks(df, ["k"], "pos", ["pos"], "t", ["t"]).orderBy("pos").collect()
    # each block starts 60 s after the end of the one before
    assert [r.t // S for r in got] == [5, 8, 68, 70, 75, 135, 137]


def test_frame_to_time(spark, cutting):
    frames = spark.createDataFrame([("r", 10 * i) for i in range(5)], "k string, t bigint")
    table = spark.createDataFrame([("r", 1, 3), ("r", 4, 9)], "k string, start int, end int")
    got = ts.frame_to_time(table, frames, ["k"], "t", ["start", "end"]).orderBy("start").collect()
    assert [(r.start, r.end) for r in got] == [(10, 30), (40, None)]


def test_decimate_drops_the_tail(spark, cutting):
    rows = [("r", i, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, t bigint, v double")
    got = ts.decimate_mean(df, ["k"], "t", "v").orderBy("t").collect()
    assert [(r.t, r.v) for r in got] == [(0, 1.5), (4, 5.5)]


def test_resample_equals_numpy(spark, cutting):
    rng = np.random.default_rng(1)
    t = np.cumsum(rng.integers(1, 40, 50))
    v = rng.normal(size=50)
    rows = [("r", int(x), float(y)) for x, y in zip(t, v)]
    df = spark.createDataFrame(rows, "k string, t bigint, v double")
    got = ts.resample_linear(df, ["k"], "t", "v", 7).orderBy("t").collect()
    grid = np.arange(t[0], t[-1], 7)
    assert [r.t for r in got] == grid.tolist()
    assert np.allclose([r.v for r in got], np.interp(grid, t, v))


def test_nan_padding_and_drop(spark):
    a = spark.createDataFrame([(1, 2.0, [1.0, 2.0])], "id int, speed double, pos array<double>")
    b = spark.createDataFrame([(2, [1.0])], "id int, pos array<double>")
    got = ts.nan_pad_schema([a, b], ["id"], ["speed", "theta"], ["pos"])
    assert got.columns == ["id", "speed", "theta", "pos_x", "pos_y"]
    kept = ts.drop_nan_samples(got, ["speed"]).collect()
    assert [r.id for r in kept] == [1] and kept[0].pos_y == 2.0
    assert [r.id for r in ts.drop_nan_samples(a.union(a.withColumn("pos", F.array(
        F.lit(float("nan"))))), vectors=["pos"]).collect()] == [1]


def test_signal_wide_and_long(spark):
    rows = [("r", "a", [1.0, 2.0, 3.0]), ("r", "b", [4.0, 5.0, 6.0]), ("r", "c", [0.0] * 3)]
    df = spark.createDataFrame(rows, "k string, ch string, x array<double>")
    wide = ts.signal_wide(df, ["k"], "ch", "x", ["a", "b", "c"], ["c"])
    got = sorted((r.a, r.b) for r in wide.collect())
    assert got == [(1.0, 4.0), (2.0, 5.0), (3.0, 6.0)]


def test_concat_by_date_or_input_order(spark, cutting):
    day = 86_400 * S
    rows = [
        ("a", 1, 7200 * S, 100, "c"), ("a", 2, 0, 50, "c"),
        ("b", 1, 5 * day, 10, "c"), ("b", 2, None, 20, "d"),
        ("e", 1, 0, 10, "c"), ("e", 2, day, 10, "c"),
    ]
    df = spark.createDataFrame(rows, "k string, pos bigint, t bigint, n bigint, ch string")
    got = ts.concat_recordings(df, ["k"], "pos", "t", "n", 1.0, "ch", 3600 * S)
    found = {(r.k, r.pos): r for r in got.collect()}
    assert found["a", 2].sample_offset == 0 and found["a", 1].sample_offset == 50
    assert found["a", 1].gap_us == (7200 - 50) * S and found["a", 1].gap_exceeded
    assert found["b", 2].sample_offset == 10 and found["b", 2].gap_us is None
    assert found["b", 1].missing_date and found["b", 1].channel_mismatch
    assert found["e", 1].day_mismatch and not found["a", 1].day_mismatch
