"""Filters against direct sums and sequential recursions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kymo.functions import design
from kymo.operators import filters as fl
from kymo.operators import series as ts


def frame(spark, v, key="r"):
    return spark.createDataFrame([(key, i * 1000, float(x)) for i, x in enumerate(v)], "k string, t bigint, v double")


def values(df, column):
    return [r[column] for r in df.orderBy("t").collect()]


@pytest.mark.parametrize("n_taps", [1, 4, 301])
def test_fir_equals_numpy(spark, monkeypatch, n_taps):
    monkeypatch.setattr(fl, "BLOCK", 64)
    rng = np.random.default_rng(2)
    v, taps = rng.normal(size=500), rng.normal(size=n_taps)
    got = values(fl.fir_filter(frame(spark, v), ["k"], "t", ["t"], "v", taps, "o"), "o")
    half = n_taps // 2
    assert np.allclose(got, np.convolve(v, taps)[half : half + 500], atol=1e-10)


def test_design_passes_and_stops():
    def gain(taps, f, rate):
        return abs(np.exp(-2j * np.pi * f / rate * np.arange(len(taps))) @ taps)

    for rate in (250, 1000):
        clean = design.notch(60, rate)
        assert gain(clean, 60, rate) < 0.01 and gain(clean, 50, rate) == pytest.approx(1, abs=0.01)
        assert gain(clean, 120 if rate == 1000 else 60, rate) < 0.01
        theta = design.designed(3, 10, rate)
        assert gain(theta, 6, rate) == pytest.approx(1, abs=0.01)
        assert gain(theta, 0.5, rate) < 0.01 and gain(theta, 14, rate) < 0.01
    assert gain(design.designed(50, 300, 250), 100, 250) == pytest.approx(1, abs=0.01)  # open above


@pytest.mark.parametrize("rate", [250, 1000])
@pytest.mark.parametrize("band,hz", [("delta", 2.2), ("theta", 7), ("alpha", 17), ("beta", 32), ("gamma", 80)])
def test_sines_show_in_their_band(spark, rate, band, hz):
    t = np.arange(6 * rate) / rate
    got = fl.band_power(frame(spark, np.sin(2 * np.pi * hz * t)), ["k"], "t", "v", rate, smooth=(None, 18))
    mean = got.filter("band <> 'lmp' and slot between 100 and 200").groupBy("band").agg(F.avg("power").alias("p"))
    power = {r.band: r.p for r in mean.collect()}
    assert max(power, key=power.get) == band and power[band] == pytest.approx(0.5, abs=0.06)


def test_line_is_removed(spark):
    t = np.arange(6000) / 1000
    got = fl.band_power(frame(spark, np.sin(2 * np.pi * 60 * t)), ["k"], "t", "v", 1000, {"gamma": (50, 300)}, smooth=(None, 18))
    assert got.filter("band = 'gamma' and slot between 120 and 180").agg(F.max("power")).first()[0] < 0.01


def test_band_power_equals_direct_sums(spark, monkeypatch):
    """Blocks no longer than the filters' reach; squares of samples outside count as zero."""
    monkeypatch.setattr(fl, "BLOCK", 10)
    rate, n = 100, 1200
    v = np.random.default_rng(5).normal(size=n)
    got = fl.band_power(frame(spark, v), ["k"], "t", "v", rate, {"theta": (3, 10)}, line=40)
    direct = lambda x, taps: np.convolve(x, taps)[len(taps) // 2 :][: len(x)]
    clean, fold = design.notch(40, rate), design.designed(None, 20, rate)
    theta = direct(v, np.convolve(clean, design.designed(3, 10, rate))) ** 2
    want = {"theta": direct(theta, np.convolve(design.designed(18, None, rate), fold))[1::2]}
    want["lmp"] = direct(direct(v, np.convolve(clean, design.designed(0.1, 20, rate))), fold)[1::2]
    for band, power in want.items():
        rows = got.filter(F.col("band") == band).orderBy("slot").collect()
        assert [r.slot for r in rows] == list(range(n // 2)) and rows[0].t == 1000
        assert np.allclose([r.power for r in rows], power, atol=1e-9)


def test_band_power_shape(spark):
    got = fl.band_power(frame(spark, np.sin(np.arange(1013) / 20)), ["k"], "t", "v", 1000)
    counts = {r.band: r["count"] for r in got.groupBy("band").count().collect()}
    assert counts == dict.fromkeys(["delta", "theta", "alpha", "beta", "gamma", "lmp"], 51)
    assert got.agg(F.min("t")).first()[0] == 10_000
    with pytest.raises(ValueError):
        fl.band_power(frame(spark, [1.0]), ["k"], "t", "v", 75)


def sequential(v, cut, rate):
    def once(x):
        states = []
        for b0, b1, b2, a1, a2 in design.butterworth(cut, rate):
            states.append([(b1 - a1 + b2 - a2) * x[0], (b2 - a2) * x[0]])
        out = []
        for value in x:
            for s, (b0, b1, b2, a1, a2) in zip(states, design.butterworth(cut, rate), strict=True):
                y = b0 * value + s[0]
                s[0], s[1] = b1 * value - a1 * y + s[1], b2 * value - a2 * y
                value = y
            out.append(value)
        return np.array(out)

    pad = min(15, len(v) - 1)
    x = np.concatenate([2 * v[0] - v[1 : pad + 1][::-1], v, 2 * v[-1] - v[len(v) - 1 - pad : -1][::-1]])
    y = once(once(x)[::-1])[::-1]
    return y[pad : pad + len(v)]


@pytest.mark.parametrize("n,cut", [(1, 40.0), (5, 40.0), (16, 40.0), (35, 40.0), (400, 1.0)])
def test_zero_phase_equals_a_sequential_recursion(spark, n, cut):
    """At 1 Hz what a block leaves behind lasts for many blocks."""
    v = np.random.default_rng(n).normal(size=n) + 3
    got = values(fl.zero_phase_low_pass(frame(spark, v), ["k"], "t", ["t"], "v", cut, 250.0, "o", size=16), "o")
    assert np.allclose(got, sequential(v, cut, 250.0), atol=1e-9)


def test_zero_phase_has_one_python_function_in_a_stage(spark, monkeypatch):
    """A core then needs one worker, whatever the table's size."""
    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    write = fl.kept
    monkeypatch.setattr(fl, "kept", lambda df: plans.append(plan(df)) or write(df))
    v = np.arange(40.0)
    got = fl.zero_phase_low_pass(frame(spark, v), ["k"], "t", ["t"], "v", 40.0, 250.0, "o", size=16)
    plans.append(plan(got))
    assert sum("EvalPython" in p for p in plans) == 3
    assert max(p.count("EvalPython") for p in plans) == 1


def test_low_pass_keeps_the_phase():
    x = np.cos(2 * np.pi * 5 * np.arange(1000) / 250)
    assert np.abs(sequential(x, 40.0, 250.0)[200:800] - x[200:800]).max() < 0.01


def test_wideband_is_reduced(spark, cutting):
    rng = np.random.default_rng(8)
    t = np.arange(203) * 100
    v = np.sin(t / 9000) + 0.1 * rng.normal(size=203)
    df = spark.createDataFrame([("r", int(a), float(b)) for a, b in zip(t, v)], "k string, t bigint, v double")
    got = fl.reduce_wideband(df, ["k"], "t", "v", 10_000.0).orderBy("t").collect()
    low = sequential(v[:200].reshape(-1, 4).mean(1), 333.0, 2500.0)
    grid = np.arange(0, t[:200:4][-1], 1000)
    assert [r.t for r in got] == grid.tolist()
    assert np.allclose([r.v for r in got], np.interp(grid, t[:200:4], low), atol=1e-9)


def test_masks_at_any_width(spark, cutting):
    rng = np.random.default_rng(6)
    m = [None if x > 0.97 else bool(x > 0.5) for x in rng.random(120)]
    df = spark.createDataFrame([("r", i, x) for i, x in enumerate(m)], "k string, t bigint, m boolean")
    for k in (4, 5, 100_000):
        wide = values(ts.dilate_mask(df, ["k"], "t", ["t"], "m", k, "o"), "o")
        thin = values(ts.erode_mask(df, ["k"], "t", ["t"], "m", k, "o"), "o")
        for i in range(120):
            b, a = (k - 1) // 2, k // 2
            assert wide[i] == any(x for x in m[max(0, i - b) : i + a + 1])
            b, a = a, b
            assert thin[i] == (i >= b and i + a < 120 and all(x is not False for x in m[i - b : i + a + 1]))
