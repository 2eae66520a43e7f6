"""Ordered scans must equal plain windows, however keys are cut."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kymo.plans import lanes
from kymo.plans import (
    LANE,
    assign_lanes,
    attach,
    exact_median,
    measure,
    ordered,
    spread_range,
    with_halo,
)


@pytest.fixture
def rows(spark):
    rng = random.Random(7)
    data, t = [], 0
    for i in range(400):
        # bursts and long pauses; one key holds most rows
        t += rng.choice([1, 1, 1, 2, 5000])
        data.append(("hot" if rng.random() < 0.7 else rng.choice("abcdef"), t, rng.randint(0, 9)))
    return spark.createDataFrame(data, "k string, t bigint, v int")


def test_all_window_values(rows, cutting):
    known = F.when(F.col("v") > 6, F.col("v"))
    got = ordered(
        rows,
        ["k"],
        "t",
        prev={"p": "v"},
        following={"n": "v"},
        sums={"s": "v"},
        earlier_max={"m": "v"},
        totals={"all": "v"},
        last_known={"l": known},
        next_known={"x": known},
        number="i",
    )
    w = Window.partitionBy("k").orderBy("t")
    want = rows.select(
        "*",
        F.lag("v").over(w).alias("p"),
        F.lead("v").over(w).alias("n"),
        F.sum("v").over(w).alias("s"),
        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("m"),
        F.sum("v").over(Window.partitionBy("k")).alias("all"),
        F.last(known, True).over(w).alias("l"),
        F.first(known, True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("x"),
        F.row_number().over(w).cast("bigint").alias("i"),
    )
    assert sorted(got.collect(), key=str) == sorted(want.select(got.columns).collect(), key=str)


def test_without_keys(rows, cutting):
    got = ordered(rows, [], "t", number="i")
    assert [r.i for r in got.orderBy("t").collect()] == list(range(1, 401))


@pytest.mark.parametrize("before,after", [(0, 3), (4, 0), (7, 5)])
def test_halo_frames(rows, cutting, before, after):
    near = with_halo(rows, ["k"], "t", ["t"], before, after)
    parts = [c for c in ("k", LANE) if c in near.columns]
    frame = Window.partitionBy(*parts).orderBy("t").rowsBetween(-before, after)
    got = near.withColumn("s", F.sum("v").over(frame)).filter(~F.col("halo_"))
    plain = Window.partitionBy("k").orderBy("t").rowsBetween(-before, after)
    want = rows.withColumn("s", F.sum("v").over(plain))
    cols = ["k", "t", "v", "s"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_exact_median(spark, cutting):
    rng = random.Random(3)
    data = [("a", rng.randint(-50, 50)) for _ in range(101)]
    data += [("b", 10 ** rng.randint(0, 12)) for _ in range(40)] + [("c", None), ("d", 4)]
    df = spark.createDataFrame(data, "k string, v bigint")
    got = {r.k: r.median for r in exact_median(df, ["k"], "v").collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    want.pop("c")
    assert got == want


def test_median_with_cuts_of_the_rows(rows, cutting):
    cuts = measure(rows, ["k"], "t")
    big = rows.withColumn("w", F.col("t") * F.col("v"))
    got = {r.k: r.median for r in exact_median(big, ["k"], "w", cuts=cuts).collect()}
    want = {r.k: r.m for r in big.groupBy("k").agg(F.median("w").alias("m")).collect()}
    assert got == want


def test_attach_keeps_every_row(rows, cutting):
    laned = assign_lanes(rows, ["k"], "t")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("k") != "a")
    got = attach(laned, table, ["k"])
    assert got.count() == 400
    assert got.filter((F.col("k") == "a") & F.col("n").isNotNull()).count() == 0
    assert got.filter((F.col("k") != "a") & F.col("n").isNull()).count() == 0


def test_spread_range_crosses_blocks(spark):
    df = spark.createDataFrame([("a", 150_000), ("b", 0), ("c", 1)], "k string, n bigint")
    got = spread_range(df, ["k"], F.col("n"), "i").groupBy("k").agg(
        F.count(F.lit(1)).alias("c"), F.min("i").alias("lo"), F.max("i").alias("hi")
    )
    assert {tuple(r) for r in got.collect()} == {("a", 150_000, 0, 149_999), ("c", 1, 0, 0)}


def test_no_hot_key_gives_a_plain_window(rows, capsys):
    ordered(rows, ["k"], "t", number="i").explain()
    plan = capsys.readouterr().out
    assert "Window" in plan and "Join" not in plan


def largest_lanes(df, keys, pos, **more):
    """Rows of the largest lane, and the number of lanes."""
    sizes = [r["count"] for r in assign_lanes(df, keys, pos, **more).groupBy(*keys, LANE).count().collect()]
    return max(sizes), len(sizes)


@pytest.fixture
def small_lanes(spark):
    spark.conf.set(lanes.HOT_ROWS_CONF, "1000")
    spark.conf.set(lanes.LANE_ROWS_CONF, "500")
    yield 500
    spark.conf.unset(lanes.HOT_ROWS_CONF)
    spark.conf.unset(lanes.LANE_ROWS_CONF)


@pytest.mark.parametrize("shape", ["even", "outlier", "burst", "equal", "steps", "null key"])
def test_no_lane_above_twice_the_target(spark, small_lanes, shape):
    n = 20_000
    at = {
        "even": F.col("id"),
        "outlier": F.when(F.col("id") == 0, F.lit(1 << 60)).otherwise(F.col("id")),
        "burst": F.when(F.col("id") % 10 > 0, 5_000_000_000 + F.col("id") % 3000).otherwise(F.col("id") * 1_000_000),
        "equal": F.lit(7).cast("bigint"),
        "steps": F.floor(F.col("id") / 4500),
        "null key": F.col("id") % 977,
    }[shape]
    key = F.lit(None).cast("string") if shape == "null key" else F.lit("hot")
    df = spark.range(n).select(key.alias("k"), at.cast("bigint").alias("t"), F.col("id").alias("u"))
    most, count = largest_lanes(df, ["k"], "t", tie="u")
    assert most <= 2 * small_lanes and count >= n // (2 * small_lanes)
    got = ordered(df, ["k"], "t", ["t", "u"], number="i", prev={"p": "u"})
    w = Window.partitionBy("k").orderBy("t", "u")
    want = df.select("*", F.row_number().over(w).cast("bigint").alias("i"), F.lag("u").over(w).alias("p"))
    assert got.exceptAll(want.select(got.columns)).isEmpty() and got.count() == n


@pytest.mark.parametrize("kind", ["string", "double", "timestamp", "int"])
def test_ties_are_cut_along_any_column(spark, small_lanes, kind):
    value = {
        "string": F.concat(F.lit("x"), F.hex("id")),
        "double": F.when(F.col("id") % 50 == 0, F.lit(float("nan"))).otherwise((F.col("id") - 4000) / 7.0),
        "timestamp": F.timestamp_micros(F.col("id") * 1000),
        "int": F.col("id").cast("int"),
    }[kind]
    df = spark.range(8000).select(F.lit(1).alias("k"), F.lit(5).cast("bigint").alias("t"), value.alias("u"))
    laned = assign_lanes(df, ["k"], "t", tie="u")
    ends = laned.groupBy(LANE).agg(F.min("u").alias("a"), F.max("u").alias("b")).orderBy(LANE).collect()
    assert len(ends) > 4
    order = [x for r in ends for x in (r.a, r.b)]
    assert all(a <= b or b != b for a, b in zip(order, order[1:]))


def test_levels_and_groups_of_lanes(rows, spark, monkeypatch):
    """Few parts per level and few lanes per group: several levels of both."""
    monkeypatch.setattr(lanes, "FAN", 4)
    monkeypatch.setattr(lanes, "STRIDE", 8)
    monkeypatch.setattr(lanes, "SCAN", 3)
    spark.conf.set(lanes.HOT_ROWS_CONF, "3")
    spark.conf.set(lanes.LANE_ROWS_CONF, "2")
    try:
        most, _ = largest_lanes(rows, ["k"], "t")
        assert most <= 4
        known = F.when(F.col("v") > 6, F.col("v"))
        got = ordered(rows, ["k"], "t", prev={"p": "v"}, following={"n": "v"}, sums={"s": "v"}, totals={"a": "v"},
                      earlier_max={"m": "v"}, last_known={"l": known}, next_known={"x": known}, number="i")
        w = Window.partitionBy("k").orderBy("t")
        want = rows.select(
            "*", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"), F.sum("v").over(w).alias("s"),
            F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("m"),
            F.sum("v").over(Window.partitionBy("k")).alias("a"), F.last(known, True).over(w).alias("l"),
            F.first(known, True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("x"),
            F.row_number().over(w).cast("bigint").alias("i"),
        )
        assert sorted(got.collect(), key=str) == sorted(want.select(got.columns).collect(), key=str)
    finally:
        spark.conf.unset(lanes.HOT_ROWS_CONF)
        spark.conf.unset(lanes.LANE_ROWS_CONF)


def test_joins_beyond_a_broadcast(rows, cutting, monkeypatch):
    monkeypatch.setattr(lanes, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lanes, "SALTS", 3)
    monkeypatch.setattr(lanes, "FEW", 0)
    got = ordered(rows, ["k"], "t", number="i")
    want = rows.select("*", F.row_number().over(Window.partitionBy("k").orderBy("t")).cast("bigint").alias("i"))
    assert sorted(got.collect()) == sorted(want.collect())
    medians = {r.k: r.median for r in exact_median(rows, ["k"], "v").collect()}
    assert medians == {r.k: r.m for r in rows.groupBy("k").agg(F.median("v").alias("m")).collect()}


def test_median_of_distinct_and_extreme_values(spark, cutting):
    rng = random.Random(4)
    data = [("j", 1000 + rng.randint(-(10**6), 10**6)) for _ in range(301)]
    data += [("x", v) for v in (-(1 << 63), (1 << 63) - 1, 0, 5)] + [(None, v) for v in range(10)]
    df = spark.createDataFrame(data, "k string, v bigint")
    got = {r.k: r.median for r in exact_median(df, ["k"], "v").collect()}
    values = {k: sorted(v for q, v in data if q == k) for k in ("j", "x", None)}
    assert got == {k: (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 for k, v in values.items()}
