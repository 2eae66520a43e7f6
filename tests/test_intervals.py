"""Interval algebra against a brute-force timeline of integers."""

import random

import pytest
from pyspark.sql import functions as F

from kymo.operators import intervals as iv

SPAN = 60


def random_set(rng, n):
    out = []
    for _ in range(n):
        s = rng.randint(0, SPAN - 1)
        out.append((rng.choice("xy"), s, min(SPAN, s + rng.randint(0, 9))))
    return out


def timeline(intervals, key):
    return {i for k, s, e in intervals if k == key for i in range(s, e)}


def pieces(points):
    out = []
    for p in sorted(points):
        if out and out[-1][1] == p:
            out[-1][1] = p + 1
        else:
            out.append([p, p + 1])
    return [tuple(p) for p in out]


@pytest.fixture(params=range(2))
def pair(request, spark):
    rng = random.Random(request.param)
    a, b = random_set(rng, 14), random_set(rng, 11)
    frame = "k string, start bigint, end bigint"
    return a, b, spark.createDataFrame(a, frame), spark.createDataFrame(b, frame)


@pytest.mark.parametrize(
    "op,rule",
    [
        (iv.interval_union, lambda x, y: x | y),
        (iv.interval_intersection, lambda x, y: x & y),
        (iv.interval_difference, lambda x, y: x - y),
    ],
)
def test_set_operations(pair, cutting, op, rule):
    a, b, da, db = pair
    got = op(da, db, ["k"]).orderBy("k", "start").collect()
    for key in "xy":
        want = pieces(rule(timeline(a, key), timeline(b, key)))
        assert [(r.start, r.end) for r in got if r.k == key] == want


def test_dilate(pair, cutting):
    a, _, da, _ = pair
    got = iv.interval_dilate(da, ["k"], 2).collect()
    wide = [(k, s - 2, e + 2) for k, s, e in a]
    for key in "xy":
        want = pieces(timeline(wide, key))
        assert sorted((r.start, r.end) for r in got if r.k == key) == want


def test_stab_takes_the_smallest_start(pair, cutting, spark):
    a, _, da, _ = pair
    points = [(k, t) for k in "xyz" for t in range(-1, SPAN + 2)]
    got = iv.interval_stab(spark.createDataFrame(points, "k string, t bigint"), da, ["k"])
    for r in got.collect():
        hits = [(s, -e) for k, s, e in a if k == r.k and s <= r.t < e]
        want = min(hits) if hits else None
        assert (r.hit_start, r.hit_end) == ((want[0], -want[1]) if want else (None, None))


@pytest.mark.parametrize("closed", [False, True])
def test_covered_points(pair, cutting, spark, closed):
    a, _, da, _ = pair
    points = [(k, t) for k in "xy" for t in range(SPAN + 1)]
    df = spark.createDataFrame(points, "k string, t bigint")
    for r in iv.covered_points(df, da, ["k"], closed=closed).collect():
        want = any(k == r.k and s <= r.t and (r.t <= e if closed else r.t < e) for k, s, e in a)
        assert r.covered == want


def test_coverage(pair, cutting, spark):
    a, _, da, _ = pair
    domain = spark.createDataFrame([("x", 0, 57), ("y", 3, 43)], "k string, start bigint, end bigint")
    blocks = iv.interval_linspace(domain, 10)
    for r in iv.interval_coverage(blocks, da, ["k"], ["block"]).collect():
        assert r.covered_us == len(timeline(a, r.k) & set(range(r.start, r.end)))


def test_linspace_tiles_the_domain(spark):
    df = spark.createDataFrame([("x", 5, 108)], "k string, start bigint, end bigint")
    got = iv.interval_linspace(df, 10).orderBy("block").collect()
    assert got[0].start == 5 and got[-1].end == 108
    assert all(a.end == b.start for a, b in zip(got, got[1:]))


def test_subdivide(spark):
    df = spark.createDataFrame([(1, 0, 95), (2, 10, 19)], "id int, start bigint, end bigint")
    whole = iv.interval_subdivide(df, 30).orderBy("start").collect()
    assert [(r.id, r.start, r.end) for r in whole] == [(1, 0, 30), (1, 30, 60), (1, 60, 90)]
    short = iv.interval_subdivide(df, 30, keep_short=True).orderBy("id", "start").collect()
    assert [(r.id, r.end) for r in short] == [(1, 30), (1, 60), (1, 90), (1, 95), (2, 19)]


def test_checks(spark, cutting):
    rows = [("a", 1, 0, 5), ("a", 2, 5, 6), ("b", 1, 4, 9), ("b", 2, 0, 5), ("c", 1, 0, 1)]
    df = spark.createDataFrame(rows, "k string, pos bigint, start bigint, end bigint")
    got = {r.k: (r.is_sorted, r.is_disjoint) for r in
           iv.interval_checks(df, ["k"], "pos", ["pos"]).collect()}
    assert got == {"a": (True, True), "b": (False, False), "c": (True, True)}


def test_min_duration_is_strict_and_select_keeps_attributes(spark):
    df = spark.createDataFrame([(1, 0, 10), (2, 0, 11)], "id int, start bigint, end bigint")
    assert [r.id for r in iv.interval_min_duration(df, 10).collect()] == [2]
    assert iv.interval_select(df, F.col("id") == 1).columns == df.columns
    empty = iv.interval_union(df.limit(0), None, [])
    assert empty.count() == 0
