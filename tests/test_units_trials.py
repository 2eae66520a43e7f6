"""Units, channels, trials and stimuli on small literal inputs."""

import math

import pytest
from pyspark.sql import functions as F

from kymo.operators import selection as sel
from kymo.operators import trials as tr
from kymo.operators import units as un
from kymo.plans import lanes

S = 1_000_000


def test_cube(spark, cutting):
    rows = [(0, t, c, 2 if (t, c) == (6, 0) else 3 if (t, c) == (5, 1) else 0)
            for t in range(1, 11) for c in (0, 1)]
    df = spark.createDataFrame(rows, "trial int, t bigint, channel int, n int")
    got = un.cube_to_long(df, ["trial"], "t", "channel", "n").orderBy("idx").collect()
    assert [(r.t, r.channel) for r in got] == [(5, 1)] * 3 + [(6, 0)] * 2
    units = un.cube_units(df, "channel", "n").orderBy("channel").collect()
    assert [(r.id, r.channel_name, r["count"]) for r in units] == [
        ("chan0", "chan000", 2), ("chan1", "chan001", 3)
    ]
    bad = df.withColumn("n", F.lit(-1))
    with pytest.raises(Exception):
        un.cube_to_long(bad, ["trial"], "t", "channel", "n").collect()


def test_cube_of_bins_that_share_a_stamp_and_channel(spark, cutting):
    rows = [("r", 5, 1, float(n)) for n in (3, 1, 3, 0, 2)] + [("r", 5, 2, 2.0), ("r", 4, 1, 1.0), ("q", 1, 1, 2.0)]
    df = spark.createDataFrame(rows, "trial string, t bigint, channel int, n double")
    for keys in (["trial"], []):
        want, idx = [], {}
        copies = [(trial if keys else "", t, c, k + 1) for trial, t, c, n in rows for k in range(int(n))]
        for trial, t, c, k in sorted(copies):
            want.append((trial, t, c, k, idx.setdefault(trial, 0)))
            idx[trial] += 1
        got = un.cube_to_long(df, keys, "t", "channel", "n").collect()
        assert sorted((r.trial if keys else "", r.t, r.channel, r.copy, r.idx) for r in got) == want


def test_cube_shuffles_bins_not_copies(spark):
    df = spark.createDataFrame([("r", 1, 1, 2.0)], "trial string, t bigint, channel int, n double")
    plan = un.cube_to_long(df, ["trial"], "t", "channel", "n")._jdf.queryExecution().executedPlan().toString()
    # the plan is printed from its result down to its input
    assert plan.index("Generate explode") < plan.index("Exchange") and plan.count("Exchange") == 1


def test_explode_spikes_keeps_silent_units(spark, cutting):
    df = spark.createDataFrame([("r", 0, [5, 1]), ("r", 1, []), ("r", 2, [3])],
                               "k string, u int, times array<bigint>")
    spikes, units = un.explode_spikes(df, ["k"], "u", "times")
    assert [(r.t, r.u) for r in spikes.orderBy("idx").collect()] == [(1, 0), (3, 2), (5, 0)]
    assert {(r.u, r["count"]) for r in units.collect()} == {(0, 2), (1, 0), (2, 1)}


def test_regions(spark, cutting):
    def units(*ids):
        return spark.createDataFrame([("r", i) for i in ids], "k string, u int")

    def spikes(*rows):
        return spark.createDataFrame([("r", *x) for x in rows], "k string, u int, t bigint")

    regions = {
        "mec": (units(4), spikes((4, 9), (4, 1))),
        "hc": (units(2, 7), spikes((7, 5))),
    }
    table, fired = un.units_and_spikes_by_region(regions, ["k"], "u")
    assert {(r.id, r.unit_index) for r in table.collect()} == {("mec_0", 0), ("hc_0", 1), ("hc_1", 2)}
    assert [(r.t, r.unit_index) for r in fired.orderBy("idx").collect()] == [(1, 0), (5, 2), (9, 0)]


def test_a_region_of_many_units_is_cut(spark):
    units = spark.range(20_000).selectExpr("id AS unit", "CAST(id % 2 AS bigint) AS rank")
    spark.conf.set(lanes.HOT_ROWS_CONF, "2000")
    spark.conf.set(lanes.LANE_ROWS_CONF, "1000")
    try:
        cut = lanes.assign_lanes(units.withColumn("k", F.lit(0)), ["k"], "rank", None, "unit")
        assert cut.groupBy(lanes.LANE).count().agg(F.max("count")).first()[0] <= 2000
        got = un.dense_unit_index(units, [], "rank", ["rank", "unit"])
        want = F.col("rank") * 10_000 + F.floor(F.col("unit") / 2)
        assert got.filter(F.col("unit_index") != want).count() == 0 and got.count() == 20_000
    finally:
        spark.conf.unset(lanes.HOT_ROWS_CONF)
        spark.conf.unset(lanes.LANE_ROWS_CONF)


def test_rename_maps(spark):
    rows = [("swap", "a", "b", 0), ("swap", "b", "a", 1), ("same", "a", "a", 0),
            ("twice", "a", "z", 0), ("twice", "b", "z", 1)]
    df = spark.createDataFrame(rows, "m string, s string, t string, pos int")
    got = {r.m: (r.n_overlaps, r.n_repeated, r.is_valid)
           for r in un.validate_rename_map(df, ["m"], "s", "t", "pos").collect()}
    assert got == {"swap": (2, 0, False), "same": (0, 0, True), "twice": (0, 1, False)}


def test_channel_table(spark):
    df = spark.createDataFrame([("A", "EEG"), ("B", "EOG"), ("X", "STIM")], "ch string, native string")
    plain = un.channel_table(df, "ch", "native")
    assert plain.columns == ["ch", "native", "id", "type"]
    got = un.channel_table(df, "ch", "native", {"A": "A1"}, {"A1": "Ref"}, {"A1": (1, 2, 3)}, ["X"], ["B"])
    a, b = got.orderBy("ch").collect()
    assert (a.id, a.type, a.pos, a.bad) == ("A1", "ref", [1.0, 2.0, 3.0], False)
    assert b.type == "eog" and b.bad and math.isnan(b.pos[0])


def test_unit_names(spark):
    row = spark.range(1).select(
        un.threshold_unit_name(F.lit("M1"), F.lit(3)),
        un.sorted_unit_name(F.lit("M1"), F.lit(3), F.lit(8)),
        un.channel_unit_name(F.lit("M1 001"), F.lit(0)),
        un.channel_unit_name(F.lit("M1 001"), F.lit(4)),
    ).first()
    assert tuple(row) == ("group_M1/elec3/multiunit_0", "group_M1/elec3/unit_8",
                          "M1 001/unsorted", "M1 001/sorted_04")


def test_trial_bounds(spark, cutting):
    rows = [("r", 0, None, 0, 5 * S), ("r", 1, 7 * S, 6 * S, 9 * S),
            ("r", 2, None, 10 * S, 20 * S), ("r", 3, 22 * S, 21 * S, 30 * S)]
    df = spark.createDataFrame(
        rows, "k string, pos bigint, on bigint, start bigint, stop bigint"
    ).withColumn("dom", F.lit(30 * S + 1))
    got = tr.trial_bounds_from_next(df, ["k"], "pos", ["pos"], "on", "start", "stop", "dom")
    assert [(r.trial_start, r.trial_end) for r in got.orderBy("pos").collect()] == [
        (0, 7 * S), (7 * S, 10 * S), (10 * S, 22 * S), (22 * S, 30 * S + 1)
    ]


def test_trial_bounds_with_an_unknown_stop(spark, cutting):
    rows = [("r", 0, 0, 0, 5 * S), ("r", 1, 10 * S, 9 * S, None), ("r", 2, 20 * S, 19 * S, 25 * S),
            ("r", 3, None, 26 * S, None)]
    df = spark.createDataFrame(
        rows, "k string, pos bigint, on bigint, start bigint, stop bigint"
    ).withColumn("dom", F.lit(30 * S))
    got = tr.trial_bounds_from_next(df, ["k"], "pos", ["pos"], "on", "start", "stop", "dom")
    assert [(r.trial_start, r.trial_end) for r in got.orderBy("pos").collect()] == [
        (0, 10 * S), (10 * S, 20 * S), (20 * S, None), (None, None)
    ]


def test_time_columns_shift_together(spark):
    df = spark.createDataFrame([(1, 5, 9, 7)], "id int, a bigint, b bigint, go bigint")
    got = tr.shift_times(tr.trials_from_table(df, "a", "b", ["go"]), 10).first()
    assert tuple(got) == (1, 15, 19, 17)


def test_phases(spark, cutting):
    df = spark.createDataFrame([("r", 1, True, 0, 4, 9), ("r", 2, False, 10, 11, 20)],
                               "k string, id int, ok boolean, start bigint, mid bigint, end bigint")
    got = tr.movement_phases(df, ["k"], "ok", {"hold": ("start", "mid"), "reach": ("mid", "end")})
    assert {tuple(r) for r in got.collect()} == {
        ("r", "hold", 0, 4), ("r", "reach", 4, 9), ("r", "invalid", 10, 20)
    }
    domain = spark.createDataFrame([("r", -5, 25)], "k string, start bigint, end bigint")
    rest = tr.random_period(domain, got, ["k"]).orderBy("start").collect()
    assert [(r.start, r.end) for r in rest] == [(-5, 0), (9, 10), (20, 25)]
    out = spark.createDataFrame([("r", 3, 6)], "k string, start bigint, end bigint")
    cut = tr.phases_minus_outliers(got, out, ["k"], ["hold", "reach"]).collect()
    assert {(r.phase, r.start, r.end) for r in cut} == {("hold", 0, 3), ("reach", 6, 9)}


def test_stages_and_epochs(spark, cutting):
    df = spark.createDataFrame([(0, 30, "Sleep stage R"), (30, 30, "Lights")], "o int, d int, x string")
    assert [(r.start, r.end, r.id) for r in tr.stage_intervals(df, "o", "d", "x").collect()] == [
        (0, 30, 5), (30, 60, None)
    ]
    frame = "k string, start bigint, end bigint"
    sws = spark.createDataFrame([("r", 10, 20), ("r", 30, 40)], frame)
    rem = spark.createDataFrame([("r", 25, 28)], frame)
    got = tr.union_epoch_domain(sws, rem, ["k"]).orderBy("idx").collect()
    assert [(r.start, r.end, r.overlaps) for r in got] == [
        (10, 20, False), (25, 28, False), (30, 40, False)
    ]


def test_gratings(spark):
    df = spark.createDataFrame([(0.0, 90.0, 1.4), (1.0, 45.0, 2.0), (0.0, 10.0, 3.0)],
                               "blank double, ori double, tf double")
    got = tr.drifting_labels(df, "blank", "ori", "tf").collect()
    assert [(r.orientation_id, r.temporal_frequency_id) for r in got] == [(2, 0), (None, None)]
    df = spark.createDataFrame([(60.0, 0.159, 0.5), (None, 0.02, 0.0)], "o double, f double, p double")
    got = tr.static_labels(df, "o", "f", "p").collect()
    assert [(r.orientation_id, r.spatial_frequency_id, r.phase_id) for r in got] == [(2, 3, 2)]


def test_series_concat(spark, cutting):
    df = spark.createDataFrame([("r", 2, [3, 4]), ("r", 1, [0, 1, 2]), ("r", 3, [])],
                               "k string, trial bigint, x array<int>")
    got = tr.trial_series_concat(df, ["k"], "trial", "x").orderBy("idx").collect()
    assert [(r.idx, r.v) for r in got] == [(i, i) for i in range(5)]


def test_reading(spark, cutting):
    frame = "k string, start bigint, end bigint"
    domains = spark.createDataFrame([("a", 0, 100), ("b", 0, 50)], frame)
    splits = domains.withColumn("split", F.lit("valid"))
    assert sel.sampling_intervals(domains, splits, ["k"], "val").count() == 2
    assert sel.sampling_intervals(domains, splits.limit(0), ["k"]).count() == 2
    with pytest.raises(ValueError):
        sel.sampling_intervals(domains, splits, ["k"], "dev")
    other = spark.createDataFrame([("a", 20, 200)], frame)
    got = sel.sampling_intervals_joint(domains, splits, [other, other], ["k"]).collect()
    assert [tuple(r) for r in got] == [("a", 20, 100)]
    named = spark.createDataFrame(
        [("a", "intersubject", 0, "train"), ("a", "any", 0, "test"), ("b", "any", 0, "test")],
        "k string, scheme string, fold int, split string",
    )
    ask = lambda s: [r.k for r in sel.sampling_intervals_fold(
        domains, splits, named, ["k"], "intersubject", 0, s).collect()]
    assert ask("train") == ["a"] and ask("test") == ["b"]


def test_selector_reports_what_is_missing(spark):
    requests = spark.createDataFrame([("r", 1), ("r", 2), ("r", 3)], "k string, selector int")
    splits = spark.createDataFrame([("r", 1, 0, 9), ("r", 2, 0, 9)],
                                   "k string, selector int, start bigint, end bigint")
    masks = spark.createDataFrame([("r", 1, "c0", True), ("r", 1, "c1", False)],
                                  "k string, selector int, ch string, used boolean")
    got = sel.sampling_intervals_selector(requests, splits, masks, ["k", "selector"])
    assert [(r.selector, r.n_channels, r.missing) for r in got.orderBy("selector").collect()] == [
        (1, 1, ""), (2, None, "mask"), (3, None, "intervals,mask")
    ]
