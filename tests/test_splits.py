"""Split operators: fixed hash values, invariants of the shuffled splits, epoch rules."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kymo.functions import hashing as hs
from kymo.operators import splits as sp
from kymo.plans import lanes


def md5_int(text):
    return int(hashlib.md5(text.encode()).hexdigest(), 16)


def test_hash_mod_equals_the_big_integer(spark):
    ids = [f"S{i:04d}" for i in range(200)] + ["", "é", "example"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    for n in (1, 2, 3, 10_000, 2_147_483_647):
        got = df.select("id", hs.string_hash_mod(F.col("id"), n).alias("h")).collect()
        assert all(r.h == md5_int(r.id) % n for r in got)


def test_string_kfold(spark):
    ids = [f"S{i:04d}" for i in range(1000)]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    parts = {r.id: r.p for r in df.select("id", hs.string_kfold(F.col("id"), 5).alias("p")).collect()}
    for ident, row in parts.items():
        assert row.count("test") == 1
        assert row.index("test") == md5_int(f"{ident}_42") % 5
    rest = [p for row in parts.values() for p in row if p != "test"]
    assert abs(rest.count("valid") / len(rest) - 0.2) < 0.05
    known = spark.createDataFrame([("sub-01",), ("sub-01_ses-01",), ("",)], "id string")
    got = [r.p for r in known.select(hs.string_kfold(F.col("id")).alias("p")).collect()]
    assert got == [["valid", "train", "test"], ["valid", "valid", "test"], None]
    with pytest.raises(ValueError):
        hs.string_kfold(F.col("id"), 0)
    with pytest.raises(ValueError):
        hs.string_kfold(F.col("id"), 3, 1.5)


def labelled(spark):
    rows = [(i, "ABC"[(i % 10 > 5) + (i % 10 > 8)], i, i + 1) for i in range(100)]
    return spark.createDataFrame(rows, "id int, label string, start bigint, end bigint")


def test_stratified_folds(spark, cutting):
    got = sp.stratified_folds(labelled(spark), [], "label", "id").collect()
    assert len(got) == 500
    assert Counter(r.id for r in got if r.split == "test") == Counter(range(100))
    for fold in range(5):
        mine = [r for r in got if r.fold == fold]
        sizes = Counter(r.split for r in mine)
        assert sizes == {"test": 20, "valid": 16, "train": 64}
        assert Counter(r.label for r in mine if r.split == "test") == {"A": 12, "B": 6, "C": 2}
    again = sp.stratified_folds(labelled(spark).repartition(7), [], "label", "id").collect()
    assert sorted(again) == sorted(got)
    other = sp.stratified_folds(labelled(spark), [], "label", "id", seed=1).collect()
    assert sorted(other) != sorted(got)


def test_stratified_folds_unfold_after_the_shuffles(spark, cutting):
    """Items are shuffled, not items times folds: what unfolds is at the end of the plan, or counted."""
    rows = [(i, "AB"[i % 7 == 0], f"x{i % 3}") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, label string, more string")
    folds = sp.stratified_folds(df, [], "label", "id", n_folds=4)
    got = folds.collect()
    # ranks within a class, taken in one list
    md5 = lambda i, s: (hashlib.md5(f"{i}_{s}".encode()).hexdigest(), i)
    split, home, before = {}, {}, 0
    for label in "AB":
        mine = [r[0] for r in rows if r[1] == label]
        home |= {i: (before + n) % 4 for n, i in enumerate(sorted(mine, key=lambda i: md5(i, 42)))}
        before += len(mine)
    for fold in range(4):
        valid = Counter(r.label for r in got if r.fold == fold and r.split == "valid")
        for label in "AB":
            rest = sorted((r[0] for r in rows if r[1] == label and home[r[0]] != fold), key=lambda i: md5(i, 42 + fold))
            split |= {(i, fold): "valid" if n < valid[label] else "train" for n, i in enumerate(rest)}
        split |= {(i, fold): "test" for i in home if home[i] == fold}
        assert sum(valid.values()) == -(-sum(home[i] != fold for i in home) // 5)
    assert {(r.id, r.fold): r.split for r in got} == split and len(got) == 800
    assert all(r.more == f"x{r.id % 3}" for r in got)
    if cutting == "whole":
        plan = folds._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Generate explode") < plan.index("Exchange")


@pytest.mark.parametrize(
    "split,sizes",
    [
        (lambda d: sp.interval_split_shuffled(d, [], "id", (8, 1, 1)), (80, 10, 10)),
        (lambda d: sp.interval_split_shuffled(d, [], "id", (0.7, 0.1, 0.2)), (70, 10, 20)),
        (lambda d: sp.interval_split_shuffled(d, [], "id", (0.8, 0.2)), (80, 0, 20)),
        (lambda d: sp.interval_split_ordered(d, [], (0.6, 0.1, 0.3)), (60, 10, 30)),
        (lambda d: sp.two_stage_trial_split(d, [], "id"), (70, 10, 20)),
    ],
)
def test_sizes(spark, cutting, split, sizes):
    got = split(labelled(spark)).collect()
    counts = Counter(r.split for r in got)
    assert (counts["train"], counts["valid"], counts["test"]) == sizes
    assert sorted(r.id for r in got) == list(range(100))


def test_ordered_split_follows_time(spark, cutting):
    got = sp.interval_split_ordered(labelled(spark), [], (0.6, 0.1, 0.3)).orderBy("start").collect()
    assert [r.split for r in got] == ["train"] * 60 + ["valid"] * 10 + ["test"] * 30


def test_invalid_and_predefined(spark, cutting):
    df = labelled(spark).withColumn("ok", F.col("label") != "C")
    got = sp.invalid_trials_to_train(df, [], "id", "ok").collect()
    assert {r.split for r in got if not r.ok} == {"train"}
    assert Counter(r.split for r in got if r.ok) == {"train": 63, "valid": 9, "test": 18}
    marked = df.withColumn("part", F.when(F.col("ok"), "train").otherwise("val"))
    got = sp.predefined_split(marked, [], "id", "part").collect()
    assert {r.split for r in got if r.part == "val"} == {"test"}
    assert Counter(r.split for r in got if r.part == "train") == {"train": 72, "valid": 18}


def test_causal_and_hash(spark):
    d = spark.createDataFrame([("s1", 0, 100), ("s2", 50, 60)], "id string, start bigint, end bigint")
    got = sp.causal_ratio_split(d, (0.5, 0.25, 0.25)).filter("id = 's1'").orderBy("start").collect()
    assert [(r.split, r.start, r.end) for r in got] == [
        ("train", 0, 50), ("valid", 50, 75), ("test", 75, 100)
    ]
    part = {r.id: r.split for r in sp.hash_assignment(d, "id", (0.8, 0.1, 0.1), 42).collect()}
    for ident, name in part.items():
        share = md5_int(f"{ident}_42") % 10000 / 10000
        assert name == ("train" if share < 0.8 else "valid" if share < 0.9 else "test")


def test_snap(spark, cutting):
    grid = spark.createDataFrame([("r", 0, 10), ("r", 10, 20)], "k string, start bigint, end bigint")
    points = spark.createDataFrame([("r", t) for t in (3, 5, 6, 10, 19, 25)], "k string, t bigint")
    got = sp.snap_to_grid(points, grid, ["k"]).orderBy("t").collect()
    assert [r.snapped for r in got] == [0, 0, 10, 10, 20, 25]


def split_of(spark, n, **kw):
    rows = [("r", "movie", 100 * i, 100 * i + 50) for i in range(n)]
    frame = "rec string, stim string, start bigint, end bigint"
    epochs = spark.createDataFrame(rows, frame)
    grid = spark.createDataFrame([], "rec string, start bigint, end bigint")
    got = sp.epoch_split(epochs, grid, ["rec", "stim"], ["rec"]).orderBy("start").collect()
    return [(r.split, r.start, r.end) for r in got]


@pytest.mark.parametrize(
    "n,want",
    [
        (1, [("train", 0, 30), ("valid", 30, 35), ("test", 35, 50)]),
        (2, [("train", 0, 25), ("valid", 25, 50), ("test", 100, 150)]),
        (3, [("train", 0, 50), ("train", 100, 135), ("valid", 135, 150), ("test", 200, 250)]),
        (4, [("train", 0, 50), ("train", 100, 150), ("train", 200, 225), ("valid", 225, 250),
             ("test", 300, 350)]),
        (5, [("train", 0, 50), ("train", 100, 150), ("train", 200, 225), ("valid", 225, 250),
             ("test", 300, 350), ("test", 400, 450)]),
    ],
)
def test_epoch_rules(spark, n, want):
    assert split_of(spark, n) == want


def test_many_epochs_split_by_number(spark):
    parts = [p[0] for p in split_of(spark, 10)]
    assert parts == ["train"] * 6 + ["valid"] + ["test"] * 3


def test_dispatch_skips_invalid_and_unites(spark, cutting):
    rows = [("r", "a", 0, 50), ("r", "a", 100, 150), ("r", "b", 40, 60), ("r", "b", 140, 160),
            ("r", "invalid_presentation_epochs", 0, 500)]
    epochs = spark.createDataFrame(rows, "rec string, stim string, start bigint, end bigint")
    grid = epochs.limit(0).select("rec", "start", "end")
    got = sp.epoch_split_dispatch(epochs, grid, ["rec"], "stim").orderBy("split", "start").collect()
    assert [(r.split, r.start, r.end) for r in got] == [
        ("test", 100, 160), ("train", 0, 25), ("train", 40, 50), ("valid", 25, 60)
    ]  # the pieces [25, 50) and [50, 60) of valid touch


def test_coverage_ranked(spark, cutting):
    s = 1_000_000
    domain = spark.createDataFrame([("r", 0, 1000 * s), ("calm", 0, 1000 * s)],
                                   "k string, start bigint, end bigint")
    held = {b: 0 if b == 7 else 5 if b == 3 else 20 + b for b in range(10)}
    paused = {i for b, n in held.items() for i in range(100 * b, 100 * b + n)}
    rows = [("r", 100 * b * s, (100 * b + n) * s) for b, n in held.items() if n]
    pauses = spark.createDataFrame(rows, "k string, start bigint, end bigint")
    got = sp.coverage_ranked_split(domain, pauses, ["k"]).collect()
    # ten blocks of 98 s from the first active second on, ranked by active seconds
    blocks = [range(20 + 98 * b, 20 + 98 * (b + 1)) for b in range(10)]
    ranked = sorted(range(10), key=lambda b: len(set(blocks[b]) - paused))
    wanted = {"train": ranked[:8], "valid": ranked[8:9], "test": ranked[9:]}
    for split, chosen in wanted.items():
        active = sorted({i for b in chosen for i in blocks[b]} - paused)
        pieces = []
        for i in active:
            if pieces and pieces[-1][1] == i:
                pieces[-1][1] = i + 1
            else:
                pieces.append([i, i + 1])
        found = sorted((r.start // s, r.end // s) for r in got if r.split == split and r.k == "r")
        assert found == [tuple(p) for p in pieces if p[1] - p[0] > 10]
    calm = [r for r in got if r.k == "calm"]
    assert sum(r.end - r.start for r in calm) == 1000 * s
    assert sum(r.end - r.start for r in calm if r.split == "train") == 800 * s


def test_half_roles(spark, cutting):
    df = spark.createDataFrame([("r", i) for i in range(7)], "k string, pos bigint")
    got = sp.half_role_split(df, ["k"], "pos", ["pos"]).collect()
    by = {s: sorted(r.pos for r in got if r.split == s) for s in ("train", "valid", "test")}
    assert by == {"train": list(range(7)), "valid": [0, 1, 2], "test": [3, 4, 5, 6]}


def test_rest_dilated(spark, cutting):
    d = spark.createDataFrame([("r", 0, 100)], "k string, start bigint, end bigint")
    held = spark.createDataFrame([("r", 20, 30), ("r", 31, 40)], "k string, start bigint, end bigint")
    got = sp.train_is_rest_dilated(d, held, ["k"], 1).orderBy("start").collect()
    assert [(r.start, r.end) for r in got] == [(0, 19), (41, 100)]


def test_epoch_split_of_one_size(spark):
    frame = "rec string, stim string, start bigint, end bigint"
    sizes = {("r", "a"): 1, ("r", "b"): 3, (None, "a"): 3, ("s", "c"): 8, ("t", "a"): 1}
    rows = [(*k, 100 * i + 7, 100 * i + 57) for k, n in sizes.items() for i in range(n)]
    epochs = spark.createDataFrame(rows, frame)
    grid = spark.createDataFrame(
        [(k, 10 * i, 10 * i + 10) for k in ("r", "s", None) for i in range(90)], "rec string, start bigint, end bigint"
    )
    whole = sp.epoch_split(epochs, grid, ["rec", "stim"], ["rec"]).collect()
    key = lambda r: tuple(str(x) for x in r)
    for n in (3, 8):
        want = sorted((r for r in whole if r.n_epochs == n), key=key)
        got = sorted(sp.epoch_split(epochs, grid, ["rec", "stim"], ["rec"], only=n).collect(), key=key)
        assert got == want
    halves = sp.epoch_split(epochs, grid, ["rec", "stim"], ["rec"], only=1, ratios=(0.2, 0.4, 0.4))
    assert [(r.split, r.start, r.end) for r in halves.filter("rec = 't'").orderBy("start").collect()] == [
        ("train", 7, 17), ("valid", 17, 37), ("test", 37, 57),
    ]
    for wrong in ((0.5, 0.5), (0.5, 0.6, -0.1), (0.5, 0.1, 0.1)):
        with pytest.raises(ValueError):
            sp.epoch_split(epochs, grid, ["rec", "stim"], ["rec"], ratios=wrong)


def test_sleep_splits(spark, cutting):
    rows = [("r", "p", "n1", i, i % 3, i * 90, i * 90 + 95) for i in range(12)]
    rows += [("r", "p", "n1", 90, 6, 2000, 2600), ("r", "p", "n1", 91, 4, 3000, 3060)]
    df = spark.createDataFrame(
        rows, "rec string, subj string, ses string, sid int, id int, start bigint, end bigint"
    )
    got = sp.sleep_splits(df, "rec", "subj", "ses", "sid", "id", [6], 30).collect()
    # 36 whole epochs stay; the unknown stage and the one with two epochs drop out
    assert len(got) == 36 * 3 and {r.id for r in got} == {0, 1, 2}
    assert Counter(r.split for r in got)["test"] == 36
    assert len({(r.fold, r.intersubject, r.intersession) for r in got}) == 3


def test_tasks_follow_the_rows(spark, monkeypatch):
    """Ranks within classes are sorted by as many tasks as the counted rows ask for."""
    monkeypatch.setattr(lanes, "TASK_ROWS", 10)
    folds = sp.stratified_folds(labelled(spark), [], "label", "id")
    assert "REPARTITION_BY_NUM" in (plan := folds._jdf.queryExecution().executedPlan().toString())
    assert ", 10), REPARTITION_BY_NUM" in plan and folds.count() == 500
