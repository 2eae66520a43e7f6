"""Walsh-Hadamard k-means against exact integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kymo.llm import hadamard, queries
from kymo.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, vector int"


def brute(rows, k=16, rounds=3):
    """rows: (vec_id, list of Python integers)."""
    rows = sorted(rows, key=lambda r: str(r[0]))
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    ends = [v for _, v in sorted(rows, key=lambda r: (name(r[0]), r[1]))[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        best = [min((gap(v, c), j) for j, c in enumerate(ends)) for _, v in rows]
        if turn == rounds:
            break
        for j in range(len(ends)):
            mine = [v for (_, v), (_, b) in zip(rows, best, strict=True) if b == j]
            if mine:
                ends[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    whole = sum(d for d, _ in best)
    part = {j: sum(d for d, b in best if b == j) for j in range(len(ends))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in ends]
    return sorted(((i, j, d, part[j], whole, sha[j]) for (i, _), (d, j) in zip(rows, best, strict=True)), key=str)


def given(rows):
    """The rows that are kept, as integers."""
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            yield i, [math.floor(64 * float(np.float32(x))) for x in v]


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").collect()]
    got = queries.QUERIES["op11_hadamard_kmeans"](spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == brute(list(given(rows)))


@pytest.mark.parametrize("shape", ["spread", "ties", "few", "same"])
def test_odd_rows(spark, shape):
    rng = np.random.default_rng(len(shape))
    n = {"spread": 300, "ties": 200, "few": 7, "same": 90}[shape]
    if shape == "spread":
        values = rng.normal(size=(n, 64)) * rng.choice([0.01, 1, 900], (n, 1))
    elif shape == "ties":
        values = rng.integers(-1, 2, (n, 64)) / 64
    else:
        values = np.repeat(rng.normal(size=(max(1, n // 30), 64)), 30, 0)[:n] if shape == "same" else rng.normal(size=(n, 64))
    rows = [(i // 2, v.tolist()) for i, v in enumerate(values)]
    whole = [0.5] * 64
    rows += [(900, None), (901, []), (902, whole[:63]), (903, [*whole, 1.0]), (904, [*whole[:63], None])]
    rows += [(905, [*whole[:63], float("nan")]), (906, [*whole[:63], float("-inf")]), (None, whole), (None, whole)]
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    got = hadamard.clustered(frame).collect()
    assert sorted(map(tuple, got), key=str) == brute(list(given(rows)))


def test_out_of_reach_and_empty(spark):
    rows = [(1, [1.0] * 64), (2, [-3.0] * 64), (3, [1e30] + [0.0] * 63)]
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    got = {r.vec_id: r for r in hadamard.clustered(frame).collect()}
    assert got[3].cluster is None and got[3].distance is None and got[3].inertia == 0
    assert {got[1].cluster, got[2].cluster} == {0, 1} and got[1].distance == 0
    assert hadamard.clustered(frame.limit(0)).count() == 0


def test_largest_integers_stay_exact():
    order = hadamard.sequency_order(64)
    ends = np.full((2, 64), hadamard.REACH, np.int64)
    ends[1] *= -1
    number, total = hadamard.nearest(hadamard.transform(-ends, order), hadamard.transform(ends, order), 4)
    assert number.tolist() == [1, 0] and total.tolist() == [0, 0]
    _, total = hadamard.nearest(hadamard.transform(ends[:1], order), hadamard.transform(ends[1:], order), 4)
    assert int(total[0]) // 64 == 64 * (2 * hadamard.REACH) ** 2


def test_search_leaves_out_most_centroids():
    """Bounds do cut: far centroids never reach the last coefficients."""
    rng = np.random.default_rng(3)
    order = hadamard.sequency_order(64)
    ends = hadamard.transform(rng.integers(-90, 90, (16, 1)) + rng.integers(-2, 3, (16, 64)), order)
    vectors = hadamard.transform(rng.integers(-90, 90, (500, 1)) + rng.integers(-2, 3, (500, 64)), order)
    number, total = hadamard.nearest(vectors, ends, 4)
    want = ((vectors[:, None] - ends[None]) ** 2).sum(2)
    assert (number == want.argmin(1)).all() and (total == want.min(1)).all()
    coarse = ((vectors[:, None, :4] - ends[None, :, :4]) ** 2).sum(2)
    assert (coarse <= total[:, None]).mean() < 0.5


def test_empty_tasks(spark):
    frame = spark.createDataFrame([(i, [float(i)] * 64, 1, "x", 2) for i in range(3)], SCHEMA).repartition(9)
    assert hadamard.clustered(frame).agg(F.sum("distance")).first()[0] == 0
