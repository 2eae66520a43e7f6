"""Exact k-means on integer vectors by progressive search among Walsh-Hadamard coefficients.

Vectors and centroids are integers, and so are their Walsh-Hadamard coefficients; squared
distances between coefficients are ``dims`` times those between vectors. Coefficients are taken
in order of sequency, coarse to fine. The centroid nearest by the coarsest ones sets a bound,
its full distance; a centroid whose sum of squared differences so far exceeds the bound is worse
for certain and left out, the others go on to the last coefficient. Results are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import written

# Integers up to 2^24: then dims times a squared distance is below 2^63 for 64 components.
REACH = 1 << 24


@dataclass(frozen=True)
class Settings:
    """``dims``: components, a power of two up to 64; ``scale``: what they are multiplied by
    before they are rounded down; ``first``: coefficients that choose the bounding centroid."""

    dims: int = 64
    centroids: int = 16
    rounds: int = 3
    scale: int = 64
    seed: int = 1
    first: int = 4


def sequency_order(dims: int) -> np.ndarray:
    """Places of the coefficients in natural order, by the sign changes of their functions."""
    rows = transform(np.eye(dims, dtype=np.int64), np.arange(dims))
    return np.argsort((np.diff(np.sign(rows), axis=0) != 0).sum(0), kind="stable")


def transform(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of every row, in the given order."""
    out = values.astype(np.int64)
    n, dims = out.shape
    half = 1
    while half < dims:
        pairs = out.reshape(n, dims // (2 * half), 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack((low + high, low - high), axis=2).reshape(n, dims)
        half *= 2
    return out[:, order]


def nearest(vectors: np.ndarray, centroids: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and exact squared coefficient distance of the nearest centroid of every vector,
    both given as coefficients from coarse to fine; ties go to the smaller number."""
    dims = vectors.shape[1]
    at = min(first, dims)
    gaps = vectors[:, None, :at] - centroids[None, :, :at]
    begun = np.einsum("nkd,nkd->nk", gaps, gaps)
    leader = begun.argmin(1)
    rest = vectors - centroids[leader]
    bound = np.einsum("nd,nd->n", rest, rest)
    rows, number = np.nonzero(begun <= bound[:, None])
    held = begun[rows, number]
    while at < dims:
        upto = min(dims, 2 * at)
        gaps = vectors[rows, at:upto] - centroids[number, at:upto]
        held = held + np.einsum("pd,pd->p", gaps, gaps)
        alive = held <= bound[rows]
        rows, number, held = rows[alive], number[alive], held[alive]
        at = upto
    # pairs are ordered by vector, then number, and every vector still has its leader
    least = np.minimum.reduceat(held, np.searchsorted(rows, np.arange(len(vectors)))) if len(vectors) else held
    best = held == least[rows]
    _, place = np.unique(rows[best], return_index=True)
    return number[best][place], least


def kept(embeddings: DataFrame, settings: Settings) -> DataFrame:
    """vec_id and vector: whole vectors without missing components, as doubles."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embeddings.filter((F.size(vector) == settings.dims) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")
    )


def in_reach(settings: Settings) -> Column:
    return F.forall("vector", lambda x: F.abs(x) <= F.lit(REACH / settings.scale))


def integers(vectors: np.ndarray, settings: Settings) -> np.ndarray:
    return np.floor(settings.scale * vectors).astype(np.int64)


def starts(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """The vectors whose hashed ids are smallest."""
    name = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(name, 256), "vector").limit(settings.centroids).collect()
    return integers(np.array([r.vector for r in rows], float).reshape(-1, settings.dims), settings)


def _blocks(batch: pa.RecordBatch, settings: Settings, size: int = 4096) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for at in range(0, batch.num_rows, size):
        part = batch.slice(at, size)
        flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
        yield part.column(0), integers(flat.reshape(-1, settings.dims), settings)


def _moved(vectors: DataFrame, centroids: np.ndarray, settings: Settings) -> np.ndarray:
    """The centroids after one round; a task sends one row of sums per centroid."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = sequency_order(dims)
        ends = transform(centroids, order)
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, values in _blocks(batch, settings):
                number, _ = nearest(transform(values, order), ends, settings.first)
                for c in np.unique(number):
                    sums[c] += values[number == c].sum(0)
                counts += np.bincount(number, minlength=k)
        met = np.flatnonzero(counts)
        if len(met):
            columns = [pa.array(met, pa.int32()), pa.array(counts[met]), pa.array(list(sums[met]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    parts = vectors.mapInArrow(run, "cluster int, n long, sums array<long>")
    wide = F.col("total").cast("decimal(38,0)")
    totals = (
        parts.select("cluster", "n", F.posexplode("sums").alias("place", "total"))
        .groupBy("cluster", "place")
        .agg(F.sum("n").alias("n"), F.sum(wide).alias("total"))
        .collect()
    )  # at most centroids * dims rows
    moved = centroids.copy()
    for row in totals:
        moved[row.cluster, row.place] = int(row.total) // row.n
    return moved


def clustered(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors with exactly ``dims`` components, none null, NaN or infinite; null, shorter
    and longer ones give no row. Rows that repeat are vectors each, and may both start as
    centroids; with fewer vectors than centroids, all start. A null vec_id hashes as an empty one.
    Among equal hashes the smaller vector comes first. Further columns are ignored; an empty
    table gives no rows. A vector with an integer beyond 2^24 has squared distances beyond a
    long: it keeps its row with null cluster and distance and moves no centroid. Sums beyond a
    long are null.
    """
    spark = embeddings.sparkSession
    all_kept = kept(embeddings, settings)
    vectors = all_kept.filter(in_reach(settings))
    centroids = starts(vectors, settings)
    for _ in range(settings.rounds if len(centroids) else 0):
        centroids = _moved(vectors, centroids, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = sequency_order(settings.dims)
        ends = transform(centroids, order)
        for batch in batches:
            for ids, values in _blocks(batch, settings):
                number, total = nearest(transform(values, order), ends, settings.first)
                columns = [ids, pa.array(number, pa.int32()), pa.array(total // settings.dims, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    near = vectors.mapInArrow(run, "vec_id long, cluster int, distance long")
    far = all_kept.filter(~in_reach(settings)).select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    assigned = written(near.unionByName(far))
    sums = assigned.filter("cluster is not null").groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    fit = lambda n: n if n < 1 << 63 else None
    whole = fit(sum(int(r.s) for r in sums))
    facts = spark.createDataFrame(
        [(r.cluster, fit(int(r.s)), names[r.cluster]) for r in sums], "cluster int, cluster_inertia long, centroid_sha256 string"
    )
    return assigned.join(F.broadcast(facts), "cluster", "left").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid_sha256"
    )
