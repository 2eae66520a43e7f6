"""Near-duplicate groups by min-max hashing.

Every permutation of the shingles gives two signature values, its minimum and its maximum.
Bands of consecutive values deal documents into buckets. Equal sets are one class; class
representatives that share a bucket are linked if their full sets are similar enough.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import batched, mix, rows, words, written

_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hash", pa.binary()), ("signature", pa.binary())]
)


@dataclass(frozen=True)
class Settings:
    """``permutations`` give twice as many signature values, cut into bands of ``rows`` values.

    A pair at similarity s is missed with probability (1 - s^rows)^bands, below 1e-6 at 0.85.
    ``agreement`` is the share of equal signature values below which full sets are not compared:
    over five standard deviations below the threshold.
    """

    shingle: int = 3
    percent: int = 85
    permutations: int = 96
    rows: int = 6
    agreement: float = 0.70
    block: int = 1024
    load: int = 4_000_000
    seed: int = 20_023

    @property
    def bands(self) -> int:
        return 2 * self.permutations // self.rows


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of the whole text; fewer words are one shingle."""
    found = words(text, lower=True)
    if not found:
        return np.empty(0, np.uint64)
    n = len(found)
    size = min(size, n)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total = mix(total + each[i : n - size + 1 + i])
    return np.unique(total)


def multipliers(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    pick = np.random.default_rng(settings.seed)
    odd = pick.integers(0, 2**63, settings.permutations, np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, pick.integers(0, 2**63, settings.permutations, np.uint64)


def signature(found: np.ndarray, settings: Settings, parts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Minimum and maximum of every permutation, as 32-bit values."""
    odd, add = parts
    low = np.full(settings.permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(settings.permutations, np.uint64)
    for at in range(0, len(found), 512):
        turned = found[at : at + 512] * odd[:, None]
        turned += add[:, None]
        turned ^= turned >> np.uint64(32)
        np.minimum(low, turned.min(1), out=low)
        np.maximum(high, turned.max(1), out=high)
    both = np.stack([low, high], 1).ravel()
    return (mix(both) >> np.uint64(32)).astype(np.uint32)


def signed(documents: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, set_hash and signature; both null without words."""

    def run(batches):
        parts = multipliers(settings)

        def each():
            for doc, text in rows(batches):
                found = shingles(text, settings.shingle)
                if len(found):
                    yield doc, len(found), xxhash.xxh3_128_digest(found.tobytes()), signature(found, settings, parts).tobytes()
                else:
                    yield doc, 0, None, None

        yield from batched(_SIGNED, each())

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_shingles long, set_hash binary, signature binary")


def bucket_key(part: np.ndarray, band: int) -> int:
    return xxhash.xxh3_64_intdigest(part.tobytes(), band) - 2**63


def buckets(classes: DataFrame, settings: Settings) -> DataFrame:
    """(bucket, id, next) of every band of every class; ``next`` is the bucket of the band after it."""
    schema = pa.schema([("bucket", pa.int64()), ("id", pa.int64()), ("next", pa.int64())])

    def run(batches):
        def each():
            for id_, sign in rows(batches):
                at = np.frombuffer(sign, np.uint32).reshape(settings.bands, settings.rows)
                keys = [bucket_key(part, band) for band, part in enumerate(at)]
                for band, key in enumerate(keys):
                    yield key, id_, keys[(band + 1) % settings.bands]

        yield from batched(schema, each(), 20_000)

    return classes.select("id", "signature").mapInArrow(run, "bucket long, id long, next long")


def agreeing(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow the threshold."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        least = settings.agreement * 2 * settings.permutations
        return pd.Series(
            [bool((np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).sum() >= least) for x, y in zip(a, b, strict=True)],
            dtype=bool,
        )

    sizes = classes.select("id", "n_shingles", "signature")
    return (
        pairs.join(sizes.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa")), "a")
        .join(sizes.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb")), "b")
        # a similarity cannot exceed the ratio of the sizes
        .filter(100 * F.least("na", "nb") >= settings.percent * F.greatest("na", "nb"))
        .filter(alike("sa", "sb"))
        .select("a", "b")
    )


def meetings(named: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Classes that share a bucket, lie in different components and agree enough, as lists.

    ``named`` holds (bucket, id, component) of buckets with several components. A bucket is dealt
    into blocks of about ``block`` rows or ``load`` shingles, and every two blocks meet in one
    group, so that no group grows with the bucket. A pair counts in the first band it shares.
    Rows: group (bucket, i, j), id, component and ``near``, the later ids it may be linked with.
    """
    known = named.join(classes.select("id", "n_shingles", "signature"), "id")
    weight = F.greatest(F.count("id") / settings.block, F.sum("n_shingles") / settings.load)
    blocks = known.groupBy("bucket").agg(F.ceil(weight).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (
        known.join(blocks, "bucket")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "component", "n_shingles", "signature")
    )
    long = pa.int64()
    schema = pa.schema(
        [("bucket", long), ("i", pa.int32()), ("j", pa.int32()), ("id", long), ("component", long), ("near", pa.list_(long))]
    )
    least = settings.agreement * 2 * settings.permutations
    shape = (settings.bands, settings.rows)

    def meet(batches):
        def each():
            for (bucket, i, j), group in groupby(rows(batches), lambda r: r[:3]):
                group = list(group)
                sides = [[r for r in group if r[3] == k] for k in dict.fromkeys((i, j))]
                if not all(sides):
                    continue
                ids, parts, sizes = ([np.array([r[at] for r in side]) for side in sides] for at in (4, 5, 6))
                signs = [np.stack([np.frombuffer(r[7], np.uint32).reshape(shape) for r in side]) for side in sides]
                here = next((n for n in range(settings.bands) if bucket_key(signs[0][0][n], n) == bucket), None)
                company: dict[int, list[int]] = {}
                for k, id_ in enumerate(ids[0].tolist()):
                    # within one block, only what follows
                    start = k + 1 if i == j else 0
                    big, small = np.maximum(sizes[0][k], sizes[-1][start:]), np.minimum(sizes[0][k], sizes[-1][start:])
                    # a similarity cannot exceed the ratio of the sizes
                    open_ = (parts[0][k] != parts[-1][start:]) & (100 * small >= settings.percent * big)
                    at = np.flatnonzero(open_) + start
                    if not len(at):
                        continue
                    same = signs[-1][at] == signs[0][k]
                    met = ids[-1][at[(same.sum((1, 2)) >= least) & (same.all(2).argmax(1) == here)]].tolist()
                    if met:
                        company.setdefault(id_, []).extend(met)
                        for other in met:
                            company.setdefault(other, [])
                part = {r[4]: r[5] for r in group}
                for id_, met in company.items():
                    yield bucket, i, j, id_, part[id_], met

        yield from batched(schema, each(), 2_000)

    return (
        dealt.repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
        .mapInArrow(meet, "bucket long, i int, j int, id long, component long, near array<long>")
    )


def similar(p: np.ndarray, q: np.ndarray, settings: Settings) -> bool:
    """Whether two sorted sets reach the threshold."""
    both = len(np.intersect1d(p, q, assume_unique=True))
    return bool(100 * both >= settings.percent * (len(p) + len(q) - both))


def full_sets(wanted: DataFrame, documents: DataFrame, settings: Settings) -> DataFrame:
    """(id, found) with all shingles of the documents in ``wanted``."""
    schema = pa.schema([("id", pa.int64()), ("found", pa.binary())])

    def run(batches):
        yield from batched(schema, ((doc, shingles(text, settings.shingle).tobytes()) for doc, text in rows(batches)))

    texts = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return written(texts.join(wanted, "id", "left_semi").mapInArrow(run, "id long, found binary"))


def confirmed(met: DataFrame, documents: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) of full sets among the ``meetings`` that join all components they can.

    A group compares its members' full sets and leaves out pairs it has already connected, so
    that it returns fewer links than it has members. A set goes once to each of its groups.
    """
    sets = full_sets(met.select("id").distinct(), documents, settings)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        def each():
            for _, group in groupby(rows(batches), lambda r: r[:3]):
                held = {r[3]: (r[4], r[5], np.frombuffer(r[6], np.uint64)) for r in group}
                up: dict[int, int] = {}

                def top(x):
                    while x in up:
                        x = up[x]
                    return x

                for a, (part, near, found) in held.items():
                    for b in near:
                        x, y = top(part), top(held[b][0])
                        if x != y and similar(found, held[b][2], settings):
                            up[max(x, y)] = min(x, y)
                            yield min(a, b), max(a, b)

        yield from batched(schema, each(), 20_000)

    return (
        met.join(sets, "id")
        .select("bucket", "i", "j", "id", "component", "near", "found")
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
        .mapInArrow(run, "a long, b long")
    )


def verified(likely: DataFrame, documents: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        found = ((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b, strict=True))
        return pd.Series([similar(p, q, settings) for p, q in found], dtype=bool)

    wanted = likely.select(F.col("a").alias("id")).union(likely.select(F.col("b").alias("id"))).distinct()
    sets = full_sets(wanted, documents, settings)
    return (
        likely.join(sets.select(F.col("id").alias("a"), F.col("found").alias("fa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("found").alias("fb")), "b")
        .filter(linked("fa", "fb"))
        .select("a", "b")
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of the edges (a, b): the smallest id reachable.

    Each round, every node points to its smallest neighbour, pointers are doubled until they
    reach a root, and edges are contracted to roots. Rounds end when no edge is left; their
    number grows with the logarithm of the longest chain. Minima are combined before the shuffle.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    labels: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("near")).union(
            edges.select(F.col("b").alias("id"), F.col("a").alias("near"))
        )
        root = written(both.groupBy("id").agg(F.min("near").alias("low")).select("id", F.least("id", "low").alias("root")))
        while True:
            up = root.select(F.col("id").alias("root"), F.col("root").alias("top"))
            further = written(root.join(up, "root").select("id", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")))
            root = further.select("id", "root")
            if further.filter("moved").isEmpty():
                break
        if labels is None:
            labels = root.select("id", F.col("root").alias("component"))
        else:
            step = root.select(F.col("id").alias("component"), "root")
            labels = written(
                labels.join(step, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
            )
        one = root.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        two = root.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        edges = written(
            edges.join(one, "a").join(two, "b")
            .filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
    return labels if labels is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("component"))


def near_duplicates(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id, kept.

    Documents without words are linked with nothing, so they are kept, each its own component.
    ``class_id`` is the smallest doc_id with the same set. Rows that repeat a doc_id with the
    same text get equal results. A null doc_id counts as none and stays its own component.
    Further columns are ignored; an empty table gives no rows.

    A bucket first links every class to its smallest id and to the smallest id with the same next
    band; a group of copies has few such ids over all its buckets, so its pairs grow with its size.
    Then all classes that share a bucket but not yet a component are compared, block by block, so
    that a group of copies costs a few rows each and no link between buckets' members is lost.
    """
    found = written(signed(documents, settings))
    classes = written(
        found.filter("set_hash is not null and doc_id is not null")
        .groupBy("set_hash")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    )
    dealt = buckets(classes, settings)
    shared = dealt.groupBy("bucket").agg(F.count("id").alias("n"), F.min("id").alias("low")).filter("n > 1").drop("n")
    # only buckets with company go on
    dealt = written(dealt.join(shared, "bucket"))
    parts = dealt.groupBy("bucket", "next").agg(F.min("id").alias("first"), F.count("id").alias("n")).filter("n > 1").drop("n")
    star = dealt.select(F.col("low").alias("a"), F.col("id").alias("b"))
    inner = dealt.join(parts, ["bucket", "next"]).select(F.col("first").alias("a"), F.col("id").alias("b"))
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    first = written(agreeing(star.union(inner).select(*pair).filter("a <> b").distinct(), classes, settings))
    links = written(verified(first, documents, settings))
    grouped = components(links)
    # what is left: pairs in one bucket, in different components
    named = dealt.select("bucket", "id").join(grouped, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    split = named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("bucket")
    met = written(meetings(written(named.join(split, "bucket")), classes, settings))
    final = grouped
    if not met.isEmpty():
        final = components(links.union(written(confirmed(met, documents, settings))))
    held = classes.select("set_hash", F.col("id").alias("class_id")).join(
        final.select(F.col("id").alias("class_id"), "component"), "class_id", "left"
    )
    out = found.select("doc_id", "n_shingles", "set_hash").join(held, "set_hash", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "class_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
