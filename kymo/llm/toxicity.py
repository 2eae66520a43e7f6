"""Toxicity by compression distance.

zstandard trains two dictionaries, one on ordinary windows and one on what is left of toxic windows
without the stretches that ordinary ones have, too. Every window of a text is compressed with the ordinary
dictionary alone and with the toxic one added; the bytes saved are its distance. Counts of
windows above several thresholds enter a logistic calibration fitted on labelled rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import batched, fold, rows, written

_NOT_LETTER = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+")
_GRAM = 5
# At the end of both dictionaries and before every window: its match makes each block worth
# compressing, so that none is stored as it is and single bytes count.
_LEAD = b"The quick onyx goblin jumps over the lazy dwarf 0123456789 "
_STEPS = (2, 3, 4, 5, 6, 7, 8)
_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("windows", pa.int64()), ("best_saving", pa.int64())])


@dataclass(frozen=True)
class Settings:
    """``train_docs`` bounds the labelled sample (toxic documents, and twice as many ordinary
    ones) that dictionaries and calibration are fitted on, ``train_windows`` the windows per class
    that go into a dictionary, ``ordinary_bytes`` and ``toxic_bytes`` the dictionaries, the toxic one
    made of segments of ``toxic_segment`` bytes; nothing bounds what is scored."""

    window: int = 48
    step: int = 32
    train_window: int = 256
    train_windows: int = 20_000
    train_docs: int = 2_500
    ordinary_bytes: int = 98_304
    toxic_bytes: int = 1_024
    toxic_segment: int = 16
    least_count: int = 8
    lift: float = 8.0
    level: int = 5


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    settings: Settings


def letters(text: str | None) -> bytes:
    """Lower case, ASCII runs that are no letters as one space."""
    return _NOT_LETTER.sub(b" ", (text or "").lower().encode("utf-8", "surrogatepass"))


def windows(data: bytes, size: int, step: int) -> list[bytes]:
    return [data[i : i + size] for i in range(0, max(1, len(data) - (size - step)), step)]


def compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=level)
    return zstandard.ZstdCompressor(
        level=level, dict_data=held, write_content_size=False, write_dict_id=False, write_checksum=False
    )


def savings(data: bytes, plain, toxic, settings: Settings, block: int = 4096) -> np.ndarray:
    """Bytes that the toxic dictionary saves in each window."""
    parts = []
    cut = windows(data, settings.window, settings.step)
    for i in range(0, len(cut), block):
        some = [_LEAD + w for w in cut[i : i + block]]
        a, b = plain.multi_compress_to_buffer(some), toxic.multi_compress_to_buffer(some)
        parts.append(np.array([len(x) for x in a], np.int32) - np.array([len(x) for x in b], np.int32))
    return np.concatenate(parts)


def features(saved: np.ndarray) -> list[float]:
    n = len(saved)
    above = [int((saved >= k).sum()) for k in _STEPS]
    return [x / n for x in above] + [float(np.log1p(x)) for x in above[1:6]] + [int(saved.max()) / 4, float(np.log(n))]


def _grams(window: bytes) -> set[bytes]:
    return {w[i : i + _GRAM] for w in window.split() if len(w) >= 4 for i in range(max(1, len(w) - _GRAM + 1))}


def _marked(window: bytes, telling: set[bytes]) -> list[bytes]:
    """Stretches of words that telling grams cover."""
    out = []
    for word in window.split():
        if len(word) < 4:
            continue
        covered = np.zeros(len(word), bool)
        for i in range(max(1, len(word) - _GRAM + 1)):
            if word[i : i + _GRAM] in telling:
                covered[i : i + _GRAM] = True
        edges = np.flatnonzero(np.diff(np.r_[0, covered.astype(np.int8), 0]))
        out += [word[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)]
    return out


def dictionary(samples: list[bytes], size: int, **options: int) -> bytes:
    """A trained dictionary; where there is too little to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, **options).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


def train(ordinary: list[bytes], toxic: list[bytes], settings: Settings) -> tuple[bytes, bytes]:
    """Both dictionaries. Trained on whole toxic windows, the second would spend itself on what both
    classes say; what remains of a window are the stretches whose grams are frequent in toxic windows
    and ``lift`` times rarer in ordinary ones."""
    base = dictionary(ordinary, settings.ordinary_bytes)
    usual, telling = Counter(), Counter()
    for window in ordinary:
        usual.update(_grams(window))
    for window in toxic:
        telling.update(_grams(window))
    least = min(settings.least_count, max(2, len(toxic) // 40))
    keep = {
        g
        for g, n in telling.items()
        if n >= least and n * len(ordinary) > settings.lift * (usual[g] + 1) * len(toxic)
    }
    left = [x for x in (b" ".join(_marked(window, keep)) for window in toxic) if x]
    if not left:
        return base, b""
    return base, dictionary(left, settings.toxic_bytes, k=settings.toxic_segment, d=6)


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
    """Ridge logistic regression by Newton's method: (mean, scale, weights)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) - ridge * np.r_[0, w[1:]]
        bend = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        w += np.linalg.solve(bend, slope)
    return mean, scale, w


def sample(documents: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, toxic) of the labelled documents to learn from, the first by a seeded hash,
    and how many labelled documents there are of each class, in the sample or not.

    Only ids are joined with the labels, so the documents are filtered by a broadcast of bounded
    size and their texts are not shuffled.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic").distinct()
    held = documents.filter(F.col("text").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    present = written(known.join(held, "doc_id"))
    counts = {r.toxic: r.n for r in present.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    drawn = [
        present.filter(F.col("toxic") == kind).select("doc_id", "toxic").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(settings.train_docs * (2 - kind))
        for kind in (0, 1)
    ]
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))
    return written(documents.select("doc_id", "text").join(chosen, "doc_id").filter(F.col("text").isNotNull())), counts


def fit(known: DataFrame, counts: dict[int, int], settings: Settings = Settings()) -> Model:
    """Fit on sampled rows (doc_id, text, toxic) of ``counts`` labelled documents per class.

    The intercept moves by the difference of the log odds of all labelled documents and of the
    sample, so that scores mean the same whether or not the sample's bounds bind. Rows without
    text or label teach nothing. Without both classes, every score is the base rate.
    """
    window = pa.schema([("toxic", pa.int32()), ("part", pa.binary()), ("rank", pa.int64())])
    size = settings.train_window

    def cut(batches):
        def each():
            for _, text, toxic in rows(batches):
                for i, part in enumerate(windows(letters(text), size, size - 32)):
                    yield int(toxic), part, i

        yield from batched(window, each())

    cuts = known.mapInArrow(cut, "toxic int, part binary, rank long")
    parts = {
        kind: [
            bytes(r.part)
            for r in cuts.filter(F.col("toxic") == kind)
            .select("part", F.xxhash64("part", "rank").alias("h"))
            .orderBy("h", "part")
            .limit(settings.train_windows)
            .select("part")
            .collect()
        ]
        for kind in (0, 1)
    }
    if not parts[0] or not parts[1]:
        rate = 0.0 if not parts[1] else 1.0
        odds = -30.0 if not rate else 30.0
        width = 2 * len(_STEPS)
        return Model(b" ", b" ", np.zeros(width), np.ones(width), np.r_[odds, np.zeros(width)], settings)
    base, extra = train(parts[0], parts[1], settings)
    model = Model(base, extra, np.zeros(1), np.ones(1), np.zeros(1), settings)
    found = _featured(known, model).collect()
    y = np.array([float(r.toxic) for r in found])
    mean, scale, weights = calibrate(np.array([r.features for r in found]), y)
    weights[0] += np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return Model(base, extra, mean, scale, weights, settings)


def _pair(model: Model):
    s = model.settings
    return (
        compressor(model.ordinary + b" " + _LEAD, s.level),
        compressor(model.ordinary + b" " + model.toxic + b" " + _LEAD, s.level),
    )


def _featured(frame: DataFrame, model: Model) -> DataFrame:
    schema = pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.float64()))])

    def run(batches):
        plain, toxic = _pair(model)
        yield from batched(schema, ((int(t), features(savings(letters(text), plain, toxic, model.settings))) for _, text, t in rows(batches)))

    return frame.mapInArrow(run, "toxic int, features array<double>")


def score(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score, windows, best_saving.

    Null and empty texts have one empty window, so they get the score of a text without any
    toxic window. Whole texts are scored, whatever their length; equal rows get equal scores;
    further columns are ignored.
    """

    def run(batches):
        plain, toxic = _pair(model)

        def each():
            for doc, text in rows(batches):
                saved = savings(letters(text), plain, toxic, model.settings)
                z = np.r_[1.0, (np.array(features(saved)) - model.mean) / model.scale] @ model.weights
                yield doc, float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), len(saved), int(saved.max())

        yield from batched(_SCORED, each())

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, score double, windows long, best_saving long")


def toxicity(documents: DataFrame, labels: DataFrame, folds: int = 5, settings: Settings = Settings()) -> DataFrame:
    """Scores of all documents from labels of rows whose checksum modulo ``folds`` is not 0.

    Adds held_out and predicted (score at least 0.5). Labels that repeat count once, labels
    without document not at all.
    """
    teach = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(fold("doc_id", folds) != 0)
    model = fit(*sample(documents, teach, settings), settings)
    return score(documents, model).select(
        "doc_id",
        (fold("doc_id", folds) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "windows",
        "best_saving",
    )
