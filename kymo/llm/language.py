"""Language identification by error-correcting output codes.

Every language has a codeword; each bit is one binary classifier over character n-grams.
Loss-weighted decoding compares the classifiers' margins with all codewords.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import batched, fold, rows

_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("runner_up", pa.string()),
        ("margin", pa.float64()),
        ("ambiguous", pa.bool_()),
    ]
)


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 15
    smoothing: float = 0.5
    temperature: float = 4.0
    least_margin: float = 0.2
    block: int = 1 << 16


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    code: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # languages x bits, rows sum to 1
    settings: Settings


def codewords(n: int) -> np.ndarray:
    """The exhaustive code up to six languages, beyond it seeded balanced columns."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 6:
        cols = [[1] + [1 if (k >> i) & 1 else -1 for i in range(n - 1)] for k in range(2 ** (n - 1) - 1)]
        return np.array(cols, np.int8).T
    pick = np.random.default_rng(20_011)
    out: list[np.ndarray] = []
    seen: set[bytes] = set()
    while len(out) < int(np.ceil(15 * np.log2(n))):
        column = np.ones(n, np.int8)
        column[pick.permutation(n)[: n // 2]] = -1
        column *= column[0]
        if column.tobytes() not in seen:
            seen.add(column.tobytes())
            out.append(column)
    return np.array(out).T


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str | None, settings: Settings):
    """Bucket ids of all 1- to 3-grams of letters and word edges, in blocks of the whole text."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    shift = np.uint32(32 - int(settings.buckets).bit_length() + 1)
    for at in range(0, len(codes), settings.block):
        # two more on the left, so that no n-gram is lost at a block's edge
        part = codes[max(0, at - 2) : at + settings.block]
        part = np.where(_letters()[part], part, np.uint32(0))
        part = np.r_[np.uint32(0), part, np.uint32(0)]
        part = part[np.r_[True, (part[1:] != 0) | (part[:-1] != 0)]].astype(np.uint32)
        if not part.any():
            continue
        one = part * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (one[1:] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + part[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE35) + one[2:]
        both = np.concatenate([one[part != 0], two, three])
        both = (both ^ (both >> np.uint32(16))) * np.uint32(0x7FEB352D)
        yield (both ^ (both >> np.uint32(15))) >> shift


def counts(text: str | None, settings: Settings) -> np.ndarray | None:
    """Occurrences per bucket, or None where the text has no letter."""
    total = None
    for part in grams(text, settings):
        got = np.bincount(part, minlength=settings.buckets)
        total = got if total is None else total + got
    return total


def margins(found: np.ndarray, model: Model) -> np.ndarray:
    return found.astype(np.float32) @ model.weights


def decode(margin: np.ndarray, model: Model) -> np.ndarray:
    """Probability of every language: its codeword's weighted logistic loss, normalised."""
    if len(model.langs) == 1:
        return np.ones(1)
    signed = model.code * (margin / model.settings.temperature)
    bits = model.code.shape[1]
    loss = bits * (model.trust * np.logaddexp(0, -signed)).sum(1)
    like = np.exp(-(loss - loss.min()))
    return like / like.sum()


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from rows (text, lang); null text or lang teaches nothing.

    Counts cover every row. The driver receives one matrix of languages x buckets, whose size
    does not depend on the number of rows.
    """
    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    langs = tuple(sorted(r.lang for r in known.select("lang").distinct().collect()))
    place = {lang: i for i, lang in enumerate(langs)}
    code = codewords(len(langs))
    if len(langs) < 2:
        return Model(langs, code, np.zeros((settings.buckets, 0), np.float32), np.zeros((len(langs), 0)), settings)
    schema = pa.schema([("lang", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches):
        total = np.zeros((len(langs), settings.buckets), np.int64)
        for lang, text in rows(batches):
            found = counts(text, settings)
            if found is not None:
                total[place[lang]] += found
        i, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(b, pa.int32()), pa.array(total[i, b], pa.int64())], schema=schema
        )

    seen = (
        known.mapInArrow(count, "lang int, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    table = np.zeros((len(langs), settings.buckets))
    table[seen.lang, seen.bucket] = seen.n
    # every language weighs the same in a bit's two sides
    table = table / np.maximum(1, table.sum(1, keepdims=True)) * 1e6
    sides = []
    for sign in (1, -1):
        side = (code == sign).astype(float).T @ table + settings.smoothing
        sides.append(np.log(side / side.sum(1, keepdims=True)))
    weights = (sides[0] - sides[1]).T.astype(np.float32)
    flat = np.full(code.shape, 1 / code.shape[1])
    model = Model(langs, code, weights, flat, settings)
    return Model(langs, code, weights, _trust(known, model, place), settings)


def _trust(known: DataFrame, model: Model, place: dict[str, int]) -> np.ndarray:
    """Share of each language's training rows that each classifier gets right, per language."""
    size = model.code.shape
    schema = pa.schema([("lang", pa.int32()), ("bit", pa.int32()), ("hit", pa.int64()), ("n", pa.int64())])

    def judge(batches):
        hit, n = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for lang, text in rows(batches):
            found = counts(text, model.settings)
            if found is not None:
                i = place[lang]
                hit[i] += np.sign(margins(found, model)) == model.code[i]
                n[i] += 1
        i, b = np.indices(size).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(b, pa.int32()), pa.array(hit.ravel(), pa.int64()), pa.array(n.ravel(), pa.int64())],
            schema=schema,
        )

    got = (
        known.mapInArrow(judge, "lang int, bit int, hit long, n long")
        .groupBy("lang", "bit")
        .agg(F.sum("hit").alias("hit"), F.sum("n").alias("n"))
        .collect()
    )
    share = np.ones(size)
    for r in got:
        share[r.lang, r.bit] = (r.hit + 1) / (r.n + 2)
    return share / share.sum(1, keepdims=True)


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, runner_up, margin, ambiguous.

    ``und`` with score 0 for texts that are null or without a letter, and for all texts when
    nothing was learned; they count as ambiguous. Ties go to the first language by name. Whole
    texts are read in blocks; further columns are ignored.
    """

    def run(batches):
        def each():
            for doc, text in rows(batches):
                found = counts(text, model.settings) if model.langs else None
                if found is None:
                    yield doc, "und", 0.0, None, 0.0, True
                    continue
                like = decode(margins(found, model), model)
                order = np.argsort(-like, kind="stable")
                second = float(like[order[1]]) if len(order) > 1 else 0.0
                gap = float(like[order[0]]) - second
                yield (
                    doc,
                    model.langs[order[0]],
                    float(like[order[0]]),
                    model.langs[order[1]] if len(order) > 1 else None,
                    gap,
                    gap < model.settings.least_margin,
                )

        yield from batched(_OUT, each())

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(
        run, "doc_id long, lang_pred string, score double, runner_up string, margin double, ambiguous boolean"
    )


def language_id(documents: DataFrame, folds: int = 5, settings: Settings = Settings()) -> DataFrame:
    """Predictions for all documents, learned from rows whose checksum modulo ``folds`` is not 0."""
    model = fit(documents.filter(fold("doc_id", folds) != 0).select("text", "lang"), settings)
    found = identify(documents, model)
    return found.withColumn("held_out", fold("doc_id", folds) == 0)
