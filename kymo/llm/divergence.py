"""Quality rules by distribution divergence.

Every language has two references summed over all its documents: a histogram of character
classes and one of its common words. A document is kept when its Jensen-Shannon distance to
both references stays below a threshold; short texts are exempt from what they are too short for.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import batched, rows, written

SYMBOLS = "#*$%&|<>"
_CLASSES = 10
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("reference", pa.string()),
        ("class_distance", pa.float64()),
        ("word_distance", pa.float64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
    ]
)
_SQL_OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "reference string, class_distance double, word_distance double, base_failed boolean, kept boolean"
)


@dataclass(frozen=True)
class Settings:
    """``common_share``: a common word makes up at least this share of its language, so a
    language has at most 1 / common_share of them. ``*_slack`` widens a threshold for short
    texts by slack / sqrt(n)."""

    common_share: float = 0.002
    reference_words: int = 2_000
    class_chars: int = 100
    class_limit: float = 0.20
    class_slack: float = 1.0
    words: int = 100
    word_limit: float = 0.32
    word_slack: float = 2.5
    flush: int = 300_000


def _class_table() -> np.ndarray:
    table = np.full(256, 8, np.uint8)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[0xC0:] = 2
    table[ord("0") : ord("9") + 1] = 3
    table[[32, 9, 11, 12, 13]] = 4
    table[10] = 5
    table[[ord(c) for c in ".,"]] = 6
    table[[ord(c) for c in SYMBOLS]] = 7
    table[0x80:0xC0] = 9  # continuation of a character counted already
    return table


CLASS_OF = _class_table()


def class_counts(raw: bytes) -> np.ndarray:
    """Characters per class, of the whole text in blocks."""
    total = np.zeros(_CLASSES, np.int64)
    for at in range(0, len(raw), 1 << 20):
        total += np.bincount(CLASS_OF[np.frombuffer(raw[at : at + (1 << 20)], np.uint8)], minlength=_CLASSES)
    return total[:9]


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (root of the divergence in bits) of two histograms."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    a, b = p > 0, q > 0
    bits = (p[a] * np.log2(p[a] / m[a])).sum() + (q[b] * np.log2(q[b] / m[b])).sum()
    return float(np.sqrt(max(0.0, bits / 2)))


def repeat_words(found: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    n = len(found)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in found), np.int64, n)
    pair = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)[1]
    _, window, times = np.unique(pair[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    twice = times[window] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : shift + n - 2] |= twice
    return int(inside.sum())


def duplicate_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        # only ASCII white space separates words, so a line of other white space has one
        if line.strip(" \t\r\x0b\x0c"):
            n += 1
            seen.add(line)
    return n - len(seen)


def references(documents: DataFrame, settings: Settings) -> dict[str, tuple[np.ndarray, dict[bytes, int], np.ndarray]]:
    """Per language: class histogram, index of common words, word histogram (last: all others).

    Sums over all rows with text and language, combined before the shuffle. The driver gets
    common words only, at most 1 / common_share per language.
    """
    schema = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("key", pa.binary()), ("n", pa.int64())])

    def count(batches):
        def each():
            seen: dict[str, Counter] = defaultdict(Counter)
            classes = defaultdict(lambda: np.zeros(9, np.int64))
            total: Counter = Counter()
            for lang, text in rows(batches):
                raw = text.encode("utf-8", "surrogatepass")
                found = raw.lower().split()
                classes[lang] += class_counts(raw)
                total[lang] += len(found)
                seen[lang].update(found)
                if sum(map(len, seen.values())) > settings.flush:
                    for name, counter in seen.items():
                        yield from ((name, "word", w, n) for w, n in counter.items())
                    seen.clear()
            for name, counter in seen.items():
                yield from ((name, "word", w, n) for w, n in counter.items())
            for name, found in classes.items():
                yield from ((name, "class", bytes([i]), int(n)) for i, n in enumerate(found) if n)
            yield from ((name, "all", b"", n) for name, n in total.items())

        yield from batched(schema, each(), 50_000)

    known = documents.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    sums = (
        known.mapInArrow(count, "lang string, kind string, key binary, n long")
        .groupBy("lang", "kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    sums = written(sums)
    total = {r.lang: r.n for r in sums.filter("kind = 'all'").collect() if r.n >= settings.reference_words}
    classes: dict[str, np.ndarray] = {lang: np.zeros(9) for lang in total}
    for r in sums.filter("kind = 'class'").collect():
        if r.lang in classes:
            classes[r.lang][r.key[0]] = r.n
    limit = F.lit(None).cast("double")
    for lang, n in total.items():
        limit = F.when(F.col("lang") == lang, F.lit(settings.common_share * n)).otherwise(limit)
    common: dict[str, list] = defaultdict(list)
    for r in sums.filter("kind = 'word'").filter(F.col("n") >= limit).collect():
        common[r.lang].append((bytes(r.key), r.n))
    out = {}
    for lang in sorted(total):
        ranked = sorted(common[lang], key=lambda e: (-e[1], e[0]))
        held = np.array([n for _, n in ranked] + [total[lang] - sum(n for _, n in ranked)], float)
        out[lang] = (classes[lang], {w: i for i, (w, _) in enumerate(ranked)}, held)
    return out


def judge(documents: DataFrame, known: dict, settings: Settings = Settings()) -> DataFrame:
    """One row per document with base counts, distances and the verdict.

    A null or empty text has no words and fails the base rule. A text whose language is null or
    has no reference is held against the nearest one; with no reference at all only the base
    rule decides. Distances are null where the text is too short for them. Repeated rows get
    equal verdicts; further columns are ignored.
    """

    def one(doc, text, lang):
        raw = (text or "").encode("utf-8", "surrogatepass")
        found = raw.split()
        n = len(found)
        classes = class_counts(raw)
        blank = int(classes[4] + classes[5])
        symbols = int(classes[7])
        repeated = repeat_words(found)
        failed = n < 50 or 100 * repeated > 50 * n
        reference, by_class, by_word = None, None, None
        if known and classes.sum():
            seen = Counter(raw.lower().split()) if n else Counter()
            options = [lang] if lang in known else list(known)
            measured = []
            for name in options:
                ref_classes, index, ref_words = known[name]
                held = np.zeros(len(ref_words))
                for w, c in seen.items() if len(seen) < len(index) else ((w, seen[w]) for w in index if w in seen):
                    i = index.get(w)
                    if i is not None:
                        held[i] = c
                held[-1] = n - held.sum()
                measured.append(
                    (
                        distance(classes, ref_classes) if classes.sum() >= settings.class_chars else None,
                        distance(held, ref_words) if n >= settings.words else None,
                        name,
                    )
                )
            by_class, by_word, reference = min(measured, key=lambda m: ((m[1] or 0.0) + (m[0] or 0.0), m[2]))
        kept = not failed
        if by_class is not None and by_class > settings.class_limit + settings.class_slack / np.sqrt(classes.sum()):
            kept = False
        if by_word is not None and by_word > settings.word_limit + settings.word_slack / np.sqrt(n):
            kept = False
        return (
            doc,
            n,
            len(text or "") - blank,
            symbols,
            duplicate_lines(text or ""),
            repeated,
            reference,
            by_class,
            by_word,
            failed,
            kept,
        )

    def run(batches):
        yield from batched(_OUT, (one(*r) for r in rows(batches)))

    slim = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    return slim.mapInArrow(run, _SQL_OUT)


def quality(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return judge(documents, references(documents, settings), settings)

