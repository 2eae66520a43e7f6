"""Best-fit packing of token sequences with several capacities.

A piece needs tokens, one document slot and attention cost (its length squared). Pieces are
dealt to groups by hash; in each group they are placed longest first. Among the open bins that
can take a piece under every capacity, the one whose residual matches the need best is chosen:
by weighted dot product of need and used-up shares, or by the smallest residual norm.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import batched, rows

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


@dataclass(frozen=True)
class Settings:
    """``documents`` and ``cost`` cap a sequence's pieces and its attention cost; the defaults are
    as many pieces as tokens and the cost of one full piece, so neither costs a sequence. Lower
    ones bind."""

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02)
    rule: str = "norm"
    group_docs: int = 4000


def _visible() -> dict[int, str]:
    """Bytes as the byte-level vocabulary writes them: printable ones as they are, the others as
    the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cache(dict):
    """Ids of the stretches between spaces; what was not asked for since the last turn goes.

    A stretch that ends in one comma or full stop after a letter is two words. Letters alone, of
    the Latin blocks without combining marks, are one word, which the model cuts directly. Workers
    outlive their tasks and keep it: at about 200 bytes each, both turns take 50 MB at most.
    """

    limit = 131_072

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.visible = _visible()
        self.older: dict[str, bytes] = {}

    def ids(self, part: str) -> list[int]:
        if part.isalpha() and max(part) < "\u0250" and (low := part.lower()).isalpha():
            word = low if low.isascii() else low.encode().decode("latin-1").translate(self.visible)
            return [token.id for token in self.model.tokenize(word)]
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            if len(part) > 1 and part[-1] in ",." and part[-2].lower().isalpha():
                ids = self[part[:-1]] + self[part[-1]]
            else:
                found = self.ids(part) if part else []
                ids = struct.pack(f"<{len(found)}I", *found)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[part] = ids
        return ids


_held: dict[str, _Cache] = {}


def _encoder(path: str) -> _Cache:
    if path not in _held:
        from tokenizers import Tokenizer

        _held[path] = _Cache(Tokenizer.from_file(path))
    return _held[path]


def ids_of(text: str | None, cache: _Cache) -> bytes:
    """All ids of a text as little-endian 32-bit, then id 0. White space only separates, so the
    stretches between spaces and line feeds are encoded one by one."""
    parts = (text or "").replace("\n", " ").split(" ")
    return b"".join(map(cache.__getitem__, parts)) + b"\0\0\0\0"


def pieces(documents: DataFrame, tokenizer: str, settings: Settings = Settings()) -> DataFrame:
    """Tokenised pieces; only documents longer than a sequence are cut, every ``tokens`` ids."""
    width = 4 * settings.tokens

    def run(batches):
        cache = _encoder(tokenizer)

        def each():
            for doc, text in rows(batches):
                ids = ids_of(text, cache)
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    yield doc, piece, at // 4, len(part) // 4, zlib.crc32(part)

        yield from batched(_PIECES, each(), 10_000)

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(lengths: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece, given longest first."""
    full = np.array([settings.tokens, settings.documents, settings.cost], float)
    weights = np.array(settings.weights)
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    room = np.empty((max(1, len(lengths)), 3))  # residual capacity of open bins
    names = np.empty(len(room), np.int64)
    used = np.empty(len(room), np.int64)
    opened = count = 0
    least = int(lengths.min()) if len(lengths) else 0
    for i, length in enumerate(lengths):
        need = np.array([length, 1, float(length) ** 2])
        best = -1
        if count:
            left = room[:count] - need
            fits = (left >= 0).all(1)
            if fits.any():
                if settings.rule == "dot":
                    # what is used up already, in the directions the piece needs most
                    value = -((1 - room[:count] / full) * (need / full)) @ weights
                else:
                    value = ((left / full) ** 2) @ weights
                best = int(np.where(fits, value, np.inf).argmin())
        if best < 0:
            best = count
            names[best], used[best] = opened, 0
            room[best] = full
            opened += 1
            count += 1
        bins[i], offsets[i] = names[best], used[best]
        used[best] += length
        room[best] -= need
        if room[best, 0] < least or room[best, 1] < 1:
            count -= 1
            for a in (room, names, used):
                a[best] = a[count]
    return bins, offsets


def pack(cut: DataFrame, groups: int, settings: Settings = Settings()) -> DataFrame:
    """Place pieces; every group leaves at most a few sequences partly filled."""
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = place(frame["length"].to_numpy(), settings)
        # at most 2^31 sequences per group
        frame["sequence_id"] = bins + (frame["group"].to_numpy(np.int64) << 31)
        frame["offset"] = offsets
        return frame.drop(columns="group")

    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    return cut.withColumn("group", group).groupBy("group").applyInPandas(run, out)


def packed(documents: DataFrame, tokenizer: str, settings: Settings = Settings()) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of the closing id. Rows that repeat are packed each;
    among equal lengths the smaller doc_id comes first, null last. Further columns are ignored;
    an empty table gives no rows.
    """
    groups = max(1, -(-documents.count() // settings.group_docs))
    return pack(pieces(documents, tokenizer, settings), groups, settings)
