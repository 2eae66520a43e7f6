"""Token counts of whole texts by a given tokenizer file; only lengths leave the tasks.

Texts are encoded in batches of about equal bytes, so that a task holds a bounded number of
encodings. A long text is cut where the tokenizer starts a new word in any case, and the counts
of its stretches are added up.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# White space after a character that is none. Byte-level words never reach from the one into the
# other, nothing looks back, and what looks ahead does so from white space only; hence words on
# both sides are those of the whole text. Special strings hold no white space.
_SAFE = re.compile(r"(?<=[!-~\w])[ \t\n\r]")


@dataclass(frozen=True)
class Settings:
    """``batch``: bytes encoded at once; ``stretch``: code points above which a text is cut;
    ``limit``: tokens above which a text is reported as over the limit."""

    batch: int = 1 << 18
    stretch: int = 1 << 16
    limit: int = 1024


def stretches(text: str, size: int) -> Iterator[str]:
    """The text in parts of at most ``size`` code points, or more where no safe cut lies."""
    start = last = 0
    if len(text) > size:
        for found in _SAFE.finditer(text):
            if found.start() - start > size and last > start:
                yield text[start:last]
                start = last
            last = found.start()
        if len(text) - start > size and last > start:
            yield text[start:last]
            start = last
    yield text[start:]


_held: dict[str, tuple[Callable[[list[str]], list[int]], bool]] = {}


def counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """A function from texts to their token counts, and whether texts may be cut before it.

    Only byte-level files without a normaliser may: the others treat the start of a text, or
    white space, in ways of their own, and get whole texts.
    """
    if path not in _held:
        if path.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            _held[path] = (lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)], False)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            before = tokenizer.pre_tokenizer
            plain = tokenizer.normalizer is None and type(before).__name__ == "ByteLevel" and not before.add_prefix_space
            _held[path] = (lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], plain)
    return _held[path]


def count_tokens(texts: list[str], path: str, settings: Settings = Settings()) -> tuple[list[int], list[int]]:
    """Bytes and tokens of every text."""
    encode, cut = counter(path)
    n_bytes, n_tokens = [0] * len(texts), [0] * len(texts)
    parts: list[str] = []
    owners: list[int] = []
    load = 0

    def flush() -> None:
        for owner, n in zip(owners, encode(parts), strict=True):
            n_tokens[owner] += n
        parts.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for part in stretches(text, settings.stretch) if cut else (text,):
            size = len(part.encode())
            if parts and load + size > settings.batch:
                flush()
                load = 0
            parts.append(part)
            owners.append(i)
            load += size
            n_bytes[i] += size
    flush()
    return n_bytes, n_tokens


def token_counts(documents: DataFrame, tokenizer: str, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    A null text is an empty one with no bytes and no tokens. Every row is counted, so rows that
    repeat give equal rows, and a null doc_id stays null. Further columns are ignored; an empty
    table gives no rows. A text without a safe cut is encoded whole, however long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_tokens = count_tokens(batch.column(1).to_pylist(), tokenizer, settings)
            lengths = [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lengths], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    counted = slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > settings.limit)
