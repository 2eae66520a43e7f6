"""Token counts against the tokenizer on whole texts."""

import random

import pytest

from kymo.llm import queries, token_counts
from kymo.llm.common import table
from kymo.llm.queries import COUNTED_TOKENIZER, tokenizer_path

SCHEMA = "doc_id long, text string, n_tokens string, n_bytes int"
PATH = tokenizer_path(COUNTED_TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_query_equals_brute_force(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    rows = table(spark, folder, "documents").collect()
    got = queries.QUERIES["op13_token_counts"](spark, folder).collect()
    n = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    want = [(r.doc_id, len((r.text or "").encode()), n(r.text), n(r.text) > 1024) for r in rows]
    assert sorted(map(tuple, got)) == sorted(want)


def test_odd_rows(spark, tokenizer):
    table(spark, "/root/testdata/sf0.001", "documents")  # ships the package
    texts = [None, "", " ", "\n\n \t", "a", "a", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>", "é" * 5000, "it's we'll I'LL", "\x1c \x85  b", "word " * 40000, "z" * 300000]
    frame = spark.createDataFrame([(i if i else None, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    got = sorted((tuple(r) for r in token_counts.token_counts(frame, PATH).collect()), key=lambda r: r[0] or 0)
    for text, row in zip(texts, got, strict=True):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert row[1:] == (len((text or "").encode()), n, n > 1024)
    assert token_counts.token_counts(frame.limit(0), PATH).count() == 0


def test_cuts_change_no_count(tokenizer):
    """Small stretches and batches over random texts, white space and special strings included."""
    random.seed(5)
    bits = ["a", "Zb", "7", " ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u2003", "\u3000", "\x1c", "\x85", "'s", "'", "...", "é", "日本", "👍🏽", "_", "<|endoftext|>", "<|endof", "́", "﻿"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 120))) for _ in range(3000)]
    settings = token_counts.Settings(batch=64, stretch=9)
    _, got = token_counts.count_tokens(texts, PATH, settings)
    assert got == [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    cut = [list(token_counts.stretches(t, 9)) for t in texts]
    assert ["".join(c) for c in cut] == texts and sum(map(len, cut)) > 3 * len(texts)


def test_other_files(tokenizer):
    """Files with a normaliser or a start of their own get whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    texts = ["", "Hello  World ", "a b\nc " * 50, "é <s> x"]
    settings = token_counts.Settings(batch=16, stretch=4)
    pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    assert token_counts.count_tokens(texts, tokenizer_path("piece_bpe_32k.model"), settings)[1] == [len(pieces.encode(t)) for t in texts]
    words = Tokenizer.from_file(tokenizer_path())
    assert token_counts.count_tokens(texts, tokenizer_path(), settings)[1] == [len(words.encode(t, add_special_tokens=False).ids) for t in texts]
