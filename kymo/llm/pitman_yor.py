"""Hierarchical Pitman-Yor language model with seating sampled by Gibbs.

Every previous word has a restaurant; all share one parent restaurant, whose own base is uniform
over the vocabulary and one unknown word. Customers first sit down one by one. A sweep then takes
every dish's customers out and draws its tables from their distribution given all other tables,
in the restaurants and then in the parent; predictive probabilities are averaged over the sweeps
kept. Dishes of one sweep see the tables of the sweep before.

Dishes are dealt to shards by hash: everything of one dish, in all restaurants, is in one shard,
so that a shard samples alone within a sweep. After each one the restaurants' tables are
summed over the shards, in parts by the hash of the restaurant's word, and return to the shards
that serve there. Texts are coded once into chunks; chunks ask shards for the probabilities of
their distinct words and word pairs, so that no row stands for a single token.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import bucketed, fold, rows, words, written

_END = xxhash.xxh3_64_intdigest(b" end")  # no word holds a space


@dataclass(frozen=True)
class Settings:
    strength: float = 1.0
    burn_in: int = 1
    kept: int = 2
    chunk_docs: int = 1000
    chunk_bytes: int = 1 << 23
    shard_tokens: int = 1_000_000
    seed: int = 20_021


@dataclass(frozen=True)
class Totals:
    """What all shards need of the corpus."""

    tokens: int
    known: int
    pairs: int
    discount: float
    root_discount: float


class _Hashes(dict):
    limit = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def token_hashes(text: str | None) -> np.ndarray:
    found = words(text, lower=True)
    out = np.empty(len(found) + 1, np.uint64)
    out[:-1] = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    out[-1] = _END
    return out


_CODED = "chunk long, learned long, docs array<long>, held binary, lengths binary, wide int, end int, vocabulary binary, tokens binary"


def coded(documents: DataFrame, learn, settings: Settings) -> DataFrame:
    """Chunks of documents as positions in their own sorted vocabularies of word hashes."""
    schema = pa.schema(
        [("chunk", pa.int64()), ("learned", pa.int64()), ("docs", pa.list_(pa.int64())), ("held", pa.binary()), ("lengths", pa.binary()), ("wide", pa.int32()), ("end", pa.int32()), ("vocabulary", pa.binary()), ("tokens", pa.binary())]
    )

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        docs, held, parts, load = [], [], [], 0

        def close():
            nonlocal number
            vocabulary, at = np.unique(np.concatenate(parts), return_inverse=True)
            number += 1
            row = {
                "chunk": number,
                "learned": sum(len(p) for p, out in zip(parts, held, strict=True) if not out),
                "docs": docs,
                "held": np.array(held, bool).tobytes(),
                "lengths": np.array([len(p) for p in parts], np.int64).tobytes(),
                "wide": len(vocabulary),
                "end": int(np.searchsorted(vocabulary, np.uint64(_END))),
                "vocabulary": _packed(vocabulary, steps=True),
                "tokens": _packed(at.astype(np.int32)),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for doc, text, out in rows(batches):
            docs.append(doc)
            held.append(out)
            parts.append(token_hashes(text))
            load += len(text or "")
            if len(docs) >= settings.chunk_docs or load >= settings.chunk_bytes:
                yield close()
                docs, held, parts, load = [], [], [], 0
        if docs:
            yield close()

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (~learn).alias("held"))
    return slim.mapInArrow(run, _CODED)


class Chunk:
    """A coded chunk's arrays: tokens, contexts, distinct pairs."""

    def __init__(self, held, lengths, wide, end, tokens):
        self.held = np.frombuffer(held, bool)
        self.lengths = np.frombuffer(lengths, np.int64)
        self.tokens = _unpacked(tokens, np.int32)
        self.learned = np.repeat(~self.held, self.lengths)
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]]
        # the word before, which at a start is the end of a text
        before = np.r_[np.int32(end), self.tokens[:-1]]
        before[self.starts] = end
        code = self.tokens.astype(np.int64) * wide + before
        self.pairs, self.pair_of = np.unique(code, return_inverse=True)
        self.pair_word = self.pairs // wide
        self.pair_context = self.pairs % wide


_STATE = (
    "shard int, words int, wide int, word_n binary, codes binary, pair_n binary, chunks array<long>, "
    "word_at array<binary>, pair_at array<binary>, contexts binary, customers binary, dishes binary, "
    "known long, pairs long, pair_one long, pair_two long, root_one long, root_two long"
)


def _edges(parts: int) -> np.ndarray:
    """Hashes are uniform, so equal ranges of them are equal parts."""
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


def _packed(numbers: np.ndarray, steps: bool = False) -> bytes:
    """Numbers to send: compressed byte by byte of equal weight, sorted ones as steps."""
    if steps:
        numbers = np.diff(numbers, prepend=numbers.dtype.type(0))
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.dtype.itemsize)
    return zstandard.compress(planes.T.tobytes(), 1)


def _unpacked(sent: bytes, kind, steps: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(sent), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    numbers = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(numbers, dtype=kind) if steps else numbers


def state(chunks: DataFrame, shards: int) -> DataFrame:
    """One row per shard: counts of its words and pairs, where each chunk finds its own, and what
    the shard's dishes add to the restaurants they are in."""
    schema = pa.schema(
        [("shard", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("n", pa.binary()), ("contexts", pa.binary()), ("codes", pa.binary()), ("pair_n", pa.binary())]
    )
    edges = _edges(shards)

    def ask(batches):
        for chunk, held, lengths, wide, end, vocabulary, tokens in rows(batches):
            c, vocabulary = Chunk(held, lengths, wide, end, tokens), _unpacked(vocabulary, np.uint64, True)
            words_n = np.bincount(c.tokens[c.learned], minlength=wide).astype(np.int32)
            pair_n = np.bincount(c.pair_of[c.learned], minlength=len(c.pairs)).astype(np.int32)
            cut = np.r_[0, np.searchsorted(vocabulary, edges), wide]
            pair_cut = np.searchsorted(c.pair_word, cut)
            out = []
            for s in range(shards):
                a, b, p, q = cut[s], cut[s + 1], pair_cut[s], pair_cut[s + 1]
                if a < b:
                    used, place = np.unique(c.pair_context[p:q], return_inverse=True)
                    out.append(
                        {
                            "shard": s,
                            "chunk": chunk,
                            "keys": _packed(vocabulary[a:b], steps=True),
                            "n": _packed(words_n[a:b]),
                            "contexts": _packed(vocabulary[used], steps=True),
                            "codes": _packed((c.pair_word[p:q] - a) * len(used) + place, steps=True),
                            "pair_n": _packed(pair_n[p:q]),
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        read = lambda name, kind, steps=False: [_unpacked(x, kind, steps) for x in frame[name]]
        keys, places = read("keys", np.uint64, True), read("contexts", np.uint64, True)
        sizes = np.cumsum([len(k) for k in keys])[:-1]
        contexts, own = np.unique(np.concatenate(places), return_inverse=True)
        own = np.split(own, np.cumsum([len(x) for x in places])[:-1])
        wide = len(contexts)
        merged, at = np.unique(np.concatenate(keys), return_inverse=True)
        at = at.astype(np.int32)
        total = lambda name: np.bincount(at, np.concatenate(read(name, np.int32)), len(merged)).astype(np.int64)
        word_n = total("n")
        spots = np.split(at, sizes)
        local = [np.divmod(code, len(o)) for code, o in zip(read("codes", np.int64, True), own, strict=True)]
        code = np.concatenate([spot[w].astype(np.int64) * wide + o[c] for spot, o, (w, c) in zip(spots, own, local, strict=True)])
        pairs, pair_at = np.unique(code, return_inverse=True)
        pair_n = np.bincount(pair_at, np.concatenate(read("pair_n", np.int32)), len(pairs)).astype(np.int64)
        pair_spots = np.split(pair_at.astype(np.int32), np.cumsum([len(w) for w, _ in local])[:-1])
        word, context = pairs // wide, pairs % wide
        real = pair_n > 0
        root = np.bincount(word[real], minlength=len(merged))
        return pd.DataFrame(
            {
                "shard": [int(frame["shard"].iloc[0])],
                "words": [len(merged)],
                "wide": [wide],
                "word_n": [_packed(word_n)],
                "codes": [_packed(pairs, steps=True)],
                "pair_n": [_packed(pair_n)],
                "chunks": [frame["chunk"].tolist()],
                "word_at": [[_packed(s, steps=True) for s in spots]],
                "pair_at": [[_packed(s, steps=True) for s in pair_spots]],
                "contexts": [_packed(contexts, steps=True)],
                "customers": [_packed(np.bincount(context, pair_n, wide).astype(np.int64))],
                "dishes": [_packed(np.bincount(context[real], minlength=wide).astype(np.int64))],
                "known": [int((word_n > 0).sum())],
                "pairs": [int(real.sum())],
                "pair_one": [int((pair_n == 1).sum())],
                "pair_two": [int((pair_n == 2).sum())],
                "root_one": [int((root == 1).sum())],
                "root_two": [int((root == 2).sum())],
            }
        )

    used = chunks.select("chunk", "held", "lengths", "wide", "end", "vocabulary", "tokens")
    asked = used.mapInArrow(ask, "shard int, chunk long, keys binary, n binary, contexts binary, codes binary, pair_n binary")
    return asked.groupBy("shard").applyInPandas(join, _STATE)


def restaurants(held: DataFrame, shards: int) -> DataFrame:
    """(part, shard, places, customers, dishes): the shard's restaurants that are in the part, as
    places among the part's, and their corpus totals.

    ``part`` is a range of restaurants; a shard's rows by part are all its restaurants in order.
    """
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("contexts", pa.binary()), ("customers", pa.binary()), ("dishes", pa.binary())])
    edges = _edges(max(1, -(-shards // 4)))

    def deal(batches):
        for shard, contexts, customers, dishes in rows(batches):
            contexts, customers, dishes = _unpacked(contexts, np.uint64, True), _unpacked(customers, np.int64), _unpacked(dishes, np.int64)
            cut = np.r_[0, np.searchsorted(contexts, edges), len(contexts)]
            yield pa.RecordBatch.from_pylist(
                [
                    {"part": i, "shard": shard, "contexts": _packed(contexts[a:b], steps=True), "customers": _packed(customers[a:b]), "dishes": _packed(dishes[a:b])}
                    for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))
                    if a < b
                ],
                schema=schema,
            )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        contexts = [_unpacked(x, np.uint64, True) for x in frame["contexts"]]
        merged, at = np.unique(np.concatenate(contexts), return_inverse=True)
        spots = np.split(at.astype(np.int32), np.cumsum([len(c) for c in contexts])[:-1])
        out = {"part": frame["part"], "shard": frame["shard"], "places": [_packed(s, steps=True) for s in spots]}
        for name in ("customers", "dishes"):
            total = np.bincount(at, np.concatenate([_unpacked(x, np.int64) for x in frame[name]]), len(merged)).astype(np.int64)
            out[name] = [_packed(total[s]) for s in spots]
        return pd.DataFrame(out)

    dealt = held.select("shard", "contexts", "customers", "dishes").mapInArrow(deal, "part int, shard int, contexts binary, customers binary, dishes binary")
    return dealt.groupBy("part").applyInPandas(add, "part int, shard int, places binary, customers binary, dishes binary")


def totals(held: DataFrame, tokens: int) -> Totals:
    """Sums over the shards."""
    sums = held.agg(*(F.sum(c).alias(c) for c in ("known", "pairs", "pair_one", "pair_two", "root_one", "root_two"))).first()
    rate = lambda one, two: float(np.clip((one or 0) / max(1, (one or 0) + 2 * (two or 0)), 0.1, 0.95))
    return Totals(
        tokens,
        int(sums["known"] or 0),
        int(sums["pairs"] or 0),
        rate(sums["pair_one"], sums["pair_two"]),
        rate(sums["root_one"], sums["root_two"]),
    )


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, pick: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers sat down one by one.

    With i seated at t tables, the next one opens a table with odds opening : i - discount * t.
    From the 64th on, customers are taken in blocks of a quarter of those seated, with the odds
    of the block's middle.
    """
    tables = (customers > 0).astype(float)
    order = np.argsort(-customers, kind="stable")
    sizes = customers[order]
    upto = lambda n: int(np.searchsorted(-sizes, -n, side="right"))  # noqa: E731  how many have n or more
    seated = 1
    most = int(sizes[0]) if len(sizes) else 0
    while seated < min(64, most):
        who = order[: upto(seated + 1)]
        chance = opening[who] / (opening[who] + seated - discount * tables[who])
        tables[who] += pick.random(len(who)) < chance
        seated += 1
    while seated < most:
        who = order[: upto(seated + 1)]
        block = np.minimum(max(1, seated // 4), customers[who] - seated)
        middle = seated + block / 2
        chance = opening[who] / (opening[who] + middle - discount * tables[who])
        tables[who] += pick.binomial(block, np.clip(chance, 0, 1))
        seated += max(1, seated // 4)
    return np.minimum(tables, customers)


# Up to so many customers, all numbers of tables are weighed; LEVEL * LEVEL numbers are held.
LEVEL = 256
_log_gamma = np.vectorize(math.lgamma, otypes=[float])


def _rising(x, n):
    """Logarithm of x (x + 1) ... (x + n - 1)."""
    return _log_gamma(x + n) - _log_gamma(x)


@lru_cache(maxsize=4)
def _arrangements(discount: float) -> np.ndarray:
    """[n, t]: log weight of all ways to seat n customers at t tables, a table of m counting
    (1 - discount) (2 - discount) ... (m - 1 - discount)."""
    out = np.full((LEVEL + 1, LEVEL + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, LEVEL + 1)
    for n in range(1, LEVEL):
        held = np.log(np.maximum(n - discount * t, 1e-300))
        out[n + 1, 1:] = np.logaddexp(out[n, :-1], np.where(t <= n, out[n, 1:] + held, -np.inf))
    return out


class Parent:
    """What each dish's new tables weigh in the parent: ``later + k`` of ``total + k`` for table k,
    ``first`` of ``total`` for the first. Without growth every table weighs as the first."""

    def __init__(self, first, later, total, grows: bool = True):
        self.first, self.later, self.total, self.grows = first, later, total, grows

    def of(self, who) -> Parent:
        return Parent(self.first[who], self.later[who], self.total[who], self.grows)

    def at(self, k):
        """Weight of table k, from 1 on."""
        return (self.later + k) / (self.total + k) if self.grows else self.first / self.total

    def product(self, t):
        """Log weight of the tables after the first, up to t of them."""
        if not self.grows:
            return (t - 1) * np.log(self.first / self.total)
        return _rising(self.later + 1, t - 1) - _rising(self.total + 1, t - 1)


def _constant(weight, n: int) -> Parent:
    return Parent(np.full(n, float(weight)), np.full(n, float(weight)), np.ones(n), grows=False)


def _weighed(n, base, discount: float, parent: Parent, pick: np.random.Generator) -> np.ndarray:
    """Tables of dishes with up to LEVEL customers: a draw among all numbers of them."""
    ways, tables = _arrangements(discount), np.minimum(n, 1)
    order = np.argsort(n, kind="stable")
    sizes, starts = np.unique(n[order], return_index=True)
    for size, begin, end in zip(sizes, starts, [*starts[1:], len(n)], strict=True):
        if size < 2:
            continue
        k = np.arange(1, size)
        step = max(1, (1 << 20) // int(size))
        for at in range(begin, end, step):
            who = order[at : min(at + step, end)]
            own = parent.of(who[:, None])
            # the first table's weight is in all numbers of tables
            weights = np.zeros((len(who), size))
            np.cumsum(np.log((base[who, None] + discount * k) * own.at(k)), axis=1, out=weights[:, 1:])
            weights += ways[size, 1 : size + 1]
            weights = np.cumsum(np.exp(weights - weights.max(axis=1, keepdims=True)), axis=1)
            tables[who] = 1 + (weights < pick.random((len(who), 1)) * weights[:, -1:]).sum(axis=1)
    return tables


def _unconditioned(n, strength, discount: float, pick: np.random.Generator) -> np.ndarray:
    """Tables of n customers in a restaurant of its own with this strength.

    LEVEL customers are seated; of those who follow, a beta share opens tables, and these sit
    down like the guests of a further restaurant whose strength counts the tables so far.
    """
    tables, left, strength = np.zeros(len(n), np.int64), n.copy(), strength.astype(float)
    who = np.arange(len(n))
    while len(who):
        now = np.minimum(left[who], LEVEL)
        opened = _weighed(now, strength[who], discount, _constant(1, len(who)), pick)
        tables[who] += opened
        strength[who] += discount * opened
        left[who] = pick.binomial(left[who] - now, pick.beta(strength[who], now - discount * opened))
        who = who[left[who] > 0]
    return tables


def _expected(n, strength, discount: float):
    """Mean number of tables in such a restaurant."""
    grown = _rising(strength + discount, n) - _rising(strength + 1, n - 1)
    return np.exp(grown) / discount - strength / discount


def _proposed(n, old, base, discount: float, parent: Parent, pick: np.random.Generator) -> np.ndarray:
    """Tables of dishes with many customers: a Metropolis-Hastings step.

    The proposal is a restaurant of the dish alone, whose strength opens tables at the rate of
    the true weights where these have their mean; ways to sit are the same in both, so that they
    cancel. It depends on the other dishes only, not on the tables that the dish has.
    """

    def strength(t):
        return np.maximum((base + discount * t) * parent.at(t) - discount * t, -0.999 * discount)

    low, high = np.ones(len(n)), n.astype(float)
    for _ in range(40):
        middle = np.sqrt(low * high)
        more = _expected(n, strength(middle), discount) > middle
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    own = strength(np.sqrt(low * high))
    new = _unconditioned(n, own, discount, pick)
    weight = lambda t: _rising(base / discount + 1, t - 1) - _rising(own / discount + 1, t - 1) + parent.product(t)
    return np.where(np.log(pick.random(len(n))) < weight(new) - weight(old), new, old)


def reseated(n, old, base, discount: float, parent: Parent, pick: np.random.Generator) -> np.ndarray:
    """Tables of each dish, drawn given all tables but its own.

    ``n`` customers sat at ``old`` tables; table k opens with odds (base + discount k) times its
    weight in the parent, against the size of a table less the discount.
    """
    tables = np.minimum(n, 1)
    few, many = np.flatnonzero((n > 1) & (n <= LEVEL)), np.flatnonzero(n > LEVEL)
    if len(few):
        tables[few] = _weighed(n[few], base[few], discount, parent.of(few), pick)
    if len(many):
        tables[many] = _proposed(n[many], np.minimum(old[many], n[many]), base[many], discount, parent.of(many), pick)
    return tables


@dataclass
class Seats:
    """Tables of a shard's pairs, and in the parent of its words."""

    tables: np.ndarray
    root: np.ndarray


@dataclass
class Whole:
    """Corpus totals of one state: tables of the shard's restaurants, customers and tables of the parent."""

    tables: np.ndarray
    root_customers: float
    root_tables: float


class Shard:
    """A shard's pairs: counts by word and by restaurant, starting seats, sweeps, predictions."""

    def __init__(self, words: int, pair_word, pair_context, pair_n, wide: int, t: Totals, settings: Settings, shard: int):
        self.words, self.wide, self.t, self.settings, self.shard = words, wide, t, settings, shard
        self.word, self.context, self.n = pair_word, pair_context, np.asarray(pair_n, np.int64)
        self.live = np.flatnonzero(self.n > 1)
        self.new_dish = 1.0 / (t.known + 1)

    def pick(self, turn: int) -> np.random.Generator:
        return np.random.default_rng([self.settings.seed, self.shard, turn])

    def in_context(self, tables) -> np.ndarray:
        return np.bincount(self.context, tables, self.wide).astype(np.int64)

    def in_root(self, tables) -> np.ndarray:
        return np.bincount(self.word, tables, self.words).astype(np.int64)

    def expanded(self, tables) -> np.ndarray:
        """Tables of all pairs from those of pairs with several customers."""
        out = np.minimum(self.n, 1)
        out[self.live] = tables
        return out

    def unknown(self, rooms: float) -> float:
        return (self.settings.strength + self.t.root_discount * rooms) * self.new_dish

    def base(self, seats: Seats, whole: Whole) -> np.ndarray:
        """Probability of each word in the parent."""
        d = self.t.root_discount
        return (self.in_root(seats.tables) - d * seats.root + self.unknown(whole.root_tables)) / (self.settings.strength + whole.root_customers)

    def start(self, dishes) -> Seats:
        """Customers sit down one by one, where every dish has a table."""
        t, pick = self.t, self.pick(0)
        seats = Seats(np.minimum(self.n, 1), np.zeros(self.words, np.int64))
        guests = self.in_root(seats.tables)
        seats.root = seat(guests, np.full(self.words, self.unknown(t.known)), t.root_discount, pick).astype(np.int64)
        p = self.base(seats, Whole(dishes, t.pairs, t.known))
        who = self.live
        opening = (self.settings.strength + t.discount * dishes[self.context[who]]) * p[self.word[who]]
        seats.tables = self.expanded(seat(self.n[who], opening, t.discount, pick).astype(np.int64))
        guests = self.in_root(seats.tables)
        seats.root = seat(guests, np.full(self.words, self.unknown(t.known)), t.root_discount, pick).astype(np.int64)
        return seats

    def sweep(self, seats: Seats, whole: Whole, turn: int) -> Seats:
        """Every dish's tables given all others, then those of the words in the parent."""
        t, settings, pick, who = self.t, self.settings, self.pick(turn), self.live
        word, own = self.word[who], seats.tables[who]
        base = settings.strength + t.discount * (whole.tables[self.context[who]] - own)
        # without the dish's customers in the parent; a word that has others there keeps its tables
        others = self.in_root(seats.tables)[word] - own
        rooms = np.minimum(seats.root[word], others)
        back = self.unknown(whole.root_tables)
        parent = Parent(
            others - t.root_discount * rooms + back,
            others - t.root_discount * np.maximum(rooms, 1) + back,
            settings.strength + whole.root_customers - own,
        )
        tables = self.expanded(reseated(self.n[who], own, base, t.discount, parent, pick))
        guests = self.in_root(tables)
        base = settings.strength + t.root_discount * np.maximum(whole.root_tables - seats.root, 0.0)
        root = reseated(guests, np.maximum(seats.root, 1), base, t.root_discount, _constant(self.new_dish, self.words), pick)
        return Seats(tables, root)

    def predicted(self, seats: Seats, whole: Whole, customers) -> np.ndarray:
        """Probability of each pair's word after its context, all of one state."""
        d, strength = self.t.discount, self.settings.strength
        back = (strength + d * whole.tables[self.context]) * self.base(seats, whole)[self.word]
        return (self.n - d * seats.tables + back) / (strength + customers[self.context])


def probabilities(word_n, pair_word, pair_context, pair_n, customers, dishes, t: Totals, settings: Settings, shard: int):
    """Average predictive probabilities of a shard's pairs, all sweeps in one place.

    ``customers`` and ``dishes`` are the corpus totals of the shard's restaurants. A shard that has
    all dishes knows all tables; else those of others are taken to grow as its own do.
    """
    own = Shard(len(word_n), pair_word, pair_context, pair_n, len(dishes), t, settings, shard)
    first = own.in_context(np.minimum(own.n, 1))
    guests = max(1, int(first.sum()))

    def whole(seats: Seats) -> Whole:
        now, root = own.in_context(seats.tables), own.in_root(seats.tables)
        return Whole(
            now + (dishes - first) * (now + 1) / (first + 1),
            max(1.0, t.pairs * root.sum() / guests),
            t.known * seats.root.sum() / max(1, (root > 0).sum()),
        )

    seats = own.start(dishes)
    made = np.zeros(len(pair_n))
    for turn in range(settings.burn_in + settings.kept):
        seats = own.sweep(seats, whole(seats), turn + 1)
        if turn >= settings.burn_in:
            made += own.predicted(seats, whole(seats), customers)
    return made / settings.kept


@dataclass(frozen=True)
class Round:
    """One state of the sampler: (shard, part, tables) of the corpus, what shards keep, the parent's totals."""

    sums: DataFrame
    seats: DataFrame
    root_customers: int
    root_tables: int


def _messages(turn: int, sums: DataFrame, column: str, seats: DataFrame | None = None) -> DataFrame:
    """Corpus totals by part, and a shard's own seats, as rows that go to the shard."""
    none = F.lit(None).cast("binary")
    out = sums.select("shard", F.lit(turn).alias("turn"), "part", F.col(column).alias("sums"), none.alias("tables"), none.alias("root"))
    if seats is None:
        return out
    return out.unionByName(seats.select("shard", F.lit(turn).alias("turn"), "part", none.alias("sums"), "tables", "root"))


def _sums(messages: pd.DataFrame, turn: int) -> list[np.ndarray]:
    mine = messages[(messages["turn"] == turn) & (messages["part"] >= 0)].sort_values("part")
    return [_unpacked(x, np.int64) for x in mine["sums"]]


def _seats(messages: pd.DataFrame, turn: int, own: Shard) -> Seats:
    row = messages[(messages["turn"] == turn) & (messages["part"] < 0)].iloc[0]
    return Seats(own.expanded(_unpacked(row["tables"], np.int64)), _unpacked(row["root"], np.int64))


def _shard(row, t: Totals, settings: Settings) -> Shard:
    word, context = np.divmod(_unpacked(row["codes"], np.int64, True), row["wide"])
    return Shard(int(row["words"]), word, context, _unpacked(row["pair_n"], np.int64), int(row["wide"]), t, settings, int(row["shard"]))


def sampled(held: DataFrame, places: DataFrame, t: Totals, settings: Settings) -> list[Round]:
    """The states of all sweeps, with the corpus totals that belong to each; the first is the start."""
    made: list[Round] = []
    for turn in range(settings.burn_in + settings.kept + 1):
        made.append(_turn(held, places, made[-1] if made else None, turn, t, settings))
    return made


def _turn(held: DataFrame, places: DataFrame, last: Round | None, turn: int, t: Totals, settings: Settings) -> Round:
    """Start, or one sweep from the last state; then tables are added up over the shards."""
    customers, rooms = (last.root_customers, last.root_tables) if last else (t.pairs, t.known)

    def run(own: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
        shard = _shard(own.iloc[0], t, settings)
        parts = _sums(messages, turn - 1)
        tables = np.concatenate(parts)
        if turn:
            seats = shard.sweep(_seats(messages, turn - 1, shard), Whole(tables, customers, rooms), turn)
        else:
            seats = shard.start(tables)
        # the parts know of one table of every dish
        more = np.split(shard.in_context(np.maximum(seats.tables - 1, 0)), np.cumsum([len(p) for p in parts])[:-1])
        numbers = sorted(messages.loc[messages["part"] >= 0, "part"])
        n = len(more)
        return pd.DataFrame(
            {
                "shard": shard.shard,
                "part": [*numbers, -1],
                "more": [*(_packed(m) for m in more), None],
                "tables": [None] * n + [_packed(seats.tables[shard.live])],
                "root": [None] * n + [_packed(seats.root)],
                "root_customers": [0] * n + [int(seats.tables.sum())],
                "root_tables": [0] * n + [int(seats.root.sum())],
            }
        )

    def add(own: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        places = dict(zip(own["shard"], (_unpacked(x, np.int32, True) for x in own["places"]), strict=True))
        total = np.zeros(1 + max(int(p[-1]) for p in places.values()), np.int64)
        for shard, dishes in zip(own["shard"], own["dishes"], strict=True):
            total[places[shard]] = _unpacked(dishes, np.int64)
        for shard, more in zip(sent["shard"], sent["more"], strict=True):
            total[places[shard]] += _unpacked(more, np.int64)
        return pd.DataFrame({"shard": list(places), "part": int(own["part"].iloc[0]), "sums": [_packed(total[p]) for p in places.values()]})

    messages = _messages(turn - 1, last.sums, "sums", last.seats) if last else _messages(turn - 1, places, "dishes")
    used = held.select("shard", "words", "wide", "codes", "pair_n")
    schema = "shard int, part int, more binary, tables binary, root binary, root_customers long, root_tables long"
    made = written(used.groupBy("shard").cogroup(messages.groupBy("shard")).applyInPandas(run, schema))
    sent = made.filter("part >= 0").select("part", "shard", "more")
    known = places.select("part", "shard", "places", "dishes")
    sums = written(known.groupBy("part").cogroup(sent.groupBy("part")).applyInPandas(add, "shard int, part int, sums binary"))
    seats = made.filter("part < 0")
    customers_now, rooms_now = seats.agg(F.sum("root_customers"), F.sum("root_tables")).first()
    return Round(sums, seats.select("shard", "part", "tables", "root"), int(customers_now), int(rooms_now))


_REPLY = "chunk long, shard int, n binary, pair binary"


def replies(held: DataFrame, places: DataFrame, rounds: list[Round], t: Totals, settings: Settings) -> DataFrame:
    """Counts and log probabilities for each chunk, from the states of the sweeps kept."""
    kept = range(settings.burn_in + 1, len(rounds))
    parents = {turn: (rounds[turn].root_customers, rounds[turn].root_tables) for turn in kept}

    def run(own: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
        row, shard = own.iloc[0], _shard(own.iloc[0], t, settings)
        n, customers = _unpacked(row["word_n"], np.int64), np.concatenate(_sums(messages, -1))
        if parents:
            pair = np.zeros(len(shard.n))
            for turn, parent in parents.items():
                pair += shard.predicted(_seats(messages, turn, shard), Whole(np.concatenate(_sums(messages, turn)), *parent), customers)
            pair /= len(parents)
        else:
            pair = probabilities(n, shard.word, shard.context, shard.n, customers, np.concatenate(_sums(messages, 0)), t, settings, shard.shard)
        pair = np.log10(pair).astype(np.float32)
        spots = lambda name: [_unpacked(x, np.int32, True) for x in row[name]]
        return pd.DataFrame(
            {
                "chunk": np.asarray(row["chunks"], np.int64),
                "shard": shard.shard,
                "n": [_packed(n[a]) for a in spots("word_at")],
                "pair": [_packed(pair[b]) for b in spots("pair_at")],
            }
        )

    parts = [_messages(-1, places, "customers")]
    parts += [_messages(turn, rounds[turn].sums, "sums", rounds[turn].seats) for turn in kept] if rounds else [_messages(0, places, "dishes")]
    messages = reduce(DataFrame.unionByName, parts)
    used = held.select("shard", "words", "wide", "word_n", "codes", "pair_n", "chunks", "word_at", "pair_at")
    return used.groupBy("shard").cogroup(messages.groupBy("shard")).applyInPandas(run, _REPLY)


def scored(chunks: DataFrame, answers: DataFrame, t: Totals) -> DataFrame:
    tokens, known = t.tokens, t.known

    def run(coded_part: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        answer = answer.sort_values("shard")
        n, pair = (np.concatenate([_unpacked(x, k) for x in answer[c]]) for c, k in (("n", np.int64), ("pair", np.float32)))
        row = coded_part.iloc[0]
        c = Chunk(row["held"], row["lengths"], row["wide"], row["end"], row["tokens"])
        value = pair[c.pair_of].astype(float)
        seen = n[c.tokens]
        base = np.log10((seen + 1) / (tokens + known + 1))
        return pd.DataFrame(
            {
                "doc_id": pd.array(row["docs"], "Int64"),
                "held_out": c.held,
                "n_tokens": c.lengths,
                "n_known": np.add.reduceat((seen > 0).astype(np.int64), c.starts),
                "train_tokens": np.full(len(c.lengths), tokens, np.int64),
                "base_score": np.add.reduceat(base, c.starts),
                "score": np.add.reduceat(value, c.starts),
                "perplexity": 10 ** (-np.add.reduceat(value, c.starts) / c.lengths),
            }
        )

    return (
        chunks.drop("learned", "vocabulary")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInPandas(
            run,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double",
        )
    )


def language_model(documents: DataFrame, folds: int = 7, held_out: int = 2, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, perplexity.

    Learns from rows whose checksum modulo ``folds`` is not ``held_out``. A null or empty text is
    its end alone. Rows that repeat count and are scored each; with nothing to learn from, all
    probabilities are those of the unknown word. Further columns are ignored; an empty table
    gives no rows.
    """
    chunks = bucketed(coded(documents, fold("doc_id", folds) != held_out, settings), "chunk")
    tokens = int(chunks.agg(F.sum("learned")).first()[0] or 0)
    shards = max(1, -(-tokens // settings.shard_tokens))
    held = bucketed(state(chunks, shards), "shard")
    t = totals(held, tokens)
    places = bucketed(restaurants(held, shards), "part")
    # one shard has all tables of its restaurants
    rounds = sampled(held, places, t, settings) if shards > 1 else []
    return scored(chunks, replies(held, places, rounds, t, settings), t)
