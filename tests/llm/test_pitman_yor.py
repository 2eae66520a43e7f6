"""Predictive probabilities of a context are a distribution over the words and the unknown one."""

import numpy as np

from kymo.llm import pitman_yor


def corpus(pick, words, contexts):
    """Counts of every pair; the last word does not occur, the last context neither."""
    counts = pick.poisson(0.6, (contexts, words)) * pick.integers(1, 200, (contexts, 1))
    counts[0, : words - 1] += 1
    counts[:, -1] = 0
    counts[-1] = 0
    context, word = (x.ravel().astype(np.int32) for x in np.indices(counts.shape))
    return counts, word, context, counts.ravel().astype(np.int64)


def sums(counts, word, context, n, shards, settings):
    """Per context, probabilities summed over all words, as the shards give them."""
    words, seen = counts.shape[1], (counts > 0)
    t = pitman_yor.Totals(int(counts.sum()), words - 1, int(seen.sum()), 0.6, 0.7)
    whole = np.zeros(counts.shape[0])
    for shard in range(shards):
        mine = word % shards == shard
        own, local = np.unique(word[mine], return_inverse=True)
        p = pitman_yor.probabilities(
            counts.sum(axis=0)[own], local, context[mine], n[mine], counts.sum(axis=1), seen.sum(axis=1), t, settings, shard
        )
        assert (p > 0).all()
        whole += np.bincount(context[mine], p, counts.shape[0])
    return whole


def test_a_context_sums_to_one():
    pick = np.random.default_rng(5)
    for words, contexts in ((2, 2), (40, 12), (300, 60)):
        made = corpus(pick, words, contexts)
        for settings in (pitman_yor.Settings(), pitman_yor.Settings(strength=20.0, burn_in=0, kept=1)):
            assert np.abs(sums(*made, 1, settings) - 1).max() < 1e-9


def test_shards_estimate_the_totals_of_others():
    made = corpus(np.random.default_rng(6), 400, 30)
    whole = sums(*made, 4, pitman_yor.Settings())
    assert np.abs(whole - 1).max() < 0.005


def test_sent_numbers_come_back():
    pick = np.random.default_rng(7)
    for kind in (np.int32, np.int64, np.uint64, np.float32):
        for n in (0, 1, 1000):
            x = pick.integers(0, 1 << 30, n).astype(kind)
            assert (pitman_yor._unpacked(pitman_yor._packed(x), kind) == x).all()
            x = np.sort(x)
            if kind is not np.float32:
                assert (pitman_yor._unpacked(pitman_yor._packed(x, steps=True), kind, True) == x).all()


def one_by_one(n, base, discount, parent, sweeps, pick):
    """Tables after every removal of one customer who sits down again, for one dish."""
    sizes, seen = [n], []
    for _ in range(sweeps):
        at = pick.choice(len(sizes), p=np.array(sizes) / n)
        sizes[at] -= 1
        sizes = [s for s in sizes if s]
        t = len(sizes)
        odds = np.array([s - discount for s in sizes] + [(base + discount * t) * parent(t)])
        at = pick.choice(t + 1, p=odds / odds.sum())
        sizes = [*sizes, 1] if at == t else sizes[:at] + [sizes[at] + 1] + sizes[at + 1 :]
        seen.append(len(sizes))
    return np.array(seen[len(seen) // 10 :])


def grown(first, later, total, n):
    return pitman_yor.Parent(np.full(n, first), np.full(n, later), np.full(n, total))


def test_tables_follow_the_sampler_that_moves_one_customer():
    pick = np.random.default_rng(11)
    many = 20_000
    for n, base, discount, first, later, total in ((2, 3.0, 0.5, 4.0, 4.0, 50.0), (12, 40.0, 0.7, 0.2, -0.4, 30.0), (30, 5.0, 0.4, 9.0, 9.0, 20.0)):
        weight = lambda t, f=first, l=later, w=total: (l + t) / (w + t) if t else f / w
        slow = one_by_one(n, base, discount, weight, 60_000, pick)
        fast = pitman_yor.reseated(np.full(many, n), np.full(many, 1), np.full(many, base), discount, grown(first, later, total, many), pick)
        for t in range(1, n + 1):
            assert abs((slow == t).mean() - (fast == t).mean()) < 0.025


def test_many_customers_are_drawn_from_the_same_distribution():
    pick = np.random.default_rng(12)
    many, n = 4000, 200
    for base, discount, first, later, total in ((800.0, 0.6, 3.0, 3.0, 400.0), (300.0, 0.5, 0.3, -0.2, 90.0), (9.0, 0.8, 50.0, 50.0, 60.0)):
        parent, bases = grown(first, later, total, many), np.full(many, base)
        exact = pitman_yor._weighed(np.full(many, n), bases, discount, parent, pick)
        tables, moved = np.full(many, n), 0.0
        for _ in range(30):
            new = pitman_yor._proposed(np.full(many, n), tables, bases, discount, parent, pick)
            moved, tables = (new != tables).mean(), new
        spread = 5 * exact.std() / many**0.5 + 1e-9
        assert abs(exact.mean() - tables.mean()) < 2 * spread and moved > 0.3
        both = np.bincount(exact, minlength=n + 1) - np.bincount(tables, minlength=n + 1)
        assert np.abs(both).max() < 0.03 * many and np.abs(np.cumsum(both)).max() < 0.05 * many


def test_tables_of_a_restaurant_of_its_own():
    pick = np.random.default_rng(13)
    n, many = 3000, 3000
    for strength, discount in ((5.0, 0.5), (-0.2, 0.6)):
        got = pitman_yor._unconditioned(np.full(many, n), np.full(many, strength), discount, pick)
        want = pitman_yor._expected(np.full(1, float(n)), np.full(1, strength), discount)[0]
        assert abs(got.mean() - want) < 5 * got.std() / many**0.5


def test_all_shards_see_one_state(spark):
    """After every sweep, restaurants' and the parent's totals are those of all shards' tables."""
    pick = np.random.default_rng(14)
    texts = [" ".join(f"w{int(x)}" for x in pick.zipf(1.4, 300) % 80) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    settings = pitman_yor.Settings(shard_tokens=4000, chunk_docs=20)
    chunks = pitman_yor.bucketed(pitman_yor.coded(docs, pitman_yor.fold("doc_id", 7) != 2, settings), "chunk")
    held = pitman_yor.bucketed(pitman_yor.state(chunks, 4), "shard")
    t = pitman_yor.totals(held, chunks.agg({"learned": "sum"}).first()[0])
    places = pitman_yor.bucketed(pitman_yor.restaurants(held, 4), "part")
    rounds = pitman_yor.sampled(held, places, t, settings)
    rows = held.toPandas()
    names = [pitman_yor._unpacked(x, np.uint64, True) for x in rows["contexts"]]
    assert len(rows) == 4 and len(rounds) == 4
    changed = 0
    for state in rounds:
        seats, sums = state.seats.toPandas().set_index("shard"), state.sums.toPandas()
        whole, told, root, rooms, chance = {}, {}, 0, 0, 0.0
        for (_, row), contexts in zip(rows.iterrows(), names, strict=True):
            own = pitman_yor._shard(row, t, settings)
            mine = seats.loc[[own.shard]].reset_index()
            mine["turn"] = 0
            got = pitman_yor._seats(mine, 0, own)
            assert (got.tables <= np.maximum(own.n, 0)).all() and ((got.tables > 0) == (own.n > 0)).all()
            changed += int((got.tables > 1).sum())
            parts = sums[sums["shard"] == own.shard].sort_values("part")["sums"]
            totals = np.concatenate([pitman_yor._unpacked(x, np.int64) for x in parts])
            for context, here, corpus in zip(contexts, own.in_context(got.tables), totals, strict=True):
                whole[context] = whole.get(context, 0) + here
                assert told.setdefault(context, corpus) == corpus
            base = own.base(got, pitman_yor.Whole(totals, state.root_customers, state.root_tables))
            chance += base[pitman_yor._unpacked(row["word_n"], np.int64) > 0].sum()
            unknown = own.unknown(state.root_tables) / (settings.strength + state.root_customers)
            root, rooms = root + int(got.tables.sum()), rooms + int(got.root.sum())
        assert told == whole and (root, rooms) == (state.root_customers, state.root_tables)
        # the parent's words and the unknown one
        assert abs(chance + unknown - 1) < 1e-9
    assert changed > 0


def test_one_shard_samples_alike_with_and_without_exchange(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i * j % 23}" for j in range(400))) for i in range(40)], "doc_id long, text string")
    settings = pitman_yor.Settings()
    chunks = pitman_yor.bucketed(pitman_yor.coded(docs, pitman_yor.fold("doc_id", 7) != 2, settings), "chunk")
    held = pitman_yor.bucketed(pitman_yor.state(chunks, 1), "shard")
    t = pitman_yor.totals(held, chunks.agg({"learned": "sum"}).first()[0])
    places = pitman_yor.bucketed(pitman_yor.restaurants(held, 1), "part")
    value = lambda rounds: {
        r.chunk: pitman_yor._unpacked(r.pair, np.float32) for r in pitman_yor.replies(held, places, rounds, t, settings).collect()
    }
    here, there = value([]), value(pitman_yor.sampled(held, places, t, settings))
    assert here.keys() == there.keys() and all(np.allclose(here[c], there[c], atol=1e-6) for c in here)
