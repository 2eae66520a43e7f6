"""Small fixtures against brute force: nulls, empty and long texts, ties, repeats, empty tables."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kymo.llm import divergence, hamming, language, minmax_dedup, mixing, packing, page_text, pitman_yor, sanitise, toxicity
from kymo.llm.common import rows, table
from kymo.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, a int"
LONG = "the quick brown fox jumps over it and then " * 3000


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, repeated rows, clashing column names."""
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    table(spark, "/root/testdata/sf0.001", "documents")  # ships the package
    text = "one two three four five six seven eight nine ten " * 8
    rows = [
        (1, text, "en", "b", 1, "x", 1),
        (1, text, "en", "b", 1, "x", 1),
        (2, None, None, None, None, None, None),
        (3, "", "en", "a", 0, "x", 1),
        (4, " \t\n", "de", "a", 0, "x", 1),
        (None, "ein kurzer satz", "de", "a", 0, "x", 1),
        (5, LONG, "en", "b", 0, "x", 1),
        (6, text + "eleven", "en", None, 0, "x", 1),
        (7, "12 34", None, "c", 0, "x", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark, odd):
    return spark.createDataFrame([], SCHEMA)


def test_language(spark, odd, none, folder):
    found = {r.doc_id: r for r in language.language_id(odd).collect()}
    assert len(found) == 8 and found[2].lang_pred == "und" and found[2].score == 0
    assert found[4].lang_pred == "und" and found[7].lang_pred == "und"
    assert language.language_id(none).count() == 0
    docs = table(spark, folder, "documents")
    got = language.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95


@pytest.mark.parametrize("n", [2, 4, 6, 9])
def test_codewords_differ(n):
    code = language.codewords(n)
    gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert min(gaps) >= max(1, code.shape[1] // 4)


def test_packing(odd, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = packing.packed(odd, tokenizer_path()).toPandas()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    for (doc, start, n, crc) in got[["doc_id", "start", "length", "ids_crc32"]].dropna().itertuples(index=False):
        ids = [*tokenizer.encode(texts[doc], add_special_tokens=False).ids, 0]
        assert zlib.crc32(np.array(ids[int(start) : int(start + n)], "<u4").tobytes()) == crc
    for _, group in got.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group.length.sum() <= 2048
        assert (group.length.cumsum() - group.length == group.offset).all()
    assert packing.packed(none, tokenizer_path()).count() == 0


def test_packing_ids_are_those_of_whole_texts():
    """Random texts with special strings, capitals, combining marks and stops; a small cache."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pick = np.random.default_rng(9)
    bits = ["a", "Be", "\u00c9t\u00e9", "\u0131", "\u01c5", "\u017f", "\u0130", "\u0130.", "\u00e9,", "\u03a3", "\u03a3.", "\u00df.", "x.", "Y,", "z..", " ", " ", "\n", "\t", "\u00a0", "7.", "'s", "e\u0301.", "\u65e5.", "<|endoftext|>", "<|startoftext|>.", "<|ENDOFTEXT|>", "<|", "|>", "-", "\U0001f44d"]
    cache = packing._Cache(tokenizer)
    cache.limit = 50
    for _ in range(4000):
        text = "".join(pick.choice(bits, pick.integers(0, 25)))
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert np.frombuffer(packing.ids_of(text, cache), "<u4").tolist() == want, text


def _peak(work):
    """Bytes that ``work`` takes at most, and what stays of them."""
    tracemalloc.start()
    try:
        work()
        stays, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    return most, stays


def test_workers_keep_little_of_what_they_read():
    # every word is a new one
    texts = [" ".join(f"{i}x{j}" for j in range(2_000)) for i in range(300)]
    assert _peak(lambda: [minmax_dedup.shingles(text, 5).size for text in texts])[1] < 2 << 20

    class Plain:
        model = None

        def encode(self, part, add_special_tokens):
            return SimpleNamespace(ids=[1, 2])

    cache = packing._Cache(Plain())
    assert _peak(lambda: [len(packing.ids_of(text, cache)) for text in texts])[0] < 72 << 20
    assert len(cache) + len(cache.older) <= 2 * 131_072


def test_rows_of_a_batch_become_objects_bit_by_bit():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(10_000)), "text": ["x" * 2_000] * 10_000})
    assert [r[0] for r in rows([batch, batch.slice(0, 0), batch.slice(9_000)])] == [*range(10_000), *range(9_000, 10_000)]
    assert _peak(lambda: sum(len(r[1]) for r in rows([batch])))[0] < 4 << 20


def test_packing_of_empty_documents(spark, odd):
    docs = spark.range(4000).selectExpr("id as doc_id", "cast(null as string) as text")
    assert packing.packed(docs, tokenizer_path()).select("sequence_id").distinct().count() == 2


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_holds_every_capacity(rule):
    settings = packing.Settings(tokens=100, documents=3, cost=3000, rule=rule)
    lengths = np.sort(np.random.default_rng(1).integers(1, 51, 300))[::-1]
    bins, _ = packing.place(lengths, settings)
    for b in np.unique(bins):
        one = lengths[bins == b]
        assert one.sum() <= 100 and len(one) <= 3 and (one**2).sum() <= 3000


def test_language_model(spark, odd, none, folder):
    docs = table(spark, folder, "documents").unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    got = pitman_yor.language_model(docs).toPandas()
    rows = docs.collect()
    assert len(got) == len(rows)
    cut = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b" end"]
    held = lambda r: zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 7 == 2
    count = Counter(w for r in rows if not held(r) for w in cut(r.text))
    n, v = sum(count.values()), len(count)
    want = sorted(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in cut(r.text)) for r in rows)
    assert np.allclose(sorted(got.base_score), want) and set(got.train_tokens) == {n}
    unseen = got[got.held_out]
    assert unseen.score.sum() > unseen.base_score.sum()
    assert pitman_yor.language_model(none).count() == 0


def test_every_previous_word_has_a_restaurant(spark, odd):
    """A word pair in a corpus whose other words make up nearly all tokens."""
    filler = " ".join(f"w{i % 5}" for i in range(6000))
    rows = [(i, f"{filler} rare{i % 3} next{i % 3}") for i in range(60)]
    unseen = [i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 7 == 2][:12]
    rows += [(d, f"rare{i % 3} next{(i + i // 6) % 3}") for i, d in enumerate(unseen)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for shard_tokens in (1_000_000, 20_000):
        found = pitman_yor.language_model(docs, settings=pitman_yor.Settings(shard_tokens=shard_tokens)).collect()
        score = {r.doc_id: r.score for r in found}
        assert len(found) == 72
        # the last six hold pairs that do not occur
        assert min(score[d] for d in unseen[:6]) > max(score[d] for d in unseen[6:]) + 1


def test_seating_follows_the_one_by_one_process():
    pick = np.random.default_rng(3)
    fast = pitman_yor.seat(np.full(4000, 300), np.full(4000, 2.0), 0.5, pick).mean()
    slow = []
    for _ in range(1500):
        t = 1
        for i in range(1, 300):
            t += pick.random() < 2.0 / (2.0 + i - 0.5 * t)
        slow.append(t)
    assert abs(fast - np.mean(slow)) < 0.3


def test_mix(spark, odd, none, folder):
    docs = table(spark, folder, "documents").unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    got = mixing.mixed(docs).toPandas()
    again = mixing.mixed(docs.repartition(3)).toPandas()
    order = ["doc_id", "size"]
    assert (got.sort_values(order).taken.to_numpy() == again.sort_values(order).taken.to_numpy()).all()
    assert (got.taken <= 2 * got["size"]).all()
    sums = got.groupby(["target", "source_size"]).taken.sum().reset_index()
    assert (abs(sums.taken - sums.target) <= 40).all()
    assert abs(sums.target.sum() - 1.5 * got["size"].sum()) < 1
    mix = mixing.applied(docs)
    taken = mix.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    repeats = 80 * 2  # doc 1 is there twice
    assert abs(taken - got.taken.sum()) <= 2 * repeats
    assert mixing.mixed(none).count() == 0 and mixing.applied(none).count() == 0


def test_apportionment_is_highest_quotients(spark):
    shares = [7.0, 3.0, 3.0, 1.5, 0.4, 0.0]
    frame = spark.createDataFrame([(0, i, s, 23) for i, s in enumerate(shares)], "g int, k int, s double, seats int")
    got = {r.k: r.quota for r in mixing.apportion(frame, "g", "k", "s", "seats").collect()}
    want = Counter()
    for _ in range(23):
        want[max(range(6), key=lambda i: (shares[i] / (2 * want[i] + 1), -i))] += 1
    assert got == {i: want[i] for i in range(6)}


def test_quality(odd, none):
    got = {r.doc_id: r for r in divergence.quality(odd).collect()}
    assert got[2].n_words == 0 and got[2].base_failed and not got[2].kept
    assert got[5].n_words == len(LONG.split()) and got[5].n_repeat_words == got[5].n_words and not got[5].kept
    assert got[1].word_chars == sum(map(len, ("one two three four five six seven eight nine ten " * 8).split()))
    assert divergence.quality(none).count() == 0
    assert divergence.duplicate_lines("a\nb\na\n\n\na") == 2
    assert divergence.repeat_words(b"a b c x a b c y".split()) == 6
    assert divergence.distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1


PERSONAL = [
    (1, "Write to jo.do@mail.example.com or a@b.c..x@d.e now 10.0.0.255 and 10.0.0.256", None, None, 0, None, 1),
    (2, "card 4111 1111 1111 1111 phone +1 (702) 555-0742 1.2.3.4.5.6.7.8 4111-1111-1111-1112", None, None, 0, None, 1),
    (3, None, None, None, 0, None, 1),
    (4, "é ü " * 500 + "x@y.zz" + " 1" * 4000 + " a@" + "b." * 4000 + "c", None, None, 0, None, 1),
]


def _brute(text):
    spans = []
    for rank, (kind, pattern) in enumerate(
        (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
        )
    ):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"\D", "", m[0])
            luhn = sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(digits[::-1])) % 10 == 0
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(spans))


def test_personal_data(spark, odd, none):
    docs = spark.createDataFrame(PERSONAL, SCHEMA)
    for r in sanitise.personal_data(docs).collect():
        want = _brute(next(t for d, t, *_ in PERSONAL if d == r.doc_id))
        assert r.spans == want and r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    clean = {r.doc_id: r.text for r in sanitise.sanitised(docs).collect()}
    assert clean[1] == "Write to [EMAIL] or [EMAIL][EMAIL] now [IP] and 10.0.0.256" and clean[3] is None
    assert sanitise.personal_data(odd).count() == odd.count() and sanitise.personal_data(none).count() == 0


def _filler(seed, n=40):
    """Words of a document of its own."""
    pick = np.random.default_rng(seed)
    return " ".join("".join(pick.choice(list("bcdfgh"), 7)) for _ in range(n))


def _disclosing(texts, group):
    """Terms by kind: lower bound of the probability of a value, copies counted once."""
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    words = [{m.lower() for m in re.findall(r"[^\W_]{3,}", t)} for t in texts]
    kinds = {}
    for value in {v.lower() for t in texts for v in mail.findall(t)}:
        have = [value in (v.lower() for v in mail.findall(t)) for t in texts]
        for term in set().union(*(w for w, h in zip(words, have, strict=True) if h)):
            k = len({g for w, h, g in zip(words, have, group, strict=True) if h and term in w})
            n = k + sum(term in w and not h for w, h in zip(words, have, strict=True))
            z, share = 1.96, k / n
            low = (share + z * z / 2 / n - z * math.sqrt(share * (1 - share) / n + z * z / 4 / n / n)) / (1 + z * z / n)
            if k >= 4 and low >= 0.5:
                kinds[term] = max(kinds.get(term, ""), "removed" if low >= 0.9 else "generalised")
    return kinds, mail


def test_terms_that_disclose_a_value(spark, odd):
    """In copies and near copies, far from the value, and in texts without it, by brute force."""
    texts = [f"Colonel {_filler(i)} zx@corp.example.org of Quibble7 {_filler(100 + i)}" for i in range(8)]
    texts += [f"A clerk {_filler(200 + i)} u{i}@corp.example.org" for i in range(12)]
    # three near copies hold a value and words of their own: no evidence
    base = f"{_filler(300)} the orchard {_filler(301)} y@other.example.org"
    texts += [base, base + " one", base + " two", base]
    texts += [f"an orchard {_filler(400 + i)}" for i in range(20)] + ["no value but the COLONEL", "an \u00e9t\u00e9colonel is none"]
    # a term with its value in nearly all of many texts
    texts += [f"{_filler(500 + i)} major {_filler(600 + i)} m@army.example.org" for i in range(60)]
    group = [*range(20), 20, 20, 20, 20, *range(21, 21 + 82)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds, mail = _disclosing(texts, group)
    assert {"colonel": "generalised", "quibble7": "generalised", "major": "removed"}.items() <= kinds.items()
    assert "orchard" not in kinds and "clerk" not in kinds
    for r in sanitise.personal_data(docs).collect():
        text = texts[r.doc_id]
        held = [(m.start(), m.end()) for m in mail.finditer(text)]
        spans = [(a, f"email:{a}:{b}") for a, b in held]
        for m in re.finditer(r"[^\W_]{3,}", text):
            if m[0].lower() in kinds and not any(a < m.end() and m.start() < b for a, b in held):
                spans.append((m.start(), f"{kinds[m[0].lower()]}:{m.start()}:{m.end()}"))
        assert r.spans == ",".join(x for _, x in sorted(spans))
    clean = {r.doc_id: r.text for r in sanitise.sanitised(docs).collect()}
    assert all("orchard" in clean[i] for i in range(20, 44)) and all("olonel" not in t.replace("\u00e9t\u00e9colonel", "") for t in clean.values())


@pytest.mark.parametrize("few", [0, 1000])
def test_terms_alike_by_broadcast_and_by_shuffle(spark, odd, few):
    texts = [f"Colonel {_filler(i)} zx@corp.example.org" for i in range(6)] + [f"clerk {_filler(50 + i)}" for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sanitise.personal_data(docs, sanitise.Settings(broadcast_terms=few)).collect()
    assert sorted(r.n_terms for r in got) == [0] * 6 + [1] * 6


def test_nearest_codes(spark, odd):
    pick = np.random.default_rng(5)
    codes = [int(x) for x in pick.integers(-(2**63), 2**63 - 1, 400)] + [17] * 60
    frame = spark.createDataFrame([*enumerate(codes), (None, 3), (900, None)], "id long, code long")
    got = hamming.nearest(frame, frame.filter("id % 100 = 0"), hamming.Settings(k=5)).collect()
    for q in (0, 100, 200, 300, 400):
        order = sorted((bin((codes[q] ^ c) & (2**64 - 1)).count("1"), i) for i, c in enumerate(codes) if i != q)[:5]
        assert [(r.distance, r.neighbour_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == order
    assert hamming.nearest(frame.limit(0), frame.limit(0)).count() == 0


def test_near_duplicates(spark, odd, none, folder):
    docs = table(spark, folder, "documents")
    got = {r.doc_id: r for r in minmax_dedup.near_duplicates(docs).collect()}
    sets = {r.doc_id: set(minmax_dedup.shingles(r.text, 3).tolist()) for r in docs.collect()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {i: got[i].component_id for i in ids} == {i: find(i) for i in ids}
    assert all(got[i].n_shingles == len(sets[i]) for i in ids)
    few = minmax_dedup.near_duplicates(odd).collect()
    assert len(few) == 9 and all(r.kept for r in few if r.doc_id in (2, 3, 4))
    assert {r.component_id for r in few if r.doc_id in (1, 6)} == {1}
    assert minmax_dedup.near_duplicates(none).count() == 0


def test_chain_of_links_is_one_component(spark, odd):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    got = {r.id: r.component for r in minmax_dedup.components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[90] == 90


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use cookies. Accept them now please.</div>
<article><h1>Head &amp; line</h1><p>First <b>bold
 text.<br>More.</p><div class="ad">Buy this wonderful thing today, it is cheap and good.</div><p>Ok.</p></article>
<aside class="sidebar"><p>Related stories that are long enough to look like content, really.</p></aside>
<section id="comments"><p>Nice article, I did like it very much indeed.</p></section><footer>&copy; x</footer>"""


def test_main_text(spark, odd):
    kept, _ = page_text.main_blocks(PAGE)
    assert kept == ["Head & line", "First bold text. More.", "Ok."]
    assert page_text.main_blocks(None) == ([], 0) and page_text.main_blocks("<p>") == ([], 0)
    long = "<article>" + "<p>Some words of a paragraph.</p>" * 3000 + "</article>"
    assert len(page_text.main_blocks(long)[0]) == 3000
    frame = spark.createDataFrame([(1, "u", PAGE, 1), (2, None, None, 1)], "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in page_text.main_text(frame).collect()}
    assert got[1].n_chars == len("\n\n".join(kept)) and got[2].text == ""


def test_cut_is_minimal():
    pick = np.random.default_rng(2)
    for _ in range(30):
        terminal = [int(x) for x in pick.integers(-9, 10, 7)]
        edges = [(i, j, int(pick.integers(0, 6))) for i in range(7) for j in range(i)]

        def value(side, terminal=terminal, edges=edges):
            return sum(max(0, c) for c, s in zip(terminal, side, strict=True) if not s) + sum(
                max(0, -c) for c, s in zip(terminal, side, strict=True) if s
            ) + sum(w for i, j, w in edges if side[i] != side[j])

        best = min(value([bool(m >> i & 1) for i in range(7)]) for m in range(128))
        assert value(page_text.source_side(terminal, edges)) == best


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (5, 1), (99, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(odd, labels).collect()}
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got.values())
    assert got[2].score == got[3].score
    assert toxicity.toxicity(none, labels).count() == 0
    pick = np.random.default_rng(4)
    say = lambda: " ".join("".join(pick.choice(list("aeioubdfglmnrst"), 5)) for _ in range(60))
    rows = [(i, say() + (" grumblefoo blastwort" * 3 if i % 4 == 0 else ""), i % 4 == 0) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(m)) for i, _, m in rows], "doc_id long, toxic int")
    held = toxicity.toxicity(docs, marks).filter("held_out").collect()
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.9


def test_both_toxicity_dictionaries_are_trained():
    pick = np.random.default_rng(8)
    say = lambda: " ".join("".join(pick.choice(list("aeioubdfglmnrst"), 5)) for _ in range(30)).encode()
    ordinary = [say() for _ in range(800)]
    slurs = [b"grumblefoo blastwort", b"snarkelpuff vexmuddle", b"quibbledrat"]
    toxic = [say() + b" " + slurs[i % 3] + b" " + say() for i in range(800)]
    settings = toxicity.Settings()
    base, extra = toxicity.train(ordinary, toxic, settings)
    # both carry the mark of a trained dictionary, and are no longer than asked
    assert base[:4] == extra[:4] == bytes.fromhex("37a430ec")
    assert len(base) <= settings.ordinary_bytes and len(extra) <= settings.toxic_bytes
    # it is made of segments, which may end within a word
    assert all(any(w[i : i + 7] in extra for i in range(3)) for s in slurs for w in s.split())
    model = toxicity.Model(base, extra, np.zeros(1), np.ones(1), np.zeros(1), settings)
    plain, both = toxicity._pair(model)
    saved = [toxicity.savings(x, plain, both, settings).max() for x in (toxic[0], say())]
    assert saved[0] >= 5 > saved[1]
    # nothing sets the classes apart, or there is too little to train on
    assert toxicity.train(ordinary, ordinary, settings)[1] == b""
    base, extra = toxicity.train([b"a quiet day"] * 30, [b"grumblefoo"] * 3, settings)
    assert b"quiet" in base and b"grumblefoo" in extra


def test_toxicity_odds_are_those_of_all_labels(spark, odd):
    """The same document fits, whether or not the sample's bounds bind."""
    pick = np.random.default_rng(6)
    say = lambda: " ".join("".join(pick.choice(list("aeioubdfglmnrst"), 5)) for _ in range(30))
    # the mark is in every toxic document and in as many ordinary ones
    rows = [(i, say() + (" grumblefoo blastwort" * 3 if i % 10 < 2 else ""), int(i % 10 == 0)) for i in range(3000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    known, counts = toxicity.sample(docs, marks, toxicity.Settings(train_docs=100))
    assert counts == {0: 2700, 1: 300} and {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()} == {0: 200, 1: 100}
    found = toxicity.toxicity(docs, marks, settings=toxicity.Settings(train_docs=100)).agg(F.avg("score")).first()[0]
    assert abs(found - 0.1) < 0.03  # the sample's share is a third


def test_pipeline(spark, odd, folder):
    import corpus_pipeline

    docs = table(spark, folder, "documents")
    toxic = toxicity.toxicity(docs, table(spark, folder, "labels")).filter("predicted = 1")
    first = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert first.columns == docs.columns and first.count() == docs.count() - toxic.count()
    second = corpus_pipeline.drop_near_duplicates(spark, first, folder)
    assert second.count() == minmax_dedup.near_duplicates(first, corpus_pipeline.NEAR).filter("kept").count()
    last = corpus_pipeline.run(spark, folder).toPandas()
    assert last.groupby("sequence_id").length.sum().max() <= 2048


def test_pipeline_drops_copies_from_080_on(spark, odd, folder):
    """Five-word shingles by brute force; rows that repeat an id and text leave one."""
    import corpus_pipeline

    near = corpus_pipeline.NEAR
    assert (1 - 0.8**near.rows) ** near.bands < 1e-6 and 2 * near.permutations == near.rows * near.bands
    assert near.agreement < 0.8 - 5 * math.sqrt(0.8 * 0.2 / (2 * near.permutations))
    word = lambda n, i: f"w{n}x{i}"
    texts = {}
    for n in range(20):
        # 200 words and as many more: 196 of 236 five-word shingles (0.83), or 196 of 256 (0.77)
        texts[10 * n] = [word(n, i) for i in range(200)]
        texts[10 * n + 1] = [word(n, i) for i in range(240 if n % 2 else 260)]
    rows = [(d, " ".join(t), "en") for d, t in texts.items()]
    rows += [rows[0], rows[0], (500, None, "en"), (500, None, "en"), (501, "", "en"), (None, "a b", "en"), (None, "a b", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    sets = {d: set(zip(*(t[i:] for i in range(5)), strict=False)) for d, t in texts.items()}
    want = [d for d in texts if d % 10 == 0 or len(sets[d] & sets[d - 1]) < 0.8 * len(sets[d] | sets[d - 1])]
    found = [(r.doc_id, r.lang) for r in kept.collect()]
    assert len(want) == 30 and sorted(d for d, _ in found if d is not None) == sorted([*want, 500, 501])
    assert [x for d, x in found if d is None] == ["de"] and kept.columns == docs.columns
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), folder).count() == 0
