"""Conversation repair against a plain search over whole conversations."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from kymo.llm import conversation, queries
from kymo.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, cost string, id int"
SPACE = " \t\n\v\f\r"


def damage(rows):
    """conv -> rows (turn, role, text) after damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        own = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{own(conv)}:{own(turn)}".encode()) % 20
        role, text = own(role), own(text)
        out[conv] += []
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def cheapest(marks):
    """marks: (must go, initial, cut off). All edits by cost, then audit; whole prefixes compared."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def inserted(best):
        for _ in range(2):
            for q, (cost, audit, roles) in list(best.items()):
                for r in set(after[q]) & {"u", "a"}:
                    new = (cost + 5, audit + "I", (*roles, ("I", r)))
                    if r not in best or new[:2] < best[r][:2]:
                        best[r] = new
        return best

    for i, (gone, initial, cut_off) in enumerate(marks):
        found = {}
        for q, (cost, audit, roles) in inserted(dict(best)).items():
            ways = [(2, "D", q, None)]
            if not gone:
                more = 5 if cut_off else 0
                if initial and initial in after[q]:
                    ways.append((more, "K", initial, initial))
                ways += [(more + 1, "R", r, r) for r in set(after[q]) & {"u", "a"}]
            for price, letter, to, role in ways:
                new = (cost + price, audit + letter, (*roles, (letter, role, i)) if role else roles)
                if to not in found or new[:2] < found[to][:2]:
                    found[to] = new
        best = found
    ends = {q: v for q, v in inserted(best).items() if q in ("", "a")}
    return min(ends.values(), key=lambda v: v[:2])


def brute(rows):
    out = []
    for conv, kept in damage(rows).items():
        turns = {t for t, _, _ in kept if t is not None}
        seen, marks, found = set(), [], Counter()
        for _, role, text in kept:
            bare = text.strip(SPACE)
            kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            found[kind] += 1
            marks.append((kind in ("blank", "duplicate"), role[:1], kind == "truncated"))
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, audit, roles = cheapest(marks)
        name = {"u": "user", "a": "assistant"}
        done = []
        for r in roles:
            if r[0] == "I":
                done.append(name[r[1]] + ":")
            else:
                _, role, text = kept[r[2]]
                done.append(f"{role if r[0] == 'K' else name[r[1]]}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        sha = hashlib.sha256("\n".join(done).encode()).hexdigest()
        out.append((conv, gaps, found["blank"], found["duplicate"], found["truncated"], illegal, cost, audit, sha))
    return Counter(out)


def test_query_equals_brute_force(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, folder, "conversations").collect()]
        got = queries.QUERIES["op12_conversation_repair"](spark, folder)
        assert got.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
        assert Counter(map(tuple, got.collect())) == brute(rows)


def odd_rows(kind):
    """Conversations of many shapes; ``kind`` makes those that costs take longest to settle in."""
    random.seed(kind)
    roles = {"cut": ["user", "assistant"], "system": ["system"], "blank": ["user"]}.get(kind, ["system", "user", "assistant", "tool", "", "Uncle", "use", None])
    texts = {"cut": None, "blank": ["", " ", "\t\n"]}.get(kind, ["Yes.", "No", "", " \n", None, "Done!", "é?", "x. "])
    rows = []
    for conv in [*range(40), None]:
        n = random.choice([0, 1, 2, 3, 9, 30])
        n = 150 if conv in (3, 4, None) else n
        for i in range(n):
            turn = random.choice([None, i, i, i, i // 2, 3 * i])
            text = random.choice(texts) if texts else f"part {i}"
            rows.append((conv, turn, random.choice(roles), f"{text}{i}{random.choice('.,')}" if random.random() < 0.3 and kind == "mixed" else text))
    rows += rows[:7]
    return rows


@pytest.mark.parametrize("kind", ["mixed", "cut", "system", "blank"])
@pytest.mark.parametrize("size", [1, 5, 4096])
def test_odd_rows_in_chunks(spark, kind, size):
    table(spark, "/root/testdata/sf0.001", "documents")  # ships the package
    rows = odd_rows(kind)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    got = conversation.repaired(frame, conversation.Settings(rows=size)).collect()
    assert Counter(map(tuple, got)) == brute(rows)


def test_passes_double_their_reach(spark, monkeypatch):
    """A thousand chunks in which every start matters need about ten passes, not a thousand."""
    rows = [(7, i, "system", f"text {i}.") for i in range(1000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    passes = []
    step = conversation.fixed_up
    monkeypatch.setattr(conversation, "fixed_up", lambda state: passes.append(1) or step(state))
    got = conversation.repaired(frame, conversation.Settings(rows=1)).collect()
    assert Counter(map(tuple, got)) == brute(rows)
    assert 5 < len(passes) < 13


def test_empty_and_dropped(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert conversation.repaired(frame).count() == 0
    gone = [(c, 0, "user", "x.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = conversation.repaired(spark.createDataFrame([(*r, "x", 1) for r in gone], SCHEMA)).collect()
    assert len(got) == len(gone) and {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_string_ids(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 1, "assistant", "Ho."), ("b", 0, "user", "Hi")]
    frame = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert Counter(map(tuple, conversation.repaired(frame).collect())) == brute(rows)
