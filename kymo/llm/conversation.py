"""Repair of role order in conversations by least-cost edits.

A conversation is in order if the initials of its roles read ``(s?(ua)+)?``. Rows are kept,
given the role user or assistant, deleted, or preceded by an empty row. Costs run backward over
the rows: from each of four states (nothing written yet, after the system row, after a user row,
after an assistant row) the least cost of finishing the rest. The cheapest edits that read least
are then traced forward.

Conversations are cut into chunks, so that one of any length is spread over tasks. A chunk does
not know the costs behind it; it starts from four speculative cost vectors, one per state, zero
there. Where all outcomes differ by constants only, no start matters any more and the chunk is
settled. Fix-up passes run the others again behind what follows them, twice as far in every pass,
until all are settled. The trace crosses chunks likewise: per chunk from each of the four states,
joined up in passes where these do not end in one state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from kymo.llm.common import rows, written

BLANKS = " \t\n\v\f\r"
DELETE, REROLE, INSERT, CUT_OFF = 2, 1, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
NONE = 1 << 40  # no way
# The role that may follow, other than a system row at the start.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

Vector = tuple[int, ...]


@dataclass(frozen=True)
class Settings:
    """A chunk ends after ``rows`` rows or ``chars`` code points of text."""

    rows: int = 4096
    chars: int = 1 << 22


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (0: dropped) of every row."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(own("conv_id"), F.lit(":"), own("turn"))), F.lit(20))
    text = F.when(fault <= 1, "").when(fault == 2, F.translate(own("text"), ".!?", "")).otherwise(own("text"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    role = F.when(fault == 0, "").when(fault == 4, "user").otherwise(own("role"))
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies")
    )


# Costs. A row is a letter: b blank and d duplicate, which go; s, u, a, o by role, in upper case
# when the text is cut off.


def closed(costs: list[int]) -> list[int]:
    """With empty rows put in front where that is cheaper."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return costs


FINAL: Vector = tuple(closed([0, NONE, NONE, 0]))
UNITS = [tuple(0 if q == j else NONE for q in range(4)) for j in range(4)]


def _options(code: str, after: Vector, q: int) -> list[tuple[str, int, int]]:
    """(edit, cost with what follows, next state) of one row, in ASCII order."""
    found = [("D", DELETE + after[q], q)]
    if code not in "bd":
        extra = CUT_OFF if code.isupper() else 0
        to = KEPT[code.lower()].get(q)
        if to is not None:
            found.append(("K", extra + after[to], to))
        found.append(("R", extra + REROLE + after[NEXT[q]], NEXT[q]))
    return found


class Costs:
    """Steps over one row, kept by vector and letter: vectors without their least part are few."""

    def __init__(self) -> None:
        self.steps: dict[tuple[Vector, str], tuple[Vector, int]] = {}
        self.edits: dict[tuple[Vector, str, int], tuple[str, int, int]] = {}

    def before(self, after: Vector, code: str) -> tuple[Vector, int]:
        """The normed vector in front of a row, and what was taken off."""
        key = (after, code)
        if key not in self.steps:
            self.steps[key] = normed(closed([min(o[1] for o in _options(code, after, q)) for q in range(4)]))
        return self.steps[key]

    def edit(self, after: Vector, code: str, q: int) -> tuple[str, int, int]:
        """Edits at a row from a state, their cost, and the state behind it: the least letter
        among the cheapest, empty rows first where they are needed."""
        key = (after, code, q)
        if key not in self.edits:
            least = closed([min(o[1] for o in _options(code, after, s)) for s in range(4)])
            done, paid = "", 0
            while True:
                here = {o[0]: o for o in _options(code, after, q) if o[1] == least[q]}
                if least[q] == INSERT + least[NEXT[q]]:
                    here["I"] = ("I", least[q], NEXT[q])
                letter, _, to = here[min(here)]
                done += letter
                if letter == "I":
                    paid, q = paid + INSERT, to
                    continue
                extra = CUT_OFF if code.isupper() and letter != "D" else 0
                paid += {"D": DELETE, "K": 0, "R": REROLE}[letter] + extra
                self.edits[key] = (done, paid, to)
                break
        return self.edits[key]

    def front(self, codes: str, final: Vector) -> tuple[Vector, int]:
        """The normed vector in front of a chunk, and its least part."""
        vector, base = normed(list(final))
        for code in reversed(codes):
            vector, more = self.before(vector, code)
            base += more
        return vector, base

    def behind(self, codes: str, final: Vector) -> tuple[Vector, list[Vector]]:
        """The normed vectors in front of a chunk and behind each of its rows."""
        vector = normed(list(final))[0]
        after = [vector] * len(codes)
        for i in range(len(codes) - 1, -1, -1):
            after[i] = vector
            vector = self.before(vector, codes[i])[0]
        return vector, after

    def trace(self, codes: str, after: list[Vector], q: int) -> tuple[list[str], int, int]:
        """Edits per row, their cost, and the state behind the chunk."""
        edits, paid = [], 0
        for code, vector in zip(codes, after, strict=True):
            done, cost, q = self.edit(vector, code, q)
            edits.append(done)
            paid += cost
        return edits, paid, q


def normed(costs: list[int]) -> tuple[Vector, int]:
    least = min(costs)
    return tuple(NONE if c >= NONE // 2 else c - least for c in costs), least


def ending(q: int) -> str:
    """The empty rows needed behind the last row."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[q]


def lines(edits: list[str], roles: list[str], texts: list[str], q: int) -> Iterator[str]:
    """``role:text`` of the repaired rows."""
    for done, role, text in zip(edits, roles, texts, strict=True):
        for letter in done:
            if letter == "D":
                continue
            if letter == "K":
                q = KEPT[role[:1]][q]
                yield f"{role}:{text}"
            else:
                q = NEXT[q]
                yield f"{ROLES[q]}:{'' if letter == 'I' else text}"


# Chunks


def signature(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


def code_rows(roles: list[str], texts: list[str]) -> tuple[str, list[bytes | None]]:
    """The letters of rows, repeats among them found, and the signatures of those that may
    repeat rows of other chunks."""
    codes, signs = [], []
    seen = set()
    for role, text in zip(roles, texts, strict=True):
        bare = text.rstrip(BLANKS)
        sign = signature(role, text) if bare else None
        if sign is None:
            code = "b"
        elif sign in seen:
            code, sign = "d", None
        else:
            seen.add(sign)
            code = role[:1] if role[:1] in ("s", "u", "a") else "o"
            code = code if bare[-1] in ".!?" else code.upper()
        codes.append(code)
        signs.append(sign)
    return "".join(codes), signs


def bad_pairs(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


def counts(codes: str) -> tuple[int, int, int]:
    return codes.count("b"), codes.count("d"), sum(c.isupper() for c in codes)


_FACTS = "low long, high long, turns long, illegal long, head string, tail string, blank long, duplicate long, truncated long, cost long, audit string"
_HELD = "codes string, roles array<string>, texts array<string>, signs array<binary>"
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _batches(schema: pa.Schema, records: Iterator[tuple], size: int = 5000, weight: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded rows and code points, lists included."""
    held: list[tuple] = []
    load = 0

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for record in records:
        held.append(record)
        load += sum(len(x) for x in record if isinstance(x, str))
        load += sum(len(y) for x in record if isinstance(x, list) for y in x if isinstance(y, str))
        if len(held) >= size or load >= weight:
            yield batch()
            held, load = [], 0
    if held:
        yield batch()


def cut(faulty: DataFrame, settings: Settings) -> DataFrame:
    """Chunks in order of conversation and turn. Those that cannot go on in the range of another
    task are whole and finished at once; ``sha`` is theirs."""
    out = f"conv_id {dict(faulty.dtypes)['conv_id']}, id long, part int, whole boolean, {_FACTS}, sha string, {_HELD}"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, costs = TaskContext.get().partitionId(), Costs()

        def each() -> Iterator[tuple]:
            now, begun, seq, edge = None, False, part << 32, True
            turns: list[int | None] = []
            roles: list[str] = []
            texts: list[str] = []
            size = 0

            def chunk(whole: bool) -> tuple:
                known = [t for t in turns if t is not None]
                low, high = (known[0], known[-1]) if known else (None, None)
                ends = (roles[0][:1], roles[-1][:1]) if roles else (None, None)
                facts = (now, seq, part, whole, low, high, len(set(known)), bad_pairs(roles), *ends)
                codes, signs = code_rows(roles, texts)
                if not whole:
                    return (*facts, 0, 0, 0, 0, "", None, codes, list(roles), list(texts), signs)
                edits, paid, q = costs.trace(codes, costs.behind(codes, FINAL)[1], START)
                more = ending(q)
                done = "\n".join(lines([*edits, more], [*roles, ""], [*texts, ""], START))
                sha = hashlib.sha256(done.encode("utf-8", "surrogatepass")).hexdigest()
                return (*facts, *counts(codes), paid + INSERT * len(more), "".join(edits) + more, sha, None, None, None, None)

            for conv, turn, role, text, copies in rows(batches):
                if begun and conv != now:
                    yield chunk(not edge)
                    seq, edge, size = seq + 1, False, 0
                    for held in (turns, roles, texts):
                        held.clear()
                now, begun = conv, True
                for _ in range(copies):
                    if len(roles) >= settings.rows or size >= settings.chars:
                        yield chunk(False)
                        seq, edge, size = seq + 1, True, 0
                        for held in (turns, roles, texts):
                            held.clear()
                    turns.append(turn)
                    roles.append(role)
                    texts.append(text)
                    size += len(text)
            if begun:
                yield chunk(False)

        yield from _batches(schema, each())

    place = ["conv_id", "turn", "role"]
    ranged = faulty.repartitionByRange(*place, F.substring("text", 1, 64)).sortWithinPartitions(*place, "text")
    return ranged.mapInArrow(run, out)


# Chunks that other chunks may precede or follow


def linked(chunks: DataFrame) -> DataFrame:
    """id, codes, rows that repeat a row of an earlier chunk, and the ids before and after."""
    signs = chunks.select("conv_id", "id", F.posexplode("signs").alias("row", "sign")).filter("sign is not null")
    firsts = signs.groupBy("conv_id", "sign").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("_conv"), F.col("sign").alias("_sign"), "first")
    again = (F.col("sign") == F.col("_sign")) & F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("id") > F.col("first"))
    repeats = signs.join(firsts, again).groupBy("id").agg(F.collect_list("row").alias("repeats"))
    # a conversation's chunks of one task have successive ids; one row per task and conversation
    runs = chunks.groupBy("conv_id", "part").agg(F.min("id").alias("low_id"), F.max("id").alias("high_id"))
    along = Window.partitionBy("conv_id").orderBy("part")
    runs = runs.select(
        F.col("conv_id").alias("_conv"),
        F.col("part").alias("_part"),
        "low_id",
        "high_id",
        F.lag("high_id").over(along).alias("ahead"),
        F.lead("low_id").over(along).alias("behind"),
    )
    met = chunks.select("conv_id", "part", "id", "codes").join(runs, (F.col("part") == F.col("_part")) & F.col("conv_id").eqNullSafe(F.col("_conv")))
    return met.join(repeats, "id", "left").select(
        "id",
        "codes",
        "repeats",
        F.when(F.col("id") == F.col("low_id"), F.col("ahead")).otherwise(F.col("id") - 1).alias("prev"),
        F.when(F.col("id") == F.col("high_id"), F.col("behind")).otherwise(F.col("id") + 1).alias("next"),
    )


def settled(outcome: list[list[int]]) -> tuple[list[list[int]], list[int] | None]:
    """Outcomes per state in front (rows) and behind a chunk (columns) without those that cannot
    be cheapest, and the vector in front if it is the same, but for a constant, whatever follows.

    What follows costs from the state after an assistant row at most as much as from that after a
    system row, 2 more than from the start, and 5 more or less than after a user row.
    """
    kept = []
    for row in outcome:
        s0, s1, s2, s3 = (NONE if c >= NONE // 2 else c for c in row)
        s1 = NONE if min(s3, s2 + INSERT) <= s1 else s1
        s0 = NONE if min(s3, s2 + INSERT) + DELETE <= s0 else s0
        kept.append([s0, s1, NONE if s3 + INSERT <= s2 else s2, NONE if s2 + INSERT <= s3 else s3])
    base = kept[0]
    ways = [j for j in range(4) if base[j] < NONE]
    steps = [row[ways[0]] - base[ways[0]] for row in kept]
    same = all((row[j] == base[j] + step) if j in ways else row[j] == NONE for row, step in zip(kept, steps, strict=True) for j in range(4))
    return kept, list(normed(steps)[0]) if same else None


def composed(ahead: list[list[int]], behind: list[list[int]]) -> list[list[int]]:
    return [[min(row[k] + behind[k][j] for k in range(4)) for j in range(4)] for row in ahead]


def _square(flat: list[int]) -> list[list[int]]:
    return [flat[4 * q : 4 * q + 4] for q in range(4)]


_BACK = "id long, next long, outcome array<long>, vector array<long>"


def speculated(links: DataFrame) -> DataFrame:
    """Every chunk from four starts; the last one of a conversation knows what follows."""
    out = f"{_BACK}, prev long, behind long, codes string"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()

        def each() -> Iterator[tuple]:
            for key, codes, repeats, prev, next_ in rows(batches):
                letters = list(codes)
                for row in repeats or ():
                    letters[row] = "d"
                codes = "".join(letters)
                if next_ is None:
                    yield key, None, None, list(costs.front(codes, FINAL)[0]), prev, None, codes
                    continue
                columns = []
                for unit in UNITS:
                    vector, base = costs.front(codes, unit)
                    columns.append([c if c >= NONE else c + base for c in vector])
                kept, vector = settled([list(r) for r in zip(*columns, strict=True)])
                yield key, next_, sum(kept, []), vector, prev, next_, codes

        yield from _batches(schema, each())

    return links.mapInArrow(run, out)


def fixed_up(state: DataFrame) -> DataFrame:
    """One pass: chunks not settled are run on behind the next one's costs, or through it."""
    schema = _arrow(_BACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for key, next_, outcome, vector, far, through, known in rows(batches):
                if vector is None and known is not None:
                    costs = [min(c + k for c, k in zip(row, known, strict=True)) for row in _square(outcome)]
                    vector = list(normed(costs)[0])
                elif vector is None:
                    kept, vector = settled(composed(_square(outcome), _square(through)))
                    next_, outcome = far, sum(kept, [])
                yield key, next_, outcome, vector

        yield from _batches(schema, each())

    other = state.select(F.col("id").alias("_id"), F.col("next").alias("_next"), F.col("outcome").alias("_outcome"), F.col("vector").alias("_vector"))
    asked = F.when(F.col("vector").isNull(), F.col("next")) == F.col("_id")
    return state.join(other, asked, "left").select("id", "next", "outcome", "vector", "_next", "_outcome", "_vector").mapInArrow(run, _BACK)


_FORTH = "id long, prev long, ends array<int>, state int"


def traced(coded: DataFrame, back: DataFrame) -> DataFrame:
    """The state behind every chunk from each state in front; ``state`` where it is one."""
    out = f"{_FORTH}, ahead long, after array<long>"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()

        def each() -> Iterator[tuple]:
            for key, prev, codes, follows in rows(batches):
                final = tuple(follows) if follows else FINAL
                after = costs.behind(codes, final)[1]
                ends = [costs.trace(codes, after, q)[2] for q in range(4)]
                one = ends[START] if prev is None or len(set(ends)) == 1 else None
                yield key, prev, ends, one, prev, follows

        yield from _batches(schema, each())

    vectors = back.select(F.col("id").alias("_id"), F.col("vector").alias("follows"))
    met = coded.join(vectors, F.col("behind") == F.col("_id"), "left")
    return met.select("id", "prev", "codes", "follows").mapInArrow(run, out)


def carried(state: DataFrame) -> DataFrame:
    """One pass: states behind chunks from those behind the chunks ahead. SQL suffices."""
    other = state.select(F.col("id").alias("_id"), F.col("prev").alias("_prev"), F.col("ends").alias("_ends"), F.col("state").alias("_state"))
    asked = F.when(F.col("state").isNull(), F.col("prev")) == F.col("_id")
    joined = state.join(other, asked, "left")
    through = F.transform("_ends", lambda q: F.get("ends", q))
    ends = F.when(F.col("state").isNotNull(), F.col("ends")).when(F.col("_state").isNotNull(), F.transform("ends", lambda _: F.get("ends", F.col("_state")))).otherwise(through)
    found = joined.select("id", F.col("_prev").alias("prev"), ends.alias("ends"), "state")
    one = F.when(F.size(F.array_distinct("ends")) == 1, F.get("ends", F.lit(0)))
    return found.select("id", "prev", "ends", F.coalesce("state", one).alias("state"))


def _settle(state: DataFrame, column: str, step) -> DataFrame:
    """Passes until every row has the column; each reaches twice as far as the one before."""
    while not state.filter(F.col(column).isNull()).isEmpty():
        state = written(step(state))
    return state


def _pieces(chunks: DataFrame, coded: DataFrame, forth: DataFrame, ends: DataFrame) -> DataFrame:
    """Counts, audit and repaired rows of every chunk."""
    out = f"conv_id {dict(chunks.dtypes)['conv_id']}, id long, {_FACTS}, done string"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()

        def each() -> Iterator[tuple]:
            for conv, key, low, high, turns, illegal, head, tail, roles, texts, codes, follows, q in rows(batches):
                q = START if q is None else q
                after = costs.behind(codes, tuple(follows) if follows else FINAL)[1]
                edits, paid, last = costs.trace(codes, after, q)
                more = "" if follows else ending(last)
                kept = list(lines([*edits, more], [*roles, ""], [*texts, ""], q))
                done = "\n".join(kept) if kept else None
                facts = (low, high, turns, illegal, head, tail, *counts(codes), paid + INSERT * len(more), "".join(edits) + more)
                yield conv, key, *facts, done

        yield from _batches(schema, each())

    before = ends.select(F.col("id").alias("_before"), F.col("state").alias("start"))
    plan = coded.select("id", "codes").join(forth.select("id", "ahead", "after"), "id").join(before, F.col("ahead") == F.col("_before"), "left")
    met = chunks.drop("codes").join(plan, "id")
    names = ["conv_id", "id", "low", "high", "turns", "illegal", "head", "tail", "roles", "texts", "codes", "after", "start"]
    return met.select(names).mapInArrow(run, out)


class _Total:
    """The sums over a conversation's chunks, given in order."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.sums = [0] * 5
        self.low = self.high = self.tail = None
        self.turns = 0
        self.audits: list[str] = []
        self.sha = hashlib.sha256()
        self.started = False

    def add(self, low, high, turns, illegal, head, tail, blank, duplicate, cut_off, cost, audit, done) -> None:
        self.sums = [a + b for a, b in zip(self.sums, (blank, duplicate, cut_off, illegal, cost), strict=True)]
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high
        if head is not None:
            self.sums[3] += self.tail is not None and self.tail + head not in LEGAL
            self.tail = tail
        self.audits.append(audit)
        if done is not None:
            self.sha.update((("\n" if self.started else "") + done).encode("utf-8", "surrogatepass"))
            self.started = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv, gaps, *self.sums, "".join(self.audits), self.sha.hexdigest()


def _together(pieces: DataFrame) -> DataFrame:
    """One row per conversation: a task reads its chunks in order, one at a time. The checksum
    of all repaired rows asks for that; it is taken as they pass."""
    out = f"conv_id {dict(pieces.dtypes)['conv_id']}, {_RESULT}"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            total: _Total | None = None
            for conv, _, *facts in rows(batches):
                if total is None or conv != total.conv:
                    if total is not None:
                        yield total.row()
                    total = _Total(conv)
                total.add(*facts)
            if total is not None:
                yield total.row()

        yield from _batches(schema, each())

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "id").mapInArrow(run, out)


def repaired(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256, after the damage that a checksum of id and turn decides on.

    Nulls count as one space in the checksum, in roles and in texts; a null conv_id is a
    conversation, null turns come first. Rows of one turn go by role, then text. A row equal in
    role and text to an earlier one that is not blank is a duplicate. Roles with other or no
    initials cannot be kept. A conversation that loses all rows has zeros and the empty text's
    checksum. Further columns are ignored; an empty table gives no rows.

    Memory per task is bounded by a chunk, but for a conversation's audit, which is one value of
    a letter per row.
    """
    chunks = written(cut(damaged(conversations), settings))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long")).alias("gaps")
    names = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    whole = chunks.filter("whole").select("conv_id", gaps, *names, F.col("sha").alias("repaired_sha256"))
    edges = chunks.filter("not whole")
    coded = written(speculated(linked(edges)))
    back = _settle(coded.select("id", "next", "outcome", "vector"), "vector", fixed_up)
    forth = written(traced(coded, back))
    ends = _settle(forth.select("id", "prev", "ends", "state"), "state", carried)
    return whole.unionByName(_together(_pieces(edges, coded, forth, ends)))
