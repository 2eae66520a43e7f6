"""Personal data: patterns, and terms whose co-occurrence gives protected values away.

Protected values are found by pattern. How strongly a term reveals a value is the probability that
a text with the term holds the value, estimated over the whole corpus by its lower confidence bound:
texts with both are counted by classes of near copies, texts with the term alone one by one. A term
beyond the disclosure threshold is generalised, beyond a second one removed, wherever it occurs.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import written

KINDS = ("email", "ip", "card", "phone")
# Runs are possessive and start where no run is cut, so that every scan stays linear; what they
# match is what the plain patterns match.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A text without these has no valid match of the kind.
_HINTS = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[ -]?[0-9]){11}",
    "phone": r"\+[0-9]",
}
TOKENS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalised": "[TERM]", "removed": ""}


@dataclass(frozen=True)
class Settings:
    """``generalise`` and ``remove`` are probabilities that a text with the term holds the value;
    ``z`` is how many standard deviations below the estimate they must still be met (2.5 percent
    of estimates are that far off). ``support``: classes of near copies in which both meet, which
    no bound reaches with fewer. ``term``: runs of at least three letters or digits; shorter ones
    are no terms. ``bands`` of ``rows`` minima find near copies among the texts with a value."""

    support: int = 4
    generalise: float = 0.5
    remove: float = 0.9
    z: float = 1.96
    term: str = r"[\p{L}\p{N}]{3,}"
    bands: int = 8
    rows: int = 4
    broadcast_terms: int = 500_000


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        bare = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(bare, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    n = F.length(_digits(value))
    if kind == "card":
        return n.between(12, 19) & F.call_function("luhn_check", _digits(value))
    return n.between(9, 15)


_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _located(text: Column, pattern: str, kept: Callable[[Column], Column] | None = None) -> Column:
    """All matches with start and end (code points, end exclusive); with ``kept``, those whose
    value it gives a kind for, with that kind."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(found.alias("value"), F.slice(gaps, 1, F.size(found)).alias("before"))
    held_type = "array<struct<start:int,kind:int,end:int>>" if kept else "array<struct<start:int,end:int,value:string>>"
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(held_type).alias("out"))

    def step(held: Column, one: Column) -> Column:
        start = held["at"] + F.length(one["before"])
        end = start + F.length(one["value"])
        if kept:
            kind = kept(one["value"])
            span = F.struct(start.alias("start"), kind.alias("kind"), end.alias("end"))
            out = F.when(kind.isNotNull(), F.array_append(held["out"], span)).otherwise(held["out"])
        else:
            out = F.array_append(held["out"], F.struct(start.alias("start"), end.alias("end"), one["value"].alias("value")))
        return F.struct(end.alias("at"), out.alias("out"))

    return F.aggregate(zipped, begin, step, lambda held: held["out"])


def base_spans(text: Column) -> Column:
    """Valid matches of all kinds, by start and then kind."""
    def of_kind(number: int, kind: str) -> Column:
        spans = F.transform(
            F.filter(_located(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"])),
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(number).alias("kind"),
                s["end"].alias("end"),
                s["value"].alias("value"),
            ),
        )
        return F.when(F.regexp_like(text, F.lit(_HINTS[kind])), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))

    parts = [of_kind(i, kind) for i, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*parts))


def written_spans(spans: Column, names: Column | None = None) -> Column:
    names = names if names is not None else F.array(*map(F.lit, KINDS))
    one = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(one, ",")


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _row(text: Column) -> Column:
    """The text's 128-bit digest."""
    return F.unhex(F.md5(text))


def _terms(text: Column, settings: Settings) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(settings.term), F.lit(0)), F.lower))


def near_classes(texts: DataFrame, settings: Settings) -> DataFrame:
    """(row, class) of texts (row, terms): those whose minima agree in a band are near copies.

    The class is the least row reached; rows take the least of their bands until none changes.
    """
    hashed = F.transform("terms", lambda t: F.xxhash64(t))

    def least(seed: int) -> Column:
        return F.array_min(F.transform(hashed, lambda h: F.xxhash64(h, F.lit(seed))))

    minima = [least(i) for i in range(settings.bands * settings.rows)]
    marked = texts.filter(F.size("terms") > 0).select("row", *[m.alias(f"m{i}") for i, m in enumerate(minima)])
    parts = [[f"m{b * settings.rows + r}" for r in range(settings.rows)] for b in range(settings.bands)]
    bands = F.array(*[F.xxhash64(F.lit(b), *part) for b, part in enumerate(parts)])
    links = written(marked.select("row", F.explode(bands).alias("band")))
    # a band of one text links nothing
    shared = written(links.join(links.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band"), "band"))
    state = written(shared.select("row").distinct().select("row", F.col("row").alias("class")))
    while True:
        lowest = shared.join(state, "row").groupBy("band").agg(F.min("class").alias("class"))
        moved = shared.join(lowest, "band").groupBy("row").agg(F.min("class").alias("new"))
        step = written(state.join(moved, "row").select("row", F.col("new").alias("class"), (F.col("new") < F.col("class")).alias("changed")))
        state = step.select("row", "class")
        if step.filter("changed").isEmpty():
            break
    return texts.select("row").join(state, "row", "left").select("row", F.coalesce("class", "row").alias("class"))


def lower_bound(both: Column, alone: Column, z: float) -> Column:
    """Wilson's lower bound of a probability from successes and failures."""
    n = (both + alone).cast("double")
    p = both / n
    spread = F.sqrt(p * (1 - p) / n + F.lit(z * z / 4) / (n * n))
    return (p + F.lit(z * z / 2) / n - F.lit(z) * spread) / (1 + F.lit(z * z) / n)


def disclosing(documents: DataFrame, scanned: DataFrame, settings: Settings) -> DataFrame:
    """(entity, term, bound): terms that reveal a value with at least probability ``generalise``.

    Values in fewer texts than the support cannot reach it, and are dropped before they meet
    terms; terms that meet no value often enough are dropped before they are counted over all
    texts. Copies of one document, near ones included, are one piece of evidence.
    """
    held = scanned.filter(F.size("entities") > 0).groupBy("row").agg(F.first("entities").alias("entities"), F.count(F.lit(1)).alias("n"))
    values = held.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_rows"))
    values = written(values.filter(F.col("n_rows") >= settings.support).select("entity"))
    met = written(held.select("row", "n", F.explode("entities").alias("entity")).join(values, "entity", "left_semi"))
    rows = met.select(F.col("row").alias("_row")).distinct()
    text = documents.select(_row(_text()).alias("row"), _text().alias("text"))
    once = text.join(rows, F.col("row") == F.col("_row"), "left_semi").groupBy("row").agg(F.first("text").alias("text"))
    texts = written(once.select("row", _terms(F.col("text"), settings).alias("terms")))
    classes = near_classes(texts, settings)
    pairs = met.join(texts, "row").join(classes, "row").select("entity", "class", "n", F.explode("terms").alias("term"))
    by_class = pairs.groupBy("entity", "term", "class").agg(F.sum("n").alias("n"))
    both = by_class.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_classes"), F.sum("n").alias("n_both"))
    both = written(both.filter(F.col("n_classes") >= settings.support))
    wanted = written(both.select("term").distinct())
    every = documents.select(F.explode(_terms(_text(), settings)).alias("term"))
    if wanted.count() <= settings.broadcast_terms:
        # at most as many terms as counted; others never leave their task
        every = every.join(F.broadcast(wanted), "term", "left_semi")
        by_term = every.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    else:
        by_term = every.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).join(wanted, "term")
    bound = lower_bound(F.col("n_classes"), F.col("n_term") - F.col("n_both"), settings.z)
    return both.join(by_term, "term").withColumn("bound", bound).filter(F.col("bound") >= settings.generalise).select("entity", "term", "bound")


def spans_of(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, row (digest of the text), base and terms: arrays of spans per document."""
    names = F.array(*map(F.lit, KINDS))
    slim = F.transform("found", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end")))
    entities = F.transform("found", lambda b: F.concat_ws(":", F.element_at(names, b["kind"] + 1), F.lower(b["value"])))
    found = documents.select("doc_id", _row(_text()).alias("row"), base_spans(_text()).alias("found"))
    scanned = written(found.select("doc_id", "row", slim.alias("base"), F.array_distinct(entities).alias("entities")))
    kind = F.when(F.col("bound") >= settings.remove, 5).otherwise(4)
    marks = written(disclosing(documents, scanned, settings).groupBy("term").agg(F.max(kind).alias("kind")))
    each = documents.select(_row(_text()).alias("row"), F.explode(_terms(_text(), settings)).alias("term"))
    few = marks.count() <= settings.broadcast_terms
    named = written(
        each.join(F.broadcast(marks) if few else marks, "term")
        .select("row", "term", "kind")
        .distinct()
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("named"))
    )
    texts = documents.select(_row(_text()).alias("row"), _text().alias("text")).join(named, "row").groupBy("row").agg(
        F.first("text").alias("text"), F.first("named").alias("named")
    )
    places = _located(F.col("text"), settings.term, lambda value: F.try_element_at(F.col("named"), F.lower(value)))
    per_row = written(texts.select(F.col("row").alias("_row"), places.alias("terms")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = scanned.join(per_row, F.col("row") == F.col("_row"), "left")
    apart = F.filter(
        F.coalesce("terms", none), lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    )
    return joined.select("doc_id", "row", "base", apart.alias("terms"))


def _names() -> Column:
    return F.array(*map(F.lit, (*KINDS, "generalised", "removed")))


def personal_data(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, counts per kind, n_terms, base_sha256, spans.

    A term inside a base span adds none. A null text is an empty one without spans. Rows that repeat a doc_id and text get equal
    results; further columns are ignored; overlapping spans of several kinds all stay.
    """
    found = spans_of(documents, settings)

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.size("terms").cast("long").alias("n_terms"),
        F.sha2(written_spans(F.col("base")), 256).alias("base_sha256"),
        written_spans(F.array_sort(F.concat("base", "terms")), _names()).alias("spans"),
    )


def sanitised(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents with every span replaced by its kind's token; a null text stays null.

    Where spans overlap, the first one's token stands for them all.
    """
    found = spans_of(documents, settings).select(
        F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), F.array_sort(F.concat("base", "terms")).alias("_spans")
    )
    found = found.filter(F.size("_spans") > 0).dropDuplicates(["_doc", "_row"])
    tokens = F.array(*(F.lit(TOKENS[k]) for k in (*KINDS, "generalised", "removed")))
    joined = documents.withColumn("_hash", _row(_text())).join(
        found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_row")), "left"
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(held: Column, s: Column) -> Column:
        added = F.concat(
            held["out"],
            F.array(F.substring(F.col("text"), held["at"] + 1, s["start"] - held["at"]), F.element_at(tokens, s["kind"] + 1)),
        )
        later = s["start"] >= held["at"]
        return F.struct(F.greatest(held["at"], s["end"]).alias("at"), F.when(later, added).otherwise(held["out"]).alias("out"))

    new = F.aggregate(
        "_spans",
        begin,
        step,
        lambda held: F.concat(F.array_join(held["out"], ""), F.substring(F.col("text"), held["at"] + 1, F.length("text"))),
    )
    changed = joined.withColumn("_new", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(new))
    out = {c: F.col(c) for c in documents.columns}
    out["text"] = F.col("_new")
    if "n_chars" in out:
        out["n_chars"] = F.length("_new").cast(dict(documents.dtypes)["n_chars"])
    return changed.select(*(column.alias(name) for name, column in out.items()))
