"""Reading of broken and deeply nested pages: against one expression, and in bounded time."""

import random
import re
import time

from kymo.llm import page_text

# the grammar as one expression, which takes quadratic time on broken pages
GRAMMAR = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|textarea|select|iframe|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
PIECES = (
    "<div>,</div>,<p>,<a href=x>,<a \",\",',>,<,</p ,<script,<script>,</script >,</SCRIPT>,<!--,-->,<!,?>,<?,</,text,"
    "<hr>,<br/>,<h1>,<article id='x\"y'>,</article>,&amp;,<svg ,<title>,<9>,<span title=\">\">"
).split(",")


def by_expression(page):
    for m in GRAMMAR.finditer(page):
        if m["name"]:
            yield m.start(), m.end(), m["name"].lower(), bool(m["end"]), m["rest"]
        else:
            yield m.start(), m.end(), "raw" if m["raw"] else None, False, ""


def test_tags_equal_the_expression():
    pick = random.Random(3)
    for _ in range(5000):
        page = "".join(pick.choice(PIECES) for _ in range(pick.randint(0, 25)))
        assert list(page_text.tags(page)) == list(by_expression(page)), page


def test_time_grows_with_length():
    n = 300_000
    hostile = {
        "open tags": "<a " * n,
        "open quotes": "<a \"" * n,
        "both quotes": "<a '\"" * n,
        "raw": "<script " * n,
        "ends": "</" * n,
        "late quotes": "<a " * n + "\"" * (n + 1),
        "nested": "<div>x" * 100_000,
        "nested with ends": "<div>x" * 100_000 + "</p>" * n,
    }
    start = time.time()
    for name, page in hostile.items():
        page_text.main_blocks(page)
        assert time.time() - start < 60, name


def test_ends_close_up_to_their_start():
    found = page_text.blocks("<div>a<ul><li>b<li>c</div>d</ul>e<p>f<p>g</section>h")
    assert [b.text for b in found] == ["a", "b", "c", "d", "e", "f", "g", "h"]
    assert [b.element.depth for b in found] == [1, 3, 3, 0, 0, 1, 1, 1]


def test_ties_reach_over_what_lies_between():
    def tied(page):
        return {(i, j) for i, j, _ in page_text.ties(page_text.blocks(page), page_text.Settings())}

    # the text goes on in the same element
    assert tied("<div>a<ul><li>x</ul>b</div>") == {(0, 1), (1, 2), (0, 2)}
    # a paragraph ends where a block begins; what follows is no part of it
    assert tied("<div><p>a<div>x</div>b<p>c</div>") == {(0, 1), (1, 2), (2, 3), (1, 3)}
    # paragraphs beside each other, a list within a section between them
    assert tied("<div><p>a</p><section><ul><li>x</ul></section><p>c</div>") == {(0, 1), (1, 2), (0, 2)}
