"""Tokens, elements and spans of pages against the standard parser and a stack."""

import hashlib
import random
from html.parser import HTMLParser

from claimlens.operators import pages
from pyspark.sql import functions as F

ODD = [
    (1, "<!DOCTYPE html><HTML><p>one<br>two &amp;amp; &lt;b&gt;<P>three</p><script>if (a<b) '</p>'</script><style>p{}</style>tail<!-- a <p> --> end"),
    (2, "no tags at all: 1 < 2"),
    (3, ""),
    (4, None),
    (5, "<div><div>Ünïcödé \U0001f600 <i>中文</i></div> after</div></div><div>open"),
    (6, "<script>never closed <p>x"),
    (7, "<li>a</li><li>b <li>c</li></li><img src='x'/>&nbsp;<a href=\"u>v\">"),
    (8, "x" * 200_000 + "<p>y</p>"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, html string")


def test_tokens_tile_every_page(spark):
    held = {}
    for r in pages.tokens(frame(spark, ODD)).orderBy("page_id", "n").collect():
        at = held.setdefault(r.page_id, [])
        assert r.start == (at[-1][1] if at else 0) and r.end - r.start == len(r.token.encode())
        at.append((r.start, r.end, r.token))
    for i, html in ODD:
        assert "".join(t for *_, t in held.get(i, [])) == (html or "")
    kinds = [r.kind for r in pages.tokens(frame(spark, ODD[:1])).orderBy("n").collect()]
    assert kinds == ["hidden", "open", "open", "text", "void", "text", "open", "text", "close", "hidden", "hidden", "text", "hidden", "text"]


def test_spans_are_what_the_parser_shows(spark):
    rng = random.Random(3)
    parts = ["<p>", "</p>", "<div class='a'>", "</div>", "<br>", "word ", "é &amp; ", "<!-- x -->", "<script>a<b</script>", "<b>", "</b>", " \n", "tail"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(30))) for i in range(40)]

    class Shown(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.hidden, self.parts = 0, []

        def handle_starttag(self, tag, attrs):
            self.hidden += tag == "script"

        def handle_endtag(self, tag):
            self.hidden -= tag == "script"

        def handle_data(self, data):
            if not self.hidden:
                self.parts.append(data)

    got = {}
    for r in pages.spans(pages.tokens(frame(spark, rows))).orderBy("page_id", "n").collect():
        assert dict(rows)[r.page_id].encode()[r.start : r.end].decode() == r.raw
        got.setdefault(r.page_id, []).append(r.text)
    for i, html in rows:
        p = Shown()
        p.feed(html)
        p.close()
        assert " ".join(" ".join(got.get(i, [])).split()) == " ".join(" ".join(p.parts).split())


def test_elements_equal_a_stack_for_each_name(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(["<p>", "</p>", "<div>", "</div>", "t", "<hr>"]) for _ in range(40))) for i in range(30)]
    df = pages.tokens(frame(spark, rows))
    want = set()
    for i in range(30):
        depth, opened = {}, {}
        tags = [(r.n, r.name, r.kind) for r in df.where(F.col("page_id") == i).orderBy("n").collect() if r.kind in ("open", "close")]
        for n, name, kind in tags:
            d = depth.get(name, 0) + (1 if kind == "open" else -1)
            level = d if kind == "open" else d + 1
            if kind == "open":
                opened[name, level] = n
                want.add((i, name, n, next((m for m, *rest in _after(tags, n, name, level)), None), level))
            depth[name] = d
    got = {(r.page_id, r.name, r.n, r.until, r.level) for r in pages.elements(df).collect()}
    assert got == want


def _after(tags, n, name, level):
    """The tag of this name and level that comes next, if it closes."""
    d = 0
    for m, other, kind in tags:
        if other != name:
            continue
        d += 1 if kind == "open" else -1
        if m > n and (d if kind == "open" else d + 1) == level:
            return [(m,)] if kind == "close" else []
    return []


def test_fields_and_nested_names(spark):
    t = pages.tokens(frame(spark, ODD))
    got = {(r.page_id, r.name, r.text) for r in pages.within(pages.spans(t), pages.elements(t), ["li", "div"]).collect()}
    assert got == {(5, "div", "Ünïcödé \U0001f600 中文"), (5, "div", "Ünïcödé \U0001f600 中文 after"), (7, "li", "a"), (7, "li", "b c"), (7, "li", "c")}


def test_only_the_bytes_prove_a_statement(spark):
    html = "<p>Capacity of 5 é units</p>"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    at = html.encode().index(b"Capacity")
    end = html.encode().index(b"</p>")
    claims = [(1, at, end, sha("Capacity of 5 é units")), (1, at + 1, end, sha("Capacity of 5 é units")), (1, at, 999, sha("x")), (1, -1, 2, sha("<p")), (2, 0, 1, sha("x")), (1, None, end, None)]
    got = pages.proved(spark.createDataFrame(claims, "page_id long, start long, end long, sha256 string"), frame(spark, [(1, html)])).collect()
    assert sorted(r.holds for r in got) == [False] * 5 + [True]
