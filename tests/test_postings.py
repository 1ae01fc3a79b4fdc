"""Selectors by posting lists give what testing every node gives."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F
from test_select import HTML, SELECTORS

from cardloom.functions.sql import transform
from cardloom.operators import select as sel
from cardloom.operators.markup import parse_pages
from cardloom.plans import profiles

CSS = [css for css, _ in SELECTORS] + [
    "*", "div *", "div div div", "p > *", "[id]", "#a, #b .c", "div:not(.a):has(p > b)", "li:nth-of-type(3), .zzz", ".zzz p",
    "div > :nth-of-type(1)", "[class='a b']", "b:not(div b)",
]


def positions(css, root=None):
    return transform(sel.find("nodes", root, css), lambda n: f"{n}.pos")


def both(spark, pages, css_list):
    """Positions of each selector, and of those below each div, by testing nodes and by posting lists."""
    frame = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    below = lambda css: transform(sel.find("nodes", None, "div"), lambda d: positions(css, d))
    columns = lambda: [F.expr(x).alias(f"c{i}") for i, css in enumerate(css_list) for x in (positions(css),)] + [
        F.expr(below(css)).alias(f"d{i}") for i, css in enumerate(css_list)]
    tested = parse_pages(frame).select("id", *columns()).orderBy("id").collect()
    with sel.marked() as used:
        listed = columns()
    return tested, parse_pages(frame, selectors={None: used}).select("id", *listed).orderBy("id").collect()


def test_hand_made_page(spark):
    tested, listed = both(spark, [HTML, "", None, "no tags", "<p>"], CSS)
    assert listed == tested


def test_random_pages(spark):
    rng = random.Random(6)

    def page():
        out = []
        for _ in range(rng.randrange(120)):
            tag = rng.choice(["div", "p", "b", "ul", "li", "a", "span", "table", "td"])
            if rng.random() < 0.4:
                out.append(f"</{tag}>")
            else:
                own = "".join(rng.choice(["", "", f" class='{rng.choice(['a', 'b', 'c', 'a b', 'c c'])}'", f" id={rng.choice('ab')}", " title='t1' data-k=pre-1",
                                          " href='mailto:x'"]) for _ in range(2))
                out.append(f"<{tag}{own}>{rng.choice(['', 'x'])}")
        return "".join(out)

    tested, listed = both(spark, [page() for _ in range(60)], CSS)
    assert listed == tested


def test_selectors_of_all_profiles(spark):
    """Every selector the profiles use, on a page that holds something of each."""
    used: set[str] = set()

    def gather(rule):
        if isinstance(rule, (tuple, list)):
            for r in rule:
                gather(r)
        elif isinstance(rule, dict):
            gather(list(rule.values()))
        elif hasattr(rule, "__dataclass_fields__"):
            for f in rule.__dataclass_fields__:
                if f in ("css", "card", "group") and getattr(rule, f):
                    used.add(getattr(rule, f))
                else:
                    gather(getattr(rule, f))

    gather(profiles.PROFILES)
    assert len(used) > 80
    words = sorted({w for css in used for w in sel.re.findall(r"\.([\w-]+)", css)})
    page = "".join(f"<div class='{w}'><ul><li class='{w}'><h3 class='{w}'>x</h3><p><a href='mailto:a' class='{w}'>b</a><em>i</em></p></li></ul></div>" for w in words)
    css_list = sorted(used)
    frame = spark.createDataFrame([(1, page)], "id int, html string")
    tested = parse_pages(frame).select(*[F.expr(positions(css)).alias(f"c{i}") for i, css in enumerate(css_list)]).first()
    with sel.marked() as wanted:
        listed = [F.expr(positions(css)).alias(f"c{i}") for i, css in enumerate(css_list)]
    assert parse_pages(frame, selectors={None: wanted}).select(*listed).first() == tested


def test_pages_get_only_their_own_selectors(spark):
    frame = spark.createDataFrame([("x", "<p>1</p>"), ("y", "<p>1</p><b>2</b>"), ("z", "<p>3</p>"), (None, "<p>4</p>")], "kind string, html string")
    parsed = parse_pages(frame, selectors={"x": {"p"}, "y": {"b"}}, by="kind")
    found = {r.kind: {k: v for k, v in r.nodes_postings.items()} for r in parsed.select("kind", "nodes_postings").collect()}
    assert found == {"x": {sel.number("p"): [0]}, "y": {sel.number("b"): [2]}, "z": {}, None: {}}


@pytest.mark.parametrize("css", [".card p a", "div:has(b) a", "p:not(.x) > a"])
def test_time_grows_with_the_page(css):
    from cardloom.operators.markup import _Nodes
    from cardloom.operators.postings import compiled, names_of

    chains = compiled(css)

    def seconds(cards):
        nodes = _Nodes()
        nodes._walk("<div class=card><p><a>x</a><b>y</b></p></div>" * cards)
        start = time.perf_counter()
        nodes._mark(0, [(0, chains)], names_of(chains))
        return time.perf_counter() - start

    seconds(100)
    assert seconds(32_000) < 40 * max(seconds(4_000), 0.004)
