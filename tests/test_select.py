"""Selectors and picks on a hand-made page."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardloom.functions.sql import transform
from cardloom.operators import select as sel
from cardloom.operators.fields import field_value
from cardloom.operators.markup import parse_pages
from cardloom.operators.rules import Checked, Joined, Pick

HTML = """<body><div id="top" class="a"><div class="b x:y"><p title="t1">one <b>two</b></p><p>three</p></div>
<ul class="b"><li class="off">A</li><li data-k="pre-1">B</li><li data-k="pre-2">C<ul><li>D</li></ul></li></ul></div>
<div class="b"><p> </p><p>four</p><a href="mailto:">x</a><a href="mailto:z@x.org">y</a></div>
<h2>H</h2>té€xt😀<h6 class="n">next</h6></body>"""

SELECTORS = [
    ("p", ["one two", "three", " ", "four"]),
    (".a p", ["one two", "three"]),
    (".a .b p", ["one two", "three"]),
    (".a > p", []),
    (".a > .b > p", ["one two", "three"]),
    ("body > .b p", [" ", "four"]),
    (".b .b", []),
    (r".x\:y b", ["two"]),
    ("#top li", ["A", "B", "CD", "D"]),
    ("ul > li > ul > li", ["D"]),
    ("div > li", []),
    ("li:not(.off)", ["B", "CD", "D"]),
    ("li:nth-of-type(2)", ["B"]),
    ("ul li:nth-of-type(1)", ["A", "D"]),
    ("[data-k]", ["B", "CD"]),
    ("[data-k='pre-2']", ["CD"]),
    ("[data-k^=pre]", ["B", "CD"]),
    ("[data-k*='-1']", ["B"]),
    ("p[title=t1], h6", ["one two", "next"]),
    ("div:has(b) p", ["one two", "three"]),
    (".b:has(a[href^='mailto:'])", [" fourxy"]),
    ("h6.n", ["next"]), ("*.n", ["next"]), ("H6", ["next"]),
    ("h6,b , h2", ["two", "H", "next"]),
]

PICKS = [
    ((Pick("p", "first", scope="page"),), "one two"),
    ((Pick("p", 2, scope="page"),), ""),
    ((Pick("p", 9, scope="page"),), ""),
    ((Pick("p", "all", scope="page", steps=()),), "one twothree four"),
    ((Pick("body > .b p", "first_text", scope="page"),), "four"),
    ((Pick("p", "first", "own", scope="page"),), "one"),
    ((Pick("p", "first", "without:b", scope="page", steps=()),), "one "),
    ((Pick(".a p", "first_value", "first_node", scope="page", steps=()),), "one "),
    ((Pick("p", "first", "attr:title", scope="page", steps=()),), "t1"),
    ((Pick("p", "first", "attr:none", scope="page"),), ""),
    ((Pick("p", "first", "inner_html", scope="page", steps=()),), "one <b>two</b>"),
    ((Pick("b", "first", "outer_html", scope="page", steps=()),), "<b>two</b>"),
    ((Pick("h6", "first", "outer_html", scope="page", steps=()),), '<h6 class="n">next</h6>'),
    ((Pick("li", "first", scope="page", inside=(("ul", 1),)),), "D"),
    ((Pick("li", "first_other", scope="page"),), "B"),
    ((Pick("a", "first", "attr_or_text:name", scope="page"),), "x"),
    ((Pick(".none", scope="page"), "", Pick("h2", scope="page")), "H"),
    ((Pick(".none", scope="page"), "Member"), "Member"),
    ((Joined((Pick("h2", scope="page"), Pick(".none", scope="page"), Pick("b", scope="page"))),), "H two"),
    ((Checked((Pick("h2", scope="page"), Pick("[href*='@']", "first", "attr:href", scope="page")), ("if_address",)),), ""),
    ((Pick("div", "all", scope="page", where=(("at_least", "a", 2),)),), "fourxy"),
    ((Pick("li", "first", scope="page", where=(("plain_text", 2),)),), "A"),
    (None, ""),
]


@pytest.fixture(scope="module")
def page(spark):
    return parse_pages(spark.createDataFrame([(HTML,)], "html string")).cache()


def test_selectors(page):
    found = page.select(*[
        F.expr(transform(sel.find("nodes", None, css), lambda el: sel.element_text("nodes", el))).alias(f"s{i}")
        for i, (css, _) in enumerate(SELECTORS)
    ]).first()
    squeezed = lambda texts: [t.replace("\n", "") for t in texts]
    assert [(c, squeezed(found[i])) for i, (c, _) in enumerate(SELECTORS)] == SELECTORS


def test_picks(page):
    found = page.select(*[
        F.expr(field_value("nodes", None, rule)).alias(f"p{i}") for i, (rule, _) in enumerate(PICKS)
    ]).first()
    assert [(r, found[i]) for i, (r, _) in enumerate(PICKS)] == PICKS


def test_moves(page):
    def texts(move):
        moved = f"flatten({transform(sel.find('nodes', None, 'b, h2'), move)})"
        return F.expr(transform(moved, lambda el: sel.element_text("nodes", el)))

    found = page.select(
        texts(lambda el: sel.parent("nodes", el)).alias("parent"),
        texts(lambda el: sel.closest("nodes", el, ".b, .a")).alias("closest"),
        texts(lambda el: sel.next_sibling("nodes", el, "h6")).alias("next"),
        F.expr(transform(sel.find("nodes", None, "h2, h6"), lambda el: f"{sel.next_node('nodes', el)}.text")).alias("behind"),
    ).first()
    assert found.parent[0] == "one two" and found.closest == ["one twothree"]
    assert found.next == ["next"] and found.behind == ["té€xt😀", None]


@pytest.mark.parametrize("css", ["p:hover", "p >", "p ~ q", "[a$='b']", ""])
def test_unknown_selectors_are_refused(css):
    with pytest.raises(ValueError):
        sel.matcher(css)("n", "nodes")
