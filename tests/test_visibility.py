"""Text as it is shown: attributes, inline style, style rules and their weights."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardloom.operators import select as sel
from cardloom.operators.markup import parse_pages

CASES = [
    ("<div>a<b hidden>x</b>b</div>", "ab"),
    ("<div>a<b hidden style='display:inline'>x</b></div>", "ax"),
    ("<div>a<b style='color:red;DISPLAY : NONE'>x<i>y</i></b>b<br>c</div>", "ab c"),
    ("<div>a<b style='display:none'><i style='display:block'>y</i></b></div>", "a"),
    ("<div>a<b style='visibility:hidden'>x<i style='visibility:visible'>y</i><u>z</u></b>b</div>", "ayb"),
    ("<div>a<b style='visibility:collapse'>x<br></b>b</div>", "a b"),
    ("<style>b{display:none}</style><div>a<b>x</b></div>", "a"),
    ("<div>a<b>x</b></div><style>b{display:none}</style>", "a"),
    ("<style>b{display:none} b{display:inline}</style><div>a<b>x</b></div>", "ax"),
    ("<style>.k{display:inline} b{display:none}</style><div>a<b class=k>x</b></div>", "ax"),
    ("<style>#i{display:none} .k.l{display:inline}</style><div>a<b class='k l' id=i>x</b></div>", "a"),
    ("<style>b{display:none!important} .k{display:inline}</style><div>a<b class=k style='display:inline'>x</b></div>", "a"),
    ("<style>b{display:none}</style><div>a<b style='display:inline'>x</b></div>", "ax"),
    ("<style>/* b{display:none} */ @media print{b{display:none}} @import 'x'; u{display:none}</style><div>a<b>x</b><u>y</u></div>", "ax"),
    ("<style>b:hover, b::before, u > b{display:none}</style><div>a<b>x</b><u><b>y</b>z</u></div>", "axz"),
    ("<style>b{backface-visibility:hidden; column-display:none}</style><div>a<b>x</b></div>", "ax"),
    ("<style>b{display:none", ""),
    ("<style>b{display:none</style><div>a<b>x</b></div>", "a"),
    ("<style>}{ {} b{display:none}</style><div>a</div>", "a"),
    ("<div>hidden display<p>visibility</p></div>", "hidden display visibility"),
    ("<div><script>var display = 'none'</script>a</div>", "a"),
    ("<section hidden>s<div>a<b>x</b></div></section>", "ax"),
    ("<div><ul><li hidden>x<li>y</ul></div>", "  y"),
]


@pytest.fixture(scope="module")
def shown(spark):
    frame = spark.createDataFrame([(i, html) for i, (html, _) in enumerate(CASES)], "id int, html string")
    text = sel.transform(sel.find("nodes", None, "div"), lambda d: sel.visible_text("nodes", d))
    return {r.id: r.t for r in parse_pages(frame).select("id", F.expr(f"array_join({text}, '|')").alias("t")).collect()}


@pytest.mark.parametrize("case", range(len(CASES)))
def test_shown_text(shown, case):
    assert shown[case] == CASES[case][1]


def test_whole_text_is_unchanged(spark):
    frame = spark.createDataFrame([("<div>a<b hidden>x</b></div>",)], "html string")
    assert parse_pages(frame).select(F.expr(sel.element_text("nodes", "get(nodes, 0)"))).first()[0] == "ax"
