"""Parser: tree shape on tidy and broken markup."""

from __future__ import annotations

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardloom.operators import select as sel
from cardloom.operators.markup import _FLUSH_CHARS, LISTED_DEPTH, _Nodes, _parse_batches, explode_nodes, parse_pages


def nodes(html):
    n = _Nodes()
    n.add_page(html)
    return n.to_arrow().to_pylist()[0]


def outline(html):
    """Elements as ``tag(children)`` and texts as quoted strings."""
    found = nodes(html)

    def show(pos):
        n = found[pos]
        if n["kind"] != "el":
            return {"text": repr(n["text"]), "raw": f"raw{n['text']!r}", "comment": "#"}[n["kind"]]
        below = [show(m["pos"]) for m in found if m["parent"] == pos]
        return n["tag"] + (f"({' '.join(below)})" if below else "")

    return " ".join(show(n["pos"]) for n in found if n["parent"] == -1)


@pytest.mark.parametrize("html, tree", [
    ("<p>a<p>b", "p('a') p('b')"),
    ("<p>a<b>b<div>c</div>", "p('a' b('b')) div(b('c'))"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "ul(li('a') li('b' ul(li('c'))) li('d'))"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "dl(dt('a') dd('b') dt('c'))"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "table(tbody(tr(td('a') td('b')) tr(td('c'))))"),
    ("<table><td>a</table>", "table(tbody(tr(td('a'))))"),
    ("<table><thead><tr><th>h</thead><tbody><tr><td>a</table>",
     "table(thead(tr(th('h'))) tbody(tr(td('a'))))"),
    ("<div><table><tr><td></div>x</td></tr></table>y</div>", "div(table(tbody(tr(td('x')))) 'y')"),
    ("<select><option>a<option>b</select>", "select(option('a') option('b'))"),
    ("a<br>b<img src=x>c<hr/>", "'a' br 'b' img 'c' hr"),
    ("<div/>a", "div('a')"),
    ("<svg><path d='x'/><g>t</g></svg>", "svg(path g('t'))"),
    ("<script>if (a < b) '</p>'</script>x", "script(raw\"if (a < b) '</p>'\") 'x'"),
    ("<style>p{}</style><title>a &amp; <b></title>", "style(raw'p{}') title('a & <b>')"),
    ("<script>never closed <p>", "script(raw'never closed <p>')"),
    ("<!DOCTYPE html><!-- <p> --><p>a</p>", "# p('a')"),
    ("<!-- never closed <p>", "#"),
    ("a &amp; b &copy; &#233; &nbsp;.", "'a & b © é \\xa0.'"),
    ("a < b > c", "'a < b > c'"),
    ("</p></div>x", "'x'"),
    ("<h1>a<h2>b", "h1('a') h2('b')"),
    ("<DIV><P>x</DIV>", "div(p('x'))"),
    ("<button><p>a</p><p>b</p></button>", "button(p('a') p('b'))"),
    ("", ""),
])
def test_trees(html, tree):
    assert outline(html) == tree


def test_attributes():
    el = nodes("""<a HREF="/x?a=1&amp;b=2" class=' c1  c2 ' id=i data-x='a>b' don't hidden href="y">t</a>""")[0]
    attrs = dict(el["attrs"])
    assert attrs["href"] == "/x?a=1&b=2" and attrs["data-x"] == "a>b" and attrs["hidden"] == ""
    assert el["classes"] == ["c1", "c2"] and el["id"] == "i"


def test_references_in_attributes_and_text():
    el, text = nodes('<a href="?a=1&copy=2&amp;b=3&notit;&#38;&copy" title="&eacute;&copy">&copy=2 &ampx &notit;</a>')
    assert dict(el["attrs"]) == {"href": "?a=1&copy=2&b=3&notit;&©", "title": "é©"}
    assert text["text"] == "©=2 &x ¬it;"


def test_source_offsets():
    html = "<div><h4>Room <i>5</i></h4><p>open<p>next</div>"
    by_tag = {}
    for n in nodes(html):
        if n["kind"] == "el":
            by_tag.setdefault(n["tag"], []).append(n)
    cut = lambda n, a, b: html[n[a]:n[b]]
    h4, p = by_tag["h4"][0], by_tag["p"][0]
    assert cut(h4, "inner_start", "inner_end") == "Room <i>5</i>"
    assert cut(h4, "outer_start", "outer_end") == "<h4>Room <i>5</i></h4>"
    assert cut(p, "outer_start", "outer_end") == "<p>open"


def test_numbering_holds_on_random_markup():
    rng = random.Random(7)
    pieces = ["<div class='a b'>", "</div>", "<p>", "</p>", "<b>", "</b>", "<li>", "<ul>", "</ul>", "<table>", "<tr>",
              "<td>", "</table>", "text", " ", "<br>", "<!--c-->", "&amp;", "<a href='x'", ">", '"', "<script>x</script>", "<"]
    for _ in range(400):
        html = "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))
        found = nodes(html)
        for i, n in enumerate(found):
            assert n["pos"] == i and i <= n["stop"] < len(found)
            assert n["depth"] == len(n["ancestors"])
            assert 0 <= n["outer_start"] <= n["inner_start"] <= n["inner_end"] <= n["outer_end"] <= len(html)
            if n["parent"] >= 0:
                up = found[n["parent"]]
                assert up["pos"] < i <= up["stop"] and n["stop"] <= up["stop"]
                assert n["ancestors"] == up["ancestors"] + [up["pos"]]
            inside = [m["pos"] for m in found if i in m["ancestors"]]
            assert inside == list(range(i + 1, n["stop"] + 1))
            later = [m["pos"] for m in found if m["parent"] == n["parent"] and m["kind"] == "el" and m["pos"] > i]
            if n["kind"] == "el":
                assert n["next_el"] == (later[0] if later else -1)


@pytest.mark.parametrize("part", ['<a title="', "<a ", "</a ", "<!--", "<", "<script>", "<a href='", "<title", "<p><b>", "<li><div>", "<button><p>"])
def test_broken_markup_stays_linear(part):
    begin = time.perf_counter()
    n = _Nodes()
    n.add_page(part * (300_000 // len(part)) + ("" if part.endswith(">") else "x"))
    n.to_arrow()
    assert time.perf_counter() - begin < 6


def test_end_of_page_inside_a_tag_or_comment():
    texts = lambda html: [n["text"] for n in nodes(html) if n["text"]]
    assert texts("<p>a <b>b</b> c <a href='x") == ["a ", "b", " c "]
    assert texts("<p>a</p> 1 < 2") == ["a", " 1 < 2"]
    assert texts("a<!-- b > c") == ["a"]
    assert texts("<script>if (a > b && a <c") == ["if (a > b && a <c"]


def test_deep_nesting_keeps_its_structure(spark):
    html = "<div id=cards>" + "<div>" * 600 + "deep" + "</div>" * 600 + "<div class=card id=c1>x</div></div><p>after</p>"
    found = nodes(html)
    assert max(n["depth"] for n in found) == 601 and sum(n["kind"] == "el" for n in found) == 603
    deep = next(n for n in found if n["text"] == "deep")
    assert deep["ancestors"] is None and max(len(n["ancestors"] or ()) for n in found) == LISTED_DEPTH
    row = parse_pages(spark.createDataFrame([(html,)], "html string")).select(
        F.expr(f"size({sel.find('nodes', None, '#cards .card')})").alias("cards"),
        F.expr(f"size({sel.find('nodes', None, '#cards div div')})").alias("below"),
        F.expr(f"size({sel.find('nodes', None, 'div > div')})").alias("children")).first()
    assert tuple(row) == (1, 599, 601)


def test_hostile_references():
    found = nodes("<p title='&#" + "9" * 5000 + ";'>&#" + "1" * 5000 + "; &#x" + "f" * 9000 + ";&#0000000000065;</p>")
    assert found[1]["text"] == "\ufffd \ufffdA" and dict(found[0]["attrs"]) == {"title": "\ufffd"}


def test_links_and_buttons_end_the_ones_before():
    found = [n for n in nodes("<div><a href=1>x<a href=2>y</a></div><button>1<button>2</button><a>z<td>") if n["tag"] in ("a", "button")]
    assert [n["depth"] for n in found] == [1, 1, 0, 0, 0]


def test_large_batches_are_flushed_in_parts():
    page = "<p>" + "x" * 900_000
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(7)), "html": [page] * 6 + [None]})
    parts = list(_parse_batches("html", ["page_id"])(iter([batch])))
    assert len(parts) > 1 and _FLUSH_CHARS < 7 * len(page)
    assert [i for p in parts for i in p.column("page_id").to_pylist()] == list(range(7))
    assert parts[-1].column("nodes").to_pylist()[-1] == []


def test_parse_pages_keeps_columns_and_rows(spark):
    pages = spark.createDataFrame([(1, "<p>a"), (2, None), (3, "")], "page_id int, html string")
    parsed = parse_pages(pages)
    assert parsed.columns == ["page_id", "nodes"]
    assert {r.page_id: len(r.nodes) for r in parsed.collect()} == {1: 2, 2: 0, 3: 0}
    assert explode_nodes(parsed, "page_id").count() == 2
