"""Trees of misnested markup, as the HTML standard has them."""

from __future__ import annotations

import random

import pytest

from cardloom.operators import markup
from cardloom.operators.markup import _Misnested, _Nodes, build_tree

# markup -> the tree written out; most of these stand in the standard or follow from its steps
CASES = [
    ("<p>1<b>2<i>3</b>4</i>5</p>", "<p>1<b>2<i>3</i></b><i>4</i>5</p>"),
    ("<b>1<p>2</b>3</p>", "<b>1</b><p><b>2</b>3</p>"),
    ("<p><b>x</p>y", "<p><b>x</b></p><b>y</b>"),
    ("<p><b>x<p>y</b>z", "<p><b>x</b></p><p><b>y</b>z</p>"),
    ("<b><div>a</b>b</div>", "<b></b><div><b>a</b>b</div>"),
    ("<a>1<div>2<div>3</a>4</div>5</div>", "<a>1</a><div><a>2</a><div><a>3</a>4</div>5</div>"),
    ("<a href=x>1<p><a href=y>2", '<a href="x">1</a><p><a href="x"></a><a href="y">2</a></p>'),
    ("<ul><li><b>a<li>b</ul>c", "<ul><li><b>a</b></li><li><b>b</b></li></ul><b>c</b>"),
    ("<i><b>x</i>y</b>z", "<i><b>x</b></i><b>y</b>z"),
    ("<b><b><b><b>x</p><p>y</b></b></b></b>z", None),
    ("<p><b><b><b><b>x<p>y", "<p><b><b><b><b>x</b></b></b></b></p><p><b><b><b>y</b></b></b></p>"),
    ("<table>a<tr><td>b</td></tr></table>", "a<table><tbody><tr><td>b</td></tr></tbody></table>"),
    ("<table><tr>a<td>b</td>c</tr> </table>", "ac<table><tbody><tr><td>b</td></tr> </tbody></table>"),
    ("<table><b>x<tr><td>y</td></tr></table>z", "<b>x</b><table><tbody><tr><td>y</td></tr></tbody></table><b>z</b>"),
    ("<div><table><p>x</p><tr><td>y</table></div>", "<div><p>x</p><table><tbody><tr><td>y</td></tr></tbody></table></div>"),
    ("<table><form><input type=hidden name=h><tr><td>y</td></tr></form></table>",
     '<table><form></form><input type="hidden" name="h"><tbody><tr><td>y</td></tr></tbody></table>'),
    ("<table><td><b>x</td><td>y</td></table>", "<table><tbody><tr><td><b>x</b></td><td>y</td></tr></tbody></table>"),
    ("<b><table><td></b><i>q</table>r", "<b><table><tbody><tr><td><i>q</i></td></tr></tbody></table>r</b>"),
    ("<a><table><td><a><table></table><a></tr><a></table><b>X</b>C<a>Y", None),
    ("<p><i>a<!--c--></p><script>x</script>b", "<p><i>a<!--c--></i></p><script>x</script><i>b</i>"),
    ("<em>1<h2>2</em>3</h2>", "<em>1</em><h2><em>2</em>3</h2>"),
    ("<b>1<br>2<div>3<img>4</b>5</div>", "<b>1<br>2</b><div><b>3<img>4</b>5</div>"),
]


def written(node):
    if node.kind == "text":
        return node.text
    if node.kind == "raw":
        return node.text
    if node.kind == "comment":
        return f"<!--{node.text}-->"
    inner = "".join(map(written, node.children))
    if node.tag is None:
        return inner
    attrs = "".join(f' {k}="{v}"' for k, v in node.attrs)
    return f"<{node.tag}{attrs}>" + ("" if node.tag in markup._VOID else f"{inner}</{node.tag}>")


@pytest.mark.parametrize("case", range(len(CASES)))
def test_trees(case):
    html, want = CASES[case]
    assert want is None or written(build_tree(html)) == want
    nodes = _Nodes()
    nodes.add_page(html)
    check(nodes, written(build_tree(html)))


def check(nodes, want=None):
    """Positions, intervals, siblings and paths agree with each other, and with the tree written out."""
    rows, n = nodes.rows, len(nodes.rows)
    children = {}
    for at, r in enumerate(rows):
        pos, parent, depth, sib, type_ord, kind, tag, _, _, _, _, path, _, _, _ = r
        assert pos == at and parent < at and nodes.stops[at] < n
        own = children.setdefault(parent, [])
        assert sib == len(own)
        assert type_ord == (sum(rows[c][6] == tag for c in own) + 1 if kind == "el" else 0)
        own.append(at)
        assert path == ((*rows[parent][11], parent) if parent >= 0 else ()) and depth == len(path)
        if parent >= 0:
            assert at <= nodes.stops[parent] and nodes.stops[at] <= nodes.stops[parent]
    for own in children.values():
        els = [c for c in own if rows[c][5] == "el"]
        for c, following in zip(els, [*els[1:], -1]):
            assert nodes.next_els[c] == following

    def text(at):
        kind, tag, items, said, data = (rows[at][i] for i in (5, 6, 9, 10, 12))
        if kind == "comment":
            return f"<!--{data}-->"
        if kind != "el":
            return said
        attrs = "".join(f' {k}="{v}"' for k, v in items)
        return f"<{tag}{attrs}>" + ("" if tag in markup._VOID else "".join(map(text, children.get(at, ()))) + f"</{tag}>")

    if want is not None:
        assert "".join(map(text, children.get(-1, ()))) == want


def random_page(rng, tags, size=40):
    out = []
    for _ in range(rng.randrange(size)):
        tag = rng.choice(tags)
        out.append(rng.choice([f"<{tag}>", f"<{tag} class=k>", f"</{tag}>", f"</{tag}>", "x", " ", "<br>", "<!--c-->"]))
    return "".join(out)


def test_random_pages():
    rng = random.Random(5)
    tags = "a b i p div li ul table tr td tbody h2 span em button".split()
    for _ in range(1500):
        html = random_page(rng, tags)
        nodes = _Nodes()
        nodes.add_page(html)
        check(nodes, written(build_tree(html)) if walks_apart(html) else None)
        assert shown(written(build_tree(html))) == shown(html)


def shown(html):
    """Text without what foster parenting may move: the runs in any order."""
    return sorted(markup.re.sub(r"<[^>]*>", "", html).replace(" ", ""))


def walks_apart(html):
    nodes = _Nodes()
    try:
        nodes._walk(html)
    except _Misnested:
        return True
    return False


def test_well_nested_pages_are_the_same_both_ways():
    rng = random.Random(9)
    for _ in range(400):
        html = random_page(rng, "a b i p div li ul span em section".split(), 14)
        nodes = _Nodes()
        try:
            nodes._walk(html)
        except _Misnested:
            continue
        check(nodes, written(build_tree(html)))


def test_time_stays_in_proportion():
    import time

    def seconds(html):
        start = time.perf_counter()
        _Nodes().add_page(html)
        return time.perf_counter() - start

    for piece in ("<table><b>x</b>", "<p><b>x</p>y", "<table>x<tr><td>y</td></tr></table>", "<b><div>a</b>b</div>"):
        small, large = seconds(piece * 500), seconds(piece * 4000)
        assert large < 40 * max(small, 0.02), piece
    for i in range(3):
        loose = "<table>" + "<p>x</p>" * (4000 if i else 1000)
        assert seconds(loose) < 5


def test_active_elements_are_bounded():
    html = "<p>" + "".join(f"<b id={i}>" for i in range(3000)) + "</p>" + "<p>x</p>" * 20
    nodes = _Nodes()
    nodes.add_page(html)
    assert len(nodes.rows) < 3000 + 21 * 520
