"""Element selection over a page's ``nodes`` array.

A selector string becomes a predicate on one node (SQL text), so selection is ``filter`` over the
array.  Relations between elements use the preorder numbering: the subtree of an element is an
array slice, its ancestors are listed in the node (up to a depth), its next sibling is a stored position.

Where the selectors of a plan are known before pages are parsed (``marked``), the parser finds their matches by posting
lists (``operators.postings``). A selector then is a number: nodes list the numbers they match, and the page lists the
positions of each number's matches, so that finding them does not scan the page.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from cardloom.functions.sql import case, concat, exists, filter_, lit, one_of, transform, true_only

_SIMPLE = re.compile(
    r"(?P<tag>\*|[a-zA-Z][\w-]*)"
    r"|\.(?P<cls>(?:\\.|[\w-])+)"
    r"|\#(?P<id>(?:\\.|[\w-])+)"
    r"|\[\s*(?P<attr>[\w-]+)\s*(?:(?P<op>[\^*]?=)\s*(?:\"(?P<dq>[^\"]*)\"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s]+)))?\s*\]"
    r"|:(?P<pseudo>has|not|nth-of-type)\((?P<arg>[^()]*)\)"
)
_GAP = re.compile(r"\s*(>)\s*|\s+")


def selector(css: str) -> tuple:
    """Selector text -> alternatives, each a chain of (link to the left, conditions)."""
    chains, chain, conditions, link, at = [], [], [], " ", 0
    text = css.strip()
    while at < len(text):
        simple = _SIMPLE.match(text, at)
        if simple:
            conditions.append(_condition(simple))
            at = simple.end()
            continue
        chain.append((link, tuple(conditions)))
        conditions = []
        comma = re.compile(r"\s*,\s*").match(text, at)
        gap = comma or _GAP.match(text, at)
        if not gap:
            raise ValueError(f"cannot read selector {css!r} at {text[at:]!r}")
        if comma:
            chains.append(tuple(chain))
            chain, link = [], " "
        else:
            link = gap.group(1) or " "
        at = gap.end()
    chain.append((link, tuple(conditions)))
    chains.append(tuple(chain))
    if not all(conditions for chain in chains for _, conditions in chain):
        raise ValueError(f"selector {css!r} has an empty part")
    return tuple(chains)


#: For expressions, which name a selector many times. Workers use the function itself: a cache does not travel.
_selector = lru_cache(maxsize=None)(selector)


def _condition(m: re.Match) -> tuple:
    plain = lambda s: re.sub(r"\\(.)", r"\1", s)
    if m["tag"]:
        return ("tag", m["tag"].lower())
    if m["cls"]:
        return ("class", plain(m["cls"]))
    if m["id"]:
        return ("id", plain(m["id"]))
    if m["attr"]:
        value = next((v for v in (m["dq"], m["sq"], m["bare"]) if v is not None), None)
        return ("attr", m["attr"].lower(), m["op"], value)
    return (m["pseudo"], m["arg"].strip())


def _holds(node: str, nodes: str, condition: tuple) -> str:
    kind, *args = condition
    if kind == "tag":
        return f"{node}.kind = 'el'" if args[0] == "*" else f"{node}.tag = {lit(args[0])}"
    if kind == "class":
        return f"array_contains({node}.classes, {lit(args[0])})"
    if kind == "id":
        return f"{node}.id = {lit(args[0])}"
    if kind == "attr":
        name, op, wanted = args
        value = f"{node}.attrs[{lit(name)}]"
        if op is None:
            return f"{value} IS NOT NULL"
        if op == "=":
            return f"{value} = {lit(wanted)}"
        return f"{'startswith' if op == '^=' else 'contains'}({value}, {lit(wanted)})"
    if kind == "nth-of-type":
        return f"{node}.type_ord = {int(args[0])}"
    inner = matcher(args[0])
    if kind == "not":
        return f"NOT {true_only(inner(node, nodes))}"
    return exists(subtree(nodes, node), lambda below: true_only(inner(below, nodes)))


def _chain_holds(node: str, nodes: str, chain: tuple) -> str:
    link, conditions = chain[-1]
    tests = [_holds(node, nodes, c) for c in conditions]
    left = chain[:-1]
    if left:
        up = f"filter(array({node}.parent), up -> up >= 0)" if link == ">" else above(nodes, node)
        tests.append(true_only(exists(up, lambda pos: _chain_holds(f"get({nodes}, {pos})", nodes, left))))
    return " AND ".join(tests)


_numbers: dict[str, int] = {}  # of selectors that were written as numbers
_used: ContextVar[set[str] | None] = ContextVar("used", default=None)


@contextmanager
def marked() -> Iterator[set[str]]:
    """Inside, selectors are written as numbers, and gathered in the set given; pages must be parsed with them."""
    used: set[str] = set()
    token = _used.set(used)
    try:
        yield used
    finally:
        _used.reset(token)


def number(css: str) -> int:
    return _numbers.setdefault(css, len(_numbers))


def matcher(css: str) -> Callable[[str, str], str]:
    """Predicate ``(node, nodes) -> boolean`` for a selector (list)."""
    used = _used.get()
    if used is not None:
        used.add(css)
        return lambda node, nodes: f"array_contains({node}.marks, {number(css)})"
    chains = _selector(css)

    def test(node: str, nodes: str) -> str:
        return "(" + " OR ".join(f"({_chain_holds(node, nodes, c)})" for c in chains) + ")"

    return test


# --- moves between elements ----------------------------------------------------------------------
def subtree(nodes: str, el: str) -> str:
    """All nodes below ``el``: a slice, because the array is in preorder."""
    return f"slice({nodes}, {el}.pos + 2, {el}.stop - {el}.pos)"


def above(nodes: str, el: str) -> str:
    """Positions of the enclosing elements, outermost first: listed in the node, or, for nodes nested
    very deeply, those elements before it whose subtree reaches it."""
    before = filter_(f"slice({nodes}, 1, {el}.pos)", lambda n: f"{n}.stop >= {el}.pos AND {n}.kind = 'el'")
    return f"coalesce({el}.ancestors, {transform(before, lambda n: f'{n}.pos')})"


def find(nodes: str, el: str | None, css: str) -> str:
    """Matches below ``el`` (the whole page if None), in document order."""
    test = matcher(css)
    if el is None and _used.get() is not None:
        places = f"coalesce({nodes}_postings[{number(css)}], CAST(array() AS ARRAY<INT>))"
        return transform(places, lambda pos: f"get({nodes}, {pos})")
    return filter_(nodes if el is None else subtree(nodes, el), lambda n: test(n, nodes))


def children(nodes: str, el: str) -> str:
    """Child nodes, text runs included."""
    return filter_(subtree(nodes, el), lambda n: f"{n}.parent = {el}.pos")


def parent(nodes: str, el: str) -> str:
    """B26, as an array of at most one element."""
    return filter_(f"array(get({nodes}, {el}.parent))", lambda n: f"{n} IS NOT NULL")


def closest(nodes: str, el: str, css: str) -> str:
    """The nearest enclosing match, as an array of at most one element."""
    test = matcher(css)
    outward = transform(f"reverse({above(nodes, el)})", lambda pos: f"get({nodes}, {pos})")
    return f"slice({filter_(outward, lambda n: test(n, nodes))}, 1, 1)"


def next_sibling(nodes: str, el: str, css: str) -> str:
    """The following element sibling if it matches, as an array of at most one element."""
    test = matcher(css)
    return filter_(
        f"array(get({nodes}, {el}.next_el))", lambda n: f"{n} IS NOT NULL AND {test(n, nodes)}"
    )


def next_node(nodes: str, el: str) -> str:
    """The node right behind ``el``'s subtree if it is a sibling, else NULL."""
    behind = filter_(
        f"array(get({nodes}, {el}.stop + 1))", lambda n: f"{n}.parent = {el}.parent"
    )
    return f"get({behind}, 0)"


# --- what to read from an element ------------------------------------------------------------------
def text_of(nodes: str, el: str) -> str:
    """All text at and below a node. Only text runs have ``text``, and joining skips NULLs."""
    return f"concat(coalesce({el}.text, ''), array_join({subtree(nodes, el)}.text, ''))"


def element_text(nodes: str, el: str) -> str:
    """``text_of`` for a node known to be an element."""
    return f"array_join({subtree(nodes, el)}.text, '')"


def own_text(nodes: str, el: str) -> str:
    """Text runs directly in the element."""
    return f"array_join({children(nodes, el)}.text, '')"


def text_without(nodes: str, el: str, css: str) -> str:
    """Text below the element, leaving out sub-elements that match."""
    test = matcher(css)

    def outside(t: str) -> str:
        inside = exists(
            above(nodes, t),
            lambda pos: f"{pos} > {el}.pos AND {true_only(test(f'get({nodes}, {pos})', nodes))}",
        )
        return f"{t}.text IS NOT NULL AND NOT {inside}"

    return f"array_join({filter_(subtree(nodes, el), outside)}.text, '')"


def first_node_text(nodes: str, el: str) -> str:
    """Text of the first child node, NULL without children."""
    first = f"slice({children(nodes, el)}, 1, 1)"
    return f"get({transform(first, lambda n: text_of(nodes, n))}, 0)"


# Fixed value: elements that break a line of rendered text.
_LINE_BREAKS = (
    "br p div li ul ol h1 h2 h3 h4 h5 h6 table tr section article header footer dt dd"
).split()


def visible_text(nodes: str, el: str) -> str:
    """Text without scripts, styles and what is not shown; line-breaking elements count as a space. An element
    that is not displayed itself gives all its text, as there is no rendered one."""
    runs = filter_(subtree(nodes, el), lambda n: (
        f"({n}.kind = 'text' AND {n}.hidden = 0) OR ({one_of(f'{n}.tag', _LINE_BREAKS)} AND {n}.hidden <> 1)"))
    texts = transform(runs, lambda n: f"if({n}.kind = 'text', {n}.text, ' ')")
    return f"if({el}.hidden = 1, {element_text(nodes, el)}, array_join({texts}, ''))"


def attribute(el: str, name: str) -> str:
    """B22."""
    return f"{el}.attrs[{lit(name)}]"


# Elements without an end tag.
_VOID = "area base br col embed hr img input link meta param source track wbr".split()


def _escaped(x: str) -> str:
    """Text as it is written in markup."""
    for char, name in (("&", "&amp;"), ("\u00a0", "&nbsp;"), ("<", "&lt;"), (">", "&gt;")):
        x = f"replace({x}, {lit(char)}, {lit(name)})"
    return x


def _start_tag(n: str) -> str:
    value = lambda a: f"replace(replace(replace({a}.value, '&', '&amp;'), {lit(chr(160))}, '&nbsp;'), '\"', '&quot;')"
    attrs = transform(f"map_entries({n}.attrs)", lambda a: concat("' '", f"{a}.key", "'=\"'", value(a), "'\"'"))
    return concat("'<'", f"{n}.tag", f"array_join({attrs}, '')", "'>'")


def _end_tag(n: str) -> str:
    return f"if({one_of(f'{n}.tag', _VOID)}, '', concat('</', {n}.tag, '>'))"


def _written(n: str) -> str:
    """A node by itself: start tag, text or comment."""
    return case(
        (f"{n}.kind = 'el'", _start_tag(n)), (f"{n}.kind = 'text'", _escaped(f"{n}.text")),
        (f"{n}.kind = 'raw'", f"{n}.text"), otherwise=concat("'<!--'", f"{n}.data", "'-->'"),
    )


def inner_html(nodes: str, el: str) -> str:
    """What is below the element, written out from the tree: references decoded but for those that
    markup needs, attributes quoted, every end tag there. Behind a node stand the end tags of all
    elements of which it is the last."""

    def piece(n: str) -> str:
        around = f"concat({above(nodes, n)}, if({n}.kind = 'el', array({n}.pos), array()))"
        ending = filter_(around, lambda p: f"{p} > {el}.pos AND get({nodes}, {p}).stop = {n}.pos")
        ends = transform(f"reverse({ending})", lambda p: _end_tag(f"get({nodes}, {p})"))
        return concat(_written(n), f"array_join({ends}, '')")

    return f"array_join({transform(subtree(nodes, el), piece)}, '')"


def outer_html(nodes: str, el: str) -> str:
    """B24."""
    return concat(_start_tag(el), inner_html(nodes, el), _end_tag(el))


def has_class(el: str, name: str) -> str:
    """B28."""
    return true_only(f"array_contains({el}.classes, {lit(name)})")
