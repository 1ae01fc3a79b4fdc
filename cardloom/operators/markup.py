"""Pages -> element arrays.

``parse_pages`` adds one column, ``nodes``: the page's elements and text runs in document
order (preorder).  Because the order is preorder, the subtree of a node is the contiguous slice
``nodes[pos + 1 .. stop]``.  Every selector, pick and pairing downstream is therefore a
higher-order function over one row: no join on ``page_id``, no shuffle, and a page with many
cards costs time proportional to its size instead of cards x nodes.

Only tokenising runs in Python (Arrow batches in, Arrow batches out); everything after it
stays in the JVM.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from html import unescape
from html.entities import html5
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cardloom.operators.postings import Postings, compiled, names_of
from cardloom.operators.select import number
from cardloom.operators.treebuild import FORMATTING, IN_TABLE, SPECIAL, TABLE_CONTEXT, Node, TreeBuilder
from cardloom.operators.visibility import Sheets, hidden_nodes, may_hide

NODE_TYPE = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),  # preorder position, 0-based
        T.StructField("stop", T.IntegerType()),  # last position inside the subtree
        T.StructField("parent", T.IntegerType()),  # -1 for roots
        T.StructField("depth", T.IntegerType()),
        T.StructField("sib", T.IntegerType()),  # ordinal among all child nodes, 0-based
        T.StructField("type_ord", T.IntegerType()),  # ordinal among same-tag siblings, 1-based; 0: no element
        T.StructField("next_el", T.IntegerType()),  # next element sibling, -1 if none
        T.StructField("kind", T.StringType()),  # el | text | raw (script, style) | comment
        T.StructField("tag", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text", T.StringType()),  # text and raw nodes only
        T.StructField("ancestors", T.ArrayType(T.IntegerType())),  # root first
        T.StructField("data", T.StringType()),  # what a comment says
        T.StructField("hidden", T.IntegerType()),  # 0 shown, 1 not displayed, 2 invisible (``visibility``)
        # place in the markup, in characters
        T.StructField("outer_start", T.IntegerType()),
        T.StructField("inner_start", T.IntegerType()),
        T.StructField("inner_end", T.IntegerType()),
        T.StructField("outer_end", T.IntegerType()),
    ]
)
NODES_TYPE = T.ArrayType(NODE_TYPE)
#: Nodes of pages parsed with selectors: the numbers of those that match.
MARKED_TYPE = T.ArrayType(T.StructType([*NODE_TYPE.fields, T.StructField("marks", T.ArrayType(T.IntegerType()))]))
POSTINGS_TYPE = T.MapType(T.IntegerType(), T.ArrayType(T.IntegerType()))

# Element groups from the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW_TEXT = frozenset("script style xmp iframe noembed noframes".split())
_ESCAPABLE = frozenset("title textarea".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section "
    "summary table ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TABLE_PARTS = frozenset("table caption colgroup tbody thead tfoot tr td th".split())
_SCOPE_WALLS = frozenset("td th caption table button template html".split())
# tag -> (open tags it ends, tags at which the search stops)
_IMPLIED_END = {
    "a": (frozenset(["a"]), frozenset("td th caption table template html".split())),
    "button": (frozenset(["button"]), frozenset("td th caption table template html".split())),
    "li": (frozenset(["li"]), frozenset("ul ol table td th".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "dd": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "option": (frozenset(["option"]), frozenset("select datalist optgroup".split())),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset("tr table".split())),
    "th": (frozenset(["td", "th"]), frozenset("tr table".split())),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset("tbody thead tfoot caption colgroup".split()), frozenset(["table"])),
    "thead": (frozenset("tbody thead tfoot caption colgroup".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot caption colgroup".split()), frozenset(["table"])),
}

# A quote opens a value only after "="; possessive groups keep the scan linear on broken markup.
_TOKEN = re.compile(
    r"<(?:!--(?P<comment>).*?(?:-->|\Z)"
    r"|(?P<decl>[!?][^>]*>)"
    r"|/(?P<close>[a-zA-Z][^\s/>]*+)[^>]*>"
    r"|(?P<open>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)>)",
    re.S,
)
_UNENDED = re.compile(r"<[!?/a-zA-Z]")
_ATTR = re.compile(
    r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S
)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in _RAW_TEXT | _ESCAPABLE}
_ROW_PARTS = frozenset(["tr", "td", "th"])
_ROW_GROUPS = frozenset(["tbody", "thead", "tfoot"])
_TABLE_WALL = frozenset(["table"])
_MAY_CLOSE = _CLOSES_P | _HEADINGS | frozenset(_IMPLIED_END)

# Nodes nested deeper than this do not list their ancestors, so hostile nesting cannot blow a page up;
# selectors then find the enclosing elements by their positions (``select.above``). Nothing is lost.
LISTED_DEPTH = 512


_NUMBER = re.compile(r"&#(?:([0-9]+)|[xX]([0-9a-fA-F]+));?")
_REFERENCE = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);?|([A-Za-z][A-Za-z0-9]*(?:;|(?![A-Za-z0-9=]))))")


def _attribute_text(value: str) -> str:
    """Decode references in an attribute: unlike in text, one without ``;`` counts only as a whole
    word, so ``?a=1&copy=2`` stays a query string."""
    return _REFERENCE.sub(lambda m: html5.get(m[1], m[0]) if m[1] else _text(m[0]), value)


def _text(value: str) -> str:
    """Decode references in text. A number with more digits than Unicode needs is the replacement
    character, found without turning it into a number."""
    if "&#" in value:
        value = _NUMBER.sub(lambda m: "\ufffd" if len((m[1] or m[2]).lstrip("0")) > 7 else m[0], value)
    return unescape(value)


def _attributes(raw: str) -> dict[str, str]:
    attrs: dict[str, str] = {}
    for name, dq, sq, bare in _ATTR.findall(raw):
        value = dq or sq or bare
        attrs.setdefault(name.lower(), _attribute_text(value) if "&" in value else value)
    return attrs


class _Misnested(Exception):
    """Nodes of this page have to move, so they cannot be numbered as they are met."""


def _level(tree: TreeBuilder, wanted: frozenset, walls: frozenset) -> int | None:
    """Place among the open elements of the innermost wanted one that is not behind a wall."""
    stack = tree.stack
    if not any(tree.open_count.get(tag) for tag in wanted):
        return None
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in wanted:
            return i - 1
        if stack[i].tag in walls:
            return None
    return None


_PARAGRAPH = frozenset(["p"])
_CELLS = frozenset(["td", "th", "caption"])


def _end_implied(tree: TreeBuilder, tag: str, at: int) -> None:
    """Elements that a start tag ends, and table parts that may be left out."""
    stack = tree.stack
    if tag in _CLOSES_P and (level := _level(tree, _PARAGRAPH, _SCOPE_WALLS)) is not None:
        tree.close_to(level, at, at)
    if tag in _HEADINGS and stack[-1].tag in _HEADINGS:
        tree.close_to(len(stack) - 2, at, at)
    if tag in _IMPLIED_END and tag != "a" and (level := _level(tree, *_IMPLIED_END[tag])) is not None:
        tree.close_to(level, at, at)
    if tag in _TABLE_PARTS and tag != "table" and (level := _level(tree, TABLE_CONTEXT, _CELLS)) is not None:
        tree.close_to(level + 1, at, at)  # what stands loose in the table ends
    if tag in _ROW_PARTS:
        if stack[-1].tag == "table":
            tree.element("tbody", (), at, at, True)
        if tag != "tr" and stack[-1].tag in _ROW_GROUPS:
            tree.element("tr", (), at, at, True)


def build_tree(html: str) -> Node:
    """The tree of a page of any nesting."""
    tree = TreeBuilder()
    tags_end = html.rfind(">") + 1
    unended = _UNENDED.search(html, tags_end)
    cursor, size = 0, len(html)
    last_text = unended.start() if unended else size
    while cursor < size:
        hit = _TOKEN.search(html, cursor, max(tags_end, cursor))
        stop = hit.start() if hit else max(last_text, cursor)
        if stop > cursor:
            tree.run("text", _text(html[cursor:stop]), cursor, stop)
        if not hit:
            break
        cursor = hit.end()
        group = hit.lastgroup
        if group == "attrs":
            tag, raw = hit["open"].lower(), hit["attrs"]
            attrs = tuple(_attributes(raw).items())
            _end_implied(tree, tag, stop)
            void = tag in _VOID or raw.endswith("/") and any(n.tag == "svg" for n in tree.stack)
            in_place = tree.stack[-1].tag in TABLE_CONTEXT and (
                tag == "form" or tag == "input" and dict(attrs).get("type", "").lower() == "hidden")
            if in_place:  # a form in a table holds nothing
                tree.stack[-1].add(Node("el", tag, attrs, None, stop, cursor))
                continue
            tree.element(tag, attrs, stop, cursor, not void)
            ending = None if void else _RAW_END.get(tag)
            if ending:
                tail = ending.search(html, cursor)
                inner_end, outer_end = (tail.start(), tail.end()) if tail else (size, size)
                if inner_end > cursor:
                    run = html[cursor:inner_end]
                    tree.stack[-1].add(Node("raw" if tag in _RAW_TEXT else "text", None, (), run if tag in _RAW_TEXT else _text(run), cursor, inner_end))
                tree.close_to(len(tree.stack) - 2, inner_end, outer_end)
                cursor = outer_end
        elif group == "close":
            tag = hit["close"].lower()
            if tag in FORMATTING and tree.end_formatting(tag, stop, cursor):
                continue
            walls = _TABLE_WALL if tag in _TABLE_PARTS else _SCOPE_WALLS
            level = _level(tree, frozenset([tag]), walls)
            if level is not None:
                tree.close_to(level, stop, cursor)
        elif group == "comment":
            ended = html.endswith("-->", stop, cursor)
            if not ended:
                cursor = size
            tree.run("comment", html[stop + 4:max(stop + 4, cursor - 3 if ended else cursor)], stop, cursor)
    tree.close_to(0, size, size)
    return tree.root


class _Nodes:
    """Columns of the node arrays of one Arrow batch, filled page by page.

    Values known when a node is met are kept as one tuple per node and transposed once per batch;
    positions that follow later (end of the subtree, next sibling) have lists of their own.
    """

    def __init__(self, sheets: Sheets | None = None) -> None:
        self.sheets = sheets or Sheets()
        self.rows: list[tuple] = []
        self.stops = array("i")
        self.next_els = array("i")
        self.inner_ends = array("i")
        self.outer_ends = array("i")
        self.page_offsets: list[int] = [0]
        self.hidden: dict[int, int] = {}  # of the few nodes that are not shown
        self.marks: list[list[int]] = []
        self.postings: list[list[tuple[int, list[int]]]] = []

    def add_page(self, html: str | None, selectors: tuple = ()) -> None:
        """``selectors``: (number, compiled selector) pairs, and all names they look up."""
        first = len(self.rows)
        if html:
            try:
                self._walk(html)
            except _Misnested:
                for column in (self.rows, self.stops, self.next_els, self.inner_ends, self.outer_ends):
                    del column[first:]
                self._number(build_tree(html))
            if may_hide(html):
                self._hide(first)
        self.page_offsets.append(len(self.rows))
        if selectors:
            self._mark(first, *selectors)

    def _number(self, root: Node) -> None:
        """Nodes of a finished tree in document order."""
        base = len(self.rows)
        # (node, ordinal, same-tag ordinal, position of the parent, depth, path), last one first; or a position that ends
        left: list = []

        def below(node, at, depth, path):
            counts: dict[str, int] = {}
            made = []
            for n, child in enumerate(node.children):
                of_type = 0
                if child.kind == "el":
                    of_type = counts[child.tag] = counts.get(child.tag, 0) + 1
                made.append((child, n, of_type, at, depth, path))
            left.extend(reversed(made))

        below(root, -1, 0, ())
        last_el: dict[int, int] = {}  # parent -> its last element so far
        while left:
            item = left.pop()
            if isinstance(item, int):
                self.stops[item] = len(self.rows) - base - 1
                continue
            node, n, of_type, parent, depth, path = item
            pos = len(self.rows) - base
            elem_id, classes, items = None, (), ()
            if node.kind == "el":
                if parent in last_el:
                    self.next_els[base + last_el[parent]] = pos
                last_el[parent] = pos
                attrs = dict(node.attrs)
                elem_id, classes, items = attrs.get("id"), attrs["class"].split() if "class" in attrs else (), attrs.items()
            said = node.text if node.kind == "comment" else None
            self.rows.append((pos, parent, depth, n, of_type, node.kind, node.tag, elem_id, classes, items,
                              None if said is not None else node.text, path, said, node.start, node.inner))
            self.stops.append(pos)
            self.next_els.append(-1)
            self.inner_ends.append(node.inner_end)
            self.outer_ends.append(node.outer_end)
            if node.children:
                left.append(base + pos)
                listed = path is not None and len(path) < LISTED_DEPTH
                below(node, pos, depth + 1, path + (pos,) if listed else None)

    def _of_page(self, first: int) -> tuple[list[tuple], list[int]]:
        return [(r[1], r[4], r[5] == "el", *r[6:10]) for r in self.rows[first:]], self.stops[first:].tolist()

    def _hide(self, first: int) -> None:
        rows = self.rows
        sheets = [r[10] for r in rows[first:] if r[5] == "raw" and rows[first + r[1]][6] == "style"]
        for at, state in hidden_nodes(*self._of_page(first), sheets, self.sheets).items():
            self.hidden[first + at] = state

    def _mark(self, first: int, numbered: list, names: set) -> None:
        rows, stops = self._of_page(first)
        page = Postings(rows, stops, names)
        marks: list[list[int]] = [[] for _ in rows]
        found = []
        for number, chains in numbered:
            places = page.select(chains)
            if places:
                found.append((number, places))
                for p in places:
                    marks[p].append(number)
        self.marks += marks
        self.postings.append(found)

    def _walk(self, html: str) -> None:
        rows, stops, next_els = self.rows, self.stops, self.next_els
        inner_ends, outer_ends = self.inner_ends, self.outer_ends
        base = len(rows)
        open_tags: list[str] = []
        # per open element: [position, children so far, last element child, same-tag counts, path]
        top: list = [-1, 0, -1, {}, ()]
        frames: list[list] = [top]
        open_count: dict[str, int] = {}  # an end tag that ends nothing is told without a search
        scope_p: list[int] = [-1]  # level of the open <p> in each nested scope

        def add(kind, tag, elem_id, classes, attrs, text, start, inner, data=None):
            pos = len(rows) - base
            if kind == "el":
                counts = top[3]
                type_ord = counts[tag] = counts.get(tag, 0) + 1
                if top[2] >= 0:
                    next_els[base + top[2]] = pos
                top[2] = pos
            else:
                type_ord = 0
            rows.append((pos, top[0], len(open_tags), top[1], type_ord, kind, tag, elem_id, classes,
                         attrs, text, top[4], data, start, inner))
            top[1] += 1
            stops.append(pos)
            next_els.append(-1)
            inner_ends.append(inner)
            outer_ends.append(inner)
            return pos

        def push(tag, pos):
            nonlocal top
            above = top[4]
            listed = above is not None and len(above) < LISTED_DEPTH
            if tag == "p":
                scope_p[-1] = len(open_tags)
            elif tag in _SCOPE_WALLS:
                scope_p.append(-1)
            open_tags.append(tag)
            open_count[tag] = open_count.get(tag, 0) + 1
            top = [pos, 0, -1, {}, above + (pos,) if listed else None]
            frames.append(top)

        def close_to(level, inner_end, outer_end, misnested=True):
            """End the open elements from ``level`` up; the lowest one owns the end tag."""
            nonlocal top
            last = len(rows) - base - 1
            if misnested and len(open_tags) > level + 1:
                inside = open_tags[level + 1:]
                if not FORMATTING.isdisjoint(inside) or open_tags[level] in FORMATTING and not SPECIAL.isdisjoint(inside):
                    raise _Misnested
            while len(open_tags) > level:
                tag = open_tags.pop()
                open_count[tag] -= 1
                if tag == "p":
                    scope_p[-1] = -1
                elif tag in _SCOPE_WALLS:
                    scope_p.pop()
                at = base + frames.pop()[0]
                stops[at] = last
                inner_ends[at] = inner_end
                outer_ends[at] = outer_end if len(open_tags) == level else inner_end
            top = frames[-1]

        def close_implied(tag, at):
            """Start tags that end open elements, and table parts that may be left out."""
            if tag in _CLOSES_P and scope_p[-1] >= 0:
                close_to(scope_p[-1], at, at)
            if tag in _HEADINGS and open_tags and open_tags[-1] in _HEADINGS:
                close_to(len(open_tags) - 1, at, at)
            rule = _IMPLIED_END.get(tag)
            if rule:
                ended, walls = rule
                some = any(open_count.get(t) for t in ended)
                for i in range(len(open_tags) - 1 if some else -1, -1, -1):
                    if open_tags[i] in ended:
                        close_to(i, at, at)
                        break
                    if open_tags[i] in walls:
                        break
                if tag in _ROW_PARTS and open_tags:
                    if open_tags[-1] == "table":
                        push("tbody", add("el", "tbody", None, (), (), None, at, at))
                    if tag != "tr" and open_tags[-1] in _ROW_GROUPS:
                        push("tr", add("el", "tr", None, (), (), None, at, at))

        # behind the last ">" no tag ends; what begins one there ends the page
        cursor, size = 0, len(html)
        tags_end = html.rfind(">") + 1
        unended = _UNENDED.search(html, tags_end)
        last_text = unended.start() if unended else size
        find_token = _TOKEN.search
        while cursor < size:
            hit = find_token(html, cursor, max(tags_end, cursor))
            stop = hit.start() if hit else max(last_text, cursor)
            if stop > cursor:
                run = html[cursor:stop]
                if open_tags and open_tags[-1] in TABLE_CONTEXT and not run.isspace():
                    raise _Misnested
                add("text", None, None, (), (), _text(run) if "&" in run else run, cursor, stop)
            if not hit:
                break
            cursor = hit.end()
            group = hit.lastgroup
            if group == "attrs":
                tag, raw_attrs = hit.group("open", "attrs")
                tag = tag.lower()
                elem_id, classes, items = None, (), ()
                if raw_attrs and not raw_attrs.isspace():
                    attrs = _attributes(raw_attrs)
                    elem_id = attrs.get("id")
                    if "class" in attrs:
                        classes = attrs["class"].split()
                    items = attrs.items()
                if tag in _MAY_CLOSE:
                    close_implied(tag, stop)
                if open_tags and open_tags[-1] in TABLE_CONTEXT and tag not in IN_TABLE:
                    raise _Misnested
                pos = add("el", tag, elem_id, classes, items, None, stop, cursor)
                if tag in _VOID or (raw_attrs.endswith("/") and "svg" in open_tags):
                    continue
                ending = _RAW_END.get(tag)
                push(tag, pos)
                if ending:
                    tail = ending.search(html, cursor)
                    inner_end, outer_end = (tail.start(), tail.end()) if tail else (size, size)
                    if inner_end > cursor:
                        run = html[cursor:inner_end]
                        if tag in _RAW_TEXT:
                            add("raw", None, None, (), (), run, cursor, inner_end)
                        else:
                            add("text", None, None, (), (), _text(run), cursor, inner_end)
                    close_to(len(open_tags) - 1, inner_end, outer_end)
                    cursor = outer_end
            elif group == "close":
                tag = hit["close"].lower()
                if open_tags and open_tags[-1] == tag:
                    close_to(len(open_tags) - 1, stop, cursor)
                    continue
                if not open_count.get(tag):
                    continue
                table_part = tag in _TABLE_PARTS
                for i in range(len(open_tags) - 1, -1, -1):
                    if open_tags[i] == tag:
                        close_to(i, stop, cursor)
                        break
                    if open_tags[i] in _SCOPE_WALLS and not (table_part and open_tags[i] != "table"):
                        break
            elif group == "comment":
                if not html.endswith("-->", stop, cursor):
                    cursor = size  # never ended
                said = html[stop + 4:max(stop + 4, cursor - 3 if html.endswith("-->", stop, cursor) else cursor)]
                add("comment", None, None, (), (), None, stop, cursor, said)
        close_to(0, size, size, False)

    def _hidden_to_arrow(self, n: int) -> pa.Array:
        states = np.zeros(n, np.int32)
        if self.hidden:
            states[list(self.hidden)] = list(self.hidden.values())
        return pa.array(states)

    def postings_to_arrow(self) -> pa.Array:
        sizes = lambda lists: pa.array(np.fromiter(chain((0,), accumulate(map(len, lists))), np.int32, len(lists) + 1))
        pairs = list(chain.from_iterable(self.postings))
        places = [p for _, p in pairs]
        lists = pa.ListArray.from_arrays(sizes(places), pa.array(list(chain.from_iterable(places)), pa.int32()))
        return pa.MapArray.from_arrays(sizes(self.postings), pa.array([n for n, _ in pairs], pa.int32()), lists)

    def to_arrow(self, marked: bool = False) -> pa.Array:
        n = len(self.rows)
        (pos, parent, depth, sib, type_ord, kind, tag, elem_id, classes, attrs, text, ancestors,
         data, outer_start, inner_start) = zip(*self.rows) if n else ((),) * 15
        ints = lambda values: pa.array(np.fromiter(values, np.int32, n))
        filled = lambda values: pa.array(np.frombuffer(values, np.int32)) if n else pa.array([], pa.int32())
        offsets = lambda lists: pa.array(
            np.fromiter(chain((0,), accumulate(map(len, lists))), np.int32, n + 1)
        )
        names, values = zip(*chain.from_iterable(attrs)) if any(attrs) else ((), ())
        columns = {
            "pos": ints(pos),
            "stop": filled(self.stops),
            "parent": ints(parent),
            "depth": ints(depth),
            "sib": ints(sib),
            "type_ord": ints(type_ord),
            "next_el": filled(self.next_els),
            "kind": pa.array(kind, pa.string()),
            "tag": pa.array(tag, pa.string()),
            "id": pa.array(elem_id, pa.string()),
            "classes": pa.ListArray.from_arrays(
                offsets(classes), pa.array(list(chain.from_iterable(classes)), pa.string())
            ),
            "attrs": pa.MapArray.from_arrays(
                offsets(attrs), pa.array(names, pa.string()), pa.array(values, pa.string())
            ),
            "text": pa.array(text, pa.string()),
            "ancestors": pa.ListArray.from_arrays(
                offsets([a or () for a in ancestors]),
                pa.array(list(chain.from_iterable(a or () for a in ancestors)), pa.int32()),
                mask=pa.array([a is None for a in ancestors], pa.bool_()),
            ),
            "data": pa.array(data, pa.string()),
            "hidden": self._hidden_to_arrow(n),
            "outer_start": ints(outer_start),
            "inner_start": ints(inner_start),
            "inner_end": filled(self.inner_ends),
            "outer_end": filled(self.outer_ends),
        }
        fields = NODE_TYPE.fieldNames()
        if marked:
            fields.append("marks")
            columns["marks"] = pa.ListArray.from_arrays(
                offsets(self.marks), pa.array(list(chain.from_iterable(self.marks)), pa.int32()))
        nodes = pa.StructArray.from_arrays([columns[f] for f in fields], names=fields)
        return pa.ListArray.from_arrays(pa.array(self.page_offsets, pa.int32()), nodes)


# An output batch is closed once it holds this much markup, so one task never buffers more than
# a few tens of MB of nodes however large the incoming Arrow batch is.
_FLUSH_CHARS = 2_000_000


def _parse_batches(html_col: str, kept: list[str], selectors: dict[str | None, tuple] | None = None,
                   by: str | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sheets = Sheets()
        for batch in batches:
            pages = batch.column(html_col)
            kinds = batch.column(by) if by else None
            first, chars, nodes = 0, 0, _Nodes(sheets)
            for i in range(len(pages)):
                html = pages[i].as_py()
                if selectors is None:
                    nodes.add_page(html)
                else:
                    nodes.add_page(html, selectors.get(kinds[i].as_py() if by else None, ([], set())))
                chars += len(html) if html else 0
                if chars >= _FLUSH_CHARS or i == len(pages) - 1:
                    part = batch.slice(first, i + 1 - first)
                    made = {"nodes": nodes.to_arrow()} if selectors is None else {
                        "nodes": nodes.to_arrow(True), "nodes_postings": nodes.postings_to_arrow()}
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + list(made.values()), names=kept + list(made))
                    first, chars, nodes = i + 1, 0, _Nodes(sheets)

    return run


def parse_pages(pages: DataFrame, html_col: str = "html", selectors: dict[str | None, Iterable[str]] | None = None,
                by: str | None = None) -> DataFrame:
    """B1. Add ``nodes`` to a page table.

    ``html`` is dropped: inner and outer HTML are written out from the nodes, so the markup is not
    carried twice.  The job is map-only.

    ``selectors`` are those of expressions written inside ``select.marked``: their matches are found while parsing. The
    column ``by`` tells which of them a page needs; without it they stand under None.
    """
    kept = [c for c in pages.columns if c != html_col]
    if selectors is None:
        schema = T.StructType([pages.schema[c] for c in kept] + [T.StructField("nodes", NODES_TYPE)])
        return pages.mapInArrow(_parse_batches(html_col, kept, None, None), schema)
    known = {css: compiled(css) for own in selectors.values() for css in own}
    needed = {
        kind: ([(number(css), known[css]) for css in sorted(own)], set().union(*[names_of(known[css]) for css in own]))
        for kind, own in selectors.items()
    }
    schema = T.StructType([pages.schema[c] for c in kept] + [T.StructField("nodes", MARKED_TYPE), T.StructField("nodes_postings", POSTINGS_TYPE)])
    return pages.mapInArrow(_parse_batches(html_col, kept, needed, by), schema)


def explode_nodes(parsed: DataFrame, *keys: str) -> DataFrame:
    """Row form of ``nodes``: one row per element or text run, for counting and row-wise work."""
    return parsed.select(*keys, F.inline("nodes"))
