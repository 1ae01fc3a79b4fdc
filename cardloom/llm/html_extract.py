"""HTML extraction with wrappers inferred per host by alignment of token streams.

A page is a stream of start tags, end tags and texts. Streams of one host are aligned one after another, level
by level: equal tokens stay; texts become slots; tokens that one side lacks become optional; tokens that
repeat their neighbours become a repeated group, as they already do inside one page. The result is a
regular expression without unions over tokens, the host's wrapper, for instance
``html { head { title { # } } body { nav { ul { li+ { a { # } } } } article { h1 { # } p+ { # b? { # } } } } }``.

What stands in a slot is told from what the template repeats by aggregates over all pages of the host (is
the text always the same? how much is link text?). Wrapper and slots give the host's rule: the regions that
hold the main text (inside <article> or <main> where the host has them), the slots to skip. Pages that lack the region are read by a rule of their own.

Alignment needs each different stream of a host once; these are found by an aggregate, dealt out by salted
host, folded as a sorted stream with one wrapper in memory, and the salts' wrappers folded again.
"""

from __future__ import annotations

import html
import json
import re
import sys
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import shared_folder, small, stored

SALTS = 16
_LEVELS = 2000  # of a page that its stream describes; texts below are read all the same
_PERIOD = 6  # longest group of neighbours that is seen to repeat
#: A container holds the main text if it has this share of the page's varying text.
_SHARE = 0.7
#: A menu is a repeated group with at least this share of its text in links.
_LINKED = 0.9
#: Inside an article, a text is the template's if it is the same wherever it stands, on at least this share of the host's pages.
_COMMON = 0.5

# Fixed values of HTML
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style xmp iframe noembed noframes noscript template title textarea svg math".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split())
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split())
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
         "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
_SKIPPED = frozenset(
    "head nav footer aside form script style noscript template iframe svg math button select textarea input label dialog menu "
    "object embed applet audio video canvas map title noembed noframes xmp datalist fieldset search".split())
_SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_SKIPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menus topbar masthead footer sidebar aside widget widgets cookie cookies consent gdpr notice notices alert "
    "alerts popup modal overlay comment comments reply replies respond disqus share social related "
    "recommended breadcrumb breadcrumbs pagination pager subscribe subscription newsletter signup login search toolbar skip "
    "hidden".split())
#: Words that stand beside those and say nothing themselves.
_BOXES = frozenset(
    "site page main global header head body content contents area bar box block button buttons card cards column container entry "
    "form frame group holder home icon icons inner item items left link links list main media module outer panel post posts articles "
    "stories region right row section slot space stack strip tab tabs tag tags text thread title tools top bottom unit view wrap "
    "wrapper primary secondary sub mobile desktop sticky fixed dismissible message js wp id div el x s m l xl sm md lg".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TEXT_BLOCKS = _HEADINGS | frozenset("p blockquote pre li dt dd td th caption figure table".split())
_NO_MENU = _INLINE | _HEADINGS | frozenset("table thead tbody tfoot tr td th figure blockquote".split())  # links in these are content
_SKIPPED_ARTICLES = frozenset("ad advert comment promo related reply sponsored teaser".split())
_KEPT = frozenset("html body main article".split())  # names on these say nothing about what they hold

# A quote opens a value only after "="; one that never ends is part of an unquoted value. Possessive groups and the
# last ">" as the end of the search keep broken markup linear.
_TOKEN = re.compile(
    r"<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_TELLING = re.compile(r"class|id|role|style", re.I)  # also part of "hidden"
_HIDDEN = re.compile(r"(?i)(?:^|[\s\"'])hidden(?:[\s=/]|$)")
_STABLE = re.compile(r"[A-Za-z_-]+")
_NUMBER = re.compile(r"&#(?:([0-9]+)|[xX]([0-9a-fA-F]+));?")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def decoded(text: str) -> str:
    """Character references as the standard reads them; numbers beyond Unicode become U+FFFD."""
    if "&" not in text:
        return text
    long = lambda m: "�" if len((m[1] or m[2]).lstrip("0")) > 7 else m[0]
    return html.unescape(_NUMBER.sub(long, text))


def events(page: str) -> Iterator[tuple]:
    """The token stream, made well-formed: ("<", tag, name, skipped), (">", tag) and ("#", raw text)."""
    stack: list[str] = []
    open_tags: dict[str, int] = {}

    def close(count: int):
        for _ in range(count):
            tag = stack.pop()
            open_tags[tag] -= 1
            yield (">", tag)

    def above(inner, walls) -> int:
        """How many elements to close so that the outermost of ``inner`` above a wall is closed."""
        if not any(open_tags.get(t) for t in inner):
            return 0
        found = 0
        for depth, tag in enumerate(reversed(stack), 1):
            if tag in walls:
                break
            if tag in inner:
                found = depth
        return found

    at, end = 0, page.rfind(">") + 1
    while at < end:
        start = page.find("<", at)
        if start < 0 or start >= end:
            break
        if page.startswith("<!--", start):
            if start > at:
                yield ("#", page[at:start])
            stop = page.find("-->", start + 4)
            at = stop + 3 if stop >= 0 else len(page)
            continue
        m = _TOKEN.match(page, start, end)
        if m is None:  # a bare "<" is text
            yield ("#", page[at:start + 1])
            at = start + 1
            continue
        if start > at:
            yield ("#", page[at:start])
        at = m.end()
        if m[2] is None:
            continue
        if at == end and not _TOKEN.match(page, start):  # the input ends inside this tag
            at = len(page)
            break
        tag = m[2].lower()
        if m[1]:
            if open_tags.get(tag):
                yield from close(next(i for i, t in enumerate(reversed(stack), 1) if t == tag))
            continue
        if tag in _ENDS_P and open_tags.get("p"):
            yield from close(above({"p"}, {"table", "td", "th", "button"}))
        if tag in _ENDS:
            yield from close(above(*_ENDS[tag]))
        name, skipped = _named(tag, m[3]) if m[3] and _TELLING.search(m[3]) else (tag, tag in _SKIPPED)
        yield ("<", tag, name, skipped)
        if tag in _VOID or m[3].endswith("/") and tag in ("svg", "math"):
            yield (">", tag)
        elif tag in _RAW:
            yield (">", tag)
            stop = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            at = page.find(">", stop.end()) + 1 if stop else len(page)
            at = at or len(page)
        else:
            stack.append(tag)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    rest = page[at:]
    if rest:
        cut = re.search(r"<[/!a-zA-Z]", rest)  # the input ends inside a tag
        yield ("#", rest[:cut.start()] if cut else rest)
    yield from close(len(stack))


def _named(tag: str, written: str) -> tuple[str, bool]:
    """Name of an element in streams, and whether its kind is never main text."""
    attributes = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(written)}
    hidden = bool(_HIDDEN.search(written)) or attributes.get("aria-hidden") == "true" \
        or "display:none" in attributes.get("style", "").replace(" ", "")
    role = attributes.get("role", "").lower()
    classes = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    if tag == "article" and (kind := next((c.lower() for c in classes if c.lower() in _SKIPPED_ARTICLES), "")):
        return f"{tag}.{kind}", True
    if tag in _KEPT or role == "main":
        return "main" if role == "main" else tag, hidden
    telling = classes
    if tag in _TEXT_BLOCKS:  # ids of these are made from what they say
        telling = [] if tag in _HEADINGS else attributes.get("class", "").split()
    skipped = hidden or tag in _SKIPPED or role in _SKIPPED_ROLES or any(map(_tells, telling))
    stable = next((c for c in classes if _STABLE.fullmatch(c)), "")
    return (f"{tag}.{stable}" if stable and tag not in _INLINE else tag), skipped


def _tells(name: str) -> bool:
    """Whether a class or id names a kind that is never main text: by such a word, and beside it only words for boxes
    and places. ``cookie-banner`` and ``related-posts`` do, ``notice-period`` and ``related-work`` do not."""
    words = [w.lower() for w in _WORD.findall(name)]
    return any(w in _SKIPPED_NAMES for w in words) and all(w in _SKIPPED_NAMES or w in _BOXES for w in words)


# -- wrappers -----------------------------------------------------------------------------------------------
# A node is [name, optional, repeated, skipped, children]; a text slot is named "#", a group of neighbours "(".

def stream(page: str) -> list:
    """The folded stream of one page."""
    return described(page)[0]


def slots(page: str) -> dict[str, list]:
    """Path -> [characters, of them in links, the text's hash] of the texts right below each element."""
    return described(page)[1]


def described(page: str) -> tuple[list, dict[str, list]]:
    """(folded stream, slots) of one page."""
    from xxhash import xxh3_64_intdigest

    open_nodes: list[list] = [["", False, False, False, []]]
    found: dict[str, list] = {}
    path, links, depth = [""], 0, 0
    for e in events(page):
        if e[0] == "<":
            depth += 1
            links += e[1] == "a"
            path.append(_path(path[-1], e[2]))
            if depth <= _LEVELS:
                open_nodes.append([e[2], False, False, e[3], []])
        elif e[0] == ">":
            if depth <= _LEVELS:
                done = open_nodes.pop()
                if len(done[4]) > 1:
                    done[4] = folded(done[4])
                open_nodes[-1][4].append(done)
            depth -= 1
            links -= e[1] == "a"
            path.pop()
        else:
            text = e[1].strip()
            if text:
                slot = found.setdefault(path[-1], [0, 0, 0])
                slot[0] += len(text)
                slot[1] += len(text) if links else 0
                slot[2] = xxh3_64_intdigest(text, seed=slot[2] & 0xFFFFFFFF) >> 1
                if depth <= _LEVELS:
                    open_nodes[-1][4].append(["#", False, False, False, []])
    return folded(open_nodes[0][4]), found


def folded(nodes: list) -> list:
    """Neighbours that repeat become one repeated node or group."""
    out: list = []
    for node in nodes:
        if out and out[-1][0] == node[0] and node[0] != "(":
            optional = out[-1][1] and node[1]
            out[-1] = merged(out[-1], node)
            out[-1][1:3] = optional, out[-1][2] or node[0] != "#"
        else:
            out.append(node)
    for period in range(2, _PERIOD + 1):
        at = 0
        while at + 2 * period <= len(out):
            names = [n[0] for n in out[at:at + period]]
            if "(" in names or names != [n[0] for n in out[at + period:at + 2 * period]]:
                at += 1
                continue
            group, end = out[at:at + period], at + period
            while [n[0] for n in out[end:end + period]] == names:
                group = [merged(a, b) for a, b in zip(group, out[end:end + period])]
                end += period
            out[at:end] = [["(", False, True, False, group]]
            at += 1
    return out


def merged(a: list, b: list) -> list:
    return [a[0], a[1] or b[1], a[2] or b[2], a[3] and b[3], aligned(a[4], b[4])]


def aligned(a: list, b: list) -> list:
    """One level of two streams: what only one has is optional, and may then repeat its neighbour."""
    x, y = [n[0] for n in a], [n[0] for n in b]
    if x == y:
        return [merged(p, q) for p, q in zip(a, b)]
    out, i, j = [], 0, 0
    for p, q, size in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks():
        out += [[n[0], True, *n[2:]] for n in (*a[i:p], *b[j:q])]
        out += [merged(m, n) for m, n in zip(a[p:p + size], b[q:q + size])]
        i, j = p + size, q + size
    return folded(out)


def written(nodes: list) -> str:
    """A wrapper as text; written and read without recursion."""
    out, todo = [], [iter(nodes)]
    while todo:
        node = next(todo[-1], None)
        if node is None:
            todo.pop()
            if todo:
                out.append("}")
            continue
        out.append(node[0] + "?" * node[1] + "+" * node[2] + "!" * node[3])
        if node[4]:
            out.append("{")
            todo.append(iter(node[4]))
    return " ".join(out)


def read(text: str) -> list:
    levels: list[list] = [[]]
    for token in text.split():
        if token == "{":
            levels.append(levels[-1][-1][4])
        elif token == "}":
            levels.pop()
        else:
            name = token.rstrip("?+!")
            flags = token[len(name):]
            levels[-1].append([name, "?" in flags, "+" in flags, "!" in flags, []])
    return levels[0]


# -- rules --------------------------------------------------------------------------------------------------

_PAGES = "pages"  # not a path; its slot counts the pages of a host
_PATHS: dict[tuple[str, str], str] = {}


def _path(parent: str, name: str) -> str:
    """Name of a place in the tree, of fixed length however deep it is; remembered while there are few."""
    path = _PATHS.get((parent, name))
    if path is None:
        from xxhash import xxh3_64_hexdigest

        if len(_PATHS) > 100_000:
            _PATHS.clear()
        path = _PATHS[parent, name] = xxh3_64_hexdigest(f"{parent}/{name}")
    return path


def rule_of(wrapper: list, stats: dict[str, tuple]) -> dict[str, list[str]]:
    """{"main": paths of the regions with the main text, "skip": paths of template texts and menus inside them}.

    ``stats``: path -> (characters, of them in links, whether the text is the same on all of several pages, and that
    on enough pages of the host). <article> and <main> narrow the region; see ``_template`` for what goes inside them.
    """
    flat: list[tuple] = []  # (node, path, parent's place, skipped), parents first
    todo = [(n, "", -1, False) for n in reversed(wrapper)]
    while todo:
        node, parent, up, skipped = todo.pop()
        if node[0] == "#":
            continue
        path = parent if node[0] == "(" else _path(parent, node[0])
        skipped = skipped or node[3]
        flat.append((node, path, up, skipped))
        todo += [(n, path, len(flat) - 1, skipped) for n in reversed(node[4])]
    for tag in ("article", "main"):
        hits = [i for i, f in enumerate(flat) if f[0][0] == tag and not f[3]]
        outer = [i for i in hits if not any(j in hits for j in _ancestors(flat, i))]
        if outer:
            main = {flat[i][1] for i in outer}
            return {"main": sorted(main), **_template(flat, main, stats)}
    own = [stats.get(f[1], (0, 0, False))[:3] if f[0][0] != "(" else (0, 0, False) for f in flat]
    varied = [0 if f[3] or s[2] else s[0] for f, s in zip(flat, own)]
    total, linked = [s[0] for s in own], [s[1] for s in own]
    for i in range(len(flat) - 1, -1, -1):
        up = flat[i][2]
        if up >= 0:
            varied[up] += varied[i]
            total[up] += total[i]
            linked[up] += linked[i]
    skip = {f[1] for f, s in zip(flat, own) if s[2]}
    skip |= {f[1] for f, t, k in zip(flat, total, linked) if f[0][2] and t and k >= _LINKED * t and f[0][0].split(".")[0] not in _INLINE}
    best = -1
    for i, f in enumerate(flat):  # the deepest container that still holds the text
        if not f[3] and varied[i] and (best < 0 or best in _ancestors(flat, i)) and varied[i] >= _SHARE * (varied[0] if best < 0 else varied[best]) \
                and f[0][0] != "(" and not f[0][2] and f[0][0].split(".")[0] not in _INLINE | _HEADINGS | {"p", "li"}:
            best = i
    return {"main": [flat[best][1]] if best >= 0 else [], "skip": sorted(skip)}


def _template(flat: list[tuple], main: set[str], stats: dict[str, tuple]) -> dict[str, list[str]]:
    """{"skip": paths of template blocks and menus inside the regions, "mute": paths whose own text is the template's}.

    A block's text is its own and that of its inline elements: a sentence with a part that varies is no template,
    and a constant word inside one stays. If all text is constant or a menu, nothing tells the template: all stays.
    """
    up: dict[str, str] = {}  # places inside the regions, parents first
    name: dict[str, str] = {}
    menus: set[str] = set()
    beside: dict[str, list[str]] = {}  # place -> what stands in it, in order
    for node, path, above, skipped in flat:
        parent = flat[above][1] if above >= 0 else ""
        if skipped or path not in main and parent not in up:
            continue
        if node[0] != "(":
            beside.setdefault(parent, []).append(path)
        if node[0] == "(":
            menus |= {_path(path, n[0]) for n in node[4]}
            continue
        if path not in up:
            up[path], name[path] = "" if path in main and parent not in up else parent, node[0].split(".")[0]
        if node[2]:
            menus.add(path)
    total, linked, varied, flow, moving = ({p: 0 for p in up} for _ in range(5))
    for p in reversed(up):
        chars, links, _, common = stats.get(p, (0, 0, False, False))
        other = 0 if common else chars
        for sums, own in ((total, chars), (linked, links), (varied, other), (flow, chars), (moving, other)):
            sums[p] += own
            if up[p] and (sums in (total, linked, varied) or name[p] in _INLINE):
                sums[up[p]] += sums[p]
    skip, mute = set(), set()
    for p in up:
        if p in main or name[p] in _INLINE:
            continue
        if p in menus and name[p] not in _NO_MENU and total[p] and linked[p] >= _LINKED * total[p]:
            skip.add(p)
        elif flow[p] and not moving[p] and not (name[p] in _HEADINGS and _heads(p, beside.get(up[p], []), name, varied)):
            (mute if varied[p] else skip).add(p)
    gone: set[str] = set()
    for p in up:
        if p in skip or up[p] in gone:
            gone.add(p)
        elif name[p] in _INLINE and up[p] in mute:
            mute.add(p)
    if not any(0 < stats.get(p, (0,))[0] and not stats[p][3] for p in up if p not in gone):
        return {"skip": [], "mute": []}
    return {"skip": sorted(skip), "mute": sorted(mute)}


def _heads(heading: str, siblings: list[str], name: dict[str, str], varied: dict[str, int]) -> bool:
    """Whether varying text follows a heading before the next one: then it is no template, however often it repeats."""
    open_now = False
    for p in siblings:
        if name.get(p) in _HEADINGS:
            open_now = p == heading
        elif open_now and varied.get(p):
            return True
    return False


def _ancestors(flat: list[tuple], i: int) -> Iterator[int]:
    while (i := flat[i][2]) >= 0:
        yield i


def text_by(page: str, rule: dict[str, list[str]]) -> tuple[str, bool]:
    """The main text of a page, and whether the page has the rule's region."""
    main, skip, mute = set(rule["main"]), set(rule["skip"]), set(rule.get("mute", ()))
    path, inside, out = [""], ["" in main], [(0, 0, 0)]
    pieces: list[str] = []
    region = inside[0]
    for e in events(page):
        if e[0] == "<":
            _, tag, name, skipped = e
            here = _path(path[-1], name)
            within, (skips, header, heading) = inside[-1], out[-1]
            if not within and here in main and not skips:
                within = region = True
            path.append(here)
            inside.append(within)
            out.append((skips + bool(skipped or here in skip and here not in main), header + (tag == "header"), heading + (tag in _HEADINGS)))
            if tag not in _INLINE:
                pieces.append("\n")
        elif e[0] == ">":
            path.pop()
            inside.pop()
            out.pop()
            if e[1] not in _INLINE:
                pieces.append("\n")
        else:
            skips, header, heading = out[-1]
            if inside[-1] and not skips and (not header or heading) and path[-1] not in mute:
                pieces.append(_SPACE.sub(" ", decoded(e[1])))
    # inside a piece white space is one space already; what is left joins blocks
    return _SPACE.sub(" ", "".join(pieces)).strip(), region


def _by_or_whole(page: str, rule: dict[str, list[str]]) -> tuple[str, bool]:
    """As ``text_by``; an article of which template and menus are all keeps them."""
    text, region = text_by(page, rule)
    if region and not text and "mute" in rule:
        return text_by(page, {"main": rule["main"], "skip": []})
    return text, region


def main_text(page: str, rule: dict[str, list[str]] | None) -> str:
    if rule is not None:
        text, region = _by_or_whole(page, rule)
        if region:
            return text
    own, found = described(page)
    text, region = _by_or_whole(page, rule_of(own, {p: (s[0], s[1], False, False) for p, s in found.items()}))
    return text if region else text_by(page, {"main": [""], "skip": []})[0]


# -- the jobs -----------------------------------------------------------------------------------------------

def _with_host(pages: DataFrame, url_col: str):
    found = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return found.alias("host")


def _fold(shapes: DataFrame, *keys: str) -> DataFrame:
    """Align the streams of each key, in their order, with one wrapper in memory."""
    ordered = shapes.repartition(*keys).sortWithinPartitions(*keys, "shape")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(50_000)
        key, wrapper = None, []
        names = [*keys, "shape"]
        kinds = pa.schema([(n, pa.int32() if n == "salt" else pa.string()) for n in names])
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                if row[:-1] != key:
                    if key is not None:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, written(wrapper))))], kinds)
                    key, wrapper = row[:-1], read(row[-1])
                else:
                    wrapper = aligned(wrapper, read(row[-1]))
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, written(wrapper))))], kinds)

    kinds = ", ".join(f"{k} {'string' if k == 'host' else 'int'}" for k in keys)
    return ordered.select(*keys, "shape").mapInArrow(fold, f"{kinds}, shape string")


def wrappers(pages: DataFrame, folder: str, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper, rule) of every host, stored in ``folder``."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(50_000)
        for batch in batches:
            shapes, stats = [], []
            for page in batch.column(1):
                page = page.as_py()
                tokens, found = described(page)
                shapes.append(written(tokens))
                stats.append([{"path": p, "chars": s[0], "linked": s[1], "text": s[2]} for p, s in found.items()]
                             + [{"path": _PAGES, "chars": 0, "linked": 0, "text": 0}])
            kind = pa.list_(pa.struct([("path", pa.string()), ("chars", pa.int64()), ("linked", pa.int64()), ("text", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shapes, pa.string()), pa.array(stats, kind)], ["host", "shape", "stats"])

    given = pages.select(_with_host(pages, url_col), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    pages_seen = stored(given.mapInArrow(
        describe, "host string, shape string, stats array<struct<path:string,chars:long,linked:long,text:long>>"), folder, "described")
    shapes = pages_seen.select("host", "shape", F.pmod(F.xxhash64("shape"), F.lit(SALTS)).cast("int").alias("salt")).distinct()
    folded_hosts = _fold(_fold(shapes, "host", "salt"), "host")
    slot = pages_seen.select("host", F.explode("stats").alias("s")).groupBy("host", F.col("s.path").alias("path")).agg(
        F.sum("s.chars").alias("chars"), F.sum("s.linked").alias("linked"),
        ((F.min("s.text") == F.max("s.text")) & (F.count("*") > 2)).alias("fixed"), F.count("*").alias("n"))
    stats = slot.groupBy("host").agg(F.collect_list(F.struct("path", "chars", "linked", "fixed", "n")).alias("stats"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rules = []
            for w, t in zip(batch.column(1), batch.column(2).to_pylist()):
                least = _COMMON * next(s["n"] for s in t if s["path"] == _PAGES)
                slots = {s["path"]: (s["chars"], s["linked"], s["fixed"], s["fixed"] and s["n"] >= least) for s in t}
                rules.append(json.dumps(rule_of(read(w.as_py()), slots)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(rules, pa.string())], ["host", "wrapper", "rule"])

    joined = folded_hosts.withColumnRenamed("shape", "wrapper").join(stats, "host", "left")
    return stored(joined.mapInArrow(judge, "host string, wrapper string, rule string"), folder, "wrappers")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every page: its main text, blocks joined by one space.

    Null or empty html gives an empty text. Pages without a readable host are one host. Null ids and urls and
    repeated rows are kept; other columns are ignored; an empty table gives an empty table.
    """
    folder = shared_folder(pages.sparkSession)
    rules = wrappers(pages, folder, url_col, html_col).select("host", "rule")
    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
                         _with_host(pages, url_col))
    ruled = given.join(small(rules, 256), "host", "left").select("id", "url", "html", "rule")
    kinds = {f.name: f.dataType.simpleString() for f in ruled.schema}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(50_000)
        known: dict[str | None, dict | None] = {None: None}
        for batch in batches:
            texts = []
            for page, rule in zip(batch.column(2), batch.column(3).to_pylist()):
                if rule not in known:
                    known[rule] = json.loads(rule)
                texts.append(main_text(page.as_py(), known[rule]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["id", "url", "text"])

    return ruled.mapInArrow(extract, f"id {kinds['id']}, url {kinds['url']}, text string")
