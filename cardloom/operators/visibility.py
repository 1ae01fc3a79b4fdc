"""Which nodes of a page are not shown (B29): ``hidden``, inline style and the page's own style rules.

Rules are matched by posting lists; their declarations of ``display`` and ``visibility`` are weighed as in style sheets, and
the outcome is carried down the tree once. Rules inside ``@media`` and the like, and selectors that ``select.selector``
cannot read (``:hover``, ``::before``), change nothing.
"""

from __future__ import annotations

import re

from cardloom.operators.postings import Postings, compiled, names_of

SHOWN, NOT_DISPLAYED, INVISIBLE = 0, 1, 2

_MAY_HIDE = re.compile(r"hidden|display|visibility", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_DECLARED = re.compile(r"(?:^|[;{\s])(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)


def may_hide(html: str) -> bool:
    """Whether anything in the markup can hide something."""
    return _MAY_HIDE.search(html) is not None


def _declarations(text: str) -> list[tuple[str, str, bool]]:
    return [(name.lower(), value.lower(), bool(important)) for name, value, important in _DECLARED.findall(text)]


def _rules(sheet: str):
    """(selectors, declarations) of the rules at the top level of a sheet."""
    sheet, at = _COMMENT.sub(" ", sheet), 0
    while True:
        opened = sheet.find("{", at)
        if opened < 0:
            return
        head = sheet[at:opened].rsplit(";", 1)[-1].strip()
        depth, end = 1, opened + 1
        while depth and end < len(sheet):
            brace = re.compile(r"[{}]").search(sheet, end)
            if not brace:
                end = len(sheet)
                break
            depth += 1 if brace[0] == "{" else -1
            end = brace.end()
        body = sheet[opened + 1:end - 1 if depth == 0 else end]
        if not head.startswith("@"):
            declared = _declarations(body)
            if declared:
                yield head, declared
        at = end


def _weight(chain: tuple) -> tuple[int, int, int]:
    """Specificity: ids, classes and attributes, tags."""
    ids = classes = tags = 0
    for _, names, tests in chain:
        ids += sum(kind == "id" for kind, _ in names)
        classes += sum(kind in ("class", "attr") for kind, _ in names) + sum(kind == "nth-of-type" for kind, *_ in tests)
        tags += sum(kind == "tag" for kind, _ in names)
        for kind, *args in tests:
            if kind in ("has", "not"):
                most = max(map(_weight, args[0]))
                ids, classes, tags = ids + most[0], classes + most[1], tags + most[2]
    return ids, classes, tags


class Sheets:
    """Style sheets and style attributes as they are read; pages of a directory repeat both, so a worker remembers those
    it met last, up to ``KNOWN`` characters of each."""

    KNOWN = 1 << 20

    def __init__(self):
        self.sheets: dict[tuple, tuple] = {}
        self.styles: dict[str, list] = {}
        self.sheet_chars = self.style_chars = 0

    def rules(self, sheets: tuple[str, ...]) -> tuple[list, set]:
        """(selector, its weight, declarations) of all rules in order, and the names that the selectors look up."""
        known = self.sheets.get(sheets)
        if known is None:
            rules = []
            for sheet in sheets:
                for head, declared in _rules(sheet):
                    for css in head.split(","):
                        try:
                            chains = compiled(css)
                        except ValueError:
                            continue
                        rules.append((chains, (0, *max(map(_weight, chains))), declared))
            known = rules, set().union(*[names_of(chains) for chains, *_ in rules])
            size = sum(map(len, sheets))
            if self.sheet_chars + size > self.KNOWN:
                self.sheets.clear()
                self.sheet_chars = 0
            if size <= self.KNOWN:
                self.sheets[sheets] = known
                self.sheet_chars += size
        return known

    def declarations(self, style: str) -> list[tuple[str, str, bool]]:
        known = self.styles.get(style)
        if known is None:
            known = _declarations(style)
            if self.style_chars + len(style) > self.KNOWN:
                self.styles.clear()
                self.style_chars = 0
            if len(style) <= self.KNOWN:
                self.styles[style] = known
                self.style_chars += len(style)
        return known


def hidden_nodes(nodes: list[tuple], stops: list[int], sheets: list[str], known: Sheets | None = None) -> dict[int, int]:
    """NOT_DISPLAYED or INVISIBLE for each position that is not SHOWN. ``nodes`` as in ``Postings``."""
    known = known or Sheets()
    rules, names = known.rules(tuple(sheets))
    # position -> property -> (weight, value); the weightier declaration wins, of equal ones the later
    said: dict[int, dict[str, tuple]] = {}

    def say(at: int, declared: list, weight: tuple) -> None:
        own = said.setdefault(at, {})
        for name, value, important in declared:
            if name not in own or own[name][0] <= (important, weight):
                own[name] = ((important, weight), value)

    if rules:
        page = Postings(nodes, stops, names)
        for chains, weight, declared in rules:
            for at in page.select(chains):
                say(at, declared, weight)
    for at, (_, _, element, *_, attrs) in enumerate(nodes):
        if element and attrs:
            for name, value in attrs:
                if name == "style":
                    say(at, known.declarations(value), (1, 0, 0, 0))
                elif name == "hidden":
                    say(at, [("display", "none", False)], (-1, 0, 0, 0))
    states: dict[int, int] = {}
    if not any(said.values()):
        return states
    seen: list[bool] = []
    for at, node in enumerate(nodes):
        parent = node[0]
        visible = seen[parent] if parent >= 0 else True
        gone = states.get(parent) == NOT_DISPLAYED
        own = said.get(at)
        if own:
            if "visibility" in own and own["visibility"][1] in ("hidden", "collapse", "visible"):
                visible = own["visibility"][1] == "visible"
            gone = gone or "display" in own and own["display"][1] == "none"
        seen.append(visible)
        if gone:
            states[at] = NOT_DISPLAYED
        elif not visible:
            states[at] = INVISIBLE
    return states
