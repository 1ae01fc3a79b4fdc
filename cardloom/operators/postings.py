"""Which elements of a page match which selectors, from the page's posting lists.

While a page's nodes are at hand, positions are listed by tag, class, id and attribute. A selector begins with the
shortest list among the names its parts give, tests what is left on those elements only, and finds enclosing elements by
intervals: in document order an element is inside a match if the farthest end of the matches before it reaches it.
Selectors that name something the page does not have cost one look-up.
"""

from __future__ import annotations

from bisect import bisect_right

from cardloom.operators.select import selector


def compiled(css: str) -> tuple:
    """Selector -> alternatives; an alternative is a chain of (link to the left, names, tests)."""
    return tuple(tuple((link, *_split(conditions)) for link, conditions in chain) for chain in selector(css))


def _split(conditions: tuple) -> tuple[tuple, tuple]:
    """Names with a posting list each, and tests; a name is a test of its own where its list is not the one begun with."""
    names, tests = [], []
    for kind, *args in conditions:
        if kind in ("tag", "class", "id"):
            if args[0] != "*" or kind != "tag":
                names.append((kind, args[0]))
        elif kind == "attr":
            names.append(("attr", args[0]))
            if args[1] is not None:
                tests.append((kind, *args))
        elif kind in ("has", "not"):
            tests.append((kind, compiled(args[0])))
        else:
            tests.append((kind, int(args[0])))
    return tuple(names), tuple(tests)


def names_of(chains: tuple) -> set:
    """All names that a selector looks up."""
    out: set = set()
    for chain in chains:
        for _, names, tests in chain:
            out.update(names)
            for kind, *args in tests:
                if kind in ("has", "not"):
                    out |= names_of(args[0])
    return out


class Postings:
    """Posting lists of one page for the names asked for.

    ``nodes`` has (parent, type_ord, is element, tag, id, classes, attributes) of each position, ``stops`` the last
    position inside each.
    """

    def __init__(self, nodes: list[tuple], stops: list[int], names: set):
        self.nodes, self.stops = nodes, stops
        self.elements: list[int] = []
        self.lists: dict[tuple, list[int]] = {}
        self.found: dict[tuple, list[int]] = {}
        tags = {name for kind, name in names if kind == "tag"}
        classes = {name for kind, name in names if kind == "class"}
        ids = {name for kind, name in names if kind == "id"}
        attributes = {name for kind, name in names if kind == "attr"}
        for at, (_, _, element, tag, elem_id, own, attrs) in enumerate(nodes):
            if not element:
                continue
            self.elements.append(at)
            if tag in tags:
                self._add(("tag", tag), at)
            if elem_id in ids:
                self._add(("id", elem_id), at)
            for c in set(own) & classes if own else ():
                self._add(("class", c), at)
            for a, _ in attrs:
                if a in attributes:
                    self._add(("attr", a), at)

    def _add(self, name: tuple, at: int) -> None:
        self.lists.setdefault(name, []).append(at)

    def select(self, chains: tuple) -> list[int]:
        """Positions of the matches in document order."""
        known = self.found.get(chains)
        if known is None:
            parts = [self._chain(chain) for chain in chains]
            known = self.found[chains] = parts[0] if len(parts) == 1 else sorted(set().union(*parts))
        return known

    def _chain(self, chain: tuple) -> list[int]:
        for _, names, _ in chain:
            if any(name not in self.lists for name in names):
                return []
        matches: list[int] = []
        for n, (link, names, tests) in enumerate(chain):
            lists = sorted((self.lists[name] for name in names), key=len)
            at = lists[0] if lists else self.elements
            for other in map(set, lists[1:]):
                at = [p for p in at if p in other]
            for test in tests:
                at = self._passing(at, *test)
            if n:
                at = self._below(matches, at) if link == " " else self._children(matches, at)
            if not at:
                return []
            matches = at
        return matches

    def _children(self, matches: list[int], at: list[int]) -> list[int]:
        inside = set(matches)
        return [p for p in at if self.nodes[p][0] in inside]

    def _below(self, matches: list[int], at: list[int]) -> list[int]:
        out, reach, i, stops = [], -1, 0, self.stops
        for p in at:
            while i < len(matches) and matches[i] < p:
                reach = max(reach, stops[matches[i]])
                i += 1
            if reach >= p:
                out.append(p)
        return out

    def _passing(self, at: list[int], kind: str, *args) -> list[int]:
        nodes = self.nodes
        if kind == "attr":
            name, op, wanted = args
            value = lambda p: next(v for a, v in nodes[p][6] if a == name)
            if op == "=":
                return [p for p in at if value(p) == wanted]
            if op == "^=":
                return [p for p in at if value(p).startswith(wanted)]
            return [p for p in at if wanted in value(p)]
        if kind == "nth-of-type":
            return [p for p in at if nodes[p][1] == args[0]]
        inner = self.select(args[0])
        if kind == "not":
            inside = set(inner)
            return [p for p in at if p not in inside]
        return [p for p in at if bisect_right(inner, self.stops[p]) > bisect_right(inner, p)]
