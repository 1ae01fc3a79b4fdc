"""Trees of misnested pages, as the HTML standard builds them (B1).

The parser numbers nodes as it meets tags, which is right as long as formatting elements end inside the element they began
in and tables hold only table parts. A page on which it meets anything else is built here as a tree of objects first, where
nodes can still move: formatting elements that were cut off are opened again (the list of active formatting
elements), an end tag that crosses blocks splits its element (the adoption procedure), and what is loose in a table
goes in front of it (foster parenting). The finished tree is then numbered like any other page.
"""

from __future__ import annotations

# Element groups from the HTML standard.
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
SPECIAL = frozenset(
    "address applet area article aside base basefont bgsound blockquote body br button caption center col colgroup dd details dir "
    "div dl dt embed fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe img "
    "input keygen li link listing main marquee menu meta nav noembed noframes noscript object ol p param plaintext pre script "
    "search section select source style summary table tbody td template textarea tfoot th thead title tr track ul wbr xmp".split())
_MARKERS = frozenset("applet caption marquee object td template th".split())
_SCOPE = frozenset("applet caption html marquee object table td template th".split())
TABLE_CONTEXT = frozenset("table tbody tfoot thead tr".split())
IN_TABLE = frozenset("caption col colgroup script style table tbody td template tfoot th thead tr".split())
#: Inserted without opening formatting elements again.
_BLOCKS = SPECIAL - frozenset("applet area br button embed img input keygen marquee object select wbr".split())
_MOST_ROUNDS, _MOST_KEPT = 8, 3
_MOST_ACTIVE = 512  # as deep as browsers nest elements


class Node:
    """An element, or a run of text, raw text or a comment."""

    __slots__ = ("kind", "tag", "attrs", "text", "children", "parent", "start", "inner", "inner_end", "outer_end", "open")

    def __init__(self, kind, tag=None, attrs=(), text=None, start=0, inner=0):
        self.kind, self.tag, self.attrs, self.text = kind, tag, attrs, text
        self.children: list[Node] = []
        self.parent: Node | None = None
        self.start, self.inner, self.inner_end, self.outer_end = start, inner, inner, inner
        self.open = False

    def add(self, node: Node, before: Node | None = None) -> None:
        if node.parent is not None:
            node.parent.children.remove(node)
        at = len(self.children)
        if before is not None:  # an open table is found near the end
            at -= 1
            while self.children[at] is not before:
                at -= 1
        beside = self.children[at - 1] if at else None
        if node.kind == "text" and beside is not None and beside.kind == "text":
            beside.text += node.text  # runs that meet are one
            beside.outer_end = beside.inner_end = node.outer_end
            return
        self.children.insert(at, node)
        node.parent = self


class TreeBuilder:
    """Open elements, active formatting elements and the tree so far."""

    def __init__(self):
        self.root = Node("el")
        self.stack: list[Node] = [self.root]
        self.active: list[Node | None] = []  # None: a marker
        self.open_count: dict[str, int] = {}

    def _opened(self, node: Node) -> None:
        node.open = True
        self.open_count[node.tag] = self.open_count.get(node.tag, 0) + 1

    def _closed(self, node: Node, inner_end: int, outer_end: int) -> None:
        node.open, node.inner_end, node.outer_end = False, inner_end, outer_end
        self.open_count[node.tag] -= 1

    # --- inserting -------------------------------------------------------------------------------
    def _place(self, node: Node, target: Node | None = None, foster: bool = False) -> None:
        """Below the target, or in front of the innermost open table if nothing may stand there."""
        target = target or self.stack[-1]
        if not (foster and target.tag in TABLE_CONTEXT):
            target.add(node)
            return
        for i in range(len(self.stack) - 1, 0, -1):
            table = self.stack[i]
            if table.tag == "table":
                if table.parent is not None:
                    table.parent.add(node, table)
                else:
                    self.stack[i - 1].add(node)
                return
        self.stack[0].add(node)

    def element(self, tag: str, attrs, start: int, inner: int, stays_open: bool) -> Node:
        """A start tag; what it ends has been ended by the caller."""
        foster = tag not in IN_TABLE
        if tag in FORMATTING:
            if tag == "a" and any(n is not None and n.tag == "a" for n in self._since_marker()):
                self.end_formatting("a", start, start)
                stale = next((n for n in reversed(self._since_marker()) if n.tag == "a"), None)
                if stale is not None:
                    self.active.remove(stale)
                    if stale.open:
                        self.stack.remove(stale)
                        self._closed(stale, start, start)
            self.reopen(start)
        elif tag not in _BLOCKS:
            self.reopen(start)
        node = Node("el", tag, attrs, None, start, inner)
        self._place(node, None, foster)
        if stays_open:
            self.stack.append(node)
            self._opened(node)
            if tag in FORMATTING:
                alike = [n for n in self._since_marker() if n.tag == tag and dict(n.attrs) == dict(attrs)]
                if len(alike) >= _MOST_KEPT:
                    self.active.remove(alike[0])
                elif len(self._since_marker()) >= _MOST_ACTIVE:
                    self.active.remove(self._since_marker()[0])
                self.active.append(node)
            elif tag in _MARKERS:
                self.active.append(None)
        return node

    def run(self, kind: str, text: str, start: int, end: int) -> None:
        """Text, raw text or a comment."""
        node = Node(kind, None, (), text, start, end)
        loose = kind == "text" and bool(text.strip(" \t\n\f\r"))
        if kind == "text" and (loose or self.stack[-1].tag not in TABLE_CONTEXT):
            self.reopen(start)
        self._place(node, None, loose)

    # --- formatting elements ---------------------------------------------------------------------
    def _since_marker(self) -> list[Node]:
        for i in range(len(self.active) - 1, -1, -1):
            if self.active[i] is None:
                return self.active[i + 1:]
        return list(self.active)

    def reopen(self, at: int) -> None:
        """Open again the formatting elements that ended with the element around them."""
        closed = []
        for node in reversed(self._since_marker()):
            if node.open:
                break
            closed.append(node)
        for node in reversed(closed):
            again = Node("el", node.tag, node.attrs, None, at, at)
            self._place(again, None, True)
            self.stack.append(again)
            self._opened(again)
            self.active[self.active.index(node)] = again

    def _clear_to_marker(self) -> None:
        while self.active and self.active.pop() is not None:
            pass

    def _in_scope(self, node: Node) -> bool:
        for other in reversed(self.stack[1:]):
            if other is node:
                return True
            if other.tag in _SCOPE:
                return False
        return False

    # --- ending ----------------------------------------------------------------------------------
    def close_to(self, level: int, inner_end: int, outer_end: int) -> None:
        """End the open elements from ``level`` of the stack (without the root) up."""
        while len(self.stack) - 1 > level:
            node = self.stack.pop()
            self._closed(node, inner_end, outer_end if len(self.stack) - 1 == level else inner_end)
            if node.tag in _MARKERS:
                self._clear_to_marker()

    def end_formatting(self, tag: str, inner_end: int, outer_end: int) -> bool:
        """The end tag of a formatting element; False if it is to be treated as any other."""
        if self.stack[-1].tag == tag and self.stack[-1] not in self.active:
            self.close_to(len(self.stack) - 2, inner_end, outer_end)
            return True
        for _ in range(_MOST_ROUNDS):
            subject = next((n for n in reversed(self._since_marker()) if n.tag == tag), None)
            if subject is None:
                return False
            if not subject.open:
                self.active.remove(subject)
                return True
            if not self._in_scope(subject):
                return True
            at = self.stack.index(subject)
            block = next((n for n in self.stack[at + 1:] if n.tag in SPECIAL), None)
            if block is None:
                self.close_to(at - 1, inner_end, outer_end)
                self.active.remove(subject)
                return True
            self._adopt(subject, block, inner_end)
        return True

    def _adopt(self, subject: Node, block: Node, at: int) -> None:
        """Split ``subject`` at ``block``, which stands inside it."""
        around = self.stack[self.stack.index(subject) - 1]
        mark = self.active.index(subject)
        last, level, n = block, self.stack.index(block), 0
        while True:
            n += 1
            level -= 1
            node = self.stack[level]
            if node is subject:
                break
            if n > _MOST_KEPT and node in self.active:
                where = self.active.index(node)
                mark -= where < mark
                del self.active[where]
            if node not in self.active:
                del self.stack[level]
                self._closed(node, at, at)
                continue
            copy = Node("el", node.tag, node.attrs, None, at, at)
            self._closed(node, at, at)
            self._opened(copy)
            self.active[self.active.index(node)] = self.stack[level] = copy
            if last is block:
                mark = self.active.index(copy) + 1
            copy.add(last)
            last = copy
        if last.parent is not None:
            last.parent.children.remove(last)
            last.parent = None
        self._place(last, around, True)
        copy = Node("el", subject.tag, subject.attrs, None, at, at)
        for child in block.children:
            child.parent = copy
        copy.children, block.children = block.children, []
        block.add(copy)
        where = self.active.index(subject)
        del self.active[where]
        self.active.insert(mark - (where < mark), copy)
        self._closed(subject, at, at)
        self._opened(copy)
        self.stack.remove(subject)
        self.stack.insert(self.stack.index(block) + 1, copy)
