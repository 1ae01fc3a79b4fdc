"""Page -> array of records, one function per way of laying out people on a page
(B27, B30, E5, E7, H1-H3, G2), as SQL text over the page's ``nodes``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from cardloom.functions import text as tx
from cardloom.functions.sql import (
    aggregate, case, filter_, filter_at, struct, transform, transform_at, with_value,
)
from cardloom.functions.steps import apply_steps
from cardloom.operators import select as sel
from cardloom.operators.fields import field_value, holds
from cardloom.operators.rules import RECORD_FIELDS, Profile

MAIL_LINK = "a[href^='mailto:']"


def record(card_ord: str, **values: str) -> str:
    return struct(card_ord=card_ord, **{f: values.get(f, "''") for f in RECORD_FIELDS})


def kept(rec: str, rule: tuple) -> str:
    """Which records stay."""
    kind, *args = rule
    if kind in ("all_of", "any_of"):
        return (" AND " if kind == "all_of" else " OR ").join(f"{rec}.{f} <> ''" for f in args)
    if kind == "person":
        return tx.is_person_name(f"{rec}.{args[0]}")
    if kind == "longer":
        return tx.longer_than(f"{rec}.{args[0]}", args[1])
    raise ValueError(f"unknown keep rule {rule!r}")


def first_of_each(records: str, *keys: str) -> str:
    """G2 within a page: keep the first record per key.

    Sorted by key and position, a record is a first one if its predecessor has another key; that
    is n log n per page instead of comparing all pairs.
    """
    keyed = transform(
        records,
        lambda r: struct(**{k: f"{r}.{k}" for k in keys}, card_ord=f"{r}.card_ord", rec=r),
    )

    def is_first(rows: str, r: str, i: str) -> str:
        same = " AND ".join(f"{r}.{k} = get({rows}, {i} - 1).{k}" for k in keys)
        return f"{i} = 0 OR NOT ({same})"

    firsts = with_value(
        f"array_sort({keyed})", lambda rows: filter_at(rows, lambda r, i: is_first(rows, r, i))
    )
    return transform(firsts, lambda r: f"{r}.rec")


# --- shapes --------------------------------------------------------------------------------------
def _cards_below(p: Profile, nodes: str, root: str | None, shared: dict[str, str]) -> str:
    found = sel.find(nodes, root, p.card)
    for condition in p.card_where:
        found = filter_(found, lambda c: holds(nodes, c, condition))
    return transform(
        found,
        lambda c: record(
            f"{c}.pos",
            **{f: field_value(nodes, c, rule) for f, rule in p.fields.items()},
            **shared,
        ),
    )


def cards(p: Profile, nodes: str) -> str:
    """B30; with a group (B27) the group's fields are read once and repeated on its cards."""
    if not p.group:
        return _cards_below(p, nodes, None, {})
    groups = transform(
        sel.find(nodes, None, p.group),
        lambda g: struct(
            el=g, **{f: field_value(nodes, g, rule) for f, rule in p.group_fields.items()}
        ),
    )
    rows = transform(
        groups,
        lambda g: _cards_below(p, nodes, f"{g}.el", {f: f"{g}.{f}" for f in p.group_fields}),
    )
    return f"flatten({rows})"


def zipped(p: Profile, nodes: str) -> str:
    """E5: two element lists paired by position, cut to the shorter."""

    def listed(css: str) -> str:
        return transform(
            sel.find(nodes, None, css),
            lambda el: struct(pos=f"{el}.pos", text=tx.clean(sel.element_text(nodes, el))),
        )

    pairs = f"arrays_zip({listed(p.blocks['name'])}, {listed(p.blocks['title'])})"
    full = filter_(pairs, lambda z: f"{z}.`0` IS NOT NULL AND {z}.`1` IS NOT NULL")
    return transform(
        full, lambda z: record(f"{z}.`0`.pos", name=f"{z}.`0`.text", job_title=f"{z}.`1`.text")
    )


def list_lengths(p: Profile, nodes: str) -> str:
    """E5: lengths of the two lists of a zipped page; different ones mean rows may have shifted."""
    return struct(
        names=f"size({sel.find(nodes, None, p.blocks['name'])})",
        titles=f"size({sel.find(nodes, None, p.blocks['title'])})",
    )


def _first_text(nodes: str, el: str, css: str) -> str:
    """Cleaned text of the first match, NULL if nothing matches."""
    first = f"slice({sel.find(nodes, el, css)}, 1, 1)"
    return f"get({transform(first, lambda m: tx.clean(sel.element_text(nodes, m)))}, 0)"


def _mail_address(nodes: str, el: str, finish) -> str:
    """Address of the first mail link, NULL if there is none."""
    first = f"slice({sel.find(nodes, el, MAIL_LINK)}, 1, 1)"
    address = transform(first, lambda a: finish(tx.strip_mailto(sel.attribute(a, "href"))))
    return f"get({address}, 0)"


# --- sequences of blocks -------------------------------------------------------------------------
# Blocks per inner fold. A fold copies its state at every step, so the state must stay small: slots
# are block numbers, and what has been emitted leaves the inner fold once per chunk.
_CHUNK = 256


def _state(out: str, **slots: str) -> str:
    return struct(**slots, out=out)


def run(rows: str, slots: dict[str, str], step) -> str:
    """The state behind all blocks of the array ``rows``, from the state ``slots`` before them, and what was emitted.

    ``step(acc, b)`` gives the next state and may append an entry made by ``_entry`` to ``out``.
    """

    def chunk(acc: str, first: str) -> str:
        inner = aggregate(
            f"slice({rows}, {first} + 1, {_CHUNK})",
            _state("''", **{s: f"{acc}.{s}" for s in slots}), step, lambda r: r,
        )
        return with_value(
            inner,
            lambda r: _state(f"concat({acc}.out, {r}.out)", **{s: f"{r}.{s}" for s in slots}),
        )

    firsts = (f"if(size({rows}) = 0, CAST(array() AS ARRAY<INT>),"
              f" sequence(0, size({rows}) - 1, {_CHUNK}))")
    return aggregate(firsts, _state("''", **slots), chunk, lambda acc: acc)


def entries(out: str) -> str:
    """What was emitted: arrays of block numbers."""
    return transform(filter_(f"split({out}, ' ')", lambda e: f"{e} <> ''"), lambda e: transform(
        f"split({e}, ':')", lambda n: f"CAST({n} AS INT)"))


def _fold(blocks: str, sequence: Sequence) -> str:
    """Read blocks in order with a few slots, each holding a block number or -1, and build a record of each entry."""
    empty = {s: "-1" for s in sequence.slots}
    return with_value(blocks, lambda rows: transform(
        entries(f"{run(rows, empty, sequence.step)}.out"),
        lambda ns: sequence.build(lambda k: f"get({rows}, get({ns}, {k}))")))


def _entry(acc: str, *numbers: str) -> str:
    """``out`` with one more entry."""
    return f"concat({acc}.out, concat_ws(':', {', '.join(numbers)}), ' ')"


def _filled(text: str, b: str) -> str:
    """Slot value: the block's number, or -1 if its text is blank."""
    return f"if({b}.{text} <> '', {b}.i, -1)"


@dataclass(frozen=True)
class Sequence:
    """A page read block by block: which elements are blocks, what is read from one, and how slots go on."""

    css: Callable[[Profile], str]
    block: Callable[[Profile, str, str], dict[str, str]]  # (profile, nodes, element) -> values
    slots: tuple[str, ...]
    step: Callable[[str, str], str]
    build: Callable[[Callable[[int], str]], str]  # from a function that gives an entry's k-th block

    def blocks(self, p: Profile, nodes: str) -> str:
        return transform_at(
            sel.find(nodes, None, self.css(p)),
            lambda b, i: struct(i=i, pos=f"{b}.pos", **self.block(p, nodes, b)),
        )


def _heading_text_block(p: Profile, nodes: str, b: str) -> dict[str, str]:
    return dict(heading=_first_text(nodes, b, p.blocks["heading"]), text=_first_text(nodes, b, p.blocks["text"]))


def _heading_text_step(acc: str, b: str) -> str:
    return case(
        (f"{b}.heading IS NOT NULL", _state(f"{acc}.out", name=_filled("heading", b))),
        (f"{acc}.name >= 0 AND {b}.text IS NOT NULL",
         _state(_entry(acc, f"{acc}.name", f"{b}.i"), name="-1")),
        otherwise=acc,
    )


def _heading_list_block(p: Profile, nodes: str, b: str) -> dict[str, str]:
    return dict(
        is_heading=f"coalesce({sel.matcher(p.blocks['heading_block'])(b, nodes)}, false)",
        is_list=f"coalesce({sel.matcher(p.blocks['list_block'])(b, nodes)}, false)",
        heading=_first_text(nodes, b, p.blocks["heading"]),
        email=_mail_address(nodes, b, tx.clean),
    )


def _heading_list_step(acc: str, b: str) -> str:
    complete = f"{b}.is_list AND {b}.email IS NOT NULL AND {acc}.name >= 0 AND {acc}.title >= 0"
    return case(
        (f"{b}.is_heading AND {b}.heading IS NULL", acc),
        (f"{b}.is_heading AND {acc}.name < 0",
         _state(f"{acc}.out", name=_filled("heading", b), title=f"{acc}.title")),
        (f"{b}.is_heading AND {acc}.title < 0",
         _state(f"{acc}.out", name=f"{acc}.name", title=_filled("heading", b))),
        (complete, _state(_entry(acc, f"{acc}.name", f"{acc}.title", f"{b}.i"), name="-1", title="-1")),
        (f"{b}.is_list", _state(f"{acc}.out", name="-1", title="-1")),
        otherwise=acc,
    )


def _slots_block(p: Profile, nodes: str, b: str) -> dict[str, str]:
    return dict(
        text=tx.clean(sel.element_text(nodes, b)),
        is_bold=f"size({sel.find(nodes, b, p.blocks['bold'])}) > 0",
        email=_mail_address(nodes, b, tx.trim),
    )


def _slots_step(acc: str, b: str) -> str:
    ready = f"{acc}.name >= 0 AND {acc}.email >= 0 AND {tx.is_job_text(f'{b}.text')}"
    return case(
        (f"{b}.is_bold", _state(f"{acc}.out", name=_filled("text", b), email=f"{acc}.email")),
        (f"{b}.email IS NOT NULL", _state(f"{acc}.out", name=f"{acc}.name", email=_filled("email", b))),
        (ready, _state(_entry(acc, f"{acc}.name", f"{b}.i", f"{acc}.email"), name="-1", email="-1")),
        otherwise=acc,
    )


SEQUENCES = {
    # H1: a heading block sets the name, the first paragraph block behind it emits and clears
    "heading_text": Sequence(
        lambda p: p.card, _heading_text_block, ("name",), _heading_text_step,
        lambda block: record(f"{block(1)}.pos", name=f"{block(0)}.heading", job_title=f"{block(1)}.text")),
    # H2: first and second non-blank heading are name and title; a list block emits and resets
    "heading_list": Sequence(
        lambda p: f"{p.blocks['heading_block']}, {p.blocks['list_block']}", _heading_list_block, ("name", "title"),
        _heading_list_step, lambda block: record(
            f"{block(2)}.pos", name=f"{block(0)}.heading", job_title=f"{block(1)}.heading", email=f"{block(2)}.email")),
    # H3: bold block -> name, mail block -> email, later job text -> title and emit; the slots clear only when a
    # record is emitted
    "slots": Sequence(
        lambda p: p.card, _slots_block, ("name", "email"), _slots_step,
        lambda block: record(
            f"{block(1)}.pos", name=f"{block(0)}.text", job_title=f"{block(1)}.text", email=f"{block(2)}.email")),
}


def _folded(shape: str) -> Callable[[Profile, str], str]:
    return lambda p, nodes: _fold(SEQUENCES[shape].blocks(p, nodes), SEQUENCES[shape])


def text_link(p: Profile, nodes: str) -> str:
    """A text run directly followed by a link; the run is the title, the link the person."""
    holders = sel.matcher(p.card)
    runs = filter_(
        nodes,
        lambda n: f"{n}.kind = 'text' AND "
        + with_value(f"get({nodes}, {n}.parent)", lambda up: holders(up, nodes)),
    )
    pairs = transform(
        runs,
        lambda t: struct(
            pos=f"{t}.pos", text=tx.clean(f"{t}.text"), link=sel.next_node(nodes, t)
        ),
    )
    return transform(
        filter_(pairs, lambda x: f"{x}.link.tag = 'a'"),
        lambda x: record(
            f"{x}.pos",
            name=tx.clean(sel.element_text(nodes, f"{x}.link")),
            job_title=f"{x}.text",
            email=tx.or_blank(tx.strip_mailto(sel.attribute(f"{x}.link", "href"))),
        ),
    )


SHAPES = {
    "cards": cards,
    "zip": zipped,
    "heading_text": _folded("heading_text"),
    "heading_list": _folded("heading_list"),
    "slots": _folded("slots"),
    "text_link": text_link,
}


def page_records(p: Profile, nodes: str) -> str:
    """All records of a page under one profile, filtered and deduplicated."""
    found = SHAPES[p.shape](p, nodes)
    if p.keep:
        found = filter_(found, lambda r: kept(r, p.keep))
    return first_of_each(found, "name", "job_title") if p.dedup else found


def detail_record(p: Profile, nodes: str, url: str) -> str:
    """The one record a detail page holds, under its lookup key."""
    values = {f: field_value(nodes, None, rule) for f, rule in p.lookup.fields.items()}
    return f"array({record('0', **values, lookup_key=apply_steps(url, p.lookup.key))})"
