"""Rules -> SQL text: the value of a field for one card (J, C4-C7)."""

from __future__ import annotations

from cardloom.functions import text as tx
from cardloom.functions.sql import filter_, lit, transform, with_value
from cardloom.functions.steps import apply_steps
from cardloom.operators import select as sel
from cardloom.operators.rules import Checked, Field, Joined, Pick


def _take(nodes: str, el: str, take: str) -> str:
    kind, _, arg = take.partition(":")
    if kind == "text":
        return sel.element_text(nodes, el)
    if kind == "attr":
        return sel.attribute(el, arg)
    if kind == "attr_or_text":
        return tx.first_non_blank(sel.attribute(el, arg), sel.text_of(nodes, el))
    if kind == "own":
        return sel.own_text(nodes, el)
    if kind == "visible":
        return sel.visible_text(nodes, el)
    if kind == "first_node":
        return sel.first_node_text(nodes, el)
    if kind == "without":
        return sel.text_without(nodes, el, arg)
    if kind == "inner_html":
        return sel.inner_html(nodes, el)
    if kind == "outer_html":
        return sel.outer_html(nodes, el)
    raise ValueError(f"unknown take {take!r}")


def _scope(nodes: str, card: str | None, scope: str) -> str | None:
    kind, _, css = scope.partition(":")
    if kind == "page":
        return None
    if kind == "card":
        return f"array({card})"
    if kind == "parent":
        return sel.parent(nodes, card)
    if kind == "closest":
        return sel.closest(nodes, card, css)
    if kind == "next":
        return sel.next_sibling(nodes, card, css)
    raise ValueError(f"unknown scope {scope!r}")


def holds(nodes: str, el: str, condition: tuple) -> str:
    """A condition of ``card_where`` / ``where`` on one element."""
    kind, *args = condition
    if kind == "has":
        return f"size({sel.find(nodes, el, args[0])}) > 0"
    if kind == "at_least":
        return f"size({sel.find(nodes, el, args[0])}) >= {args[1]}"
    if kind == "text_has":
        return f"contains({tx.clean(sel.element_text(nodes, el))}, {lit(args[0])})"
    if kind == "not_blank":
        return f"{pick_value(nodes, el, Pick(args[0]))} <> ''"
    if kind == "plain_text":
        text_only = with_value(
            tx.clean(sel.element_text(nodes, el)),
            lambda v: f"{v} <> '' AND length({v}) < {args[0]} AND NOT contains({v}, '@')",
        )
        return f"{text_only} AND size({sel.find(nodes, el, 'a')}) = 0"
    if kind == "id_lacks":
        return f"NOT contains(coalesce({el}.id, ''), {lit(args[0])})"
    raise ValueError(f"unknown condition {condition!r}")


def matches(nodes: str, card: str | None, pick: Pick) -> str:
    """The elements a pick refers to, in document order."""

    def below(roots: str | None, css: str) -> str:
        if roots is None:
            return sel.find(nodes, None, css)
        return f"flatten({transform(roots, lambda el: sel.find(nodes, el, css))})"

    if pick.scope == "card" and pick.css and not pick.inside:
        found = sel.find(nodes, card, pick.css)
    else:
        found = _scope(nodes, card, pick.scope)
        for css, n in pick.inside:
            found = f"slice({below(found, css)}, {n + 1}, 1)"
        if pick.css:
            found = below(found, pick.css)
    for condition in pick.where:
        found = filter_(found, lambda el: holds(nodes, el, condition))
    if pick.which == "first":
        return f"slice({found}, 1, 1)"
    if isinstance(pick.which, int):
        return f"slice({found}, {pick.which + 1}, 1)"
    return found


def pick_value(nodes: str, card: str | None, pick: Pick) -> str:
    if pick.take.startswith("attr:"):  # of the first match, whatever ``which`` says
        el = f"get({matches(nodes, card, pick)}, 0)"
        value = sel.attribute(el, pick.take.partition(":")[2])
        return tx.or_blank(apply_steps(tx.or_blank(value), pick.steps))
    if pick.css is None and pick.scope == "card" and not pick.where:
        return tx.or_blank(apply_steps(tx.or_blank(_take(nodes, card, pick.take)), pick.steps))
    texts = transform(matches(nodes, card, pick), lambda el: _take(nodes, el, pick.take))
    if pick.which == "first_text":
        value = f"get({filter_(texts, tx.not_blank)}, 0)"
    elif pick.which == "first_value":
        value = f"get({filter_(texts, lambda t: f'{t} IS NOT NULL')}, 0)"
    elif pick.which == "first_other":
        value = with_value(
            transform(texts, tx.clean),
            lambda ts: f"get({filter_(ts, lambda t: f'{t} <> get({ts}, 0)')}, 0)",
        )
    elif pick.which == "all":
        value = f"array_join({texts}, '')"
    else:
        value = f"get({texts}, 0)"
    return tx.or_blank(apply_steps(tx.or_blank(value), pick.steps))


def field_value(nodes: str, card: str | None, rule: Field | None) -> str:
    values = []
    for p in rule or ("",):
        if isinstance(p, str):
            values.append(lit(p))
        elif isinstance(p, Joined):
            parts = ", ".join(pick_value(nodes, card, q) for q in p.parts)
            values.append(tx.or_blank(apply_steps(f"concat_ws(' ', {parts})", p.steps)))
        elif isinstance(p, Checked):
            chosen = tx.first_non_blank(*[pick_value(nodes, card, q) for q in p.choices])
            values.append(tx.or_blank(apply_steps(chosen, p.steps)))
        else:
            values.append(pick_value(nodes, card, p))
    return values[0] if len(values) == 1 else tx.first_non_blank(*values)
