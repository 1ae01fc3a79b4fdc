"""Helpers for writing Spark SQL expressions as text.

The rule sets expand to some thousands of operators.  Built one ``Column`` at a time, that many
driver round trips take longer than the query; as text, a whole rule set is one ``F.expr`` call.
All functions of this package therefore take and give SQL expression text, to be used with
``F.expr``, ``selectExpr`` or ``spark.sql``.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

_names = count()


def lit(value: str | int | bool | None) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _lambda(fn: Callable[..., str], arity: int = 1) -> str:
    names = [f"v{next(_names)}" for _ in range(arity)]
    head = names[0] if arity == 1 else "(" + ", ".join(names) + ")"
    return f"{head} -> {fn(*names)}"


def filter_(array: str, fn: Callable[[str], str]) -> str:
    return f"filter({array}, {_lambda(fn)})"


def filter_at(array: str, fn: Callable[[str, str], str]) -> str:
    """Filter with the 0-based index as second argument."""
    return f"filter({array}, {_lambda(fn, 2)})"


def transform(array: str, fn: Callable[[str], str]) -> str:
    return f"transform({array}, {_lambda(fn)})"


def transform_at(array: str, fn: Callable[[str, str], str]) -> str:
    """Transform with the 0-based index as second argument."""
    return f"transform({array}, {_lambda(fn, 2)})"


def exists(array: str, fn: Callable[[str], str]) -> str:
    return f"exists({array}, {_lambda(fn)})"


def aggregate(array: str, start: str, merge: Callable[[str, str], str], finish: Callable[[str], str]) -> str:
    return f"aggregate({array}, {start}, {_lambda(merge, 2)}, {_lambda(finish)})"


def with_value(value: str, fn: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and use it several times."""
    return f"get(transform(array({value}), {_lambda(fn)}), 0)"


def case(*branches: tuple[str, str], otherwise: str | None = None) -> str:
    whens = " ".join(f"WHEN {test} THEN {value}" for test, value in branches)
    tail = "" if otherwise is None else f" ELSE {otherwise}"
    return f"CASE {whens}{tail} END"


def concat(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def true_only(test: str) -> str:
    """NULL counts as false."""
    return f"coalesce({test}, false)"


def one_of(value: str, options) -> str:
    return f"{value} IN ({', '.join(lit(o) for o in options)})"
