"""The text steps a rule may name, so that rules stay plain data."""

from __future__ import annotations

from cardloom.functions import text, urls
from cardloom.functions.sql import lit, with_value

STEPS = {
    "clean": text.clean,
    "trim": text.trim,
    "drop_quotes": text.drop_quotes,
    "drop_nbsp": text.drop_nbsp,
    "remove_first": text.remove_first,
    "replace_first": text.replace_first,
    "strip_mailto": text.strip_mailto,
    "strip_tags": text.strip_tags,
    "before_comma": text.before_comma,
    "second_comma_part": text.second_comma_part,
    "after_first_comma": text.after_first_comma,
    "before_dash": text.before_dash,
    "after_dash": text.after_dash,
    "role_of": text.role_of,
    "holder_of": text.holder_of,
    "first_segment": text.first_segment,
    "last_html_line": text.last_html_line,
    "line": text.line,
    "find_email": lambda x: with_value(x, text.find_email),
    "drop_emails": lambda x: with_value(x, text.drop_emails),
    "handler_id": text.handler_id,
    "joined_address": text.joined_address,
    "if_address": text.if_address,
    "real_link": text.real_link,
    # J32 with the base as a constant of the rule; a missing link stays missing
    "prefix": urls.prefixed,
    "prefix_unless_absolute": urls.with_prefix,
    "resolve": lambda x, base: urls.resolve(x, lit(base)),
    "query_value": lambda x, key: f"regexp_extract({x}, {lit(rf'[?&]{key}=([^&#]*)')}, 1)",
}


def apply_steps(value: str, steps: tuple) -> str:
    """Run a step list: a step is a name, or a tuple of a name and its arguments."""
    for step in steps:
        name, *args = (step,) if isinstance(step, str) else step
        value = STEPS[name](value, *args)
    return value
