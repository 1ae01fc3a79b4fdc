"""Text cleaning and splitting (J1-J24, J28-J31, J33, J35) and text predicates.

Arguments and results are SQL expression text, see ``functions.sql``.
"""

from __future__ import annotations

from cardloom.functions.sql import case, lit, true_only, with_value

# The whitespace class browsers use (Java's \s knows neither NBSP nor the BOM) and
# the patterns, phrases and key words that decide what counts as an email, a name or a job title.
SPACE = r"[\s\p{Z}\x{FEFF}]"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
INTRO_PHRASES = ["chicago christian", "three campuses", "made up of"]
JOB_KEYWORDS = ["principal", "teacher", "director", "manager", "coordinator"]
DEFAULT_PAGE_SIZE = 24
BREAKS = r"\r?\n|<br>|<br/>|  |—|–|\|"
ADDRESS_PARTS = rf"'([^']+)'{SPACE}*\+{SPACE}*'@'{SPACE}*\+{SPACE}*'([^']+)'"
LABEL_TOTAL = rf"(?i)of{SPACE}+(\d+)"
LABEL_SIZE = rf"(?i)showing{SPACE}+1{SPACE}+-{SPACE}+(\d+)"


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


# --- whitespace and removals -------------------------------------------------------------------
def clean(x: str) -> str:
    """Whitespace runs (NBSP and BOM included) become one space; ends trimmed."""
    return f"trim(regexp_replace({x}, {lit(SPACE + '+')}, ' '))"


def trim(x: str) -> str:
    """Trim only, inner whitespace kept."""
    return f"regexp_replace({x}, {lit(f'^{SPACE}+|{SPACE}+$')}, '')"


def drop_quotes(x: str) -> str:
    """J4."""
    return f"replace({x}, '\"', '')"


def drop_nbsp(x: str) -> str:
    """NBSP is deleted, not turned into a space."""
    return f"replace({x}, char(160), '')"


def replace_first(x: str, old: str, new: str) -> str:
    """Replace the first occurrence only (``new`` is plain text without ``$``)."""
    return f"regexp_replace({x}, {lit('(?s)^(.*?)' + _quoted(old))}, {lit('$1' + new)})"


def remove_first(x: str, label: str) -> str:
    """Delete the first occurrence of ``label``; later ones stay."""
    return replace_first(x, label, "")


def strip_mailto(href: str) -> str:
    """The query string stays."""
    return remove_first(href, "mailto:")


def strip_tags(html: str) -> str:
    """J15."""
    return f"regexp_replace({html}, '<[^>]+>', '')"


# --- splits ------------------------------------------------------------------------------------
def part(x: str, separator: str, n: int) -> str:
    """The n-th (0-based) piece between literal separators, NULL if there is none."""
    return f"get(split({x}, {lit(_quoted(separator))}), {n})"


def before_comma(x: str) -> str:
    """Everything up to the first comma."""
    return clean(part(x, ",", 0))


def second_comma_part(x: str) -> str:
    """Only the piece between the first and second comma."""
    return clean(part(x, ",", 1))


def after_first_comma(x: str) -> str:
    """All the rest, further commas included."""
    return clean(f"get(split({x}, ',', 2), 1)")


def _dash_part(x: str, n: int) -> str:
    return with_value(
        x, lambda v: case((f"contains({v}, '–')", part(v, "–", n)), otherwise=part(v, "-", n))
    )


def before_dash(x: str) -> str:
    """Split at the en dash, else at the hyphen."""
    return clean(_dash_part(x, 0))


def after_dash(x: str) -> str:
    return clean(_dash_part(x, 1))


def role_of(x: str, default: str = "Board Member") -> str:
    """``Role: Name``; the default when there is no colon."""
    return with_value(
        x, lambda v: case((f"contains({v}, ':')", clean(part(v, ":", 0))), otherwise=lit(default))
    )


def holder_of(x: str) -> str:
    """The name behind the colon, or the whole text."""
    return with_value(
        x, lambda v: case((f"contains({v}, ':')", clean(part(v, ":", 1))), otherwise=v)
    )


def first_segment(x: str) -> str:
    """The piece before a line break, ``<br>``, double space, dash or bar."""
    return f"get(split({x}, {lit(BREAKS)}), 0)"


def last_html_line(html: str) -> str:
    """The piece behind the last ``<br>``."""
    return f"try_element_at(split({html}, {lit(r'(?i)<br\s*/?>')}), -1)"


def line(x: str, n: int) -> str:
    """The n-th (0-based) line."""
    return f"get(split({x}, {lit(chr(10))}), {n})"


# --- finds -------------------------------------------------------------------------------------
def _if_at(x: str, found: str, otherwise: str) -> str:
    """Most texts hold no address; without an at sign the pattern need not run."""
    return f"if(contains({x}, '@'), {found}, {otherwise})"


def find_email(x: str) -> str:
    """First email address, '' if none."""
    return _if_at(x, f"regexp_extract({x}, {lit(EMAIL)}, 0)", "''")


def find_emails(x: str) -> str:
    """J16 for all addresses, in order."""
    return _if_at(x, f"regexp_extract_all({x}, {lit(EMAIL)}, 0)", "CAST(array() AS ARRAY<STRING>)")


def drop_emails(x: str) -> str:
    """J17."""
    return _if_at(x, f"regexp_replace({x}, {lit(EMAIL)}, '')", x)


def handler_id(handler: str) -> str:
    """Id inside an event handler string."""
    return f"regexp_extract({handler}, 'id=([A-Za-z0-9]+)', 1)"


def joined_address(handler: str) -> str:
    """``'a' + '@' + 'b'`` -> ``a@b``; '' if the handler has another form."""
    found = f"regexp_extract({handler}, {lit(ADDRESS_PARTS)}, 0)"
    return f"regexp_replace({found}, {lit(ADDRESS_PARTS)}, '$1@$2')"


def full_name(first: str, last: str) -> str:
    """J22."""
    return clean(f"concat_ws(' ', {first}, {last})")


# --- slugs -------------------------------------------------------------------------------------
def slug(name: str, joint: str = "_", strip_ends: bool = False) -> str:
    """Lower case, every run of other characters becomes ``joint``."""
    out = f"regexp_replace(lower({name}), '[^a-z0-9]+', {lit(joint)})"
    return f"regexp_replace({out}, {lit(f'^{joint}|{joint}$')}, '')" if strip_ends else out


def space_slug(name: str) -> str:
    """Only whitespace runs are replaced."""
    return f"lower(regexp_replace({name}, {lit(SPACE + '+')}, '_'))"


# --- numbers -----------------------------------------------------------------------------------
def int_text(x: str) -> str:
    """The leading integer as it is written, '' if there is none."""
    return f"regexp_extract({x}, {lit(rf'^{SPACE}*([+-]?\d+)')}, 1)"


def to_int(x: str) -> str:
    """Leading integer, NULL if there is none or it does not fit 64 bits."""
    return f"try_cast({int_text(x)} AS BIGINT)"


def is_number(x: str) -> str:
    """D13."""
    return true_only(f"{trim(x)} RLIKE {lit(r'^\d+$')}")


def label_total_text(label: str) -> str:
    return f"regexp_extract({label}, {lit(LABEL_TOTAL)}, 1)"


def label_total(label: str) -> str:
    """``... of 856 ...`` -> 856."""
    return f"try_cast({label_total_text(label)} AS BIGINT)"


def label_page_size(label: str, default: int = DEFAULT_PAGE_SIZE) -> str:
    """``showing 1 - 8 of ...`` -> 8."""
    found = f"regexp_extract({label}, {lit(LABEL_SIZE)}, 1)"
    return f"coalesce(try_cast({found} AS BIGINT), {default})"


def ceil_div(total: str, size: str) -> str:
    """J31; a page size of 0 gives NULL instead of an error."""
    return f"try_add({total} DIV nullif({size}, 0), CAST({total} % nullif({size}, 0) > 0 AS INT))"


# --- fallbacks and quoting ---------------------------------------------------------------------
def first_non_blank(*choices: str) -> str:
    """First value that is neither NULL nor '', else ''."""
    return f"coalesce({', '.join(f'''nullif({c}, '')''' for c in choices)}, '')"


def or_blank(x: str) -> str:
    """C4."""
    return f"coalesce({x}, '')"


def csv_field(x: str) -> str:
    """One always-quoted CSV field."""
    doubled = '""'
    return f"concat('\"', replace(coalesce({x}, ''), '\"', '{doubled}'), '\"')"


def mask_email(x: str) -> str:
    """Hide the user part of an address before data leaves the cluster."""
    return f"regexp_replace({x}, '^[^@]+', '***')"


# --- predicates --------------------------------------------------------------------------------
def not_blank(x: str) -> str:
    """Something is left after trimming."""
    return true_only(f"{trim(x)} <> ''")


def longer_than(x: str, n: int) -> str:
    """D5."""
    return true_only(f"length({x}) > {n}")


def is_person_name(x: str) -> str:
    """2..50 characters, holds whitespace, is not an introduction."""
    intro = "|".join(_quoted(p) for p in INTRO_PHRASES)
    return true_only(
        with_value(
            trim(x),
            lambda v: f"length({v}) BETWEEN 2 AND 50 AND {v} RLIKE {lit(SPACE)}"
            f" AND NOT lower({v}) RLIKE {lit(intro)}",
        )
    )


def is_job_text(x: str) -> str:
    """Short and holds a job key word."""
    return true_only(f"length({x}) < 100 AND {x} RLIKE {lit('(?i)' + '|'.join(JOB_KEYWORDS))}")


def has_at_sign(x: str) -> str:
    """D10."""
    return true_only(f"contains({x}, '@')")


def if_address(x: str) -> str:
    """The value if it looks like an address, else ''."""
    return f"regexp_extract({x}, '(?s)^.*@.*$', 0)"


def real_link(href: str) -> str:
    """NULL for a missing link and for ``#``."""
    return f"nullif(nullif({href}, '#'), '')"
