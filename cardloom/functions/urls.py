"""URL functions (J25-J27, J32) as SQL text.

Plain regular expressions: a malformed URL gives NULL, never an error.
"""

from __future__ import annotations

from cardloom.functions.sql import aggregate, case, concat, lit, with_value

# Host part of an http(s) URL, and the source id of a URL without one.
HOST = r"(?i)^https?://(?:[^/?#@\s]*@)?([^/?#:@\s%<>|^]+)(?::\d*)?(?:[/?#]|$)"
ORIGIN = r"(?i)^(https?://[^/?#]+)"
FOLDER = r"(?i)^(https?://[^/]+(?:/.*/|/)?)"
UNKNOWN_SOURCE = "unknown_school"


def host(url: str) -> str:
    return f"nullif(lower(regexp_extract({url}, {lit(HOST)}, 1)), '')"


def source_id(url: str) -> str:
    """``www.`` removed where it first occurs, then the first label of the host."""
    bare = f"regexp_replace({host(url)}, {lit(r'^(.*?)www\.')}, '$1')"
    return f"coalesce(split_part({bare}, '.', 1), {lit(UNKNOWN_SOURCE)})"


def page_url(base: str, page_no: str, query: str, suffix: str = "", bare_first: bool = True) -> str:
    """Page 1 is the bare URL if wanted; ``query`` is the text between base and number."""
    numbered = concat(base, lit(query), f"CAST({page_no} AS STRING)", lit(suffix))
    return case((f"{page_no} = 1", base), otherwise=numbered) if bare_first else numbered


def page_no_text(url: str, parameter: str) -> str:
    """The page number as it is written, '' if absent."""
    return f"regexp_extract({url}, {lit(rf'[?&]{parameter}=(\d+)')}, 1)"


def page_no(url: str, parameter: str) -> str:
    """J26 inverse, J27: the page number in a URL or link, NULL if absent."""
    return f"try_cast({page_no_text(url, parameter)} AS BIGINT)"


def origin(url: str) -> str:
    return f"nullif(regexp_extract({url}, {lit(ORIGIN)}, 1), '')"


def _fold_dots(path: str) -> str:
    """Resolve ``.`` and ``..`` segments of a path."""
    folded = aggregate(
        f"split({path}, '/')",
        "CAST(array() AS ARRAY<STRING>)",
        lambda done, part: case(
            (f"{part} = '.'", done),
            (f"{part} = '..'", f"slice({done}, 1, greatest(size({done}) - 1, 1))"),
            otherwise=f"array_append({done}, {part})",
        ),
        lambda done: f"array_join({done}, '/')",
    )
    return f"concat({folded}, if({path} RLIKE {lit(r'/\.\.?$')}, '/', ''))"


def _from_folder(href: str, base: str) -> str:
    folder = f"regexp_extract(regexp_replace({base}, '[?#].*$', ''), {lit(FOLDER)}, 1)"
    slashed = with_value(folder, lambda f: f"if(endswith({f}, '/'), {f}, concat({f}, '/'))")
    tail = f"substring(concat({slashed}, {href}), length({origin(base)}) + 1)"
    return with_value(
        tail,
        lambda t: concat(
            origin(base),
            f"if({t} RLIKE {lit(r'(^|/)\.\.?(/|$)')}, {_fold_dots(t)}, {t})",
        ),
    )


def resolve(href: str, base: str) -> str:
    """A link against the page it stands on; absolute links are kept, '' and NULL give NULL."""
    return with_value(
        href,
        lambda h: case(
            (f"{h} = ''", "NULL"),
            (f"{h} RLIKE {lit(r'(?i)^[a-z][a-z0-9+.-]*:')}", h),
            (f"startswith({h}, '//')", concat(f"regexp_extract({base}, '^([^/]*)', 1)", h)),
            (f"startswith({h}, '/')", concat(origin(base), h)),
            (f"startswith({h}, '?')", concat(f"regexp_replace({base}, '[?#].*$', '')", h)),
            (f"startswith({h}, '#')", concat(f"regexp_replace({base}, '#.*$', '')", h)),
            (f"{h} IS NOT NULL", _from_folder(h, base)),
        ),
    )


def with_prefix(href: str, prefix: str) -> str:
    """Links starting with ``http`` are kept, all others get a fixed prefix."""
    return f"regexp_replace({href}, '^(?!http)', {lit(prefix)})"


def prefixed(href: str, prefix: str) -> str:
    """Every link gets the prefix, a blank one stays blank."""
    return f"regexp_replace({href}, '(?s)^(?=.)', {lit(prefix)})"
