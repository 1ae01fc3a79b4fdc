"""What an extraction rule consists of. Rules are data; ``fields`` and ``shapes`` turn them into Columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

CORE = ("school_name", "url", "name", "job_title", "email")
EXTRAS = ("image_url", "department", "phone", "location", "category", "profile_url",
          "official_website", "lookup_key")
RECORD_FIELDS = ("name", "job_title", "email") + EXTRAS
RECORD_TYPE = T.StructType(
    [T.StructField("card_ord", T.IntegerType())]
    + [T.StructField(f, T.StringType()) for f in RECORD_FIELDS]
)


@dataclass(frozen=True)
class Pick:
    """One way to read a value from a card."""

    css: str | None = None  # None: the scope element itself
    # all | first | n (0-based) | first_text (non-blank) | first_value (not NULL) |
    # first_other (the first that differs from the first)
    which: str | int = "all"
    # text | own | visible | first_node | inner_html | outer_html | attr:<name> |
    # attr_or_text:<name> | without:<css>
    take: str = "text"
    scope: str = "card"  # card | parent | page | next:<css> | closest:<css>
    inside: tuple[tuple[str, int], ...] = ()  # hops to one element before ``css`` is searched
    where: tuple = ()  # conditions on the matched elements, as in ``Profile.card_where``
    steps: tuple = ("clean",)


@dataclass(frozen=True)
class Joined:
    """Several picks joined by a space (first and last name)."""

    parts: tuple[Pick, ...]
    steps: tuple = ("clean",)


@dataclass(frozen=True)
class Checked:
    """The first non-blank pick, then steps on the choice."""

    choices: tuple[Pick, ...]
    steps: tuple = ()


# A field is a list of alternatives, the first non-blank one wins; a plain string is a constant.
Field = tuple


@dataclass(frozen=True)
class Lookup:
    """Second page per record: detail pages of the same source, found by ``lookup_key``."""

    key: tuple = ()  # steps from a detail page's URL to its key
    fields: dict[str, Field] = field(default_factory=dict)
    how: str = "left"  # left: fills fields; inner: the detail page replaces the listing row


@dataclass(frozen=True)
class Paging:
    """How a directory announces its pages and how page URLs are built."""

    # max_attr | label_div | label_of | last_attr | max_href | max_text | hrefs | next_link
    kind: str
    css: str
    attr: str = "data-page"
    size: int | str = "cards"  # label_div: fixed size, "cards" on the page, or "label"
    query: str = "?const_page="
    suffix: str = ""
    bare_first: bool = False  # page 1 is the bare URL


@dataclass(frozen=True)
class Profile:
    """All rules of one source."""

    profile_id: str
    school_name: str
    url: str
    card: str = ""
    fields: dict[str, Field] = field(default_factory=dict)
    shape: str = "cards"  # cards | zip | heading_text | heading_list | slots | text_link
    # ("has", css) | ("at_least", css, n) | ("text_has", s) | ("not_blank", css or None) |
    # ("plain_text", max) | ("id_lacks", s)
    card_where: tuple = ()
    group: str = ""  # cards are searched below each group; group fields are read once per group
    group_fields: dict[str, Field] = field(default_factory=dict)
    keep: tuple = ("all_of", "name")  # all_of | any_of | person | longer | () keeps blanks
    dedup: bool = False
    blocks: dict[str, str] = field(default_factory=dict)  # selectors of the sequence shapes
    paging: Paging | None = None
    lookup: Lookup | None = None
    url_per_page: bool = False  # the record's url is the page's, not the source's
    when_empty: str = "empty"  # status of a source without records: empty | failed
    empty_message: str = ""
    merged: bool = False  # takes part in the merge run
    columns: tuple[tuple[str, str], ...] = tuple((c, c) for c in CORE)  # (own name, record field)

    def signature(self) -> tuple:
        """Profiles with equal signatures share one branch of the extraction plan."""
        return (
            self.shape, self.card, repr(sorted(self.fields.items())), self.card_where, self.keep,
            self.dedup, self.group, repr(sorted(self.group_fields.items())), repr(sorted(self.blocks.items())),
        )
