"""Golden values of the text and URL functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardloom.functions import text as tx, urls
from cardloom.functions.sql import lit
from cardloom.functions.steps import apply_steps

NBSP, BOM = "\u00a0", "\ufeff"
CASES = [
    (tx.clean(lit(f"a{NBSP}{NBSP}b")), "a b"),
    (tx.clean(lit(f"{BOM} a \n\t b {BOM}")), "a b"),
    (tx.trim(lit(f"{NBSP} a  b \n")), "a  b"),
    (tx.drop_nbsp(lit(f"a{NBSP}b c")), "ab c"),
    (tx.drop_quotes(lit('say "x"')), "say x"),
    (tx.remove_first(lit("Titles: Head Titles:"), "Titles:"), " Head Titles:"),
    (tx.remove_first(lit("none"), "Titles:"), "none"),
    (tx.remove_first(lit("a.b.c"), "."), "ab.c"),
    (tx.strip_mailto(lit("mailto:a@b.org?cc=mailto:x")), "a@b.org?cc=mailto:x"),
    (tx.replace_first(lit("a.localhost.me.localhost.me"), ".localhost.me", ".org"), "a.org.localhost.me"),
    (tx.before_comma(lit(" A B , t, u")), "A B"),
    (tx.second_comma_part(lit("A, t , u")), "t"),
    (tx.second_comma_part(lit("A")), None),
    (tx.after_first_comma(lit("A, t, u")), "t, u"),
    (tx.before_dash(lit("A-B – Chair")), "A-B"),
    (tx.after_dash(lit("A-B – Chair")), "Chair"),
    (tx.before_dash(lit("A - Chair")), "A"),
    (tx.after_dash(lit("A Chair")), None),
    (tx.role_of(lit("Chair: A B")), "Chair"),
    (tx.role_of(lit("A B")), "Board Member"),
    (tx.holder_of(lit("Chair: A B")), "A B"),
    (tx.holder_of(lit("A B")), "A B"),
    (tx.first_segment(lit("Head  of art | x")), "Head"),
    (tx.first_segment(lit("Head – x")), "Head "),
    (tx.strip_tags(tx.last_html_line(lit("a<br>b<BR/><em>c</em>"))), "c"),
    (tx.line(lit("a\nb\nc"), 1), "b"),
    (tx.line(lit("a"), 1), None),
    (tx.find_email(lit("x <a@b.org>, c@d.org")), "a@b.org"),
    (tx.find_email(lit("nobody")), ""),
    (tx.drop_emails(lit("x a@b.org y c@d.org")), "x  y "),
    (tx.handler_id(lit("email('id=Ab9&code')")), "Ab9"),
    (tx.joined_address(lit("l='mailto:' + 'jo' + '@' + 'x.org'")), "jo@x.org"),
    (tx.joined_address(lit("open()")), ""),
    (tx.full_name(lit("  Ann "), lit("")), "Ann"),
    (tx.slug(lit("St. Mary's & Co")), "st_mary_s_co"),
    (tx.slug(lit("(St. Mary)"), "-", strip_ends=True), "st-mary"),
    (tx.space_slug(lit("St. Mary's  School")), "st._mary's_school"),
    (tx.label_total(lit("showing 1 - 8 of 856 people")), 856),
    (tx.label_total(lit("none")), None),
    (tx.label_page_size(lit("Showing 1 - 15 of 856")), 15),
    (tx.label_page_size(lit("of 856")), 24),
    (tx.to_int(lit(" 12px")), 12),
    (tx.to_int(lit("px")), None),
    (tx.ceil_div("856", "15"), 58),
    (tx.ceil_div("856", "0"), None),
    (tx.first_non_blank("NULL", "''", "'b'"), "b"),
    (tx.first_non_blank("NULL", "''"), ""),
    (tx.csv_field(lit('a"b')), '"a""b"'),
    (tx.csv_field("NULL"), '""'),
    (tx.mask_email(lit("ann@x.org")), "***@x.org"),
    (tx.is_person_name(lit("Ann Lee")), True),
    (tx.is_person_name(lit("Ann")), False),
    (tx.is_person_name(lit("A " + "b" * 49)), False),
    (tx.is_person_name(lit("Our Three Campuses")), False),
    (tx.is_person_name(lit(" ")), False),
    (tx.is_person_name("NULL"), False),
    (tx.is_job_text(lit("Assistant PRINCIPAL")), True),
    (tx.is_job_text(lit("Office")), False),
    (tx.is_job_text(lit("teacher" + "x" * 100)), False),
    (tx.if_address(lit("a\n@b")), "a\n@b"),
    (tx.if_address(lit("ab")), ""),
    (tx.real_link(lit("#")), None),
    (tx.real_link(lit("/a")), "/a"),
    (tx.is_number(lit(" 12 ")), True),
    (tx.is_number(lit("12a")), False),
    (tx.not_blank(lit(NBSP)), False),
    (urls.source_id(lit("https://www.abc.org/x")), "abc"),
    (urls.source_id(lit("https://m.abc.org")), "m"),
    (urls.source_id(lit("https://staff.www.abc.org")), "staff"),
    (urls.source_id(lit("ht tp://%%%")), "unknown_school"),
    (urls.source_id("NULL"), "unknown_school"),
    (urls.page_url(lit("https://a.org/s"), "1", "?page_no="), "https://a.org/s"),
    (urls.page_url(lit("https://a.org/s"), "3", "?const_page=", "&"), "https://a.org/s?const_page=3&"),
    (urls.page_url(lit("https://a.org/s"), "1", "?&p=", bare_first=False), "https://a.org/s?&p=1"),
    (urls.page_no(lit("/staff?x=1&page_no=12#a"), "page_no"), 12),
    (urls.page_no(lit("/staff"), "page_no"), None),
    (urls.resolve(lit("../people/7"), lit("https://a.org/about/faculty/")), "https://a.org/about/people/7"),
    (urls.resolve(lit("x"), lit("https://a.org")), "https://a.org/x"),
    (urls.resolve(lit("/x"), lit("https://a.org/y?z=/w")), "https://a.org/x"),
    (urls.resolve(lit("./x"), lit("https://a.org/y/z?q")), "https://a.org/y/x"),
    (urls.resolve(lit("../../../x"), lit("https://a.org/y/z")), "https://a.org/x"),
    (urls.resolve(lit("mailto:a@b.org"), lit("https://a.org/")), "mailto:a@b.org"),
    (urls.resolve(lit(""), lit("https://a.org/")), None),
    (urls.with_prefix(lit("http://b.org"), "https://a.org"), "http://b.org"),
    (urls.with_prefix(lit("/b"), "https://a.org"), "https://a.org/b"),
    (urls.prefixed(lit(""), "https://a.org"), ""),
    (apply_steps(lit(" mailto:a@b.org "), ("clean", "strip_mailto")), "a@b.org"),
]


def test_golden_values(spark):
    row = spark.range(1).select(*[F.expr(e).alias(f"c{i}") for i, (e, _) in enumerate(CASES)]).first()
    wrong = [(CASES[i][0], row[i], CASES[i][1]) for i in range(len(CASES)) if row[i] != CASES[i][1]]
    assert not wrong


def test_unknown_step_is_an_error():
    with pytest.raises(KeyError):
        apply_steps("x", ("no_such_step",))
