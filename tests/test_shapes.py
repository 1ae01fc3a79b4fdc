"""Pairing shapes: golden cases and random pages against a step-by-step reading."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cardloom.functions.text import JOB_KEYWORDS
from cardloom.operators.markup import parse_pages
from cardloom.operators.rules import Pick, Profile
from cardloom.operators.shapes import page_records
from cardloom.plans.profiles import BY_ID


def extract(spark, profile, bodies):
    """Records per page as (name, title, email) tuples."""
    pages = spark.createDataFrame(list(enumerate(bodies)), "page_id int, html string").repartition(4, "page_id")
    rows = parse_pages(pages).select(
        "page_id", F.expr(page_records(profile, "nodes")).alias("records")
    ).collect()
    by_page = {r.page_id: [(x.name, x.job_title, x.email) for x in r.records] for r in rows}
    return [by_page[i] for i in range(len(bodies))]


def lengths(rng):
    """Many short block lists and a few that are read in several chunks."""
    return [rng.randrange(14) for _ in range(300)] + [255, 256, 257, 700, 1300]


# --- H1 ------------------------------------------------------------------------------------------
def h1_page(blocks):
    tag = {"H": "h2", "P": "p", "X": "span"}
    return "".join(f'<div class="wixui-rich-text"><{tag[k]}>{t}</{tag[k]}></div>' for k, t in blocks)


def h1_by_hand(blocks):
    name, out = "", []
    for kind, text in blocks:
        if kind == "H":
            name = text
        elif kind == "P" and name:
            out.append((name, text, ""))
            name = ""
    return out


def test_heading_then_paragraph(spark):
    golden = [
        ([("H", "A"), ("P", "j1")], [("A", "j1", "")]),
        ([("H", "A"), ("H", "B"), ("P", "j1"), ("P", "j2")], [("B", "j1", "")]),
        ([("P", "j1"), ("H", "A"), ("P", "")], [("A", "", "")]),
        ([("H", ""), ("P", "j1")], []),
    ]
    rng = random.Random(1)
    cases = [b for b, _ in golden] + [
        [(rng.choice("HHPPX"), rng.choice(["", "a", "b", "c"])) for _ in range(n)] for n in lengths(rng)
    ]
    found = extract(spark, BY_ID["association_house"], [h1_page(b) for b in cases])
    assert found[:4] == [want for _, want in golden]
    assert found == [h1_by_hand(b) for b in cases]


# --- H2 ------------------------------------------------------------------------------------------
def h2_page(blocks):
    def one(kind, text):
        if kind == "H":
            return f'<div class="elementor-widget-heading"><h2>{text}</h2></div>'
        if kind == "N":
            return '<div class="elementor-widget-heading"><p>no heading</p></div>'
        link = f'<a href="mailto:{text}">m</a>' if text else "<i>none</i>"
        return f'<div class="elementor-widget-icon-list">{link}</div>'

    return "".join(one(*b) for b in blocks)


def h2_by_hand(blocks):
    name = title = ""
    out = []
    for kind, text in blocks:
        if kind == "H":
            if not name:
                name = text
            elif not title:
                title = text
        elif kind == "L":
            if text and name and title:
                out.append((name, title, text))
            name = title = ""
    return out


def test_headings_ended_by_a_list(spark):
    golden = [
        ([("H", "A"), ("H", "B"), ("L", "m1")], [("A", "B", "m1")]),
        ([("H", "A"), ("H", ""), ("H", "B"), ("H", "C"), ("L", "m1")], [("A", "B", "m1")]),
        ([("H", "A"), ("L", "m1"), ("H", "B"), ("H", "C"), ("L", "m2")], [("B", "C", "m2")]),
        ([("H", "A"), ("H", "B"), ("L", "")], []),
    ]
    rng = random.Random(2)
    cases = [b for b, _ in golden] + [
        [(k := rng.choice("HHHNL"), rng.choice(["", "m1", "m2"] if k == "L" else ["", "a", "b"]))
         for _ in range(n)] for n in lengths(rng)
    ]
    found = extract(spark, BY_ID["toddlertown"], [h2_page(b) for b in cases])
    assert found[:4] == [want for _, want in golden]
    assert found == [h2_by_hand(b) for b in cases]


# --- H3 ------------------------------------------------------------------------------------------
def h3_page(blocks):
    def one(kind, text):
        if kind == "B":
            return f'<div><span style="font-weight:bold">{text}</span></div>'
        return f'<div><a href="mailto:{text}">{text}</a></div>' if kind == "M" else f"<div><p>{text}</p></div>"

    return '<div data-mesh-id="c_inlineContent-gridContainer">' + "".join(one(*b) for b in blocks) + "</div>"


def h3_by_hand(blocks):
    slots, out = {}, []
    for kind, text in blocks:
        if kind == "B":
            slots["name"] = text
        elif kind == "M":
            slots["email"] = text
        elif slots.get("name") and slots.get("email") and any(k in text for k in JOB_KEYWORDS):
            out.append((slots["name"], text, slots["email"]))
            slots = {}
    return out


def test_slots_until_complete(spark):
    t1, t2 = "teacher 1", "teacher 2"
    golden = [
        ([("B", "A"), ("M", "m1"), ("T", t1)], [("A", t1, "m1")]),
        ([("M", "m1"), ("B", "A"), ("T", t1)], [("A", t1, "m1")]),
        ([("B", "A"), ("T", t1), ("M", "m1"), ("T", t2)], [("A", t2, "m1")]),
        ([("B", "A"), ("M", "m1"), ("T", t1), ("T", t2)], [("A", t1, "m1")]),
    ]
    rng = random.Random(3)
    words = {"B": ["", "a", "b"], "M": ["m1", "m2"], "T": [t1, "office", "director"]}
    cases = [b for b, _ in golden] + [
        [(k := rng.choice("BMTT"), rng.choice(words[k])) for _ in range(n)] for n in lengths(rng)
    ]
    found = extract(spark, BY_ID["harbor_school_ny"], [h3_page(b) for b in cases])
    assert found[:4] == [want for _, want in golden]
    assert found == [h3_by_hand(b) for b in cases]


# --- cards ---------------------------------------------------------------------------------------
def test_first_of_equal_records_on_a_page(spark):
    profile = Profile("x", "x", "", "li", dict(
        name=(Pick("b", "first"),), job_title=(Pick("i", "first"),), email=(Pick("u", "first"),)), dedup=True)
    rng = random.Random(4)
    cases = [[(rng.choice("ab"), rng.choice("tu"), rng.choice("12")) for _ in range(rng.randrange(1, 9))] for _ in range(100)]
    page = lambda rows: "".join(f"<li><b>{n}</b><i>{t}</i><u>{e}</u></li>" for n, t, e in rows)

    def by_hand(rows):
        firsts = {}
        for n, t, e in rows:
            firsts.setdefault((n, t), (n, t, e))
        return sorted(firsts.values())

    found = extract(spark, profile, [page(c) for c in cases])
    assert [sorted(f) for f in found] == [by_hand(c) for c in cases]


def test_em_before_the_rest_of_the_paragraph(spark):
    body = (
        '<div class="content-wrap"><p><strong>Ann Lee</strong> Dean <em>Head of Art</em></p>'
        "<p><strong>Bo Day</strong>  Coach | more b@x.org</p><p><strong>Ann Lee</strong><em>Head of Art</em></p>"
        "<p><strong>Chicago Christian High</strong></p><p><strong>Single</strong></p></div>"
    )
    assert extract(spark, BY_ID["chicagochristian"], [body]) == [
        [("Ann Lee", "Head of Art", "b@x.org"), ("Bo Day", "Coach", "b@x.org")]
    ]


def test_cut_to_the_shorter_list(spark):
    body = ('<h2 class="elementor-heading-title">A</h2><h2 class="elementor-heading-title">B</h2>'
            '<div class="elementor-text-editor"><p><span>t1</span></p></div>')
    assert extract(spark, BY_ID["chicagocommons"], [body, "<p>nobody</p>"]) == [[("A", "t1", "")], []]


def test_short_table_rows(spark):
    body = ('<div class="table-v2-block"><table><tbody><tr><td><p>only</p></td></tr>'
            "<tr><td><p></p><p>A</p></td><td><p>Chair</p></td></tr>"
            '<tr><td><p>B</p></td><td></td><td><a href="mailto:b@x.org"> b@x.org</a></td></tr></tbody></table></div>')
    assert extract(spark, BY_ID["sd170"], [body]) == [[("A", "Chair", ""), ("B", "", "b@x.org")]]
