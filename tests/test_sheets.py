"""Style sheets that many pages share."""

from __future__ import annotations

from cardloom.operators.visibility import Sheets, hidden_nodes
from cardloom.plans.catalog.selection import visible_cards


def test_cards_are_parsed_by_all_cores(spark, sf_dir):
    assert visible_cards(spark, sf_dir).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_rules_are_read_once_for_pages_with_the_same_sheet():
    known = Sheets()
    sheet = ("b { display: none }",)
    assert known.rules(sheet) is known.rules(tuple(list(sheet)))
    nodes = [(-1, 1, True, "div", None, (), ()), (0, 1, True, "b", None, (), ()), (1, 0, False, None, None, (), ())]
    assert hidden_nodes(nodes, [2, 2, 2], list(sheet), known) == {1: 1, 2: 1}
    assert hidden_nodes(nodes, [2, 2, 2], ["b { display: block }"], known) == {}


def test_remembered_sheets_are_bounded():
    known = Sheets()
    for i in range(40):
        known.rules((f"/*{i}*/" + "x" * (Sheets.KNOWN // 8),))
        known.declarations(f"a:{i};" + "x" * (Sheets.KNOWN // 8))
    assert sum(len(s) for key in known.sheets for s in key) <= Sheets.KNOWN >= sum(map(len, known.styles))
    known.rules(("x" * (Sheets.KNOWN + 1),))
    assert all(len(s) <= Sheets.KNOWN for key in known.sheets for s in key)
