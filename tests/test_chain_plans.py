"""Joins along chains of links."""

from __future__ import annotations

import contextlib
import io

from cardloom.operators.chains import chain_report, follow_links
from cardloom.sources.layout import shared_folder


def test_chains_pass_no_table_through_the_driver(spark):
    links = spark.createDataFrame([("a", p, p + 1) for p in range(1, 9)] + [("b", 1, 1)], "source_id string, page_no long, next_page long")
    chains = follow_links(links, shared_folder(spark))
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        chains.explain()
    assert "SortMergeJoin" in shown.getvalue() and "Broadcast" not in shown.getvalue()
    assert {tuple(r)[:4] for r in chain_report(chains).collect()} == {("a", 8, 8, 0), ("b", 1, 1, 0)}
