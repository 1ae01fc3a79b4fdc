"""Every registered query against its DuckDB counterpart on the same tables."""

from __future__ import annotations

from collections import Counter

import pytest

from cardloom.plans.catalog import CATALOG

ROUND_TRIP_IDS = [f"{p}{i}" for p, n in dict(A=13, B=30, C=10, D=17, E=9, F=7, G=3, H=6, I=3, J=35, K=11, L=5).items()
                  for i in range(1, n + 1)]


def _rows(frame):
    columns = sorted(frame.columns)
    values = frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()
    return columns, Counter(map(repr, values))


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_matches_sql(name, spark, duck, sf_dir):
    entry = CATALOG[name]
    got_columns, got = _rows(entry.run(spark, sf_dir).toPandas())
    want_columns, want = _rows(duck.execute(entry.sql).df())
    assert got_columns == want_columns
    assert got == want


def test_every_operator_has_a_query():
    covered = {c for e in CATALOG.values() for c in e.covers}
    assert covered == set(ROUND_TRIP_IDS)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert CATALOG.keys() <= entry.queries().keys()
    assert CATALOG.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()
    assert entry.entry(spark).columns == ["page_id", "url", "source_id", "title", "has_email"]
