from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

#: Columns an input may bring along whose names operators use inside or return.
CLASHES = ("id", "key", "n", "c", "digest", "kept", "score", "rejected", "component_id", "lang_pred", "spans", "row", "word", "of_id")
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "Same text Here"), (5, "same text here"), (6, "same text here"), (7, "ünïcode ÄÖ 😀 ß"),
       (8, "a " * 3000 + "end"), (9, "x" * 50000), (10, "one"), (11, "ONE")]


@pytest.fixture
def make(spark):
    """Table of (doc_id, text, lang) with columns of clashing names."""

    def made(rows):
        full = [(*r, *[None] * (3 - len(r)), *["z"] * len(CLASHES)) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHES)).repartition(3)

    return made


@pytest.fixture
def odd():
    return ODD


@pytest.fixture(scope="session")
def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()


@pytest.fixture
def run(spark, sf_dir):
    """Rows of a registered query: first column -> the others, in the order asked for."""
    from cardloom.llm.queries import QUERIES

    def rows(name, *columns):
        return {r[0]: tuple(r[1:]) for r in QUERIES[name](spark, sf_dir).select(*columns).collect()}

    return rows
