"""User functions that hang, end or overflow their process."""

from __future__ import annotations

import os
import time

from cardloom.operators.custom import Limits, Quarantine, records_of_extractors


def answers(function, pages, **limits):
    quarantine = Quarantine({"s": function}, Limits(**limits))
    try:
        return [quarantine.call("s", p) for p in pages]
    finally:
        quarantine.close()


def test_a_function_that_never_returns_fails_its_page_only():
    def function(n):
        while n == 1:
            time.sleep(100)
        return [{"name": str(n)}]

    start = time.perf_counter()
    got = answers(function, [0, 1, 2, 1, 3], seconds=0.5)
    assert time.perf_counter() - start < 10
    assert [(f and f[0][0], e) for f, e in got] == [
        ("0", None), (None, "TimeoutError: no result within 0.5 seconds"), ("2", None), (None, "TimeoutError: no result within 0.5 seconds"), ("3", None)]


def test_memory_and_ends_of_the_process():
    def function(n):
        if n == 1:
            return [{"name": len(bytearray(500 << 20))}]
        if n == 2:
            os._exit(1)
        if n == 3:
            raise SystemExit("no")
        if n == 4:
            return [{"name": object()}, 5]
        return [{"name": "x", "email": None, "other": 1}]

    got = answers(function, [0, 1, 2, 3, 4, 0], memory_mb=200)
    assert [e and e.split(":")[0] for _, e in got] == [None, "MemoryError", "ChildProcessError", "SystemExit", "AttributeError", None]
    assert got[0] == got[-1]
    assert answers(function, [1], memory_mb=None)[0][1] is None


def test_no_process_is_left():
    quarantine = Quarantine({"s": lambda p: []}, Limits())
    assert quarantine.call("s", {}) == ([], None)
    process = quarantine.process
    quarantine.close()
    assert not process.is_alive() and quarantine.process is None


def test_other_sources_go_on(spark):
    pages = spark.createDataFrame([(s, s, n, "u", "listing", "<p>") for s in ("a", "b", "c") for n in range(1, 4)],
                                  "source_id string, profile_id string, page_no int, url string, role string, html string")

    def hangs(page):
        while page["page_no"] == 2:
            pass
        return [{"name": "n"}, {"name": "m"}]

    found = records_of_extractors(pages, {"a": hangs, "b": lambda p: [{"name": p["html"]}]}, Limits(seconds=1))
    rows = sorted((r.source_id, r.page_no, r.card_ord, r.name, r.error) for r in found.collect())
    late = "TimeoutError: no result within 1 seconds"
    assert rows == [("a", 1, 0, "n", None), ("a", 1, 1, "m", None), ("a", 2, None, None, late), ("a", 3, 0, "n", None), ("a", 3, 1, "m", None),
                    ("b", 1, 0, "<p>", None), ("b", 2, 0, "<p>", None), ("b", 3, 0, "<p>", None)]
