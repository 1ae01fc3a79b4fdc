"""User-supplied extractors (L4, L5), for directories whose rules cannot be written as data."""

from __future__ import annotations

import multiprocessing
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardloom.operators.rules import RECORD_FIELDS

PAGE_KEYS = ("source_id", "profile_id", "page_no", "url")


def apply_extractor(
    pages: DataFrame, extractor: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str
) -> DataFrame:
    """Run a function on Arrow batches of pages, on the executors.

    The function sees a batch of whole pages and gives any number of rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield extractor(batch)

    return pages.mapInPandas(run, schema)


@dataclass(frozen=True)
class Limits:
    """What a user's function may take for one page; None: no limit."""

    seconds: float | None = 60.0
    memory_mb: int | None = 2048


def _bounded(memory_mb: int | None) -> None:
    """In the child: end with the parent, and take no more than so much memory besides what there is."""
    import ctypes
    import resource
    import signal

    ctypes.CDLL(None).prctl(1, signal.SIGKILL)  # PR_SET_PDEATHSIG
    if memory_mb is not None:
        with open("/proc/self/statm") as now:
            used = int(now.read().split()[0]) * resource.getpagesize()
        resource.setrlimit(resource.RLIMIT_AS, (used + (memory_mb << 20),) * 2)


def _message(error: BaseException) -> str:
    return f"{type(error).__name__}: {error}"


class Quarantine:
    """Calls functions in a process of their own, which is ended if it does not answer in time.

    The function cannot hold the task, take its memory or end it: whatever it does, the caller gets its records or a
    message. One process serves pages until it has to be ended; the next page then gets a new one.
    """

    def __init__(self, extractors: dict[str, Callable[[dict], list[dict]]], limits: Limits):
        self.extractors, self.limits, self.process, self.pipe = extractors, limits, None, None

    def _serve(self, pipe) -> None:
        _bounded(self.limits.memory_mb)
        while True:
            source, page = pipe.recv()
            try:
                answer = [[str(r.get(f) or "") for f in RECORD_FIELDS] for r in self.extractors[source](page)], None
            except BaseException as error:  # whatever a user's function raises belongs to this page only
                answer = None, _message(error)
            pipe.send(answer)

    def call(self, source: str, page: dict) -> tuple[list[list[str]] | None, str | None]:
        """(records, None) or (None, message)."""
        if self.process is None:
            context = multiprocessing.get_context("fork")
            self.pipe, other = context.Pipe()
            self.process = context.Process(target=self._serve, args=(other,), daemon=True)
            self.process.start()
            other.close()
        try:
            self.pipe.send((source, page))
            if self.pipe.poll(self.limits.seconds):
                return self.pipe.recv()
            message = f"TimeoutError: no result within {self.limits.seconds:g} seconds"
        except (EOFError, OSError):
            message = "ChildProcessError: the function ended its process"
        self.close()
        return None, message

    def close(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.join()
            self.pipe.close()
            self.process = None


def records_of_extractors(pages: DataFrame, extractors: dict[str, Callable[[dict], list[dict]]],
                          limits: Limits = Limits()) -> DataFrame:
    """Records of the sources that have a function of their own (L4), each page apart from the others (L1, L2).

    A function gets one page (its columns) and gives any number of records. What it raises becomes a row
    with ``error`` and without a record, and so does a page that exceeds ``limits`` or ends the process; the other pages,
    and the other sources, go on.
    """
    schema = StructType(
        [pages.schema[k] for k in PAGE_KEYS] + [StructField("card_ord", pages.schema["page_no"].dataType)]
        + [StructField(f, StringType()) for f in (*RECORD_FIELDS, "error")])
    columns = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        quarantine = Quarantine(extractors, limits)
        try:
            for batch in batches:
                rows = []
                for page in batch.to_dict("records"):
                    keys = [page[k] for k in PAGE_KEYS]
                    found, error = quarantine.call(page["source_id"], page)
                    if error is None:
                        rows += [(*keys, n, *values, None) for n, values in enumerate(found)]
                    else:
                        rows.append((*keys, None, *[None] * len(RECORD_FIELDS), error))
                yield pd.DataFrame(rows, columns=columns).astype({"card_ord": "Int64", "error": object})
        finally:
            quarantine.close()

    own = pages.filter((F.col("role") == "listing") & F.col("source_id").isin(list(extractors)))
    return own.select(*PAGE_KEYS, "html").mapInPandas(run, schema)
