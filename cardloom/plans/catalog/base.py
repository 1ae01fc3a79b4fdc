from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    covers: tuple[str, ...]
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query with the operators it covers and its DuckDB counterpart."""

    def add(run):
        if name in CATALOG:
            raise ValueError(f"two queries named {name}")
        CATALOG[name] = Entry(run, tuple(covers.split()), sql)
        return run

    return add


# J1 for DuckDB
SQL_SPACE = r"[\s\p{Z}\x{FEFF}]"


def sql_clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SQL_SPACE}+', ' ', 'g'))"
