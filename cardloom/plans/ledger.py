"""What earlier runs extracted (L1, L3): a ledger by page content and rules, so that a run parses only what is new.

A row says what the rules named ``rules`` found on the page content named ``digest``. A run names the content of its
pages (a hash of address and markup), takes from the ledger the pairs of content and rules it knows, parses the
others, appends them, and joins records back to every page that has the content. Changed rules have another name, so a
changed profile is extracted anew and no other; a page that is gone is not asked for any more.

Names of content are all that is shuffled; markup is moved only where a page is to be parsed. Rows of a failed run stay
valid: the next run goes on behind them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cardloom.functions.sql import case, lit
from cardloom.operators.keyfilter import keep_wanted
from cardloom.operators.markup import parse_pages
from cardloom.operators.rules import RECORD_TYPE, Profile

#: Part of every rules' name: another number makes all earlier rows unknown.
VERSION = 1
_SCHEMA = T.StructType([
    T.StructField("digest", T.BinaryType()), T.StructField("rules", T.StringType()), T.StructField("profile_id", T.StringType()),
    T.StructField("run", T.LongType()), T.StructField("records", T.ArrayType(RECORD_TYPE)),
])
_PAIR = ["digest", "rules"]


def rules_name(signature: object) -> str:
    return sha256(f"{VERSION}\n{signature!r}".encode()).hexdigest()[:32]


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """All rows, or None before the first run. Pages of equal content may have left equal rows."""
    try:
        return spark.read.schema(_SCHEMA).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def recorded(pages: DataFrame, keys: tuple[str, ...], profiles: Sequence[Profile], signature: Callable[[Profile], object],
             branches: str, selectors: dict[str, set[str]], ledger: str, folder: str) -> DataFrame:
    """``keys`` and ``records`` of each page, parsing only pairs of content and rules the ledger does not know.

    ``branches`` is the CASE over ``profile_id`` that makes records of ``nodes``, with ``selectors`` by profile. ``folder`` takes the names of the pages'
    content; both folders are shared by all executors. A null address or markup counts as ''.
    """
    spark = pages.sparkSession
    name = case(*[(f"profile_id = {lit(p.profile_id)}", lit(rules_name(signature(p)))) for p in profiles])
    content = F.concat(F.coalesce("url", F.lit("")), F.lit("\n"), F.coalesce("html", F.lit("")))
    named = pages.filter(F.col("profile_id").isin([p.profile_id for p in profiles])).select(
        *keys, "html", F.unhex(F.sha2(content, 256)).alias("digest"), F.expr(name).alias("rules"))
    named.drop("html").write.mode("overwrite").parquet(f"{folder}/names")
    names = spark.read.schema(named.drop("html").schema).parquet(f"{folder}/names")

    known = read_ledger(spark, ledger)
    todo, run = named, 1
    if known is not None:
        names.select(*_PAIR).join(known.select(*_PAIR), _PAIR, "left_anti").distinct().write.mode("overwrite").parquet(f"{folder}/unseen")
        unseen = spark.read.parquet(f"{folder}/unseen")
        run += known.agg(F.max("run")).first()[0] or 0
        # most pages are known: they are dropped at the scan, what passes by chance by the join
        todo = None if unseen.isEmpty() else keep_wanted(named, (F.col("digest"), F.col("rules")), unseen, tuple(_PAIR)).join(unseen, _PAIR, "left_semi")
    if todo is not None:
        parsed = parse_pages(todo.select(*{**dict.fromkeys(keys), **dict.fromkeys(_PAIR)}, "html"), selectors=selectors, by="profile_id")
        found = parsed.select(*_PAIR, "profile_id", F.lit(run).cast("long").alias("run"), F.expr(branches).alias("records"))
        found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _SCHEMA]).hint("rebalance").write.mode("append").parquet(ledger)
    rows = read_ledger(spark, ledger)
    once = rows.groupBy(*_PAIR).agg(F.first("records").alias("records"))
    return names.join(once, _PAIR).select(*keys, "records")


def ledger_report(spark: SparkSession, ledger: str) -> DataFrame:
    """(run, profile_id, parsed): pairs of content and rules that each writing run was the first to extract."""
    rows = read_ledger(spark, ledger)
    if rows is None:
        return spark.createDataFrame([], "run long, profile_id string, parsed long")
    first = rows.groupBy(*_PAIR).agg(F.min(F.struct("run", "profile_id")).alias("first"))
    return first.groupBy("first.run", "first.profile_id").agg(F.count("*").alias("parsed"))
