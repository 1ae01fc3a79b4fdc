"""Secret scans over an incremental blob ledger (DataFrame functions only).

A text is a blob named by its SHA-256. The ledger, a Parquet table, has one row per blob and scan:
the rules, with their versions, that were tried and what they found. A run

1. names the blobs of all versions given,
2. takes from each the rules whose present version the ledger has not tried on it,
3. scans only those pairs and appends them to the ledger,
4. joins the findings of the present rule versions back to every path that holds the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardloom.llm.common import text_of


@dataclass(frozen=True)
class Rule:
    """A match counts if ``group`` of it has at least ``chars`` characters; matches do not overlap."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    chars: int = 1

    @property
    def label(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed values of the rules. A run of the last class is taken whole, so a minimum length in the pattern
#: finds the same matches as one checked afterwards; the value of an assignment must be checked afterwards.
RULES = (
    Rule("assign", 1,
         r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{32,}"),
)
_FOUND = "array<struct<start:int,rank:int,label:string,end:int>>"
_FOLDED = 256
_LEDGER = f"blob binary, tried array<string>, found {_FOUND}"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Matches of one rule with code point offsets: the texts between matches and the matches add up."""
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    parts = F.arrays_zip(
        between.alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("all"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    start = F.struct(F.lit(0).alias("at"), F.lit([]).cast(_FOUND).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.length(x["all"])
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.label).alias("label"), end.alias("end"))
        kept = F.length(x["part"]) >= rule.chars
        return F.struct(end.alias("at"), F.when(kept, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    def found(matches: Column) -> Column:
        """A fold copies what it has at every step, so inner folds begin anew every ``_FOLDED`` matches."""
        firsts = F.sequence(F.lit(1), F.greatest(F.size(matches), F.lit(1)), F.lit(_FOLDED))

        def inner(state: Column, first: Column) -> Column:
            some = F.aggregate(F.slice(matches, first, F.lit(_FOLDED)), F.struct(state["at"].alias("at"), start["spans"].alias("spans")), step)
            return F.transform(F.array(some), lambda s: F.struct(s["at"].alias("at"), F.concat(state["spans"], s["spans"]).alias("spans")))[0]

        return F.aggregate(firsts, start, inner)["spans"]

    # the piece behind the last match has none and is left out; the matches are found once, not once a fold
    matches = F.slice(parts, F.lit(1), F.size(between) - 1)
    return F.when(text.rlike(rule.pattern), F.transform(F.array(matches), found)[0]).otherwise(start["spans"])


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(path, blob, spans) of every row of ``versions``; spans are (start, end, kind), by start, then rule.

    ``ledger`` is a folder all executors reach; it need not exist. Null texts are empty, null paths are
    kept, repeated rows are repeated, other columns are ignored.
    """
    spark = versions.sparkSession
    text = text_of(text_col)
    rows = versions.select(F.col(path_col).alias("path"), F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("text"))
    _extend(spark, rows.select("blob", "text"), ledger, rules)
    labels = [r.label for r in rules]
    known = (
        spark.read.schema(_LEDGER).parquet(ledger).filter(F.size("found") > 0)
        .select("blob", F.explode("found").alias("f"))
        .filter(F.col("f")["label"].isin(labels))
        .groupBy("blob").agg(F.collect_set("f").alias("found"))  # the spans of one text
    )
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.label, i)])
    ordered = F.sort_array(F.transform("found", lambda f: F.struct(
        f["start"].alias("start"), rank[f["label"]].alias("rank"), f["end"].alias("end"),
        F.substring_index(f["label"], "@", 1).alias("kind"))))
    empty = F.lit([]).cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return rows.select("path", "blob").join(known, "blob", "left").select("path", "blob", F.coalesce(ordered, empty).alias("spans"))


def _extend(spark: SparkSession, blobs: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> None:
    """Scan unseen pairs of blob and rule version and append them."""
    now = F.array(*[F.lit(r.label) for r in rules])
    once = blobs.dropDuplicates(["blob"])
    try:
        tried = spark.read.schema(_LEDGER).parquet(ledger).groupBy("blob").agg(F.flatten(F.collect_list("tried")).alias("seen"))
    except AnalysisException as error:  # no ledger yet
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        pending = once.withColumn("todo", now)
    else:
        left = F.coalesce(F.array_except(now, "seen"), now)
        pending = once.join(tried, "blob", "left").withColumn("todo", left).filter(F.size("todo") > 0)
    none = F.lit([]).cast(_FOUND)
    found = [F.when(F.array_contains("todo", r.label), _spans(F.col("text"), r, i)).otherwise(none) for i, r in enumerate(rules)]
    pending.select("blob", F.col("todo").alias("tried"), F.concat(*found).alias("found")).write.mode("append").parquet(ledger)
