"""Global places, and JSON arrays in parts."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardloom.operators.ordinal import with_place
from cardloom.sources import sinks


@pytest.fixture
def many_parts(spark):
    """Ranges small enough that a sort gives many partitions."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_places_are_those_of_the_whole_order(spark, tmp_path, many_parts):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "a", "b", "c"]), rng.random()) for i in range(3000)]
    frame = spark.createDataFrame(rows, "id int, _part string, x double").repartition(7)
    placed = with_place(frame, [F.desc("_part"), "x", "id"], str(tmp_path))
    assert placed.columns == [*frame.columns, "place"]
    want = sorted(rows, key=lambda r: (-ord(r[1] or "\0"), r[2], r[0]))
    assert [r.id for r in sorted(placed.collect(), key=lambda r: r.place)] == [r[0] for r in want]
    assert sorted(r.place for r in placed.collect()) == list(range(1, 3001))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    assert len(list(tmp_path.glob("sorted/part-*"))) > 3


def test_ties_and_empty_tables(spark, tmp_path, many_parts):
    same = spark.range(500).select(F.lit(1).alias("k"), "id")
    first = with_place(same, ["k"], f"{tmp_path}/a")
    assert sorted(r.place for r in first.collect()) == list(range(1, 501))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, first.collect()))
    assert with_place(same.filter("false"), ["k"], f"{tmp_path}/b").count() == 0


def joined(folder):
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def test_parts_of_a_json_array(spark, tmp_path, many_parts):
    rng = random.Random(3)
    texts = ['a"b', "x\ny", "é😀", "", None, "],[", "\\", "end,"]
    rows = [(i, rng.choice(texts), rng.choice(texts)) for i in range(1200)]
    frame = spark.createDataFrame(rows, "n int, name string, email string").repartition(5)
    sinks.write_json_array(frame, f"{tmp_path}/array", ["n"], f"{tmp_path}/scratch", [("n", "n"), ("who", "name"), ("email", "email")])
    assert len([p for p in Path(f"{tmp_path}/array").glob("part-*") if p.stat().st_size]) > 3
    want = [dict(n=i, who=a or "", email=b or "") for i, a, b in rows]
    assert json.loads(joined(f"{tmp_path}/array")) == want
    sinks.merge_parts(spark, f"{tmp_path}/array", f"{tmp_path}/all.json")
    with open(f"{tmp_path}/all.json") as file:
        assert json.load(file) == want
    assert sorted(p.name for p in tmp_path.glob("*.json")) == ["all.json"] and not list(tmp_path.glob(".all*"))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_short_arrays(spark, tmp_path, n):
    frame = spark.range(n).select(F.col("id").alias("n"))
    sinks.write_json_array(frame, f"{tmp_path}/array", ["n"], f"{tmp_path}/scratch")
    sinks.merge_parts(spark, f"file://{tmp_path}/array", f"file://{tmp_path}/all.json")
    assert json.loads(joined(f"{tmp_path}/array")) == json.loads(Path(f"{tmp_path}/all.json").read_text()) == [{"n": i} for i in range(n)]
