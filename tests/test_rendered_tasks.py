"""Rendered pages are made and parsed by all cores."""

from __future__ import annotations

from cardloom.plans.rendered import detail_pages


def test_rendered_pages_are_made_by_all_cores(spark, sf_dir):
    assert detail_pages(spark, sf_dir, ("school_finder",)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
