"""Joins between pages, sources and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom.operators import merge
from cardloom.operators.lookup import never_matching, one_per_key
from cardloom.operators.markup import parse_pages
from cardloom.operators.rules import Profile
from cardloom.operators.shapes import list_lengths, zipped
from cardloom.plans.catalog.base import query
from cardloom.plans.directory import SQL, base_url, directory_people
from cardloom.sources.tables import table


@query(
    "registry_attached", "E1 C2 A4",
    f"""WITH {SQL} SELECT key, n_name AS school_name, 'https://www.dir' || source_id || '.example.org/staff' AS base_url
        FROM dir""",
)
def registry_attached(spark, sf):
    """One source per nation; no broadcast hint, Spark decides by the registry's size."""
    sources = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("school_name")
    )
    persons = directory_people(spark, sf).select("key", "nation_key", F.expr(base_url()).alias("base_url"))
    return persons.join(sources, "nation_key").select("key", "school_name", "base_url")


_LISTS = Profile("lists", "lists", "", shape="zip", blocks=dict(name=".who", title=".what"), keep=())


@query(
    "uneven_lists", "E5",
    """WITH s AS (SELECT s_suppkey AS key, s_name, s_nationkey, s_suppkey // 10 AS page FROM supplier),
        n AS (SELECT page, key, s_name, row_number() OVER (PARTITION BY page ORDER BY key) AS rn FROM s),
        t AS (SELECT page, s_nationkey, row_number() OVER (PARTITION BY page ORDER BY key) AS rn FROM s WHERE key % 4 <> 1)
        SELECT n.page AS page_id, s_name AS name, 'Lead of nation ' || s_nationkey AS job_title
        FROM n JOIN t USING (page, rn)""",
)
def uneven_lists(spark, sf):
    """Titles of some people are missing, so later rows shift; the longer list is cut."""
    records = _list_pages(spark, sf).select("page_id", F.expr(f"inline_outer({zipped(_LISTS, 'nodes')})"))
    return records.filter("card_ord IS NOT NULL").select("page_id", "name", "job_title")


@query(
    "list_lengths", "E5 F5",
    """SELECT s_suppkey // 10 AS page_id, CAST(count(*) AS INTEGER) AS names,
              CAST(count_if(s_suppkey % 4 <> 1) AS INTEGER) AS titles FROM supplier GROUP BY 1""",
)
def uneven_list_pages(spark, sf):
    return _list_pages(spark, sf).select("page_id", F.expr(f"inline(array({list_lengths(_LISTS, 'nodes')}))"))


def _list_pages(spark, sf):
    supplier = table(spark, sf, "supplier")
    items = supplier.select(
        F.floor(F.col("s_suppkey") / 10).cast("bigint").alias("page_id"), F.col("s_suppkey").alias("key"),
        F.expr("concat('<p class=\"who\">', s_name, '</p>', if(s_suppkey % 4 <> 1, "
               "concat('<p class=\"what\">Lead of nation ', s_nationkey, '</p>'), ''))").alias("item"),
    )
    pages = items.groupBy("page_id").agg(
        F.array_join(F.expr("array_sort(collect_list(struct(key, item))).item"), "").alias("html")
    )
    return parse_pages(pages)


@query(
    "copies_of_one_page", "E2 L2",
    """SELECT o_orderkey, coalesce(CASE WHEN o_custkey % 3 <> 0 AND o_custkey % 7 <> 3
                                        THEN replace(lower(c_name), '#', '.') || '@example.com' END, '') AS email
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def copies_of_one_page(spark, sf):
    """A lookup whose listing has rows without a key and whose pages are stored several times."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 3 != 0, F.concat(F.lit("/p/"), F.col("o_custkey"))).alias("profile_url")
    )
    copies = table(spark, sf, "customer").filter("c_custkey % 7 <> 3").select(
        F.concat(F.lit("/p/"), F.col("c_custkey")).alias("join_key"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("c_custkey") % 50 == 1, 40).otherwise(1))).alias("copy"),
        F.expr("concat(replace(lower(c_name), '#', '.'), '@example.com')").alias("email"),
    )
    details = one_per_key(
        copies.withColumn("email", F.when(F.col("copy") == 1, F.col("email")).otherwise("stale")),
        ["join_key"], ["copy"],
    )
    keyed = orders.withColumn("join_key", never_matching(F.col("profile_url"), F.col("o_orderkey")))
    return keyed.join(details, "join_key", "left").select(
        "o_orderkey", F.coalesce("email", F.lit("")).alias("email")
    )


@query(
    "first_of_each_key", "G2 I3",
    """SELECT o_custkey % 9 AS bucket, o_orderstatus, min_by(o_orderkey, (CASE WHEN o_custkey % 9 < 3 THEN 0 ELSE 1 END,
              -o_orderkey)) AS o_orderkey FROM orders GROUP BY 1, 2""",
)
def first_of_each_key(spark, sf):
    """A few keys hold very many rows each; every task reduces its own rows before they meet."""
    orders = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 9).alias("bucket"), "o_orderstatus", "o_orderkey", (-F.col("o_orderkey")).alias("rank")
    )
    return merge.first_of_each(orders, ["bucket", "o_orderstatus"], ["rank"]).drop("rank")
