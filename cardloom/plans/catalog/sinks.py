"""Sinks: written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom.operators.rules import CORE
from cardloom.plans.catalog.base import query
from cardloom.plans.catalog.profiles import rendered_records
from cardloom.plans.profiles import BY_ID
from cardloom.plans.rendered import expected_sql
from cardloom.sources import sinks
from cardloom.sources.layout import shared_folder

_IDS = ("chicagojewishdayschool", "hamilton_city", "texans_can_pleasant_grove")
_QUOTED = "concat('  ', job_title, ', \"', name, '\"\n', profile_id, ' ')"
_CORE_SQL = expected_sql(
    _IDS, "SELECT school_name, url, name, '  ' || job_title || ', \"' || name || '\"' || chr(10) || profile_id || ' ' AS job_title, email FROM expected"
)


def _awkward(spark, sf):
    """Titles with quotes, commas, line breaks and blanks at both ends."""
    return rendered_records(spark, sf, _IDS).withColumn("job_title", F.expr(_QUOTED.replace("\n", "\\n")))


def _read_csv(spark, folder):
    return spark.read.options(header=True, escape='"', multiLine=True, nullValue="\u0000", emptyValue="").csv(folder)


@query("csv_core_fields", "A6 A8 C4", _CORE_SQL)
def csv_core_fields(spark, sf):
    folder = shared_folder(spark)
    sinks.write_csv(_awkward(spark, sf), folder, [(c, c) for c in CORE])
    return _read_csv(spark, folder)


@query("json_core_fields", "A5 A12 C4", _CORE_SQL)
def json_core_fields(spark, sf):
    folder = shared_folder(spark)
    sinks.write_json(_awkward(spark, sf), folder, [(c, c) for c in CORE])
    return spark.read.json(folder).select(*CORE)


@query(
    "csv_declared_fields", "A8 C9 C10",
    expected_sql(_IDS, "SELECT school_name, url, name, job_title AS title, location, email FROM expected "
                       "WHERE profile_id = 'hamilton_city'"),
)
def csv_declared_fields(spark, sf):
    folder = shared_folder(spark)
    sinks.write_profile(rendered_records(spark, sf, _IDS), BY_ID["hamilton_city"], folder)
    return _read_csv(spark, f"{folder}/csv")


@query(
    "csv_all_fields", "A9",
    expected_sql(_IDS, "SELECT profile_id, name, email, phone, location FROM expected"),
)
def csv_all_fields(spark, sf):
    folder = shared_folder(spark)
    records = rendered_records(spark, sf, _IDS).select("profile_id", "name", "email", "phone", "location")
    sinks.write_csv(records, folder)
    return _read_csv(spark, folder)


@query(
    "empty_csv", "A7",
    "SELECT 'school_name,url,name,job_title,email' AS header, count(*) AS rows FROM customer WHERE c_custkey < 0",
)
def empty_csv(spark, sf):
    """No record has two at signs, so nothing is left to write but the header."""
    folder = shared_folder(spark)
    none = rendered_records(spark, sf, _IDS).filter(F.col("email").contains("@@"))
    sinks.write_csv(none, folder, [(c, c) for c in CORE])
    back = _read_csv(spark, folder)
    return back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(",".join(back.columns)).alias("header"), "rows")


@query(
    "csv_lines", "A10 J35",
    expected_sql(_IDS, """SELECT profile_id, page_no, '"' || school_name || '","' || url || '","' || name || '","' ||
        '  ' || job_title || ', ""' || name || '""' || chr(10) || profile_id || ' ","' || email || '"' AS line FROM expected"""),
)
def csv_lines(spark, sf):
    return sinks.csv_lines(_awkward(spark, sf)).select("profile_id", "page_no", "line")


@query(
    "output_per_source", "A11",
    expected_sql(_IDS, "SELECT profile_id AS source_id, name, email, phone FROM expected"),
)
def output_per_source(spark, sf):
    folder = shared_folder(spark)
    records = rendered_records(spark, sf, _IDS).select("source_id", "name", "email", "phone")
    sinks.write_per_source(records, folder, "json")
    return spark.read.json(folder).select("source_id", "name", "email", "phone")


@query(
    "masked_output", "A13",
    expected_sql(_IDS, "SELECT profile_id, name, regexp_replace(email, '^[^@]+', '***') AS email FROM expected"),
)
def masked_output(spark, sf):
    return sinks.masked(rendered_records(spark, sf, _IDS)).select("profile_id", "name", "email")
