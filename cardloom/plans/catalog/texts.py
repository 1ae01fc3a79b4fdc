"""Text and URL functions over whole ``documents``, ``pages`` and ``customer`` tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom.functions import text as tx, urls
from cardloom.plans.catalog.base import SQL_SPACE, query, sql_clean
from cardloom.plans.rendered import PEOPLE_SQL, people
from cardloom.sources.tables import PAGES_PER_TASK, spread, table

# documents with no-break spaces and byte order marks mixed in
_NOISY = "concat(' \\u00a0', replace(text, 'e ', 'e\\u00a0\\ufeff '), '\\n\\ufeff')"
_NOISY_SQL = "(' ' || chr(160) || replace(text, 'e ', 'e' || chr(160) || chr(65279) || ' ') || chr(10) || chr(65279))"


def _documents(name, covers, spark_values: dict[str, str], sql_values: dict[str, str]):
    sql = "SELECT doc_id, " + ", ".join(f"{v} AS {k}" for k, v in sql_values.items()) + " FROM documents"

    @query(name, covers, sql)
    def run(spark, sf):
        return spread(table(spark, sf, "documents"), PAGES_PER_TASK).select(
            "doc_id", *[F.expr(v).alias(k) for k, v in spark_values.items()]
        )


_documents(
    "clean_text", "J1 J2",
    dict(n=f"CAST(length({tx.clean(_NOISY)}) AS BIGINT)", digest=f"md5({tx.clean(_NOISY)})"),
    dict(n=f"length({sql_clean(_NOISY_SQL)})", digest=f"md5({sql_clean(_NOISY_SQL)})"),
)
_documents(
    "trim_text", "J3",
    dict(digest=f"md5({tx.trim(_NOISY)})"),
    dict(digest=f"md5(regexp_replace({_NOISY_SQL}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g'))"),
)
_documents(
    "drop_characters", "J4 J5",
    dict(no_quotes=f"md5({tx.drop_quotes('text')})", no_nbsp=f"md5({tx.drop_nbsp(_NOISY)})"),
    dict(no_quotes="md5(replace(text, '\"', ''))", no_nbsp=f"md5(replace({_NOISY_SQL}, chr(160), ''))"),
)
_documents(
    "replace_first_label", "J6 J7 J20",
    dict(
        removed=f"md5({tx.remove_first('text', 'the ')})",
        swapped=f"md5({tx.replace_first('text', 'en', '<en>')})",
        no_scheme=tx.strip_mailto("concat('mailto:', source, '?to=mailto:', doc_id)"),
    ),
    dict(
        removed="md5(regexp_replace(text, 'the ', ''))",
        swapped="md5(regexp_replace(text, 'en', '<en>'))",
        no_scheme="source || '?to=mailto:' || doc_id",
    ),
)
_documents(
    "comma_parts", "J8 J9",
    dict(first=tx.before_comma("text"), second=f"coalesce({tx.second_comma_part('text')}, '')",
         rest=f"md5(coalesce({tx.after_first_comma('text')}, ''))"),
    dict(
        first=sql_clean("split_part(text, ',', 1)"),
        second=f"coalesce({sql_clean('''string_split(text, ',')[2]''')}, '')",
        rest=f"md5(CASE WHEN contains(text, ',') THEN {sql_clean('''substr(text, instr(text, ',') + 1)''')} ELSE '' END)",
    ),
)
_documents(
    "first_segment", "J12",
    dict(segment=f"md5({tx.first_segment('text')})"),
    dict(segment="md5(regexp_split_to_array(text, '\\r?\\n|<br>|<br/>|  |—|–|\\|')[1])"),
)
_documents(
    "second_line", "J14",
    dict(line=f"coalesce({tx.trim(tx.line('text', 1))}, '')"),
    dict(line=f"coalesce(regexp_replace(string_split(text, chr(10))[2], '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g'), '')"),
)
_documents(
    "find_emails", "J16 J17",
    dict(first=tx.find_email("text"), n=f"CAST(size({tx.find_emails('text')}) AS BIGINT)",
         rest=f"md5({tx.drop_emails('text')})"),
    dict(first=f"regexp_extract(text, '{tx.EMAIL}', 0)",
         n=f"CAST(len(regexp_extract_all(text, '{tx.EMAIL}')) AS BIGINT)",
         rest=f"md5(regexp_replace(text, '{tx.EMAIL}', '', 'g'))"),
)
_documents(
    "text_predicates", "D5 D7 D8 D10 J33",
    dict(
        long=tx.longer_than("text", 500),
        job=tx.is_job_text("concat(text, if(doc_id % 3 = 0, ' Director', ''))"),
        comma="contains(text, ',')",
        at=tx.has_at_sign("text"),
        address=f"md5({tx.if_address('text')})",
        low="md5(lower(text))",
    ),
    dict(
        long="length(text) > 500",
        job="length(text || CASE WHEN doc_id % 3 = 0 THEN ' Director' ELSE '' END) < 100 AND "
            "regexp_matches(lower(text || CASE WHEN doc_id % 3 = 0 THEN ' Director' ELSE '' END), "
            "'principal|teacher|director|manager|coordinator')",
        comma="contains(text, ',')",
        at="contains(text, '@')",
        address="md5(CASE WHEN contains(text, '@') THEN text ELSE '' END)",
        low="md5(lower(text))",
    ),
)


def _people(name, covers, spark_values: dict[str, str], sql_values: dict[str, str]):
    sql = f"WITH {PEOPLE_SQL} SELECT key, " + ", ".join(
        f"{v} AS {k}" for k, v in sql_values.items()
    ) + " FROM people"

    @query(name, covers, sql)
    def run(spark, sf):
        persons = people(spark, sf).withColumn("name", F.expr(tx.full_name("first", "last")))
        return persons.select("key", *[F.expr(v).alias(k) for k, v in spark_values.items()])


_DASHED = ("concat(name, CASE key % 3 WHEN 0 THEN ' – ' WHEN 1 THEN '-' ELSE ' ' END, n_name)")
_DASHED_SQL = "(name || CASE key % 3 WHEN 0 THEN ' – ' WHEN 1 THEN '-' ELSE ' ' END || n_name)"
_people(
    "dash_parts", "J10",
    dict(head=tx.before_dash(_DASHED), tail=f"coalesce({tx.after_dash(_DASHED)}, '')"),
    dict(head=f"CASE WHEN key % 3 = 2 THEN trim({_DASHED_SQL}) ELSE name END",
         tail="CASE WHEN key % 3 = 2 THEN '' ELSE n_name END"),
)
_ROLE = "concat(if(key % 2 = 0, concat(title, ': '), ''), name)"
_people(
    "role_and_holder", "J11 C6",
    dict(role=tx.role_of(_ROLE), holder=tx.holder_of(_ROLE)),
    dict(role="CASE WHEN key % 2 = 0 THEN title ELSE 'Board Member' END", holder="name"),
)
_people(
    "handler_values", "J18 J19",
    dict(id=tx.handler_id("concat('open(\\'id=', key, '\\')')"),
         address=tx.joined_address("concat('x=\\'', split_part(email, '@', 1), '\\' + \\'@\\' +\\'example.com\\'')"),
         none=tx.joined_address("email")),
    dict(id="CAST(key AS VARCHAR)", address="email", none="''"),
)
_people(
    "names_and_slugs", "J22 J23 J24",
    dict(
        full=tx.full_name("first", "last"),
        underscore=tx.slug("concat('-', last, ' & ', first, '!')"),
        stripped=tx.slug("concat('-', last, ' & ', first, '!')", strip_ends=True),
        dashed=tx.slug("concat(last, '  ', first, ')')", "-", strip_ends=True),
        spaced=tx.space_slug("concat(last, '  ', first)"),
    ),
    dict(
        full="name",
        underscore="regexp_replace(lower('-' || last || ' & ' || first || '!'), '[^a-z0-9]+', '_', 'g')",
        stripped="regexp_replace(regexp_replace(lower('-' || last || ' & ' || first || '!'), '[^a-z0-9]+', '_', 'g'), "
                 "'^_|_$', '', 'g')",
        dashed="regexp_replace(regexp_replace(lower(last || '  ' || first || ')'), '[^a-z0-9]+', '-', 'g'), "
               "'^-|-$', '', 'g')",
        spaced="lower(regexp_replace(last || '  ' || first, '\\s+', '_', 'g'))",
    ),
)
_people(
    "label_numbers", "J28 J29 J30 J31",
    dict(
        total=tx.label_total("concat('showing 1 - 8 OF ', key, ' constituents')"),
        size=tx.label_page_size("concat('showing 1 - ', key + 1, ' of 900')"),
        default_size=tx.label_page_size("name"),
        parsed=f"coalesce({tx.to_int('''concat(' ', key, 'px')''')}, -1)",
        unparsed=f"coalesce({tx.to_int('email')}, -1)",
        pages=tx.ceil_div("key", "8"),
    ),
    dict(total="key", size="key + 1", default_size="CAST(24 AS BIGINT)",
         parsed="key", unparsed="CAST(-1 AS BIGINT)", pages="CAST(ceil(key / 8.0) AS BIGINT)"),
)
_people(
    "person_name_test", "D6 D12 D13",
    dict(
        plain=tx.is_person_name("name"), single=tx.is_person_name("last"),
        long=tx.is_person_name("concat(name, ' ', title)"),
        intro=tx.is_person_name("concat('Made up of ', name)"),
        number=tx.is_number("CAST(key AS STRING)"), no_number=tx.is_number("email"),
        link=f"coalesce({tx.real_link('''if(key % 2 = 0, '#', email)''')}, '')",
    ),
    dict(
        plain="name <> ''", single="false",
        long="length(name || ' ' || title) <= 50 AND (name <> '' OR contains(title, ' '))",
        intro="false", number="true", no_number="false",
        link="CASE WHEN key % 2 = 0 THEN '' ELSE email END",
    ),
)
_people(
    "fallbacks_and_quotes", "C4 C5 C7 D1 D2 D3 J35",
    dict(
        best=tx.first_non_blank("name", "if(has_email, email, NULL)"),
        filled=tx.or_blank("if(has_email, email, NULL)"),
        empty="''",
        named=tx.not_blank("concat('\\u00a0', name)"),
        both="name <> '' AND has_email", either="name <> '' OR has_email",
        quoted=tx.csv_field("concat(name, ', \"', title, '\"')"),
        masked=tx.mask_email("email"),
    ),
    dict(
        best="CASE WHEN name <> '' THEN name WHEN has_email THEN email ELSE '' END",
        filled="CASE WHEN has_email THEN email ELSE '' END",
        empty="''", named="name <> ''", both="name <> '' AND has_email", either="name <> '' OR has_email",
        quoted="'\"' || replace(name || ', \"' || title || '\"', '\"', '\"\"') || '\"'",
        masked="'***@example.com'",
    ),
)


@query(
    "source_ids", "J25",
    r"""WITH u AS (SELECT page_id, CASE page_id % 10 WHEN 3 THEN 'ht tp://%%%' || url
                      WHEN 5 THEN upper(url) ELSE url END AS url FROM pages),
        h AS (SELECT page_id, url, nullif(lower(regexp_extract(url, '(?i)^https?://([^/?#:@\s%]+)', 1)), '') AS host FROM u)
        SELECT page_id, url, coalesce(split_part(regexp_replace(host, 'www\.', ''), '.', 1), 'unknown_school') AS source_id
        FROM h""",
)
def source_ids(spark, sf):
    url = F.expr("CASE page_id % 10 WHEN 3 THEN concat('ht tp://%%%', url) WHEN 5 THEN upper(url) ELSE url END")
    return table(spark, sf, "pages").select("page_id", url.alias("url")).withColumn(
        "source_id", F.expr(urls.source_id("url"))
    )


@query(
    "page_numbers", "J26 J27",
    r"""SELECT page_id, coalesce(TRY_CAST(nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') AS INTEGER), 1) AS page_no,
               CASE WHEN page_id % 5 = 0 THEN url ELSE url || '?const_page=' || (page_id % 5 + 1) || '&' END AS page_url
        FROM pages""",
)
def page_numbers(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.expr(f"coalesce({urls.page_no('url', 'page')}, 1)").alias("page_no"),
        F.expr(urls.page_url("url", "(page_id % 5 + 1)", "?const_page=", "&")).alias("page_url"),
    )


_HREFS = ("'https://a.example.org/x'", "'/staff/1'", "'?p=2'", "'#top'", "'rel/x.html'", "'../up'", "'//cdn.example.org/y'")


@query(
    "resolve_links", "J32",
    r"""WITH b AS (SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root,
                      regexp_replace(url, '[?#].*$', '') AS path FROM pages),
        f AS (SELECT *, regexp_extract(path, '^(https?://[^/]+(/.*/|/)?)', 1) AS folder FROM b)
        SELECT page_id, 'https://a.example.org/x' AS l0, root || '/staff/1' AS l1, path || '?p=2' AS l2,
               regexp_replace(url, '#.*$', '') || '#top' AS l3, folder || 'rel/x.html' AS l4,
               root || regexp_replace(substr(folder, length(root) + 1), '[^/]+/$', '') || 'up' AS l5,
               regexp_extract(url, '^([^/]*)', 1) || '//cdn.example.org/y' AS l6,
               'https://fixed.example.org' || '/staff/1' AS l7
        FROM f""",
)
def resolve_links(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        *[F.expr(urls.resolve(h, "url")).alias(f"l{i}") for i, h in enumerate(_HREFS)],
        F.expr(urls.with_prefix("'/staff/1'", "https://fixed.example.org")).alias("l7"),
    )


@query(
    "last_html_line", "J13 J15",
    r"""SELECT page_id, md5(regexp_replace(regexp_split_to_array(html, '(?i)<br\s*/?>')[-1], '<[^>]+>', '', 'g')) AS line
        FROM pages""",
)
def last_html_line(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.md5(F.expr(tx.strip_tags(tx.last_html_line("html")))).alias("line")
    )


