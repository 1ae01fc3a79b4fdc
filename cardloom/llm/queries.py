"""The registered queries of this subpackage and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

import hashlib

import public_tokenizers
from cardloom.llm import (
    bpe, chat, decontaminate, exact_dedup, html_extract, jaccard_join, langid, lm_score, phrases, secrets, substring_dedup, vector_codes, warc,
)
from cardloom.llm.common import shared_folder
from cardloom.sources.tables import table
from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op2_exact_dedup", f"""
    WITH d AS (SELECT doc_id, sha256({_LOWER}) AS h, {_LOWER} AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, h AS text_sha256
    FROM d WINDOW w AS (PARTITION BY t)""")
def op2(spark, folder):
    return exact_dedup.exact_groups(documents(spark, folder)).withColumnRenamed("id", "doc_id")


_SCRIPT = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TEXT_WORDS = r"[^\x20\x09-\x0D]+"


@query("op3_decontaminate", f"""
    WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SCRIPT}') AS w FROM documents),
    i AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_SCRIPT}') AS w FROM benchmark),
    sized AS (SELECT *, least(len(w), 10) AS size FROM i WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS win
                FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS s FROM sized)),
    starts AS (SELECT doc_id, size, s, array_to_string(w[s:s + size - 1], ' ') AS win
               FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS s
                     FROM d, (SELECT DISTINCT size FROM sized) WHERE len(w) >= size)),
    hits AS (SELECT doc_id, s, size, item_id FROM starts JOIN windows USING (size, win)),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY 1),
    named AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hits GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
           sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""")
def op3(spark, folder):
    found = decontaminate.contamination(documents(spark, folder), table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op4_secret_scan")
def op4(spark, folder):
    found = secrets.scan(documents(spark, folder), f"{shared_folder(spark)}/ledger")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"),
                        F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))


_WRITTEN = r"""length(regexp_replace(replace(coalesce({0}, ''), '\', '\\'), '([<\[])(/?s>|/?INST\])', '\1\\\2', 'g'))"""


@query("op6_chat_format", f"""
    WITH given AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL
                   SELECT -1, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]'))),
    t AS (SELECT *, coalesce(text, '') AS body, role = 'assistant' AS reply,
                 {len(chat.OPEN + chat.HEAD + chat.END)} + {_WRITTEN.format('role')} + {_WRITTEN.format('text')} AS size FROM given),
    ranked AS (SELECT *, row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS is_last
               FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
    behind AS (SELECT *, count(*) FILTER (WHERE reply OR is_last) OVER (PARTITION BY conv_id ORDER BY turn, role, text
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS examples FROM ranked)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(body)) FILTER (WHERE reply), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(body, '' ORDER BY turn, role, text) FILTER (WHERE reply), '')) AS loss_sha256,
           CAST(sum(size * examples) AS BIGINT) AS formatted_chars FROM behind GROUP BY conv_id""")
def op6(spark, folder):
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    fixed = spark.createDataFrame(
        [(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))], given.schema)
    made = chat.examples(given.unionByName(fixed))
    masked = F.struct("example", chat.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("text"))
    by_conv = made.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"), F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
        F.sort_array(F.collect_list(masked)).alias("masked"))
    turns = by_conv.select("conv_id", "formatted_chars", chat.read_back(F.col("longest")).alias("turns"),
                           F.array_join(F.col("masked.text"), "").alias("loss"))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
                        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


@query("op5_substring_dedup", f"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_TEXT_WORDS}') AS w FROM documents),
    s AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS win
          FROM (SELECT *, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
    first AS (SELECT win, min(doc_id) AS least_id FROM s GROUP BY win),
    gone AS (SELECT doc_id, list(DISTINCT q) AS g FROM (
                 SELECT doc_id, unnest(range(p, p + 50)) AS q FROM s JOIN first USING (win) WHERE least_id < doc_id) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(len(g), 0) AS n_removed,
           sha256(coalesce(CASE WHEN g IS NULL THEN array_to_string(w, ' ') ELSE k END, '')) AS kept_sha256
    FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN (
        SELECT doc_id, string_agg(x, ' ' ORDER BY q) AS k
        FROM (SELECT doc_id, g, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d JOIN gone USING (doc_id))
        WHERE NOT list_contains(g, q) GROUP BY doc_id) USING (doc_id)""")
def op5(spark, folder):
    return substring_dedup.without_repeats(documents(spark, folder)).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_bpe")
def op7(spark, folder):
    coded = bpe.encode_decode(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _remainder(n: int):
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


@query("op9_language_id")
def op9(spark, folder):
    docs = documents(spark, folder)
    model = langid.train(docs.filter(_remainder(4) != 2))
    return langid.identify(docs, model).select(
        F.col("id").alias("doc_id"), "lang_pred", "score", "rejected").withColumn("held_out", _remainder(4) == 2)


@query("op10_jaccard_join", f"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TEXT_WORDS}') AS w FROM documents),
    g AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS gram
          FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
    linked AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
               WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
    ways AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
    reach(a, b) AS (SELECT x, y FROM ways UNION SELECT reach.a, ways.y FROM reach JOIN ways ON ways.x = reach.b),
    low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(low.b, doc_id), doc_id) AS component_id
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = doc_id""")
def op10(spark, folder):
    return jaccard_join.near_components(documents(spark, folder)).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query("op8_lm_score")
def op8(spark, folder):
    found = lm_score.scores(documents(spark, folder), _remainder(5) != 1)
    return found.select(F.col("id").alias("doc_id"), (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op1_html_extract")
def op1(spark, folder):
    found = html_extract.main_texts(table(spark, folder, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op13_phrases", f"""
    WITH d AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
    p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d),
    total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
    grams AS (SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase
              FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM p, (SELECT unnest([1, 2, 3]) AS k))),
    f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10),
    cut AS (SELECT f.lang, f.k, f.phrase, f.a, c, array_to_string(string_split(f.phrase, ' ')[:c], ' ') AS head,
                   array_to_string(string_split(f.phrase, ' ')[c + 1:], ' ') AS tail
            FROM f, (SELECT unnest([1, 2]) AS c) WHERE c < f.k),
    scored AS (SELECT cut.lang, cut.phrase, cut.k, cut.a, c, h.a AS l, t.a AS r,
                      (1000000::HUGEINT * cut.a * cut.a) // (h.a::HUGEINT * t.a) AS score
               FROM cut JOIN f h ON h.lang = cut.lang AND h.phrase = head JOIN f t ON t.lang = cut.lang AND t.phrase = tail),
    least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
    inner_of AS (SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '),
                                      array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, a FROM f WHERE k = 3),
    longer AS (SELECT lang, phrase, max(a) AS m FROM inner_of GROUP BY ALL),
    kept AS (SELECT least.* FROM least LEFT JOIN longer USING (lang, phrase) WHERE m IS NULL OR 100 * m < 50 * least.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
           CAST(score AS BIGINT) AS score
    FROM kept JOIN total USING (lang) QUALIFY rank <= 2000""")
def op13(spark, folder):
    return phrases.collocations(documents(spark, folder)).drop("first_doc")


def _lloyd_sql(rounds: int = 4) -> str:
    """Rounds of assigning and moving, written out one after the other."""
    apart = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x.v, c.v)])"
    near = lambda i: (f"a{i} AS MATERIALIZED (SELECT vec_id, x.p, min_by(e, ROW({apart}, e)) AS e, min({apart}) AS dist "
                      f"FROM parts x JOIN c{i} c ON c.p = x.p GROUP BY vec_id, x.p)")
    moved = lambda i: f"""c{i + 1} AS MATERIALIZED (
        SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
            SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS v FROM (
                SELECT a.p, a.e, pos, sum(x.v[pos]) AS s, count(*) AS n
                FROM a{i} a JOIN parts x ON x.vec_id = a.vec_id AND x.p = a.p, (SELECT unnest(range(1, (SELECT max(d) FROM k) + 1)) AS pos)
                GROUP BY ALL) GROUP BY p, e) m ON m.p = c.p AND m.e = c.e)"""
    steps = ",\n    ".join(f"{near(i)},\n    {moved(i)}" for i in range(rounds))
    return f"""
    WITH k AS MATERIALIZED (
        SELECT vec_id, label, len(embedding) // 4 AS d, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
    parts AS MATERIALIZED (SELECT vec_id, p, v[p * d + 1:(p + 1) * d] AS v FROM k, (SELECT unnest(range(4)) AS p)),
    c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts QUALIFY e < 256),
    {steps},
    {near(rounds)},
    found AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error
              FROM a{rounds} GROUP BY vec_id)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
    FROM found JOIN k USING (vec_id)"""


@query("op12_vector_codes", _lloyd_sql())
def op12(spark, folder):
    coded, codebooks = vector_codes.compress(table(spark, folder, "embeddings"))
    listed = ",".join(str(x) for entries in codebooks for entry in entries for x in entry)
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error",
                        F.lit(hashlib.sha256(listed.encode()).hexdigest()).alias("codebooks_sha256"))


def _base32_sql(sha1: str) -> str:
    """40 bits at a time."""
    parts = [f"to_base(CAST('0x' || substr({sha1}, {1 + 10 * i}, 10) AS BIGINT), 32, 8)" for i in range(4)]
    return f"translate({' || '.join(parts)}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"


@query("op11_warc", f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS kept FROM p)
    SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {_base32_sql('sha1(body)')} AS payload_digest,
           CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> kept THEN kept END AS refers_to
    FROM g""")
def op11(spark, folder):
    pages, place = table(spark, folder, "pages"), shared_folder(spark)
    warc.write_archives(pages, f"{place}/raw")
    index = warc.normalise(spark, f"{place}/raw", f"{place}/members")
    read = warc.read_records(index, f"{place}/members")
    full = F.col("type") == "response"  # a revisit states what the payload it left out was
    kind = pages.schema["page_id"].dataType
    return read.select(
        F.col("id").cast(kind).alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("http_bytes")).alias("payload_bytes"),
        F.when(full, warc.base32_sha1(F.col("payload"))).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"))
