"""All registered queries of the library itself and their SQL, on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions import urls as U
from foliospark.functions import values as V
from foliospark.operators import aggregates as A
from foliospark.operators import compare as C
from foliospark.operators import documents as D
from foliospark.operators import ingest as I
from foliospark.operators import personal_data as P
from foliospark.operators import provenance as R
from foliospark.operators import sequences as S
from foliospark.operators import structured as SD
from foliospark.plans import fts
from foliospark.sources.shared import materialised

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long(c: str):
    return F.col(c).cast("long").alias(c)


# White space as both engines' classes know it, and the token fold in SQL.
SQL_SPACE = r"[\s\v\x1c-\x1f\x85\p{Z}]"
SQL_NORM = r"(' ' || trim(regexp_replace(strip_accents(lower(coalesce(text, ''))), '[^\p{L}\p{N}]+', ' ', 'g')) || ' ')"
SQL_LINES = "(SELECT doc_id, lang, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) + 1 AS page_number FROM documents)"


def has(phrase: str, norm: str = "norm") -> str:
    return f"contains({norm}, ' {phrase} ')"


# ---- labels and counts -------------------------------------------------------


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def label_counts(spark, d):
    return A.label_counts(t(spark, d, "documents"), "lang", "source")


@query("SELECT lang, coalesce(CAST(quality AS VARCHAR), 'unknown') AS quality, count(*) AS n, count(DISTINCT d.doc_id) AS documents FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2")
def label_crosstab_unknown(spark, d):
    rows = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left").withColumn("quality", F.coalesce(F.col("quality").cast("string"), F.lit("unknown")))
    return rows.groupBy("lang", "quality").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("documents"))


@query("SELECT lang, count(DISTINCT doc_id) AS documents, CAST(min(n_chars) AS BIGINT) AS least, CAST(max(n_chars) AS BIGINT) AS most FROM documents GROUP BY lang")
def distinct_documents_by_voice(spark, d):
    return t(spark, d, "documents").groupBy("lang").agg(F.countDistinct("doc_id").alias("documents"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"))


# ---- text metrics and quality -----------------------------------------------


@query(rf"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS characters, CAST(length(regexp_replace(text, '{SQL_SPACE}', '', 'g')) AS BIGINT) AS nonspace,
  CAST(len(string_split(text, chr(10))) AS BIGINT) AS line_count, CAST(length(text) - length(replace(text, chr(65533), '')) AS BIGINT) AS replacements,
  length(regexp_replace(text, '{SQL_SPACE}', '', 'g')) < 100 AS low_text
FROM documents""")
def text_metrics(spark, d):
    body = F.col("text")
    m = T.page_metrics(F.array(body))
    return t(spark, d, "documents").select("doc_id", m["characters"].alias("characters"), m["nonspace_characters"].alias("nonspace"), F.size(F.split(body, "\n", -1)).cast("long").alias("line_count"), m["replacement_characters"].alias("replacements"), m["low_text"].alias("low_text"))


@query(f"SELECT doc_id, CAST(page_number AS BIGINT) AS page_number, CAST(length(line) AS BIGINT) AS characters FROM {SQL_LINES}")
def pseudo_pages(spark, d):
    pages = t(spark, d, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    return pages.select("doc_id", (F.col("pos") + 1).cast("long").alias("page_number"), F.length("line").cast("long").alias("characters"))


SQL_GRADES = rf"""(
WITH p AS (SELECT doc_id, lang, length(regexp_replace(line, '{SQL_SPACE}', '', 'g')) AS dense FROM {SQL_LINES}),
m AS (SELECT doc_id, any_value(lang) AS lang, count(*) AS pages, sum(dense) AS dense, count(*) FILTER (dense < 30) AS empty_pages FROM p GROUP BY doc_id)
SELECT doc_id, lang, CAST(pages AS BIGINT) AS pages, CAST(dense AS BIGINT) AS dense, CAST(empty_pages AS BIGINT) AS empty_pages,
 CASE WHEN dense < 100 THEN 'empty' WHEN empty_pages / pages >= 0.30 THEN 'gappy' WHEN dense / pages < 200 THEN 'thin' ELSE 'ok' END AS grade FROM m)"""


def _graded(spark, d):
    m = T.page_metrics(F.split(F.coalesce("text", F.lit("")), "\n", -1))
    rows = t(spark, d, "documents").select("doc_id", "lang", m["page_count"].alias("pages"), m["nonspace_characters"].alias("dense"), m["replacement_characters"].alias("repl"), m["empty_pages"].alias("empty_pages"))
    return rows.withColumn("grade", T.grade(F.col("pages"), F.col("dense"), F.col("repl"), F.col("empty_pages"))).drop("repl")


@query(f"SELECT * FROM {SQL_GRADES}")
def quality_grade(spark, d):
    return _graded(spark, d)


@query(f"SELECT grade, count(*) AS documents, CAST(sum(dense) AS BIGINT) AS characters, round(100.0 * count(*) / (SELECT count(*) FROM documents), 2) AS share, round(median(dense / pages), 3) AS median_density FROM {SQL_GRADES} GROUP BY grade")
def quality_summary(spark, d):
    # Grades are read by the counts, the total and the two passes of the medians; the texts are read once.
    rows = materialised(_graded(spark, d).select("grade", "dense", "pages"), "grades")
    total = rows.agg(F.count("*").alias("total"))
    medians = A.grouped_medians(rows.withColumn("density", F.col("dense") / F.col("pages")), ["grade"], "density").withColumn("median_density", F.round("median", 3))
    out = rows.groupBy("grade").agg(F.count("*").alias("documents"), F.sum("dense").alias("characters")).join(medians, "grade")
    return out.join(F.broadcast(total)).select("grade", "documents", "characters", F.round(100.0 * F.col("documents") / F.col("total"), 2).alias("share"), "median_density")


@query(rf"""
WITH l AS (SELECT doc_id, lower(trim(regexp_replace(line, '[ \t]+', ' ', 'g'))) AS line FROM {SQL_LINES}),
g AS (SELECT doc_id, line, count(*) AS c FROM l WHERE length(regexp_replace(line, '[^\p{{L}}\p{{N}}]', '', 'g')) >= 20 GROUP BY ALL)
SELECT doc_id, CAST(sum(c * length(line)) AS BIGINT) AS line_characters, CAST(sum((c - 1) * length(line)) AS BIGINT) AS repeated_characters,
 round(sum((c - 1) * length(line)) / sum(c * length(line)), 4) AS repeated_share FROM g GROUP BY doc_id""")
def repeated_line_share(spark, d):
    return S.repeated_line_share(t(spark, d, "documents"), "doc_id", "text")


@query("SELECT count(*) FILTER (share > 4) = 0 AS passed, any_value(share) AS share FROM (SELECT round(100.0 * sum((c - 1) * n) / sum(c * n), 2) AS share FROM (SELECT text, count(*) AS c, any_value(length(text)) AS n FROM documents GROUP BY text))")
def quality_gate(spark, d):
    per = t(spark, d, "documents").groupBy(F.sha2("text", 256).alias("h")).agg(F.count("*").alias("c"), F.max(F.length("text")).alias("n"))
    share = per.agg(F.round(100.0 * F.sum((F.col("c") - 1) * F.col("n")) / F.sum(F.col("c") * F.col("n")), 2).alias("share"))
    return share.select((F.col("share") <= 4).alias("passed"), "share")


@query("SELECT doc_id, left(text, 80) AS opening, CAST(instr(text, chr(10)) AS BIGINT) AS first_break FROM documents")
def opening_text(spark, d):
    return t(spark, d, "documents").select("doc_id", F.left("text", F.lit(80)).alias("opening"), F.instr("text", "\n").cast("long").alias("first_break"))


# ---- exact content ----------------------------------------------------------


@query("SELECT doc_id, sha256(text) AS content_sha256, count(*) OVER (PARTITION BY text) AS cluster_size, min(doc_id) OVER (PARTITION BY text) AS cluster_first FROM documents")
def content_clusters(spark, d):
    return S.clusters(t(spark, d, "documents"), F.col("text"), "doc_id").select("doc_id", "content_sha256", "cluster_size", "cluster_first")


@query(f"""SELECT CAST(sum(c) AS BIGINT) AS pages, CAST(sum(c - 1) AS BIGINT) AS duplicate_pages, CAST(sum((c - 1) * length(line)) AS BIGINT) AS duplicate_characters, CAST(sum(c * length(line)) AS BIGINT) AS characters,
 round(sum((c - 1) * length(line)) / sum(c * length(line)), 4) AS duplicate_share FROM (SELECT line, count(*) AS c FROM {SQL_LINES} GROUP BY line)""")
def duplicate_page_excess(spark, d):
    lines = t(spark, d, "documents").select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line"))
    return S.duplicate_excess(lines, F.col("line"))


@query("SELECT sha256(text) AS content_sha256, min(doc_id) AS doc_id, array_to_string(list_sort(list(DISTINCT source)), ' | ') AS aliases, count(*) AS n_rows FROM documents GROUP BY text")
def first_wins_dedupe(spark, d):
    rows = t(spark, d, "documents").select(F.sha2("text", 256).alias("content_sha256"), "doc_id", "source")
    return S.first_wins(rows, "content_sha256", ["doc_id"], "source").withColumn("aliases", F.array_join("aliases", " | "))


@query("""WITH c AS (SELECT user_id, event_type, min(event_id) AS event_id FROM events WHERE user_id < 200 OR event_type = 'error' GROUP BY ALL),
s AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM c)
SELECT user_id, event_type, event_id, CASE WHEN n = 1 THEN 'only-candidate' ELSE 'explicit-preference' END AS selection_basis, n - 1 AS alternates FROM s WHERE n = 1 OR event_type = CASE WHEN user_id % 2 = 0 THEN 'click' ELSE 'view' END""")
def preference_dedupe(spark, d):
    rows = t(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    preferred = rows.select("user_id").distinct().withColumn("preferred", F.when(F.col("user_id") % 2 == 0, "click").otherwise("view"))
    return S.preference_dedupe(rows, "user_id", "event_type", preferred).select("user_id", "event_type", "event_id", "selection_basis", "alternates")


# ---- full text --------------------------------------------------------------

TOPICS = {
    "both_words": "and AND the",
    "phrase_or_word": '"of the" OR ion',
    "nested": "(de OR la OR le) AND NOT_A_WORD OR und",
    "license": 'licensed OR "all rights reserved" OR "public license"',
    "precedence": "der OR die AND und",
}
SQL_TOPICS = {
    "both_words": f"({has('and')} AND {has('the')})",
    "phrase_or_word": f"({has('of the')} OR {has('ion')})",
    "nested": f"((({has('de')} OR {has('la')} OR {has('le')}) AND {has('not a word')}) OR {has('und')})",
    "license": f"({has('licensed')} OR {has('all rights reserved')} OR {has('public license')})",
    "precedence": f"({has('der')} OR ({has('die')} AND {has('und')}))",
}
SQL_HITS = "(" + " UNION ALL ".join(f"SELECT '{k}' AS query, doc_id, lang, source, n_chars FROM n WHERE {v}" for k, v in SQL_TOPICS.items()) + ")"
WITH_NORM = f"WITH n AS (SELECT doc_id, lang, source, n_chars, {SQL_NORM} AS norm FROM documents)"


def _hits(spark, d):
    return fts.scan(fts.with_norms(t(spark, d, "documents")), TOPICS, ["doc_id", "lang", "source", "n_chars"])


@query(f"{WITH_NORM} SELECT query, count(*) AS matching_pages, count(DISTINCT doc_id) AS matching_documents FROM {SQL_HITS} GROUP BY query")
def fts_match_counts(spark, d):
    return fts.topic_totals(_hits(spark, d), "doc_id")


@query(f"{WITH_NORM} SELECT query, lang, count(*) AS matching_pages, count(DISTINCT doc_id) AS matching_documents FROM {SQL_HITS} GROUP BY query, lang")
def fts_topic_scan_by_label(spark, d):
    return fts.topic_totals(_hits(spark, d), "doc_id", ["lang"])


@query(f"""{WITH_NORM}, h AS (SELECT * FROM {SQL_HITS}), a AS (SELECT query,
 count(*) FILTER (lang = 'en') AS pages_0, count(DISTINCT doc_id) FILTER (lang = 'en') AS documents_0, count(DISTINCT source) FILTER (lang = 'en') AS engagements_0, count(DISTINCT n_chars % 30) FILTER (lang = 'en') AS years_0, min(n_chars % 30) FILTER (lang = 'en') AS first_0, max(n_chars % 30) FILTER (lang = 'en') AS last_0,
 count(*) FILTER (lang = 'de') AS pages_1, count(DISTINCT doc_id) FILTER (lang = 'de') AS documents_1, count(DISTINCT source) FILTER (lang = 'de') AS engagements_1, count(DISTINCT n_chars % 30) FILTER (lang = 'de') AS years_1, min(n_chars % 30) FILTER (lang = 'de') AS first_1, max(n_chars % 30) FILTER (lang = 'de') AS last_1
 FROM h GROUP BY query), s AS (SELECT *, round(100.0 * documents_0 / (SELECT count(*) FROM documents WHERE lang = 'en'), 1) AS share_0, round(100.0 * documents_1 / (SELECT count(*) FROM documents WHERE lang = 'de'), 1) AS share_1 FROM a)
SELECT *, CASE WHEN share_1 <> 0 THEN round(share_0 / share_1, 2) END AS ratio, engagements_0 * years_0 AS score FROM s""")
def fts_persistence_scan(spark, d):
    hits = _hits(spark, d).withColumn("year", F.col("n_chars") % 30)
    return fts.persistence(hits, t(spark, d, "documents"), "doc_id", "lang", "source", "year", ("en", "de"))


def _line_pages(spark, d):
    pages = t(spark, d, "documents").select("doc_id", "lang", "source", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "text"))
    return fts.with_norms(pages.withColumn("page_number", (F.col("pos") + 1).cast("long")).drop("pos"))


SQL_LINE_NORM = SQL_NORM.replace("coalesce(text, '')", "line")


@query(f"""WITH n AS (SELECT doc_id, page_number, {SQL_LINE_NORM} AS norm FROM {SQL_LINES})
SELECT doc_id, count(*) AS matching_pages, CAST(min(page_number) AS BIGINT) AS first_page FROM n WHERE {has('the')} AND {has('of')} GROUP BY doc_id ORDER BY matching_pages DESC, doc_id LIMIT 25""")
def fts_top_documents(spark, d):
    hits = _line_pages(spark, d).filter(fts.matches("the AND of", F.col("text_norm")))
    return hits.groupBy("doc_id").agg(F.count("*").alias("matching_pages"), F.min("page_number").alias("first_page")).orderBy(F.desc("matching_pages"), "doc_id").limit(25)


def sql_bm25(source: str, keys: str, phrases: list[str], condition: str) -> str:
    """The closed BM25 formula over rows with ``norm``; a common table expression named scored."""
    f = ", ".join(f"CAST((length(replace(norm, ' ', '  ')) - length(replace(replace(norm, ' ', '  '), ' {p.replace(' ', '  ')} ', ''))) / {len(p.replace(' ', '  ')) + 2} AS DOUBLE) AS f{i}" for i, p in enumerate(phrases))
    n = ", ".join(f"count(*) FILTER (f{i} > 0) AS n{i}" for i in range(len(phrases)))
    idf = lambda i: f"(CASE WHEN ln((n - n{i} + 0.5) / (n{i} + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - n{i} + 0.5) / (n{i} + 0.5)) END)"
    total = " + ".join(f"{idf(i)} * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * tokens / mean))" for i in range(len(phrases)))
    return f"""src AS ({source}), cnt AS (SELECT *, {f}, CASE WHEN norm = '  ' THEN 0 ELSE length(norm) - length(replace(norm, ' ', '')) - 1 END AS tokens FROM src),
st AS (SELECT count(*) AS n, avg(tokens) AS mean, {n} FROM cnt), scored AS (SELECT {keys}, round(-({total}), 6) AS score FROM cnt, st WHERE {condition})"""


DOC_SOURCE = f"SELECT doc_id, lang, {SQL_NORM} AS norm FROM documents"
LINE_SOURCE = f"SELECT doc_id, page_number, {SQL_LINE_NORM} AS norm FROM {SQL_LINES}"


@query(f"WITH {sql_bm25(DOC_SOURCE, 'doc_id', ['of the', 'and'], f'({has("of the")} OR {has("and")})')} SELECT doc_id, score FROM scored ORDER BY score, doc_id LIMIT 50")
def bm25_topk(spark, d):
    scored = fts.bm25_many(fts.with_norms(t(spark, d, "documents")), {"q": '"of the" OR and'}, ["doc_id"]).select("doc_id", F.round("score", 6).alias("score"))
    return scored.orderBy("score", "doc_id").limit(50)


@query(f"""WITH {sql_bm25(LINE_SOURCE, 'doc_id, page_number', ['the'], has('the'))},
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score, page_number) AS k FROM scored)
SELECT doc_id, CAST(page_number AS BIGINT) AS page_number, score, row_number() OVER (ORDER BY score, doc_id) AS rank FROM b WHERE k = 1 ORDER BY score, doc_id LIMIT 40""")
def best_line_per_document(spark, d):
    scored = fts.bm25_many(_line_pages(spark, d), {"q": "the"}, ["doc_id", "page_number"]).select("doc_id", "page_number", F.round("score", 6).alias("score"))
    order = [F.col("score"), F.col("doc_id"), F.col("page_number")]
    return fts.best_page_per_document(scored, "doc_id", order, 40).withColumn("rank", F.col("rank").cast("long"))


@query(f"""WITH {sql_bm25(LINE_SOURCE, 'doc_id, page_number', ['and'], has('and'))}, x AS (SELECT *, 0 AS query_index FROM scored ORDER BY score, doc_id, page_number LIMIT 30),
{sql_bm25(LINE_SOURCE, 'doc_id, page_number', ['the'], has('the')).replace('src', 'src2').replace('cnt', 'cnt2').replace('st AS', 'st2 AS').replace(', st WHERE', ', st2 WHERE').replace('scored', 'scored2')}, y AS (SELECT *, 1 AS query_index FROM scored2 ORDER BY score, doc_id, page_number LIMIT 30)
SELECT doc_id, CAST(page_number AS BIGINT) AS page_number, min(query_index) AS query_index, arg_min(score, query_index) AS score FROM (SELECT * FROM x UNION ALL SELECT * FROM y) GROUP BY doc_id, page_number""")
def bundle_first_wins(spark, d):
    return fts.bundle(_line_pages(spark, d), ["and", "the"], 30, ["doc_id", "page_number"])


EVIDENCE = {"a": ("of", ["of"]), "b": ('"of the"', ["of the"])}


def sql_evidence() -> str:
    parts, out = [], []
    for n, (_, phrases) in EVIDENCE.items():
        for kind, extra in (("relevance", []), ("signal", ["and"])):
            both = list(dict.fromkeys(phrases + extra))
            tag = f"{n}_{kind}"
            one = sql_bm25(LINE_SOURCE, "doc_id, page_number", both, " AND ".join(has(p) for p in both))
            for word in ("src", "cnt", "scored"):
                one = one.replace(word, f"{word}_{tag}")
            one = one.replace("\nst AS", f"\nst_{tag} AS").replace(", st WHERE", f", st_{tag} WHERE")
            parts.append(one)
            out.append(f"SELECT doc_id, page_number, score, row_number() OVER (ORDER BY score, doc_id) AS rank, '{n}' AS topic, '{kind}' AS ranking FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score, page_number) AS k FROM scored_{tag}) WHERE k = 1 QUALIFY rank <= 15")
    return f"WITH {', '.join(parts)} SELECT doc_id, CAST(page_number AS BIGINT) AS page_number, score, rank, topic, ranking FROM ({' UNION ALL '.join(f'({x})' for x in out)})"


@query(sql_evidence())
def evidence_candidates(spark, d):
    topics = {n: q for n, (q, _) in EVIDENCE.items()}
    out = fts.evidence(_line_pages(spark, d), topics, "and", "doc_id", ["page_number"], ["doc_id", "page_number"])
    return out.select("doc_id", "page_number", "score", F.col("rank").cast("long").alias("rank"), "topic", "ranking")


@query(f"""{WITH_NORM.replace('n_chars,', 'n_chars, text,')}, x AS (SELECT doc_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+') AS w, string_split_regex(text, '[\\p{{L}}\\p{{N}}]+') AS s FROM n WHERE {has('of the')}),
y AS (SELECT *, list_transform(w, lambda v: strip_accents(lower(v))) AS f, len(w) AS m FROM x), z AS (SELECT *, list_transform(range(1, m + 1), lambda i: CASE WHEN (f[i] = 'of' AND i < m AND f[i + 1] = 'the') OR (f[i] = 'the' AND i > 1 AND f[i - 1] = 'of') THEN 1 ELSE 0 END) AS h FROM y),
u AS (SELECT *, list_transform(range(1, greatest(1, m - 35) + 1), lambda i: list_sum(h[i:i + 35])) AS t FROM z), v AS (SELECT *, list_position(t, list_max(t)) AS a FROM u), e AS (SELECT *, least(a + 35, m) AS b FROM v)
SELECT doc_id, CASE WHEN a > 1 THEN ' ... ' ELSE '' END || array_to_string(list_transform(range(a, b + 1), lambda j: CASE WHEN j > a THEN s[j] ELSE '' END || CASE WHEN h[j] = 1 AND NOT (j > a AND h[j - 1] = 1) THEN '[' ELSE '' END || w[j] || CASE WHEN h[j] = 1 AND NOT (j < b AND h[j + 1] = 1) THEN ']' ELSE '' END), '') || CASE WHEN b < m THEN ' ... ' ELSE '' END AS snippet FROM e""")
def snippet_rows(spark, d):
    hits = fts.with_norms(t(spark, d, "documents")).filter(fts.matches('"of the"', F.col("text_norm")))
    return hits.select("doc_id", fts.snippet(["of the"])(F.col("text")).alias("snippet"))


@query("SELECT DISTINCT d.doc_id, d.source FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1 AND contains(lower(d.text), 'license')")
def substring_search_distinct(spark, d):
    hit = t(spark, d, "documents").filter(F.lower("text").contains("license"))
    return hit.join(t(spark, d, "labels").filter("quality = 1"), "doc_id", "left_semi").select("doc_id", "source").distinct()


# ---- URLs and HTML ----------------------------------------------------------

SQL_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
SQL_PATH = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
SQL_QUERY = r"regexp_extract(url, '^[^?#]*\?([^#]*)', 1)"
SQL_PAIRS = f"array_to_string(list_sort(list_filter(string_split({SQL_QUERY}, '&'), lambda p: p <> '')), '&')"


@query(f"SELECT page_id, regexp_replace({SQL_HOST}, '^www\\.', '') || '|' || lower({SQL_PATH}) || '|' || {SQL_PAIRS} AS url_key, {SQL_HOST} AS host FROM pages")
def url_key_parts(spark, d):
    url = F.col("url")
    return t(spark, d, "pages").select("page_id", U.url_key(url).alias("url_key"), U.host(url).alias("host"))


@query(f"SELECT page_id, lower(regexp_extract(url, '^([a-z]+)://', 1)) || '://' || {SQL_HOST} || CASE WHEN {SQL_PATH} = '' THEN '/' ELSE {SQL_PATH} END || CASE WHEN {SQL_PAIRS} <> '' THEN '?' || {SQL_PAIRS} ELSE '' END AS canonical FROM pages")
def url_canonical(spark, d):
    return t(spark, d, "pages").select("page_id", U.canonical(F.col("url")).alias("canonical"))


@query(rf"SELECT regexp_extract(lower({SQL_PATH}), '\.([a-z0-9]{{1,10}})$', 1) AS extension, count(*) AS n FROM pages GROUP BY 1")
def url_extension(spark, d):
    return t(spark, d, "pages").groupBy(U.extension(F.col("url")).alias("extension")).agg(F.count("*").alias("n"))


@query(rf"SELECT page_id, left(trim(regexp_replace(regexp_replace(string_split({SQL_PATH}, '/')[-1], '\.[A-Za-z0-9]{{1,10}}$', ''), '[-_ ]+', ' ', 'g')), 500) AS title FROM pages")
def title_from_url(spark, d):
    return t(spark, d, "pages").select("page_id", U.title_from_url(F.col("url")).alias("title"))


@query("""SELECT page_id, CAST(len(list_filter(regexp_extract_all(html, '(?i)\\s(?:href|src|data-src|data-href)\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1), lambda v: NOT regexp_matches(trim(v, '"'''), '(?i)^(?:#|mailto:|tel:|javascript:|data:)') AND trim(v, '"''') <> '')) AS BIGINT) AS links FROM pages""")
def html_link_counts(spark, d):
    return t(spark, d, "pages").select("page_id", F.size(U.raw_links(F.col("html"))).cast("long").alias("links"))


# Of the ways to write a relative address: from the scheme, from the host, or in the page's own folder.
SQL_ABSOLUTE = f"CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN l WHEN l LIKE '//%' THEN regexp_extract(url, '^[A-Za-z]+:', 0) || l WHEN l LIKE '/%' THEN regexp_extract(url, '^[A-Za-z]+://[^/?#]*', 0) || l ELSE regexp_extract(url, '^[A-Za-z]+://[^/?#]*', 0) || regexp_extract({SQL_PATH}, '^.*/', 0) || l END"
SQL_QUOTES = "chr(34) || chr(39)"


@query(f"""WITH x AS (SELECT page_id, url, list_filter(list_transform(regexp_extract_all(html, '(?i)\\s(?:href|src|data-src|data-href)\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1), lambda v: replace(trim(trim(v, {SQL_QUOTES})), '&amp;', '&')), lambda v: v <> '' AND NOT regexp_matches(v, '(?i)^(?:#|mailto:|tel:|javascript:|data:)')) AS a FROM pages),
y AS (SELECT page_id, url, unnest(a) AS l, unnest(range(len(a))) AS p FROM x), z AS (SELECT page_id, p, regexp_replace({SQL_ABSOLUTE}, '#.*$', '') AS link FROM y), f AS (SELECT page_id, link, min(p) AS p FROM z GROUP BY ALL)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY p) - 1 AS INT) AS ordinal, link FROM f""")
def html_links(spark, d):
    pages = t(spark, d, "pages")
    return pages.select("page_id", F.posexplode(U.resolve_links(F.col("url"), U.raw_links(F.col("html")))).alias("ordinal", "link"))


@query(f"SELECT {SQL_HOST} AS host, count(*) AS n FROM pages WHERE regexp_matches({SQL_HOST}, '(^|\\.)example\\.(com|org)$') GROUP BY 1")
def host_allowlist(spark, d):
    return t(spark, d, "pages").select(U.host(F.col("url")).alias("host")).filter(F.col("host").rlike(r"(^|\.)example\.(com|org)$")).groupBy("host").agg(F.count("*").alias("n"))


ROBOTS = [(False, "/en/"), (True, "/en/6"), (False, "/*.html$"), (False, "/de/9"), (True, "/de/9")]


@query(f"""WITH p AS (SELECT page_id, {SQL_PATH} AS path FROM pages)
SELECT page_id, CASE WHEN path LIKE '%.html' AND path LIKE '/%' THEN 0 WHEN path LIKE '/en/6%' THEN 1 WHEN path LIKE '/de/9%' THEN 1 WHEN path LIKE '/en/%' THEN 0 ELSE 1 END = 1 AS allowed FROM p""")
def robots_allowed(spark, d):
    return U.robots_allowed(t(spark, d, "pages").withColumn("path", U.path(F.col("url"))), "path", ROBOTS).select("page_id", "allowed")


@query(f"SELECT page_id, 'pages/' || left(sha256(html), 2) || '/' || sha256(html) || '.html' AS snapshot, sha256(url)[1:2] || '/' || sha256(url)[3:4] || '/' || sha256(url) || '.html' AS blob, left(sha256({SQL_QUERY}), 10) AS query_hash FROM pages")
def safe_path_key(spark, d):
    url = F.col("url")
    return t(spark, d, "pages").select("page_id", U.snapshot_key(F.col("html")).alias("snapshot"), U.blob_key(F.sha2(url, 256), F.lit(""), F.lit("HTML")).alias("blob"), V.short_hash(U.query(url)).alias("query_hash"))


@query(f"""WITH x AS (SELECT {SQL_HOST} AS host, {SQL_PATH} AS path FROM pages)
SELECT host, array_to_string(list_sort(list(DISTINCT path)), ' | ') AS aliases, count(DISTINCT path) AS n_aliases, min(path) AS first_path FROM x GROUP BY host""")
def alias_union(spark, d):
    rows = t(spark, d, "pages").select(U.host(F.col("url")).alias("host"), U.path(F.col("url")).alias("path"))
    out = rows.groupBy("host").agg(F.array_sort(F.collect_set("path")).alias("a"))
    return out.select("host", F.array_join("a", " | ").alias("aliases"), F.size("a").cast("long").alias("n_aliases"), F.element_at("a", 1).alias("first_path"))


# ---- provenance -------------------------------------------------------------

RULE_URL = "CASE d.doc_id % 5 WHEN 0 THEN 'https://h.example/docs/consultation-papers/cp0' || (d.doc_id % 90) || '/response-from-x' || d.doc_id || '.pdf' WHEN 1 THEN 'https://h.example/docs/consultation-papers/cp71/guidance-note-' || d.doc_id || '.pdf' WHEN 2 THEN 'https://h.example/docs/discussion-papers/dp-' || (d.doc_id % 9) || '/dp' || d.doc_id || '-note.pdf' WHEN 3 THEN 'https://h.example/statistics/file' || d.doc_id || '.xls' ELSE 'https://h.example/docs/consultation-papers/cp' || (d.doc_id % 90) || '/paper' || d.doc_id || '.pdf' END"


@query(f"""WITH d AS (SELECT doc_id, {RULE_URL} AS url FROM documents d)
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'stakeholder' WHEN 1 THEN 'central-bank' WHEN 2 THEN 'central-bank' ELSE 'unresolved' END AS authorship,
 CASE doc_id % 5 WHEN 0 THEN 'stakeholder-consultation-submission' WHEN 1 THEN 'cbi-consultation-material' WHEN 2 THEN 'cbi-discussion-material' WHEN 3 THEN 'cbi-statistical-material' ELSE 'consultation-hosted-unresolved' END AS document_class,
 CASE doc_id % 5 WHEN 0 THEN 'filename-attribution:response-from' WHEN 1 THEN 'filename-cbi-doctype:guidance-note' WHEN 2 THEN 'filename-cp-prefix-without-attribution' WHEN 3 THEN 'host-path-only:non-consultation' ELSE 'content-inconclusive(0v0)' END AS basis,
 CASE doc_id % 5 WHEN 0 THEN 'cp' || (doc_id % 90) WHEN 1 THEN 'cp70' WHEN 4 THEN 'cp' || (doc_id % 90) END AS consultation_id,
 CASE doc_id % 5 WHEN 0 THEN 'cp' || (doc_id % 90) WHEN 1 THEN 'cp70' WHEN 2 THEN 'dp' || (doc_id % 9) WHEN 4 THEN 'cp' || (doc_id % 90) END AS engagement_id,
 CASE WHEN doc_id % 5 > 2 THEN 'unreviewed' ELSE 'rule-classified' END AS review_status FROM d""")
def rule_classify(spark, d):
    docs = t(spark, d, "documents").alias("d").selectExpr("d.doc_id", f"{RULE_URL} as url", "text")
    return R.classify(docs, "url", "text").select("doc_id", "authorship", "document_class", "basis", "consultation_id", "engagement_id", "review_status")


MARKERS = {"licensed under": 3, "all rights reserved": 2, "the ": 1, " und ": 2}


@query("SELECT doc_id, " + " + ".join(f"(CASE WHEN contains(lower(text), '{p}') THEN {w} ELSE 0 END)" for p, w in MARKERS.items()) + " AS points, concat_ws(';', " + ", ".join(f"CASE WHEN contains(lower(text), '{p}') THEN '{p}' END" for p in MARKERS) + ") AS phrases FROM documents")
def marker_scores(spark, d):
    s = R.score(F.col("text"), MARKERS)
    return t(spark, d, "documents").select("doc_id", s["points"].alias("points"), F.array_join(s["phrases"], ";").alias("phrases"))


OVERRIDES = [(3, 0, 1, "reviewed-a"), (3, 2, 5, "reviewed-b"), (7, 1, 1, "reviewed-a"), (20, 0, 9, "reviewed-c")]


@query("SELECT c.conv_id, c.turn, coalesce(o.l, c.role) AS final_label, CASE WHEN o.l IS NULL THEN 'inherited' ELSE 'override' END AS label_basis FROM conversations c LEFT JOIN (VALUES " + ", ".join(map(str, OVERRIDES)) + ") o(k, a, b, l) ON c.conv_id = o.k AND c.turn BETWEEN o.a AND o.b")
def page_override_range(spark, d):
    overrides = spark.createDataFrame(OVERRIDES, "conv_id long, start_position long, end_position long, override_label string")
    return S.range_override(t(spark, d, "conversations"), overrides, "conv_id", "turn", "role").select("conv_id", "turn", "final_label", "label_basis")


@query("""WITH x AS (SELECT conv_id, turn, turn // 2 % 2 AS half, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - row_number() OVER (PARTITION BY conv_id, turn // 2 % 2 ORDER BY turn) AS g, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS gap FROM (SELECT DISTINCT conv_id, turn FROM conversations))
SELECT conv_id, half, min(turn) AS range_start, max(turn) AS range_end, count(*) AS n_rows FROM x GROUP BY conv_id, half, g, gap""")
def voice_islands(spark, d):
    rows = t(spark, d, "conversations").select("conv_id", "turn").distinct().withColumn("half", F.floor(F.col("turn") / 2) % 2)
    return S.islands(rows, "conv_id", "turn", ["half"])


# ---- personal data ----------------------------------------------------------

PII = ["email_any", "email_personal", "phone_ie", "signature", "home_address"]


def sql_found(name: str) -> str:
    pattern = P.PATTERNS[name].replace("'", "''")
    hits = f"regexp_extract_all(coalesce(text, ''), '{pattern}')"
    if name == "email_personal":
        role = P.ROLE_LOCAL.replace("'", "''")
        hits = f"list_filter({hits}, lambda v: NOT regexp_matches(string_split(string_split(v, '@')[1], '.')[1], '{role}'))"
    return hits


SQL_PII = "SELECT doc_id, lang, " + ", ".join(f"CAST(len({sql_found(n)}) AS BIGINT) AS {n}" for n in PII) + " FROM documents"


@query(f"SELECT doc_id, {', '.join(PII)} FROM ({SQL_PII}) WHERE {' + '.join(PII)} > 0")
def pii_counts(spark, d):
    return P.document_counts(t(spark, d, "documents"), "doc_id", "text").select("doc_id", *PII).filter(" + ".join(PII) + " > 0")


@query("SELECT lang, pattern, count(*) AS documents FROM (" + " UNION ALL ".join(f"SELECT lang, '{n}' AS pattern, {n} AS hits FROM ({SQL_PII})" for n in PII) + ") WHERE hits > 0 GROUP BY lang, pattern")
def pii_crosstab(spark, d):
    docs = t(spark, d, "documents")
    return A.value_cross_tab(P.page_counts(docs, "text"), "lang", PII)


@query("SELECT pattern, count(DISTINCT left(sha256(lower(v)), 12)) AS distinct_tokens, count(*) AS occurrences FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS pattern, unnest({sql_found(n)}) AS v FROM documents" for n in PII[:3]) + ") GROUP BY pattern")
def pii_distinct_tokens(spark, d):
    return P.distinct_tokens(t(spark, d, "documents"), "text", tuple(PII[:3]))


# ---- tabular analytics ------------------------------------------------------

SQL_SUPPRESSED = "(SELECT *, CASE WHEN l_quantity > 5 THEN l_extendedprice END AS known_price, year(l_shipdate) AS y FROM lineitem)"


def _suppressed(spark, d):
    return t(spark, d, "lineitem").withColumn("known_price", F.when(F.col("l_quantity") > 5, F.col("l_extendedprice"))).withColumn("y", F.year("l_shipdate").cast("long"))


@query(f"SELECT y, l_returnflag, l_linestatus, round(coalesce(sum(known_price), 0.0), 2) AS known, count(*) AS observations, count(*) - count(known_price) AS suppressed, count(*) = count(known_price) AS complete FROM {SQL_SUPPRESSED} GROUP BY ALL")
def suppressed_group_sums(spark, d):
    return A.known_sums(_suppressed(spark, d), ["y", "l_returnflag", "l_linestatus"], "known_price").withColumn("known", F.round("known", 2))


@query(f"SELECT l_returnflag, round(sum(known_price * l_discount) / sum(known_price), 8) AS weighted_mean FROM {SQL_SUPPRESSED} WHERE known_price IS NOT NULL AND l_discount IS NOT NULL GROUP BY 1")
def weighted_mean(spark, d):
    return A.weighted_mean(_suppressed(spark, d), ["l_returnflag"], "known_price", "l_discount").withColumn("weighted_mean", F.round("weighted_mean", 8))


@query("""WITH y AS (SELECT o_orderpriority, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY ALL)
SELECT a.o_orderpriority, a.y, round(a.v, 2) AS total, round(b.v, 2) AS prior, CASE WHEN b.v <> 0 THEN round((a.v / b.v - 1) * 100, 4) END AS change_pct FROM y a LEFT JOIN y b ON a.o_orderpriority = b.o_orderpriority AND a.y = b.y + 1""")
def yoy_change(spark, d):
    years = t(spark, d, "orders").groupBy("o_orderpriority", F.year("o_orderdate").cast("long").alias("y")).agg(F.sum("o_totalprice").alias("v"))
    out = A.year_over_year(years, "y", "v", ["o_orderpriority"])
    return out.select("o_orderpriority", "y", F.round("v", 2).alias("total"), F.round("prior", 2).alias("prior"), F.round("change_pct", 4).alias("change_pct"))


@query("SELECT 'one' AS lookup, count(*) AS matches, CASE WHEN count(*) = 1 THEN max(n_name) END AS value FROM nation WHERE n_nationkey = 7 UNION ALL SELECT 'many', count(*), CASE WHEN count(*) = 1 THEN max(n_name) END FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'none', count(*), CASE WHEN count(*) = 1 THEN max(n_name) END FROM nation WHERE n_nationkey = 99")
def single_match_lookup(spark, d):
    nation = t(spark, d, "nation")
    parts = [A.single_match(nation, c, "n_name").select(F.lit(n).alias("lookup"), "matches", "value") for n, c in (("one", F.col("n_nationkey") == 7), ("many", F.col("n_regionkey") == 1), ("none", F.col("n_nationkey") == 99))]
    return parts[0].union(parts[1]).union(parts[2])


@query("""SELECT o_orderkey, round(o_totalprice, 2) AS published, round(s, 2) AS component_sum, round(s - o_totalprice, 2) AS difference FROM orders
LEFT JOIN (SELECT l_orderkey, CASE WHEN count(*) = count(CASE WHEN l_quantity > 2 THEN 1 END) THEN sum(l_extendedprice) END AS s FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def reconciliation(spark, d):
    parts = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_quantity") > 2, F.col("l_extendedprice")).alias("part"))
    out = A.reconcile(parts, t(spark, d, "orders"), ["o_orderkey"], "part", "o_totalprice")
    return out.select("o_orderkey", *[F.round(c, 2).alias(c) for c in ("published", "component_sum", "difference")])


@query("""SELECT 'negative-price' AS check_name, count(*) FILTER (l_extendedprice < 0) AS violations, count(*) FILTER (l_extendedprice < 0) = 0 AS passed FROM lineitem
UNION ALL SELECT 'discount-above-5', count(*) FILTER (l_discount > 0.05), count(*) FILTER (l_discount > 0.05) = 0 FROM lineitem
UNION ALL SELECT 'odd-month-first', count(*) FILTER (day(o_orderdate) = 1 AND month(o_orderdate) IN (3, 6, 9, 12)), count(*) FILTER (day(o_orderdate) = 1 AND month(o_orderdate) IN (3, 6, 9, 12)) = 0 FROM orders
UNION ALL SELECT 'missing-customer', count(*), count(*) = 0 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def qc_checks(spark, d):
    items, orders = t(spark, d, "lineitem"), t(spark, d, "orders")
    lost = orders.join(t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti")
    odd = (F.dayofmonth("o_orderdate") == 1) & F.month("o_orderdate").isin(3, 6, 9, 12)
    return A.checks(("negative-price", items, F.col("l_extendedprice") < 0), ("discount-above-5", items, F.col("l_discount") > 0.05), ("odd-month-first", orders, odd), ("missing-customer", lost, F.lit(True)))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 3 <> 0 AND n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000)")
def hierarchy_guard(spark, d):
    parents = t(spark, d, "nation").withColumn("pv", F.when(F.col("n_nationkey") % 3 != 0, 1))
    children = t(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey"), F.when(F.col("c_acctbal") > 9000, F.col("c_acctbal")).alias("cv"))
    return A.hierarchy_guard(parents, children, ["n_nationkey"], "pv", "cv").select("n_nationkey", "n_name")


@query("SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def latest_row_per_key(spark, d):
    return S.latest_per_key(t(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["ts", "event_id", "event_type", "value"])


@query("SELECT l_returnflag, unnest(['quantity', 'price', 'discount']) AS metric, unnest([round(sum(l_quantity), 2), round(sum(l_extendedprice), 2), round(avg(l_discount), 6)]) AS value FROM lineitem GROUP BY l_returnflag")
def metric_snapshot_long(spark, d):
    wide = t(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price"), F.round(F.avg("l_discount"), 6).alias("discount"))
    return A.long_metrics(wide, ["l_returnflag"], ["quantity", "price", "discount"])


@query("""SELECT CAST(g AS BIGINT) AS number, coalesce(en, 0) AS en, coalesce(de, 0) AS de, coalesce(fr, 0) AS fr, coalesce(en, 0) > 0 AND coalesce(de, 0) > 0 AND coalesce(fr, 0) > 0 AS complete_loop FROM generate_series(1, 30) s(g)
LEFT JOIN (SELECT CAST(replace(source, 'src', '') AS BIGINT) AS number, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'fr') AS fr FROM documents GROUP BY 1) ON g = number""")
def dense_coverage(spark, d):
    rows = t(spark, d, "documents").select(F.replace("source", F.lit("src"), F.lit("")).cast("long").alias("number"), "lang")
    return A.dense_coverage(rows, "number", "lang", ["en", "de", "fr"], 30)


@query("""WITH r AS (SELECT n_chars, row_number() OVER (ORDER BY n_chars) - 1 AS k, count(*) OVER () AS n FROM documents)
SELECT max(n_chars) FILTER (k = CAST(round_even((n - 1) * 0.5, 0) AS BIGINT)) AS p50, max(n_chars) FILTER (k = CAST(round_even((n - 1) * 0.9, 0) AS BIGINT)) AS p90, max(n_chars) FILTER (k = CAST(round_even((n - 1) * 0.99, 0) AS BIGINT)) AS p99 FROM r""")
def nearest_rank_percentiles(spark, d):
    return A.nearest_rank_percentiles(t(spark, d, "documents"), "n_chars", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


SQL_PAIRS_EVAL = "(SELECT l.doc_id, CAST(l.quality AS BIGINT) AS gold, CASE WHEN contains(d.text, '|') OR contains(d.text, '!!') THEN 0 WHEN d.doc_id IS NOT NULL THEN 1 END AS predicted FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id)"


def _evaluated(spark, d):
    guess = F.when(F.col("text").contains("|") | F.col("text").contains("!!"), 0).when(F.col("text").isNotNull(), 1)
    docs = t(spark, d, "documents").select("doc_id", guess.alias("predicted"))
    return t(spark, d, "labels").select("doc_id", F.col("quality").cast("long").alias("gold")).join(docs, "doc_id", "left")


@query(f"SELECT gold, predicted, count(*) AS n FROM {SQL_PAIRS_EVAL} GROUP BY gold, predicted")
def confusion_matrix(spark, d):
    return A.confusion(_evaluated(spark, d), "gold", "predicted")


@query(f"SELECT count(*) AS gold, count(*) FILTER (gold = predicted) AS correct, round(count(*) FILTER (gold = predicted) / count(*), 4) AS accuracy, count(*) FILTER (gold = predicted) / count(*) >= 0.9 AS passed FROM {SQL_PAIRS_EVAL}")
def gold_accuracy(spark, d):
    return A.accuracy(_evaluated(spark, d), "gold", "predicted", 0.9)


# ---- comparison and integrity -----------------------------------------------

# The older release: every row, some relabelled and some under ids that the newer one lacks.
SQL_BEFORE = "(SELECT CASE WHEN doc_id % 13 = 0 THEN -1 - doc_id ELSE doc_id END AS doc_id, CASE WHEN doc_id % 11 = 0 THEN 'other' ELSE lang END AS lang, CASE WHEN doc_id % 7 = 0 THEN source || 'x' ELSE source END AS source, n_chars FROM documents)"


def _before(spark, d):
    docs = t(spark, d, "documents")
    return docs.select(F.when(F.col("doc_id") % 13 == 0, -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"), F.when(F.col("doc_id") % 11 == 0, "other").otherwise(F.col("lang")).alias("lang"), F.when(F.col("doc_id") % 7 == 0, F.concat("source", F.lit("x"))).otherwise(F.col("source")).alias("source"), "n_chars")


@query(f"SELECT CASE WHEN b.doc_id IS NULL THEN 'new-document' WHEN b.lang IS DISTINCT FROM d.lang THEN 'reclassified' ELSE 'unchanged' END AS change, d.lang, count(*) AS n FROM documents d LEFT JOIN {SQL_BEFORE} b ON d.doc_id = b.doc_id GROUP BY 1, 2")
def release_change_tracking(spark, d):
    return C.changes(t(spark, d, "documents").select("doc_id", "lang"), _before(spark, d), "doc_id", "lang").groupBy("change", "lang").agg(F.count("*").alias("n"))


@query("SELECT doc_id, 'missing_from_labels' AS status FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'missing_from_documents' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def completeness_antijoin(spark, d):
    return C.missing_both_ways(t(spark, d, "documents"), t(spark, d, "labels"), "doc_id", ("documents", "labels"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def orphan_rows(spark, d):
    return t(spark, d, "customer").join(t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query(f"""WITH j AS (SELECT d.doc_id AS a, b.doc_id AS b, d.lang AS l1, b.lang AS l2, d.source AS s1, b.source AS s2, d.n_chars AS n1, b.n_chars AS n2 FROM documents d FULL JOIN {SQL_BEFORE} b ON d.doc_id = b.doc_id)
SELECT unnest(['only_left', 'only_right', 'differ_lang', 'differ_source', 'differ_n_chars']) AS measure, unnest([count(*) FILTER (b IS NULL), count(*) FILTER (a IS NULL), count(*) FILTER (a IS NOT NULL AND b IS NOT NULL AND l1 IS DISTINCT FROM l2), count(*) FILTER (a IS NOT NULL AND b IS NOT NULL AND s1 IS DISTINCT FROM s2), count(*) FILTER (a IS NOT NULL AND b IS NOT NULL AND n1 IS DISTINCT FROM n2)]) AS n FROM j""")
def columnwise_compare(spark, d):
    return C.columnwise(t(spark, d, "documents"), _before(spark, d), ["doc_id"], ["lang", "source", "n_chars"])


@query(f"SELECT d.doc_id, concat_ws(',', CASE WHEN d.lang IS DISTINCT FROM b.lang THEN 'lang' END, CASE WHEN d.source IS DISTINCT FROM b.source THEN 'source' END) AS changed FROM documents d JOIN {SQL_BEFORE} b ON d.doc_id = b.doc_id WHERE d.lang IS DISTINCT FROM b.lang OR d.source IS DISTINCT FROM b.source")
def field_drift(spark, d):
    return C.drifted(_before(spark, d), t(spark, d, "documents"), "doc_id", ["lang", "source"]).withColumn("changed", F.array_join("changed", ","))


@query("SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN n_chars > 5000 THEN 'long' END, CASE WHEN lang <> 'en' THEN 'foreign' END, CASE WHEN contains(text, '@') THEN 'address' END], lambda r: r IS NOT NULL)) AS reason FROM documents) GROUP BY reason")
def reason_histogram(spark, d):
    reasons = F.array_compact(F.array(F.when(F.col("n_chars") > 5000, "long"), F.when(F.col("lang") != "en", "foreign"), F.when(F.col("text").contains("@"), "address")))
    return A.histogram_of_reasons(t(spark, d, "documents"), reasons)


@query("""SELECT 'repeated-doc-id' AS invariant, count(*) AS n FROM (SELECT doc_id FROM documents GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'length-mismatch', count(*) FROM documents WHERE n_chars IS DISTINCT FROM length(text) UNION ALL SELECT 'label-domain', count(*) FROM labels WHERE quality NOT IN (0, 1)
UNION ALL SELECT 'cluster-size', count(*) FROM (SELECT text, count(*) AS c FROM documents GROUP BY text HAVING count(*) <> 1)""")
def invariants(spark, d):
    docs = t(spark, d, "documents")
    clusters = docs.select(F.sha2("text", 256).alias("cluster"), F.lit(1).cast("long").alias("size"))
    # Conditions on single rows are counted together; groups need a pass of their own.
    single = A.checks(("length-mismatch", docs, ~F.col("n_chars").eqNullSafe(F.length("text").cast("long"))), ("label-domain", t(spark, d, "labels"), ~F.col("quality").isin(0, 1)))
    grouped = C.violations(("repeated-doc-id", docs.groupBy("doc_id").count().filter("count > 1")), ("cluster-size", C.uneven_clusters(clusters, "cluster", "size")))
    return grouped.unionByName(single.select(F.col("check_name").alias("invariant"), F.col("violations").alias("n")))


@query("SELECT doc_id FROM labels INTERSECT SELECT doc_id FROM documents WHERE n_chars > 2000")
def set_intersection(spark, d):
    return t(spark, d, "labels").select("doc_id").intersect(t(spark, d, "documents").filter("n_chars > 2000").select("doc_id"))


@query("SELECT 'documents' AS corpus, doc_id, source, NULL AS toxic FROM documents UNION ALL SELECT 'labels', doc_id, NULL, toxic FROM labels")
def union_by_name(spark, d):
    return C.union_by_name([t(spark, d, "documents").select("doc_id", "source"), t(spark, d, "labels").select("doc_id", "toxic")], "corpus", ["documents", "labels"])


# ---- documents and published tables -------------------------------------------

DATED_URL = "CASE WHEN doc_id % 3 = 0 THEN 'https://h.example/a/published-' || (doc_id % 33) || '-june-20' || (10 + doc_id % 15) || '.pdf' WHEN doc_id % 3 = 1 THEN 'https://h.example/a/report_' || doc_id || '.pdf' ELSE 'https://h.example/a/published_5_nomonth_2011.pdf' END"


@query(f"""WITH x AS (SELECT doc_id, {DATED_URL} AS url, CASE WHEN doc_id % 2 = 0 THEN 'D:' || (1980 + doc_id % 50) || '0101' END AS stamp FROM documents),
y AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 AND doc_id % 33 BETWEEN 1 AND 30 THEN '20' || (10 + doc_id % 15) || '-06-' || lpad(CAST(doc_id % 33 AS VARCHAR), 2, '0') END AS published_at, CASE WHEN doc_id % 2 = 0 AND 1980 + doc_id % 50 BETWEEN 1990 AND 2024 THEN 1980 + doc_id % 50 END AS py FROM x)
SELECT doc_id, published_at, coalesce(CAST(left(published_at, 4) AS BIGINT), py) AS analysis_year, CASE WHEN published_at IS NOT NULL THEN 'source-url-explicit-published-date' WHEN py IS NOT NULL THEN 'pdf-creation-date-proxy' END AS analysis_year_basis FROM y""")
def temporal_metadata(spark, d):
    rows = t(spark, d, "documents").selectExpr("doc_id", f"{DATED_URL} as url", "case when doc_id % 2 = 0 then concat('D:', 1980 + doc_id % 50, '0101') end as stamp", "cast(null as array<string>) as referrers")
    return D.temporal(rows, "url", "stamp", "referrers", "2024-12-31").select("doc_id", "published_at", F.col("analysis_year").cast("long").alias("analysis_year"), "analysis_year_basis")


@query("SELECT source, array_to_string(list_sort(list(DISTINCT lang)), ',') AS urls, min(doc_id) FILTER (doc_id % 4 = 0) AS last_modified FROM documents GROUP BY source")
def source_metadata(spark, d):
    rows = t(spark, d, "documents").withColumn("refs", F.array("lang")).withColumn("modified", F.when(F.col("doc_id") % 4 == 0, F.col("doc_id")))
    return D.source_metadata(rows, "source", "lang", "refs", "modified", "doc_id").select("source", F.array_join("urls", ",").alias("urls"), "last_modified")


@query("SELECT doc_id, CAST(quality AS VARCHAR) AS label, 'new' AS origin FROM labels UNION ALL SELECT doc_id, lang, 'old' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def ledger_merge(spark, d):
    new = t(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label"), F.lit("new").alias("origin"))
    return D.merge_ledger(new, t(spark, d, "documents").select("doc_id", F.col("lang").alias("label"), F.lit("old").alias("origin")), ["doc_id"])


@query("""WITH g AS (SELECT year(l_shipdate) AS y, round(coalesce(sum(l_extendedprice) FILTER (l_returnflag IN ('A', 'R') AND l_quantity > 5), 0.0), 2) AS known, count(*) FILTER (l_returnflag IN ('A', 'R')) AS observations,
 count(*) FILTER (l_returnflag IN ('A', 'R') AND l_quantity <= 5) AS suppressed, round(max(CASE WHEN l_returnflag = 'N' AND l_quantity > 5 THEN l_extendedprice END), 2) AS published_N FROM lineitem GROUP BY 1) SELECT * FROM g""")
def component_totals(spark, d):
    rows = _suppressed(spark, d)
    out = SD.component_totals(rows, ["y"], "l_returnflag", "known_price", ["A", "R"], ["N"])
    return out.select("y", F.round("known", 2).alias("known"), "observations", "suppressed", F.round("published_N", 2).alias("published_N"))


@query("SELECT f AS l_returnflag, s AS l_linestatus FROM (SELECT unnest(['A', 'N', 'R', 'X']) AS f), (SELECT unnest(['F', 'O', 'Z']) AS s) WHERE (f, s) NOT IN (SELECT (l_returnflag, l_linestatus) FROM lineitem)")
def missing_cells(spark, d):
    return SD.missing_cells(t(spark, d, "lineitem").select("l_returnflag", "l_linestatus"), {"l_returnflag": ["A", "N", "R", "X"], "l_linestatus": ["F", "O", "Z"]})


@query("""SELECT o_orderstatus, round(sum(o_totalprice) FILTER (year(o_orderdate) = 1998), 2) AS now, round(sum(o_totalprice) FILTER (year(o_orderdate) = 1997), 2) AS before,
 round((sum(o_totalprice) FILTER (year(o_orderdate) = 1998) / sum(o_totalprice) FILTER (year(o_orderdate) = 1997) - 1) * 100, 4) AS change_pct FROM orders WHERE year(o_orderdate) IN (1997, 1998) GROUP BY 1""")
def two_periods(spark, d):
    rows = t(spark, d, "orders").withColumn("y", F.year("o_orderdate").cast("string"))
    out = SD.two_periods(rows, ["o_orderstatus"], "y", "o_totalprice", "1998", "1997", strict=True)
    return out.select("o_orderstatus", *[F.round(c, n).alias(c) for c, n in (("now", 2), ("before", 2), ("change_pct", 4))])


@query("SELECT event_type, ts, unnest(['event_id', 'user_id']) AS metric, unnest([event_id, user_id]) AS value FROM (SELECT event_type, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(user_id, (ts, event_id)) AS user_id FROM events GROUP BY 1)")
def latest_snapshot(spark, d):
    return SD.latest_snapshot(t(spark, d, "events"), "event_type", "ts", ["event_id", "user_id"])


@query("""WITH x AS (SELECT page_id, lower(url) || CASE WHEN page_id % 4 = 0 THEN '/forms' WHEN page_id % 4 = 1 THEN '/annual-return.xls' WHEN page_id % 4 = 2 THEN '/taxonomy/a.xls' ELSE '' END AS u FROM pages)
SELECT CASE WHEN page_id % 4 = 0 THEN 'application_or_form' WHEN page_id % 4 = 1 AND NOT contains(u, '?') THEN 'regulatory_reporting_template' WHEN page_id % 4 = 2 THEN 'regulatory_taxonomy_or_validation' WHEN contains(string_split(string_split(u, '/')[-1], '?')[1], 'return') THEN 'regulatory_reporting_template' ELSE 'other_workbook' END AS category, count(*) AS n FROM x GROUP BY 1""")
def workbook_categories(spark, d):
    tail = F.when(F.col("page_id") % 4 == 0, "/forms").when(F.col("page_id") % 4 == 1, "/annual-return.xls").when(F.col("page_id") % 4 == 2, "/taxonomy/a.xls").otherwise("")
    return t(spark, d, "pages").groupBy(R.workbook_category(F.concat("url", tail)).alias("category")).agg(F.count("*").alias("n"))


# ---- ingest -----------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) > 50")
def json_flatten(spark, d):
    rows = t(spark, d, "events").select("event_id", F.from_json("props", "k long").alias("p"))
    return rows.select("event_id", "p.k").filter("k > 50")


@query("""SELECT user_id, count(*) AS n_updates, count(DISTINCT event_type) AS n_sources, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS sources, arg_max(value, (ts, event_id)) FILTER (value IS NOT NULL) AS value FROM events GROUP BY user_id""")
def upsert_merge(spark, d):
    return I.upsert(t(spark, d, "events"), "user_id", ["ts", "event_id"], ["value"], "event_type").withColumn("sources", F.array_join("sources", ","))


@query("""WITH r AS (SELECT *, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_type <> 'error' DESC, ts DESC, event_id DESC) AS k FROM events) SELECT user_id, event_id, event_type, ok FROM r WHERE k = 1""")
def journal_replay(spark, d):
    return I.replay_journal(t(spark, d, "events").withColumn("ok", F.col("event_type") != "error"), "user_id", ["ts", "event_id"], "ok").select("user_id", "event_id", "event_type", "ok")


@query("SELECT u.user_id FROM (SELECT DISTINCT user_id FROM events) u WHERE u.user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def pending_items(spark, d):
    events = t(spark, d, "events").withColumn("ok", F.col("event_type") == "purchase")
    return I.pending(events.select("user_id").distinct(), events, "user_id", "ok")


@query("SELECT doc_id, n_chars, running_total FROM (SELECT doc_id, n_chars, CAST(sum(n_chars) OVER (ORDER BY doc_id) AS BIGINT) AS running_total FROM documents) WHERE running_total <= 1000000")
def byte_budget_prefix(spark, d):
    return S.budget_prefix(t(spark, d, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 1_000_000)


@query("SELECT event_type, count(*) AS files, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS known_bytes FROM events GROUP BY event_type")
def crawl_summary(spark, d):
    return I.summarise(t(spark, d, "events").withColumn("size", F.round(F.col("value") * 100).cast("long")), "event_type", "size")


@query("SELECT CAST(regexp_extract(source, '[0-9]+', 0) AS BIGINT) AS number, source, count(*) AS n FROM documents GROUP BY source ORDER BY 1")
def numeric_id_sort(spark, d):
    rows = t(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return rows.withColumn("number", F.regexp_extract("source", r"\d+", 0).cast("long")).orderBy("number")


@query("""WITH r AS (SELECT *, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_type <> 'error' DESC, ts DESC, event_id DESC) AS k FROM events) SELECT event_id, ts, user_id, event_type, value, props, ok FROM r WHERE k = 1""")
def journal_stream(spark, d):
    """The events table as a file-source stream through the idempotent journal upsert."""
    from foliospark.streaming.journal import replay_stream

    return replay_stream(spark, d)


# The other registered queries; they take their helpers from this module.
from foliospark.plans import analyses, integrity, rows  # noqa: E402, F401
