"""Registered queries of integrity checks, summaries, filters and search output, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions import urls as U
from foliospark.operators import aggregates as A
from foliospark.operators import compare as C
from foliospark.operators import documents as D
from foliospark.operators import ingest as I
from foliospark.operators import provenance as R
from foliospark.operators import sequences as S
from foliospark.plans import fts
from foliospark.plans.registry import DOC_SOURCE, SQL_GRADES, SQL_HOST, SQL_PATH, SQL_SPACE, _graded, has, query, sql_bm25, t
from foliospark.plans.rows import case, quoted, shaped
from foliospark.sources import binary


@query(f"""WITH {sql_bm25(DOC_SOURCE, 'doc_id', ['the'], has('the'))}, top AS (SELECT doc_id, row_number() OVER (ORDER BY score, doc_id) AS k FROM scored ORDER BY score, doc_id LIMIT 20)
SELECT k AS rank, k || '. ' || CASE WHEN top.doc_id % 5 = 0 THEN '(untitled)' ELSE source END || ' - page ' || (1 + top.doc_id % 3) || CASE WHEN top.doc_id % 2 = 0 THEN ' [OCR]' ELSE '' END || chr(10) || '   https://h.example/' || top.doc_id || chr(10) || '   ' || replace(left(text, 60), chr(10), ' ') AS shown FROM top JOIN documents d ON top.doc_id = d.doc_id""")
def search_output(spark, d):
    docs = fts.with_norms(t(spark, d, "documents"))
    top = fts.bm25(docs, "the").select("doc_id", "source", "text", F.round("score", 6).alias("score")).orderBy("score", "doc_id").limit(20)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy("score", "doc_id")).cast("long"))
    title = F.when(F.col("doc_id") % 5 != 0, F.col("source"))
    shown = fts.rendered(F.col("rank"), title, 1 + F.col("doc_id") % 3, F.concat(F.lit("https://h.example/"), "doc_id"), F.left("text", F.lit(60)), F.col("doc_id") % 2 == 0)
    return ranked.select("rank", shown.alias("shown"))


@query("""WITH b AS (SELECT 'documents.' || lang AS key, count(*) AS value FROM documents GROUP BY lang), a AS (SELECT 'documents.' || CASE WHEN lang = 'fr' THEN 'french' ELSE lang END AS key, CASE WHEN lang = 'de' THEN count(*) + 1 ELSE count(*) END AS value FROM documents GROUP BY lang)
SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'unknown-fact' WHEN a.key IS NULL THEN 'not-shown' ELSE 'wrong-value' END AS fault FROM a FULL JOIN b ON a.key = b.key WHERE a.key IS NULL OR b.key IS NULL OR a.value <> b.value""")
def documentation_facts(spark, d):
    truth = t(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("value")).withColumn("key", F.concat(F.lit("documents."), "lang"))
    shown = F.concat(F.lit("documents."), F.when(F.col("lang") == "fr", "french").otherwise(F.col("lang")))
    claims = truth.select(shown.alias("key"), F.format_number(F.col("value") + F.when(F.col("lang") == "de", 1).otherwise(0), 0).alias("value"))
    return C.fact_faults(claims, truth, "key", "value")


SIDE_A, SIDE_B = "CASE WHEN page_id % 7 = 0 THEN 'other' ELSE left(html, 40) END", "CASE WHEN page_id % 5 = 0 THEN 'third' ELSE left(html, 40) END"


@query(f"""WITH k AS (SELECT page_id AS key, left(html, 40) AS f, {SIDE_A} AS m, {SIDE_B} AS i FROM pages), a AS (SELECT key, f FROM k), b AS (SELECT CASE WHEN key % 11 = 0 THEN -1 - key ELSE key END AS key, m FROM k), c AS (SELECT CASE WHEN key % 13 = 0 THEN -1 - key ELSE key END AS key, i FROM k),
j AS (SELECT coalesce(a.key, b.key) AS key, f, m FROM a FULL JOIN b ON a.key = b.key), w AS (SELECT f, m, i FROM j FULL JOIN c ON j.key = c.key)
SELECT count(*) FILTER (f IS NULL) AS missing_file, count(*) FILTER (m IS NULL) AS missing_manifest, count(*) FILTER (i IS NULL) AS missing_index, count(*) FILTER (f <> m) AS file_manifest, count(*) FILTER (m <> i) AS manifest_index, count(*) FILTER (f <> i) AS file_index, count(*) FILTER (f = m AND m = i) AS agree FROM w""")
def hash_triangle(spark, d):
    rows = shaped(spark, d, "pages", f="left(html, 40)", m=SIDE_A, i=SIDE_B)
    moved = lambda n: F.when(F.col("page_id") % n == 0, -1 - F.col("page_id")).otherwise(F.col("page_id"))
    side = lambda key, c: rows.select(key.alias("key"), F.col(c).alias("sha"))
    return C.hash_triangle(side(F.col("page_id"), "f"), side(moved(11), "m"), side(moved(13), "i"), "key", "sha")


RAW_BYTES = case("doc_id", ["text", "chr(10) || text", "'\ufeff' || text", "replace(text, ' ', '\r' || chr(10))"])


@query(f"""WITH x AS (SELECT doc_id, {RAW_BYTES} AS v FROM documents) SELECT 'byte-order-mark' AS check_name, count(*) FILTER (left(v, 1) = '\ufeff') AS violations, count(*) FILTER (left(v, 1) = '\ufeff') = 0 AS passed FROM x
UNION ALL SELECT 'carriage-returns', count(*) FILTER (contains(v, '\r' || chr(10))), count(*) FILTER (contains(v, '\r' || chr(10))) = 0 FROM x UNION ALL SELECT 'empty-body', count(*) FILTER (v = ''), count(*) FILTER (v = '') = 0 FROM x""")
def manifest_format(spark, d):
    rows = shaped(spark, d, "documents", v=RAW_BYTES)
    v = F.col("v")
    return A.checks(("byte-order-mark", rows, v.startswith("\ufeff")), ("carriage-returns", rows, v.contains("\r\n")), ("empty-body", rows, v == ""))


@query(f"""WITH c AS (SELECT grade, count(*) AS documents, CAST(sum(dense) AS BIGINT) AS characters FROM {SQL_GRADES} GROUP BY grade), s AS (SELECT grade, CASE WHEN grade = 'ok' THEN documents + 1 ELSE documents END AS documents, CASE WHEN grade = 'thin' THEN characters * 2 ELSE characters END AS characters FROM c)
SELECT s.grade, f AS field FROM s JOIN c ON s.grade = c.grade, (SELECT unnest(['documents', 'characters']) AS f) WHERE CASE f WHEN 'documents' THEN s.documents <> c.documents ELSE s.characters <> c.characters END""")
def summary_against_detail(spark, d):
    computed = _graded(spark, d).groupBy("grade").agg(F.count("*").alias("documents"), F.sum("dense").alias("characters"))
    stored = computed.select("grade", (F.col("documents") + F.when(F.col("grade") == "ok", 1).otherwise(0)).alias("documents"), (F.col("characters") * F.when(F.col("grade") == "thin", 2).otherwise(1)).alias("characters"))
    return C.summary_faults(stored, computed, "grade", ["documents", "characters"])


@query("""WITH j AS (SELECT DISTINCT doc_id FROM documents), m AS (SELECT DISTINCT doc_id FROM labels), x AS (SELECT DISTINCT CASE WHEN doc_id % 3 = 0 THEN doc_id ELSE -1 - doc_id END AS doc_id FROM labels),
u AS (SELECT doc_id FROM j UNION SELECT doc_id FROM m UNION SELECT doc_id FROM x), f AS (SELECT u.doc_id, j.doc_id IS NOT NULL AS j, m.doc_id IS NOT NULL AS m, x.doc_id IS NOT NULL AS x FROM u LEFT JOIN j ON u.doc_id = j.doc_id LEFT JOIN m ON u.doc_id = m.doc_id LEFT JOIN x ON u.doc_id = x.doc_id)
SELECT doc_id, CASE WHEN m AND x THEN 'excluded-but-listed' WHEN j AND NOT m AND NOT x THEN 'journalled-only' ELSE 'not-journalled' END AS fault FROM f WHERE (m AND x) OR (j AND NOT m AND NOT x) OR NOT j""")
def journal_partition(spark, d):
    labels = t(spark, d, "labels")
    excluded = labels.select(F.when(F.col("doc_id") % 3 == 0, F.col("doc_id")).otherwise(-1 - F.col("doc_id")).alias("doc_id"))
    return C.journal_faults(t(spark, d, "documents"), labels, excluded, "doc_id")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang ELSE 'derived' END AS voice, CASE WHEN doc_id % 3 = 0 THEN source ELSE CAST(n_chars AS VARCHAR) END AS basis FROM documents")
def published_passthrough(spark, d):
    rows = t(spark, d, "documents").withColumn("v", F.lit("derived")).withColumn("b", F.col("n_chars").cast("string"))
    return D.published_or_derived(rows, F.col("doc_id") % 3 == 0, {"voice": ("lang", "v"), "basis": ("source", "b")}).select("doc_id", "voice", "basis")


AUDIT = "CASE WHEN n_chars < 30 THEN 'likely_ocr' WHEN doc_id % 9 = 0 THEN 'encrypted' ELSE 'ok' END"


@query(f"""WITH x AS (SELECT {AUDIT} AS status, n_chars AS n, doc_id % 4 = 0 AS flag FROM documents), r AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS k, count(*) OVER () AS c FROM x)
SELECT 'status:' || status AS measure, CAST(count(*) AS DOUBLE) AS value FROM x GROUP BY status UNION ALL SELECT 'flagged', CAST(count(*) FILTER (flag) AS DOUBLE) FROM x UNION ALL SELECT 'total', CAST(sum(n) AS DOUBLE) FROM x UNION ALL SELECT 'max', CAST(max(n) AS DOUBLE) FROM x
UNION ALL SELECT 'p50', CAST(max(n) FILTER (k = CAST(round_even((c - 1) * 0.5, 0) AS BIGINT)) AS DOUBLE) FROM r UNION ALL SELECT 'p90', CAST(max(n) FILTER (k = CAST(round_even((c - 1) * 0.9, 0) AS BIGINT)) AS DOUBLE) FROM r UNION ALL SELECT 'p99', CAST(max(n) FILTER (k = CAST(round_even((c - 1) * 0.99, 0) AS BIGINT)) AS DOUBLE) FROM r""")
def audit_summary(spark, d):
    rows = shaped(spark, d, "documents", status=AUDIT, flag="doc_id % 4 = 0")
    return A.audit_summary(rows, "status", "n_chars", {"flagged": F.col("flag")})


@query("""SELECT sha256(left(text, 60)) AS sha, count(*) AS alias_count, array_to_string(list_sort(list(DISTINCT 'https://h/' || doc_id)), ' | ') AS urls, min(doc_id) AS first_id FROM documents GROUP BY 1""")
def structured_catalogue(spark, d):
    rows = t(spark, d, "documents").select(F.sha2(F.left("text", F.lit(60)), 256).alias("sha"), "doc_id", F.concat(F.lit("https://h/"), "doc_id").alias("url"))
    out = S.first_wins(rows, "sha", ["doc_id"], "url")
    return out.select("sha", F.col("n_rows").alias("alias_count"), F.array_join("aliases", " | ").alias("urls"), F.col("doc_id").alias("first_id"))


@query("""SELECT s AS source, count(*) AS files, CAST(sum(n) AS BIGINT) AS known_bytes FROM (SELECT unnest(list_distinct([event_type, CASE WHEN event_id % 3 = 0 THEN 'all' ELSE event_type END])) AS s, CAST(round(value * 100) AS BIGINT) AS n FROM events) GROUP BY s""")
def crawl_summary_by_source(spark, d):
    files = t(spark, d, "events").select(F.array("event_type", F.when(F.col("event_id") % 3 == 0, "all").otherwise(F.col("event_type"))).alias("sources"), F.round(F.col("value") * 100).cast("long").alias("size"))
    return I.summarise_sources(files, "sources", "size")


WORKBOOK_URL = "'https://h.example' || " + case("page_id", ["'/forms/a.xls'", "'/x/annual-return.xlsx?y'", "'/taxonomy/a.xls'", "'/x/chartpack-2.xlsx'", "'/reporting-requirements/b.xls'", "'/x/Sign-Off sheet.xls'", "'/x/new_form.xls'", "'/net-short-positions/z.xls'", "'/public-data/q.csv'", "'/resolution/bifr/k.xls'", "'/insider-list.xls'", "'/plain/' || page_id || '.xls'"])


def sql_workbook(place: int) -> str:
    cases = " ".join(f"WHEN {' OR '.join(f'contains({w}, {quoted(x)})' for x in words)} THEN {quoted((label, reason)[place])}" for w, words, label, reason in R.WORKBOOKS)
    return f"CASE {cases} ELSE {quoted(R.OTHER_WORKBOOK[place])} END"


@query(f"SELECT category, reason, count(*) AS n FROM (SELECT {sql_workbook(0)} AS category, {sql_workbook(1)} AS reason FROM (SELECT u AS url, string_split(string_split(u, '/')[-1], '?')[1] AS name FROM (SELECT lower({WORKBOOK_URL}) AS u FROM pages))) GROUP BY ALL")
def workbook_reasons(spark, d):
    rows = shaped(spark, d, "pages", u=WORKBOOK_URL).select(R.workbook_class(F.col("u")).alias("c")).select("c.category", "c.reason")
    return rows.groupBy("category", "reason").agg(F.count("*").alias("n"))


TITLES = case("doc_id", ["'Report of the IMF mission'", "'Limburg'", "'Mr Justice Example'", "source", "'Professor Xavier'", "'courtyard'"])


@query(f"""WITH x AS (SELECT sha256(CAST(doc_id AS VARCHAR)) AS sha, concat_ws('; ', CASE WHEN doc_id % 11 = 0 THEN 'mixed-container' END, CASE WHEN n_chars < 100 THEN 'low-confidence' END, CASE WHEN regexp_matches({TITLES} || ' ' || lang, {quoted(R.SENSITIVE)}) THEN 'sensitive-title' END) AS reasons FROM documents)
SELECT sha, reasons FROM x WHERE reasons <> '' ORDER BY sha""")
def review_queue(spark, d):
    rows = shaped(spark, d, "documents", title=TITLES).withColumn("sha", F.sha2(F.col("doc_id").cast("string"), 256))
    return R.review_queue(rows, "sha", F.col("doc_id") % 11 == 0, F.col("n_chars") < 100, ["title", "lang"]).select("sha", "reasons")


@query(rf"""WITH p AS (SELECT doc_id, any_value(text) AS text, max(length(l)) AS longest, count(*) AS pages FROM (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10) || chr(10))) AS l FROM documents) GROUP BY doc_id)
SELECT p.doc_id, CAST(longest AS BIGINT) AS longest, CAST(pages AS BIGINT) AS pages, length(regexp_replace(replace(coalesce(d.text, ''), chr(10) || chr(10), chr(10)), '{SQL_SPACE}', '', 'g')) < 100 AS low_text FROM p JOIN documents d ON p.doc_id = d.doc_id""")
def office_text_metrics(spark, d):
    m = T.office_metrics(F.split(F.coalesce("text", F.lit("")), "\n\n", -1))
    return t(spark, d, "documents").select("doc_id", m["max_page_characters"].alias("longest"), m["page_count"].alias("pages"), m["low_text"].alias("low_text"))


@query("""WITH e AS (SELECT *, event_type <> 'error' AND event_id % 4 <> 0 AS ok FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ok DESC, ts DESC, event_id DESC) AS k FROM e) SELECT user_id, event_id, ok FROM r WHERE k = 1""")
def journal_with_outputs(spark, d):
    journal = t(spark, d, "events").withColumn("ok", F.col("event_type") != "error").withColumn("output", F.concat(F.lit("out/"), "event_id"))
    listing = t(spark, d, "events").select(F.concat(F.when(F.col("event_id") % 4 == 0, "gone/").otherwise("out/"), "event_id").alias("output"))
    return I.replay_with_outputs(journal, listing, "user_id", ["ts", "event_id"], "ok", "output").select("user_id", "event_id", "ok")


@query(f"""SELECT page_id FROM (SELECT page_id, {SQL_HOST} AS h, {SQL_PATH} AS p, regexp_extract(lower({SQL_PATH}), '\\.([a-z0-9]{{1,10}})$', 1) AS e FROM pages) WHERE regexp_matches(h, '(^|\\.)example\\.(com|org)$') AND p LIKE '/%' AND e IN ('html', 'pdf') ORDER BY page_id LIMIT 40""")
def page_candidates(spark, d):
    """Pages of allowed hosts below a path prefix with a wanted extension, up to the crawl's cap."""
    url = F.col("url")
    rows = t(spark, d, "pages").filter(U.host(url).rlike(r"(^|\.)example\.(com|org)$") & U.path(url).startswith("/") & U.extension(url).isin("html", "pdf"))
    return rows.select("page_id").orderBy("page_id").limit(40)


# ---- profiles of parsed files, on rows of the events table ------------------------------------


@query("""WITH e AS (SELECT event_type AS path, 't' || (user_id % 37) AS tag, CASE WHEN event_id % 3 = 0 THEN 'urn:a' ELSE 'urn:b' END AS ns, event_id % 9 + 1 AS depth, CASE WHEN event_id % 5 = 0 THEN 'text ' || (event_id % 40) END AS text FROM events),
n AS (SELECT path, tag, count(*) AS n FROM e GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY n DESC, tag) AS k FROM n), h AS (SELECT path, array_to_string(list(tag || ':' || n ORDER BY k), ',') AS names FROM r WHERE k <= 20 GROUP BY path),
t AS (SELECT path, array_to_string(list(text ORDER BY text), ',') AS samples FROM (SELECT path, text, row_number() OVER (PARTITION BY path ORDER BY text) AS k FROM (SELECT DISTINCT path, text FROM e WHERE text IS NOT NULL)) WHERE k <= 15 GROUP BY path)
SELECT e.path, count(*) AS elements, max(depth) AS max_depth, array_to_string(list_sort(list(DISTINCT ns)), ',') AS namespaces, any_value(h.names) AS names, any_value(t.samples) AS samples FROM e JOIN h ON e.path = h.path LEFT JOIN t ON e.path = t.path GROUP BY e.path""")
def xml_profile(spark, d):
    elements = shaped(spark, d, "events", path="event_type", tag="'t' || (user_id % 37)", namespace="CASE WHEN event_id % 3 = 0 THEN 'urn:a' ELSE 'urn:b' END", depth="event_id % 9 + 1", text="CASE WHEN event_id % 5 = 0 THEN 'text ' || (event_id % 40) END")
    out = binary.xml_profile(elements)
    return out.select("path", "elements", "max_depth", *[F.array_join(c, ",").alias(c) for c in ("namespaces", "names", "samples")])


@query("""SELECT path, member, bytes, place FROM (SELECT event_type AS path, 'm' || event_id AS member, event_id * 7919 % 100000 AS bytes, row_number() OVER (PARTITION BY event_type ORDER BY event_id * 7919 % 100000 DESC, 'm' || event_id) AS place FROM events) WHERE place <= 120""")
def largest_members(spark, d):
    members = shaped(spark, d, "events", path="event_type", member="'m' || event_id", bytes="event_id * 7919 % 100000")
    return binary.largest_members(members).select("path", "member", "bytes", F.col("place").cast("long").alias("place"))


@query("""WITH s AS (SELECT n_regionkey AS r, n_name AS sheet, n_nationkey % 3 <> 0 AS visible, n_nationkey * 3 AS filled FROM nation)
SELECT 'book' || r AS path, count(*) AS sheets, count(*) FILTER (visible) AS visible_sheets, CAST(sum(filled) AS BIGINT) AS filled, array_to_string(list_sort(list(sheet)), ' | ') AS names, left(array_to_string(list('a ' || sheet || ' | b' ORDER BY sheet), ' | '), 40) AS sample FROM s GROUP BY r""")
def workbook_summary(spark, d):
    sheets = t(spark, d, "nation").select(F.concat(F.lit("book"), "n_regionkey").alias("path"), F.col("n_name").alias("sheet"), (F.col("n_nationkey") % 3 != 0).alias("visible"), (F.col("n_nationkey") * 3).cast("long").alias("filled"), F.lit(0).alias("numeric"), F.lit(0).alias("formulas"), F.array(F.concat(F.lit("a "), "n_name"), F.lit("b")).alias("texts"))
    return binary.workbook_summary(sheets, 40).select("path", "sheets", "visible_sheets", "filled", "names", "sample")
