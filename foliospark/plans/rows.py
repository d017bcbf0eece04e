"""Registered queries of scalar functions, readers, sinks and rules, each beside SQL that does not share their code.

Inputs are whole tables; where these lack what a function is for, a CASE over an
id makes it, as the same text in both engines.  Such a CASE changes values, never
the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
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
from foliospark.plans.registry import SQL_HOST, SQL_LINES, SQL_PAIRS, SQL_PATH, SQL_QUERY, query, t
from foliospark.sources import readers, sinks


def shaped(spark, d: str, table: str, **columns: str) -> DataFrame:
    """A table with more columns, each a SQL expression that DuckDB reads alike."""
    return t(spark, d, table).selectExpr("*", *[f"{e} AS {c}" for c, e in columns.items()])


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def case(key: str, values: list[str]) -> str:
    """SQL that deals out expressions by an id."""
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


# ---- numbers, dates, sizes ----------------------------------------------------

RAW_NUMBER = case("o_orderkey", ["' 1,234,' || (o_orderkey % 1000)", "'NA'", "' n/a '", "'-'", "''", "'x' || o_orderkey", "'-' || o_orderkey || '.25'", "'NULL'"])


@query(f"""SELECT o_orderkey, CASE WHEN upper(trim(v)) NOT IN ('', 'NULL', 'NA', 'N/A', '-') THEN TRY_CAST(replace(trim(v), ',', '') AS DOUBLE) END AS number,
 CAST(TRY_CAST(replace(trim(v), ',', '') AS DECIMAL(38, 10)) AS DOUBLE) AS exact FROM (SELECT o_orderkey, {RAW_NUMBER} AS v FROM orders)""")
def number_parsing(spark, d):
    v = F.col("v")
    return shaped(spark, d, "orders", v=RAW_NUMBER).select("o_orderkey", V.parse_number(v).alias("number"), V.decimal_value(v).cast("double").alias("exact"))


RAW_DATE = "CASE WHEN o_orderkey % 9 = 0 THEN '3/6/2024' WHEN o_orderkey % 9 = 1 THEN 'soon' ELSE lpad(CAST(o_orderkey % 33 AS STRING), 2, '0') || '/' || lpad(CAST(o_orderkey % 14 AS STRING), 2, '0') || '/' || (1999 + o_orderkey % 30) END"
SQL_ISO = r"CASE WHEN regexp_full_match(v, '\d{2}/\d{2}/\d{4}') THEN strftime(try_strptime(v, '%d/%m/%Y'), '%Y-%m-%d') END"


@query(f"SELECT o_orderkey, iso, lpad(CAST(CAST(left(iso, 4) AS INT) - 1 AS VARCHAR), 4, '0') || substr(iso, 5) AS year_before FROM (SELECT o_orderkey, {SQL_ISO} AS iso FROM (SELECT o_orderkey, {RAW_DATE} AS v FROM orders))")
def date_parsing(spark, d):
    rows = shaped(spark, d, "orders", v=RAW_DATE).withColumn("iso", V.iso_date(F.col("v")))
    return rows.select("o_orderkey", "iso", V.prior_year(F.col("iso")).alias("year_before"))


RAW_SIZE = case("o_orderkey", ["(o_orderkey % 900) || 'M'", "'1.5GiB'", "o_orderkey || ''", "' 12 kb '", "'lots'", "'2T'"])
SIZE_PATTERN = r"(?i)^([0-9]+(?:\.[0-9]+)?)\s*([KMGT]?)(?:I?B)?$"


@query(f"""WITH x AS (SELECT o_orderkey, trim({RAW_SIZE}) AS v, CAST(o_orderkey AS BIGINT) * o_orderkey * 31 AS n FROM orders)
SELECT o_orderkey, CASE WHEN regexp_matches(v, '{SIZE_PATTERN}') THEN CAST(floor(CAST(regexp_extract(v, '{SIZE_PATTERN}', 1) AS DOUBLE) * pow(1024, CASE upper(regexp_extract(v, '{SIZE_PATTERN}', 2)) WHEN 'K' THEN 1 WHEN 'M' THEN 2 WHEN 'G' THEN 3 WHEN 'T' THEN 4 ELSE 0 END)) AS BIGINT) END AS bytes,
 CASE WHEN n >= 1099511627776 THEN printf('%.2f TiB', n / 1099511627776) WHEN n >= 1073741824 THEN printf('%.2f GiB', n / 1073741824) WHEN n >= 1048576 THEN printf('%.2f MiB', n / 1048576) WHEN n >= 1024 THEN printf('%.2f KiB', n / 1024) ELSE n || ' B' END AS shown FROM x""")
def byte_sizes(spark, d):
    rows = shaped(spark, d, "orders", v=RAW_SIZE, n="CAST(o_orderkey AS BIGINT) * o_orderkey * 31")
    return rows.select("o_orderkey", V.parse_bytes(F.col("v")).alias("bytes"), V.format_bytes(F.col("n")).alias("shown"))


RAW_TAG = case("page_id", ["'{urn:x}tag' || page_id", "'plain'", "'{a}{b}c'"])


@query(f"SELECT page_id, string_split({RAW_TAG}, '}}')[-1] AS local, replace('a\\b\\' || page_id, '\\', '/') AS portable FROM pages")
def tag_names(spark, d):
    rows = shaped(spark, d, "pages", v=RAW_TAG)
    return rows.select("page_id", V.local_name(F.col("v")).alias("local"), U.portable_path(F.concat(F.lit("a\\b\\"), "page_id")).alias("portable"))


RAW_FACTS = "'Total Fees paid were 1,' || (100 + doc_id % 900) || '.5 in all. <!-- fact:rows --> ' || doc_id || ' <!-- /fact --> <!-- fact:src.x --> ' || source || ' <!-- /fact -->'"


@query(rf"""SELECT doc_id, TRY_CAST(replace(regexp_extract(substr(v, greatest(strpos(lower(v), 'fees') - 160, 1), 324), '(?:^|[^\w.,])(\d[\d,]*(?:\.\d+)?)(?:\W|$)', 1), ',', '') AS DOUBLE) AS near,
 CAST(NULL AS DOUBLE) AS far FROM (SELECT doc_id, {RAW_FACTS} AS v FROM documents)""")
def numbers_near(spark, d):
    rows = shaped(spark, d, "documents", v=RAW_FACTS)
    return rows.select("doc_id", V.number_near(F.col("v"), "fees").cast("double").alias("near"), V.number_near(F.col("v"), "absent word").cast("double").alias("far"))


@query(rf"SELECT doc_id, unnest(regexp_extract_all(v, '<!-- fact:([\w.-]+) -->(.*?)<!-- /fact -->', 1)) AS key, trim(unnest(regexp_extract_all(v, '<!-- fact:([\w.-]+) -->(.*?)<!-- /fact -->', 2))) AS value FROM (SELECT doc_id, {RAW_FACTS} AS v FROM documents)")
def document_facts(spark, d):
    rows = shaped(spark, d, "documents", v=RAW_FACTS)
    return rows.select("doc_id", F.explode(V.fact_markers(F.col("v"))).alias("f")).select("doc_id", "f.key", "f.value")


RAW_WAIT = case("event_id", ["'' || (event_id % 100)", "'Wed, 21 Oct 2026 07:28:' || (10 + event_id % 50) || ' GMT'", "'later'", "'-5'", "CAST(NULL AS STRING)"])


@query(f"""WITH x AS (SELECT event_id, {RAW_WAIT} AS v FROM events)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN (event_id % 100) * 1000 WHEN 1 THEN 8000 + (event_id % 50) * 1000 + 2000 WHEN 3 THEN 0 END AS wait_ms, CAST(least(60000, 1000 * pow(2, event_id % 9)) AS BIGINT) AS backoff_ms FROM x""")
def retry_waits(spark, d):
    rows = shaped(spark, d, "events", v=RAW_WAIT)
    now = F.lit("2026-10-21 07:28:00").cast("timestamp")
    return rows.select("event_id", V.retry_after_ms(F.col("v"), now).alias("wait_ms"), V.backoff_ms(F.col("event_id") % 9).alias("backoff_ms"))


@query("""SELECT o_orderkey, CAST(len(list_filter(run, lambda x: x <= 60000)) AS BIGINT) AS chunks FROM (SELECT o_orderkey, [a, a + b, a + b + a, a + b + a + b] AS run FROM (SELECT o_orderkey, o_orderkey % 40000 AS a, o_orderkey % 7000 AS b FROM orders))""")
def byte_limit(spark, d):
    rows = shaped(spark, d, "orders", a="o_orderkey % 40000", b="o_orderkey % 7000")
    return rows.select("o_orderkey", F.size(V.within_byte_limit(F.array("a", "b", "a", "b"), 60_000)).cast("long").alias("chunks"))


# ---- addresses and names --------------------------------------------------------

RAW_URL = case("page_id", ["url || '?sfvrsn=' || page_id", "url || '/docs/default-source/a/Doc' || page_id || '.pdf?x=1&sfvrsn=9'", "url || '/report.pdf?sfvrsn=ab12%22junk\">tail'", "url || '/docs/default-source/b.pdf'", "'https://h.example/docs/default-source/c.pdf?sfvrsn=' || page_id", "url"])


def on(expression: str, column: str = "v") -> str:
    """A fragment of SQL over ``url`` asked of another column."""
    return expression.replace("url,", f"{column},")


@query(f"""WITH x AS (SELECT page_id, {RAW_URL} AS v FROM pages), y AS (SELECT page_id, v, lower({on(SQL_PATH)}) AS p, regexp_extract({on(SQL_QUERY)}, '(?:^|&)sfvrsn=([^&]*)', 1) AS r FROM x)
SELECT page_id, CASE WHEN strpos(p, '/docs/default-source/') > 1 THEN substr(p, strpos(p, '/docs/default-source/')) END AS nested, CASE WHEN r <> '' THEN string_split(p, '/')[-1] || '|' || r END AS alias,
 regexp_replace(regexp_extract(v, '^[^"''<>]*', 0), '([?&]sfvrsn=[A-Za-z0-9]+)[^&#]*', '\\1', 'g') AS repaired FROM y""")
def url_repairs(spark, d):
    v = F.col("v")
    return shaped(spark, d, "pages", v=RAW_URL).select("page_id", U.nested_key(v).alias("nested"), U.alias_key(v).alias("alias"), U.repair(v).alias("repaired"))


@query(f"""WITH x AS (SELECT page_id, lower({on(SQL_PATH)}) AS own, sha256(v) AS sha, v FROM (SELECT page_id, {RAW_URL} AS v FROM pages)),
y AS (SELECT *, CASE WHEN strpos(own, '/docs/default-source/') > 1 THEN substr(own, strpos(own, '/docs/default-source/')) END AS nested FROM x)
SELECT a.sha, array_to_string(list_sort(list(DISTINCT b.v)), ' | ') AS aliases FROM y a JOIN y b ON a.own = b.nested AND a.sha <> b.sha GROUP BY a.sha""")
def nested_url_aliases(spark, d):
    rows = shaped(spark, d, "pages", v=RAW_URL).withColumn("sha", F.sha2("v", 256)).select("v", "sha")
    return D.nested_aliases(rows, "v", "sha").withColumn("aliases", F.array_join("aliases", " | "))


# Failed records: one of three addresses is broken behind its revision, one has an alias key only, one cannot be settled.
BROKEN_URL = case("page_id", ["'https://h.example/x/doc' || page_id || '.pdf?sfvrsn=' || page_id || '\"junk'", "'https://old.example/doc' || page_id || '.pdf?sfvrsn=' || page_id", "'https://h.example/lost' || page_id || '.pdf'"])
GOOD_URL = "'https://h.example/' || (CASE WHEN page_id % 2 = 0 THEN 'x' ELSE 'y' END) || '/doc' || page_id || '.pdf?sfvrsn=' || page_id"


@query(f"""WITH b AS (SELECT page_id, {BROKEN_URL} AS key FROM pages)
SELECT key, CASE page_id % 3 WHEN 0 THEN left(key, length(key) - 5) WHEN 1 THEN {GOOD_URL} END AS new_key,
 CASE WHEN page_id % 3 = 2 THEN 'left' WHEN page_id % 3 = 1 OR page_id % 2 = 0 THEN 'merged' ELSE 'rewritten' END AS action FROM b""")
def record_repairs(spark, d):
    broken = shaped(spark, d, "pages", key=BROKEN_URL).select("key", U.alias_key(U.repair(F.col("key"))).alias("alias"), U.repair(F.col("key")).alias("repaired_key"))
    good = shaped(spark, d, "pages", key=GOOD_URL).select("key", U.alias_key(F.col("key")).alias("alias"))
    return I.repair_records(broken, good, "alias", "key", "repaired_key")


RAW_NAME = case("page_id", ["'a:b?' || page_id", "'CON'", "'trail. . '", "'...'", "'x%20y' || page_id || '.PDF'", "repeat('long', 30) || page_id || '.pdf'", "'lpt7'", "'<q>|*' || page_id"])
SQL_SUFFIX = r"regexp_extract({0}, '(?s)[^.].*(\.[^.]*)$', 1)"


@query(rf"""WITH x AS (SELECT page_id, url_decode({RAW_NAME}) AS d FROM pages), y AS (SELECT *, trim(regexp_replace(regexp_replace(d, '[<>:"/\\|?*\x00-\x1f]', '_', 'g'), '[. ]+$', '')) AS a FROM x),
z AS (SELECT *, CASE WHEN a = '' THEN '_' WHEN regexp_full_match(upper(a), 'CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9]') THEN '_' || a ELSE a END AS b FROM y)
SELECT page_id, CASE WHEN length(b) > 90 THEN left(b, 70 - length({SQL_SUFFIX.format('b')})) || '__' || left(sha256(d), 10) || {SQL_SUFFIX.format('b')} ELSE b END AS name FROM z""")
def portable_names(spark, d):
    return shaped(spark, d, "pages", v=RAW_NAME).select("page_id", U.safe_segment(F.col("v")).alias("name"))


RAW_PLACE = case("page_id", ["'https://h.example/a/Doc' || page_id || '.pdf'", "'https://h.example/a/b?z=' || page_id || '&a=1'", "'https://H.example/'", "'https://h.example/' || repeat('very-long/', 40) || 'report' || page_id || '.pdf?sfvrsn=1'"])
SQL_CANONICAL = f"'https://' || {SQL_HOST} || CASE WHEN {SQL_PATH} = '' THEN '/' ELSE {SQL_PATH} END || CASE WHEN {SQL_PAIRS} <> '' THEN '?' || {SQL_PAIRS} ELSE '' END"


@query(rf"""WITH x AS (SELECT page_id, {RAW_PLACE} AS url FROM pages), y AS (SELECT page_id, url, {SQL_HOST} AS h, {SQL_CANONICAL} AS c, {SQL_QUERY} AS q, list_filter(string_split({SQL_PATH}, '/'), lambda s: s <> '') AS s FROM x),
z AS (SELECT *, CASE WHEN len(s) = 0 THEN 'index.html' ELSE s[-1] END AS l FROM y),
w AS (SELECT *, {SQL_SUFFIX.format('l')} AS e FROM z), f AS (SELECT *, left(l, length(l) - length(e)) || CASE WHEN q <> '' THEN '__q-' || left(sha256('?' || q), 10) ELSE '' END || '__u-' || left(sha256(c), 12) AS stem FROM w),
g AS (SELECT *, h || '/' || CASE WHEN len(s) > 1 THEN array_to_string(s[:-2], '/') || '/' ELSE '' END || stem || e AS whole, h || '/_long/' || left(sha256(url), 24) || '/' AS folder FROM f)
SELECT page_id, CASE WHEN length(whole) > 209 THEN folder || left(stem, greatest(4, 209 - length(folder) - length(e))) || e ELSE whole END AS place FROM g""")
def file_places(spark, d):
    return shaped(spark, d, "pages", v=RAW_PLACE).select("page_id", U.file_path(F.col("v")).alias("place"))


RAW_SITEMAP = "'<urlset><url><loc> ' || replace(url, '&', '&amp;') || ' </loc></url><url><LOC>https://h.example/?a=1&amp;b=&lt;' || page_id || '&gt;</LOC></url></urlset>'"


@query(f"SELECT page_id, trim(url) AS first, 'https://h.example/?a=1&b=<' || page_id || '>' AS second, CAST(2 AS BIGINT) AS n FROM pages")
def sitemap_entries(spark, d):
    rows = shaped(spark, d, "pages", v=RAW_SITEMAP).withColumn("l", U.sitemap_locations(F.col("v")))
    return rows.select("page_id", F.get("l", F.lit(0)).alias("first"), F.get("l", F.lit(1)).alias("second"), F.size("l").cast("long").alias("n"))


FORMATS = case("doc_id", ["'PDF'", "'docx'", "'DOC'", "'XLS'", "'odd'"])
SQL_CANDIDATES = "CASE upper(f) WHEN 'PDF' THEN ['.pdf'] WHEN 'DOCX' THEN ['.docx', '.doc'] WHEN 'DOC' THEN ['.doc', '.docx'] WHEN 'XLS' THEN ['.xls', '.xlsx'] ELSE ['.' || lower(f)] END"
SQL_KEY = "left(sha, 2) || '/' || substr(sha, 3, 2) || '/' || sha"
# What a listing holds: mostly the second candidate, so the first does not resolve.
LISTED = case("doc_id", ["'.pdf'", "'.doc'", "'.docx'", "'.txt'", "'.odd'"])


@query(f"""WITH x AS (SELECT doc_id, sha256(CAST(doc_id AS VARCHAR)) AS sha, {FORMATS} AS f, {LISTED} AS e FROM documents), c AS (SELECT doc_id, {SQL_KEY} AS base, {SQL_KEY} || e AS held, {SQL_CANDIDATES} AS tried FROM x)
SELECT doc_id, list_filter(list_transform(tried, lambda z: base || z), lambda k: k = held)[1] AS resolved, 'https://blobs.example/' || base || tried[1] AS first_url FROM c""")
def resolved_blobs(spark, d):
    rows = shaped(spark, d, "documents", kind=FORMATS, ext=LISTED).withColumn("sha", F.sha2(F.col("doc_id").cast("string"), 256))
    listing = rows.select(U.blob_key(F.col("sha"), F.col("ext"), F.lit("bin")).alias("key"))
    found = U.first_existing(rows.select("doc_id", "sha", "kind"), "sha", "kind", listing, "key")
    first = U.blob_key(F.col("sha"), F.get(U.extension_candidates(F.col("kind")), F.lit(0)), F.lit("bin"))
    return found.select("doc_id", "resolved", U.blob_url("https://blobs.example", first).alias("first_url"))


@query("""WITH x AS (SELECT sha256(html) AS sha256, 'site/' || page_id || CASE WHEN page_id % 3 = 0 THEN '.HTML' ELSE '' END AS path, length(html) AS n FROM pages),
g AS (SELECT sha256, min(path) AS path, min(CASE WHEN path LIKE '%.HTML' THEN '.html' ELSE '' END) AS suffix, max(n) AS bytes, count(*) AS copies FROM x GROUP BY 1)
SELECT sha256, path, copies, left(sha256, 2) || '/' || substr(sha256, 3, 2) || '/' || sha256 || CASE WHEN suffix = '' THEN '.bin' ELSE suffix END AS key, CAST((copies - 1) * bytes AS BIGINT) AS bytes_saved FROM g""")
def content_addressed_layout(spark, d):
    files = t(spark, d, "pages").select(F.sha2("html", 256).alias("sha256"), F.concat(F.lit("site/"), "page_id", F.when(F.col("page_id") % 3 == 0, ".HTML").otherwise("")).alias("path"), F.length("html").cast("long").alias("length"))
    return sinks.blob_layout(files).select("sha256", "path", "copies", "key", "bytes_saved")


# ---- readers ---------------------------------------------------------------------

NL = "chr(10)"
RAW_MARKDOWN = f"'---' || {NL} || 'document_id: ' || doc_id || {NL} || 'source: \"' || source || '\"' || {NL} || '---' || {NL} || {NL} || '<!-- source-page: 1 -->' || {NL} || '<a id=\"page-1\"></a>' || {NL} || {NL} || left(text, 60) || {NL} || {NL} || '<!-- source-page: 2 -->' || {NL} || '<a id=\"page-2\"></a>' || {NL} || {NL} || 'end ' || lang || {NL}"
SQL_STRIP = r"regexp_replace({0}, '^[\s\v\x1c-\x1f\x85\p{{Z}}]+|[\s\v\x1c-\x1f\x85\p{{Z}}]+$', '', 'g')"


@query(f"SELECT doc_id, CAST(p AS BIGINT) AS page_number, CASE p WHEN 1 THEN {SQL_STRIP.format('left(text, 60)')} ELSE 'end ' || lang END AS text, '\"' || source || '\"' AS source FROM documents, (SELECT unnest([1, 2]) AS p)")
def markdown_pages(spark, d):
    rows = shaped(spark, d, "documents", md=RAW_MARKDOWN).select("doc_id", readers.front_matter(F.col("md")).alias("meta"), readers.pages(readers.body(F.col("md"))).alias("p"))
    return rows.select("doc_id", F.col("meta")["source"].alias("source"), F.explode("p").alias("p")).select("doc_id", F.col("p.page_number").cast("long").alias("page_number"), "p.text", "source")


RAW_STATE = "'{\"files\": {\"' || url || '\": {\"status\": \"' || (CASE page_id % 3 WHEN 0 THEN 'pending' ELSE 'downloaded' END) || '\", \"format\": \"' || (CASE page_id % 2 WHEN 0 THEN 'PDF' ELSE 'CSV' END) || '\"}}}'"


@query("SELECT url AS canonical_url, 'downloaded' AS status, 'PDF' AS format FROM pages WHERE page_id % 3 <> 0 AND page_id % 2 = 0")
def crawl_state_files(spark, d):
    state = shaped(spark, d, "pages", v=RAW_STATE).select(F.from_json("v", "files map<string,struct<status:string,format:string>>")["files"].alias("files"))
    return readers.crawl_files(state, kind="PDF").select("canonical_url", "status", "format")


RAW_CATALOGUE = "'{\"result\": {\"results\": [{\"name\": \"set' || page_id || '\", \"title\": \"Set\", \"resources\": [{\"id\": \"a\", \"name\": \"one\", \"url\": \"' || url || '\", \"format\": \"csv\"}, {\"id\": \"b\", \"name\": \"two\", \"url\": \"ftp://x/y\", \"format\": \"pdf\"}, {\"id\": \"c\", \"name\": \"three\", \"url\": \"HTTP://h.example/' || page_id || '\", \"format\": \"Xls\"}]}]}}'"


@query("SELECT 'set' || page_id AS dataset, 'Set' AS dataset_title, r AS resource_id, CASE r WHEN 'a' THEN 'one' ELSE 'three' END AS resource, CASE r WHEN 'a' THEN url ELSE 'HTTP://h.example/' || page_id END AS url, CASE r WHEN 'a' THEN 'CSV' ELSE 'XLS' END AS format FROM pages, (SELECT unnest(['a', 'c']) AS r)")
def catalogue_resources(spark, d):
    return readers.ckan_resources(shaped(spark, d, "pages", v=RAW_CATALOGUE), "v")


STATUS = case("doc_id", ["'success'", "'low_text'", "'error'", "'skipped'"])


@query(f"""SELECT corpus, status, count(*) AS n, count(engine) AS with_engine FROM (SELECT 'pdf' AS corpus, {STATUS} AS status, lang AS engine FROM documents UNION ALL SELECT 'office', {STATUS}, NULL FROM labels) WHERE status IN ('success', 'low_text') GROUP BY ALL""")
def usable_manifests(spark, d):
    frames = {"pdf": shaped(spark, d, "documents", status=STATUS, engine="lang").select("doc_id", "status", "engine"), "office": shaped(spark, d, "labels", status=STATUS).select("doc_id", "status")}
    return readers.corpora(frames).groupBy("corpus", "status").agg(F.count("*").alias("n"), F.count("engine").alias("with_engine"))


AUTHORSHIP = case("doc_id", ["'central-bank'", "' stakeholder '", "''", "'somebody'"])
CONFIDENCE = case("doc_id", ["'high'", "' '", "'certain'"])


@query(f"""WITH x AS (SELECT doc_id, nullif(trim({AUTHORSHIP}), '') AS a, coalesce(nullif(trim({CONFIDENCE}), ''), 'medium') AS c FROM documents),
y AS (SELECT *, concat_ws(',', CASE WHEN a NOT IN ('central-bank', 'stakeholder') THEN 'authorship' END, CASE WHEN c NOT IN ('high', 'medium', 'low') THEN 'confidence' END) AS bad FROM x)
SELECT doc_id, a AS authorship, c AS confidence, bad AS outside_domain FROM y""")
def override_domains(spark, d):
    rows = shaped(spark, d, "documents", authorship=AUTHORSHIP, confidence=CONFIDENCE).select("doc_id", "authorship", "confidence")
    good, bad = D.valid_overrides(rows, {"authorship": ["central-bank", "stakeholder"], "confidence": ["high", "medium", "low"]}, {"confidence": F.lit("medium")})
    return good.withColumn("outside_domain", F.lit("")).unionByName(bad.withColumn("outside_domain", F.array_join("outside_domain", ",")))


@query("SELECT doc_id, lang, 'published_at,voice' AS missing FROM documents")
def optional_columns(spark, d):
    have, missing = C.optional(t(spark, d, "documents"), ["doc_id", "lang", "published_at", "voice"])
    return have.withColumn("missing", F.lit(",".join(missing)))


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform([0, n // 4, n // 2, 3 * n // 4, n - 1], lambda x: least(x, n - 1)))), ',') AS sampled,
 CASE WHEN doc_id % 11 = 0 THEN 'error' WHEN doc_id % 7 = 0 THEN 'encrypted' WHEN n_chars < 30 THEN 'likely_ocr' ELSE 'ok' END AS status FROM (SELECT doc_id, n_chars, 1 + n_chars // 100 AS n FROM documents)""")
def audit_samples(spark, d):
    rows = shaped(spark, d, "documents", n="1 + n_chars div 100", error="CASE WHEN doc_id % 11 = 0 THEN 'unreadable' END", locked="doc_id % 7 = 0")
    n = F.col("n")
    return rows.select("doc_id", F.array_join(readers.audit_sample(n), ",").alias("sampled"), readers.audit_status(F.col("locked"), n, F.col("n_chars"), F.col("error")).alias("status"))


# ---- sinks -----------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN regexp_matches(v, '[",\r\n]') THEN '"' || replace(v, '"', '""') || '"' ELSE v END AS field, CAST(to_json(v) AS VARCHAR) AS scalar, lang || ' | ' || source AS joined
FROM (SELECT *, left(text, 50) || CASE doc_id % 3 WHEN 0 THEN ', "x"' WHEN 1 THEN chr(10) || 'y' ELSE '' END AS v FROM documents)""")
def tabular_fields(spark, d):
    rows = shaped(spark, d, "documents", v="left(text, 50) || CASE doc_id % 3 WHEN 0 THEN ', \"x\"' WHEN 1 THEN chr(10) || 'y' ELSE '' END").withColumn("joined", F.array("lang", "source"))
    return sinks.flattened(rows.select("doc_id", sinks.csv_escape(F.col("v")).alias("field"), sinks.yaml_scalar(F.col("v")).alias("scalar"), "joined"))


@query(f"""SELECT doc_id, sha256('---' || chr(10) || 'lang: ' || CAST(to_json(any_value(lang)) AS VARCHAR) || chr(10) || 'source: ' || CAST(to_json(any_value(source)) AS VARCHAR) || chr(10) || '---' || chr(10) ||
 string_agg('<!-- source-page: ' || page_number || ' -->' || chr(10) || '<a id="page-' || page_number || '"></a>' || chr(10) || line || chr(10), chr(10) ORDER BY page_number)) AS sha, count(*) AS pages FROM {SQL_LINES} GROUP BY doc_id""")
def markdown_artefacts(spark, d):
    pages = t(spark, d, "documents").select("doc_id", "lang", "source", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line")).withColumn("page_number", F.col("pos") + 1)
    made = sinks.markdown(pages, "doc_id", "page_number", "line", {"lang": "lang", "source": "source"})
    n = F.regexp_count("markdown", F.lit(r'(?m)^<!-- source-page: \d+ -->$')).cast("long")
    return made.select("doc_id", F.sha2("markdown", 256).alias("sha"), n.alias("pages"))


@query(r"""WITH x AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g'), '(?m)[ \t]+$', '', 'g')) AS b FROM documents),
y AS (SELECT doc_id, b, CAST(sum(length(b)) OVER (ORDER BY doc_id) AS BIGINT) AS running FROM x WHERE length(b) >= 200)
SELECT doc_id, running, sha256('== ' || doc_id || chr(10) || b || chr(10)) AS sha FROM y WHERE running <= 300000""")
def excerpt_budget(spark, d):
    rows = t(spark, d, "documents").select("doc_id", "text")
    return sinks.bundle_text(rows, "doc_id", F.concat(F.lit("== "), "doc_id"), "text", 300_000).select("doc_id", "running", F.sha2("excerpt", 256).alias("sha"))


CORPUS = case("doc_id", ["'pdf'", "'office'"])


@query(f"""WITH x AS (SELECT sha256(left(text, 40)) AS sha, {CORPUS} AS corpus, CASE WHEN doc_id % 6 = 1 THEN 'https://h/a.DOCX?x' ELSE 'https://h/a.pdf' END AS u FROM documents)
SELECT sha, CASE WHEN bool_or(u LIKE '%.DOCX%') THEN 'office' ELSE 'pdf' END AS preferred FROM x GROUP BY sha HAVING count(DISTINCT corpus) > 1""")
def extraction_choice(spark, d):
    rows = shaped(spark, d, "documents", corpus=CORPUS, u="CASE WHEN doc_id % 6 = 1 THEN 'https://h/a.DOCX?x' ELSE 'https://h/a.pdf' END").withColumn("sha", F.sha2(F.left("text", F.lit(40)), 256))
    return sinks.extraction_preferences(rows, "sha", "u", "corpus")


@query("SELECT doc_id, lang AS lang, CASE WHEN doc_id % 2 = 0 THEN 'x' ELSE source END AS source, doc_id % 2 = 0 AND source <> 'x' AS changed FROM documents")
def front_matter_update(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.create_map(F.lit("lang"), "lang", F.lit("source"), "source").alias("meta"), F.when(F.col("doc_id") % 2 == 0, "x").otherwise(F.col("source")).alias("v"))
    out = D.update_front_matter(rows, "meta", {"source": F.col("v")})
    return out.select("doc_id", F.col("updated")["lang"].alias("lang"), F.col("updated")["source"].alias("source"), "changed")


# ---- titles, voices, overrides -----------------------------------------------------

RAW_TEXT = case("doc_id", ["'intro' || chr(10) || '# **Heading** `' || doc_id || '`'", "'plain'", "'## Contents'", "'# ' || chr(10) || '## Real'", "'###### ' || repeat('x', 600)"])
RAW_PDF_TITLE = "CASE WHEN doc_id % 7 = 0 THEN ' Pdf title ' || doc_id WHEN doc_id % 7 = 1 THEN ' ' END"
RAW_GIVEN = "CASE WHEN doc_id % 11 = 0 THEN 'Given ' || doc_id WHEN doc_id % 11 = 1 THEN '' END"


@query(rf"""WITH x AS (SELECT doc_id, {RAW_GIVEN} AS g, {RAW_PDF_TITLE} AS p, left(list_filter(list_transform(regexp_extract_all({RAW_TEXT}, '(?m)^#{{1,6}}[ \t]+(.*)$', 1), lambda h: trim(regexp_replace(h, '[*_`#<>]', '', 'g'))), lambda h: h <> '')[1], 500) AS h FROM documents)
SELECT doc_id, coalesce(nullif(trim(g), ''), nullif(trim(p), ''), CASE WHEN lower(h) NOT IN ('contents', 'table of contents', 'introduction') THEN h END, 'some paper ' || doc_id) AS title, h AS heading FROM x""")
def document_titles(spark, d):
    rows = shaped(spark, d, "documents", g=RAW_GIVEN, p=RAW_PDF_TITLE, body=RAW_TEXT, u="'https://h.example/a/some-paper_' || doc_id || '.pdf'")
    return rows.select("doc_id", D.title(F.col("g"), F.col("p"), F.col("body"), F.col("u")).alias("title"), T.first_heading(F.col("body")).alias("heading"))


@query("SELECT count(*) FILTER (t IS NULL OR trim(t) = '') AS blank, count(*) AS n FROM (SELECT CASE WHEN doc_id % 7 = 0 THEN ' ' WHEN doc_id % 7 = 1 THEN NULL ELSE source END AS t FROM documents)")
def blank_titles(spark, d):
    rows = shaped(spark, d, "documents", t="CASE WHEN doc_id % 7 = 0 THEN ' ' WHEN doc_id % 7 = 1 THEN NULL ELSE source END")
    return rows.agg(F.count_if(F.coalesce(F.trim("t"), F.lit("")) == "").alias("blank"), F.count("*").alias("n"))


SPEAKERS = list(R.VOICES)


@query(f"SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'cbi-institutional' WHEN 1 THEN 'stakeholder' WHEN 2 THEN 'external-authority' WHEN 3 THEN 'judicial-tribunal' WHEN 4 THEN 'third-party' WHEN 5 THEN 'mixed' ELSE 'unknown' END AS voice FROM documents")
def voices(spark, d):
    return shaped(spark, d, "documents", a=case("doc_id", [quoted(s) for s in SPEAKERS])).select("doc_id", R.voice_for(F.col("a")).alias("voice"))


@query("SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN d.lang ELSE d.lang END AS lang, CASE WHEN l.doc_id IS NOT NULL THEN 'src-' || l.toxic ELSE d.source END AS source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def adjudicated_labels(spark, d):
    reviewed = t(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").alias("lang"), F.concat(F.lit("src-"), "toxic").alias("source"))
    return R.apply_overrides(t(spark, d, "documents").select("doc_id", "lang", "source"), reviewed, "doc_id", ["lang", "source"])


PAGE_OVERRIDES = [(3, 0, 1, "reviewed-a"), (3, 1, 5, "reviewed-b"), (7, 1, 1, "reviewed-a"), (20, 0, 9, "reviewed-c")]
SQL_OVERRIDES = "(VALUES " + ", ".join(map(str, PAGE_OVERRIDES)) + ") o(k, a, b, l)"
VOICE_OF_TURN = "CASE WHEN conv_id % 5 = 0 THEN 'mixed' ELSE role END"


@query(f"""WITH c AS (SELECT DISTINCT conv_id, turn, {VOICE_OF_TURN} AS voice FROM conversations), j AS (SELECT conv_id, turn, voice, count(l) AS n, min(l) AS l FROM c LEFT JOIN {SQL_OVERRIDES} ON conv_id = k AND turn BETWEEN a AND b GROUP BY ALL)
SELECT conv_id, turn, coalesce(l, voice) AS final_voice, CASE WHEN n > 0 THEN 'page-override' ELSE 'document:' || voice END AS voice_basis, CASE WHEN n > 1 THEN 'overlapping-overrides' WHEN voice = 'mixed' AND n = 0 THEN 'uncovered-page' END AS fault FROM j""")
def page_voices(spark, d):
    overrides = spark.createDataFrame(PAGE_OVERRIDES, "conv_id long, start_page long, end_page long, voice string")
    pages = t(spark, d, "conversations").selectExpr("conv_id", "turn", f"{VOICE_OF_TURN} AS own").distinct()
    return D.page_voice(pages, overrides, "conv_id", "turn", "own").select("conv_id", "turn", "final_voice", "voice_basis", "fault")


@query("""SELECT doc_id, concat_ws(';', CASE WHEN doc_id % 5 = 0 THEN 'mixed-container' END, CASE WHEN n_chars < 200 THEN 'low-confidence' END, CASE WHEN contains(lower(text), 'private') OR contains(text, '@') THEN 'sensitive-title' END) AS reasons FROM documents""")
def review_reasons(spark, d):
    rows = t(spark, d, "documents")
    reasons = R.risk_reasons(F.col("doc_id") % 5 == 0, F.col("n_chars") < 200, F.lower("text").contains("private") | F.col("text").contains("@"))
    return rows.select("doc_id", F.array_join(reasons, ";").alias("reasons"))


# ---- quality ladder and recovery ------------------------------------------------------

EXPANSION, REPEATED, LONGEST = "(doc_id % 12) * 1.0", "(doc_id % 10) / 10.0", "n_chars * 100"


@query(f"""WITH x AS (SELECT doc_id, list_filter([CASE WHEN {EXPANSION} > 5 THEN 'expansion' END, CASE WHEN {REPEATED} > 0.5 THEN 'repetition' END, CASE WHEN {LONGEST} > 500000 THEN 'long-page' END], lambda f: f IS NOT NULL) AS f,
 doc_id % 5 AS pages, doc_id * 37 % 3000 AS dense, doc_id % 13 AS bad, doc_id % 3 AS empty FROM documents),
g AS (SELECT *, CASE WHEN pages <= 0 OR dense < 100 THEN 'empty' WHEN bad > 0 AND (bad >= 200 OR bad * 500 >= dense) THEN 'garbled' WHEN empty / pages >= 0.30 THEN 'gappy' WHEN dense / pages < 200 THEN 'thin' ELSE 'ok' END AS grade FROM x)
SELECT doc_id, array_to_string(f, ',') AS flags, grade, CASE WHEN grade = 'ok' AND len(f) > 0 THEN 'suspect' ELSE grade END AS final_grade FROM g""")
def semantic_grades(spark, d):
    rows = shaped(spark, d, "documents", e=EXPANSION, r=REPEATED, l=LONGEST, pages="doc_id % 5", dense="doc_id * 37 % 3000", bad="doc_id % 13", empty="doc_id % 3")
    rows = rows.withColumn("f", T.semantic_flags(F.col("e"), F.col("r"), F.col("l"))).withColumn("grade", T.grade(F.col("pages"), F.col("dense"), F.col("bad"), F.col("empty")))
    return rows.select("doc_id", F.array_join("f", ",").alias("flags"), "grade", T.with_flags(F.col("grade"), F.col("f")).alias("final_grade"))


LAYER, SEEN = case("doc_id", ["''", "'layer'", "' '"]), case("doc_id", ["'ocr'", "''", "'ocr'", "''"])


@query(f"""WITH x AS (SELECT doc_id, doc_id % 60 AS n, (doc_id % 7) / 10.0 AS rate, trim({LAYER}) <> '' AS layer, trim({SEEN}) <> '' AS seen, doc_id % 2 = 0 AS forced FROM documents)
SELECT doc_id, CASE WHEN n < 30 AND layer THEN 'text-layer' WHEN n < 30 AND seen THEN 'ocr' WHEN n < 30 THEN 'skip:no-candidate' WHEN rate < 0.20 THEN 'skip:readable' WHEN NOT forced THEN 'skip:garbled-not-forced' WHEN layer THEN 'text-layer' WHEN seen THEN 'ocr' ELSE 'skip:no-candidate' END AS action FROM x""")
def page_recovery(spark, d):
    rows = shaped(spark, d, "documents", n="doc_id % 60", rate="(doc_id % 7) / 10.0", layer=LAYER, seen=SEEN, forced="doc_id % 2 = 0")
    return rows.select("doc_id", T.recovery_action(F.col("n"), F.col("rate"), F.col("layer"), F.col("seen"), F.col("forced")).alias("action"))


@query(f"""SELECT doc_id, grade, round(density, 3) AS density, row_number() OVER (ORDER BY grade = 'ok', density, doc_id) AS place FROM (SELECT doc_id, CASE WHEN n_chars < 100 THEN 'empty' WHEN n_chars < 1500 THEN 'thin' ELSE 'ok' END AS grade, n_chars / 7.0 AS density FROM documents) ORDER BY place LIMIT 100""")
def worst_grades_first(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") < 100, "empty").when(F.col("n_chars") < 1500, "thin").otherwise("ok").alias("grade"), (F.col("n_chars") / 7.0).alias("density"))
    out = T.worst_first(rows, "grade", "density", "doc_id", 100)
    return out.select("doc_id", "grade", F.round("density", 3).alias("density"), F.col("place").cast("long").alias("place"))


# ---- comparison, counts, periods -------------------------------------------------------

LISTED_PATH, LISTED_SIZE, LISTED_SHA = "CASE WHEN page_id % 9 = 0 THEN 'moved/' || url ELSE url || page_id END", "length(html) + CASE WHEN page_id % 7 = 0 THEN 1 ELSE 0 END", "CASE WHEN page_id % 5 = 0 THEN 'other' ELSE left(html, 30) END"


@query(f"""WITH a AS (SELECT url || page_id AS path, length(html) AS s, left(html, 30) AS h FROM pages), b AS (SELECT {LISTED_PATH} AS path, {LISTED_SIZE} AS s, {LISTED_SHA} AS h FROM pages)
SELECT count(*) FILTER (b.path IS NULL) AS missing, count(*) FILTER (a.path IS NULL) AS uncatalogued, count(*) FILTER (a.s <> b.s) AS size_differs, count(*) FILTER (a.h <> b.h) AS hash_differs FROM a FULL JOIN b ON a.path = b.path""")
def listing_check(spark, d):
    a = shaped(spark, d, "pages", path="url || page_id", s="length(html)", h="left(html, 30)")
    b = shaped(spark, d, "pages", path=LISTED_PATH, s=LISTED_SIZE, h=LISTED_SHA)
    return C.listing_faults(a, b, "path", "s", "h")


@query("SELECT count(*) AS n, round(sum(l_extendedprice), 2) AS price FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 1 AND l_quantity = 10")
def dimension_slice(spark, d):
    from foliospark.operators import structured as SD

    rows = SD.slice_of(t(spark, d, "lineitem"), l_returnflag="R", l_linestatus="F", l_linenumber=1, l_quantity=10)
    return rows.agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("""SELECT status, after, count(*) AS n FROM (SELECT CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'pending' ELSE 'downloaded' END AS status,
 CASE WHEN user_id % 5 = 0 THEN 'pending' WHEN user_id % 7 = 0 THEN 'blocked' WHEN value > 10 THEN 'downloaded' ELSE 'failed' END AS after FROM events) WHERE status IN ('pending', 'failed') GROUP BY ALL""")
def download_queue(spark, d):
    files = t(spark, d, "events").withColumn("status", F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "click", "pending").otherwise("downloaded"))
    after = I.next_status(F.col("user_id") % 5 != 0, F.col("user_id") % 7 == 0, F.col("value") > 10)
    return I.download_candidates(files, "status", retry_failed=True).withColumn("after", after).groupBy("status", "after").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (len(list_filter(s, lambda x: x = 'documents')) > 0) AS of_source, count(*) AS of_all FROM (SELECT [CASE page_id % 3 WHEN 0 THEN 'documents' ELSE 'opendata' END, 'all-pages'] AS s FROM pages)")
def source_filter(spark, d):
    files = t(spark, d, "pages").select(F.array(F.when(F.col("page_id") % 3 == 0, "documents").otherwise("opendata"), F.lit("all-pages")).alias("s"))
    return files.agg(F.count_if(I.source_matches(F.col("s"), "documents")).alias("of_source"), F.count_if(I.source_matches(F.col("s"), "all")).alias("of_all"))


@query(f"""WITH x AS (SELECT regexp_extract(lower({SQL_PATH}), '\\.([a-z0-9]{{1,10}})$', 1) AS e FROM (SELECT url || CASE page_id % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.png' WHEN 2 THEN '.zip' ELSE '' END AS url FROM pages))
SELECT count(*) FILTER (e IN ('pdf', 'zip')) AS chosen, count(*) FILTER (e IN ('pdf', 'zip', 'png')) AS with_assets FROM x""")
def type_selection(spark, d):
    rows = shaped(spark, d, "pages", v="url || CASE page_id % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.png' WHEN 2 THEN '.zip' ELSE '' END").select(U.extension(F.col("v")).alias("e"))
    return rows.agg(F.count_if(F.col("e").isin(I.selected_types(" .PDF, zip,"))).alias("chosen"), F.count_if(F.col("e").isin(I.selected_types("pdf,zip", assets=True))).alias("with_assets"))


@query("""WITH x AS (SELECT user_id, event_id, event_type, ts, 'r' || (event_id % 37) AS r FROM events), f AS (SELECT user_id, r, min((ts, event_id)) AS a FROM x GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a) AS n FROM f)
SELECT user_id, array_to_string(list(r ORDER BY n) FILTER (n <= 20), ',') AS referrers, count(*) AS all_referrers FROM k GROUP BY user_id""")
def bounded_referrers(spark, d):
    rows = t(spark, d, "events").withColumn("r", F.concat(F.lit("r"), F.col("event_id") % 37))
    merged = I.upsert(rows, "user_id", ["ts", "event_id"], ["value"], "event_type", referrer="r")
    counts = rows.groupBy("user_id").agg(F.countDistinct("r").alias("all_referrers"))
    return merged.join(counts, "user_id").select("user_id", F.array_join("referrers", ",").alias("referrers"), "all_referrers")


CONFIDENCES = case("doc_id", ["'high'", "'medium'", "'low'"])


@query(f"SELECT {CONFIDENCES.replace('doc_id', 'l.doc_id')} AS confidence, count(*) FILTER (l.quality = CASE WHEN d.n_chars > 500 THEN 1 ELSE 0 END) AS correct, count(*) FILTER (l.quality <> CASE WHEN d.n_chars > 500 THEN 1 ELSE 0 END OR d.doc_id IS NULL) AS wrong FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id GROUP BY 1")
def confidence_accuracy(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") > 500, 1).otherwise(0).alias("predicted"))
    return A.by_confidence(shaped(spark, d, "labels", confidence=CONFIDENCES).join(docs, "doc_id", "left"), "quality", "predicted", "confidence")


@query("SELECT v AS date, count(*) AS n, v LIKE '01/%' AND substr(v, 4, 2) IN ('03', '06', '09', '12') AS odd FROM (SELECT strftime(o_orderdate, '%d/%m/%Y') AS v FROM orders) GROUP BY v")
def odd_dates(spark, d):
    from foliospark.operators import structured as SD

    return SD.odd_dates(t(spark, d, "orders").select(F.date_format("o_orderdate", "dd/MM/yyyy").alias("date")), "date")


@query("SELECT year(l_shipdate) AS y, l_returnflag, count(*) AS n FROM lineitem WHERE year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem) GROUP BY ALL")
def latest_year_rows(spark, d):
    from foliospark.operators import structured as SD

    rows = t(spark, d, "lineitem").select(F.year("l_shipdate").cast("long").alias("y"), "l_returnflag")
    return SD.latest_year(rows, "y").groupBy("y", "l_returnflag").agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT event_type, CAST(ts AS DATE) AS day, event_id, user_id FROM events), m AS (SELECT event_type, max(day) AS day, max(event_id) AS last FROM x GROUP BY 1)
SELECT m.event_type, strftime(m.day, '%Y-%m-%d') AS day, min(x.event_id) AS event_id, arg_min(x.user_id, x.event_id) AS user_id, min(x.event_id) = any_value(m.last) AS in_order FROM m JOIN x ON m.event_type = x.event_type AND m.day = x.day GROUP BY m.event_type, m.day""")
def latest_first_among_ties(spark, d):
    rows = t(spark, d, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "user_id")
    return S.latest_first_among_ties(rows, ["event_type"], "day", "event_id", ["day", "event_id", "user_id"])


@query("""WITH c AS (SELECT user_id, event_type FROM events GROUP BY ALL), g AS (SELECT user_id, count(*) AS n_candidates, count(*) FILTER (event_type = CASE WHEN user_id % 2 = 0 THEN 'click' ELSE 'never' END) AS n_preferred FROM c GROUP BY 1)
SELECT * FROM g WHERE n_candidates > 1 AND n_preferred <> 1""")
def preference_faults(spark, d):
    rows = t(spark, d, "events").select("user_id", "event_type").distinct()
    preferred = rows.select("user_id").distinct().withColumn("preferred", F.when(F.col("user_id") % 2 == 0, "click").otherwise("never"))
    return S.preference_faults(rows, "user_id", "event_type", preferred)


@query("SELECT source, n FROM (SELECT source, count(*) AS n, min(doc_id) AS f FROM documents GROUP BY 1 ORDER BY n DESC, f LIMIT 5)")
def top_sources(spark, d):
    return A.most_common(t(spark, d, "documents"), "source", 5, "doc_id")


# ---- personal data: all patterns ---------------------------------------------------------

PLANTED = case("doc_id", ["' 1234567T '", "' IE12ABCD12345678901234 '", "' jo.bloggs@x.ie info.desk@x.ie '", "' date of birth: 1 '", "' as a private citizen '", "' +353 1 123 4567 '", "' Residential Address '", "' Signed by '", "''", "' IE12ABCD12345678901234 and 7654321WA, dob 9 '"])


def sql_pii(name: str) -> str:
    hits = f"regexp_extract_all(v, {quoted(P.PATTERNS[name])})"
    if name == "email_personal":
        hits = f"list_filter({hits}, lambda m: NOT regexp_matches(string_split(string_split(m, '@')[1], '.')[1], {quoted(P.ROLE_LOCAL)}))"
    return hits


SQL_PII_ALL = "SELECT doc_id, " + ", ".join(f"CAST(len({sql_pii(n)}) AS BIGINT) AS {n}" for n in P.PATTERNS) + f" FROM (SELECT doc_id, coalesce(text, '') || {PLANTED} AS v FROM documents)"
SQL_SIGNALS = " + ".join(f"CAST({n} > 0 AS BIGINT)" for n in P.PATTERNS)


def _planted(spark, d) -> DataFrame:
    return shaped(spark, d, "documents", v=f"coalesce(text, '') || {PLANTED}")


@query(f"SELECT * FROM (SELECT *, {SQL_SIGNALS} AS signal_count FROM ({SQL_PII_ALL})) WHERE signal_count > 0")
def pii_all_patterns(spark, d):
    return P.document_counts(_planted(spark, d), "doc_id", "v")


@query(f"SELECT doc_id, signal_count, email_personal, phone_ie, row_number() OVER (ORDER BY signal_count DESC, email_personal DESC, phone_ie DESC, doc_id) AS place FROM (SELECT *, {SQL_SIGNALS} AS signal_count FROM ({SQL_PII_ALL})) WHERE signal_count > 0 ORDER BY place LIMIT 50")
def pii_report(spark, d):
    from pyspark.sql import Window

    top = P.document_counts(_planted(spark, d), "doc_id", "v").orderBy(*P.report_order("doc_id")).limit(50)
    # Ranks over the fifty rows of the report.
    return top.select("doc_id", "signal_count", "email_personal", "phone_ie", F.row_number().over(Window.orderBy(*P.report_order("doc_id"))).cast("long").alias("place"))


@query("SELECT pattern, count(DISTINCT left(sha256(lower(m)), 12)) AS distinct_tokens, count(*) AS occurrences FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS pattern, unnest({sql_pii(n)}) AS m FROM (SELECT coalesce(text, '') || {PLANTED} AS v FROM documents)" for n in P.TOKENISED) + ") GROUP BY pattern")
def pii_tokens(spark, d):
    return P.distinct_tokens(_planted(spark, d), "v")
