"""Registered queries of the rule engine, the topic scans and the published-table analyses, each beside its SQL.

Inputs that the tables lack are made from whole tables by a CASE that both engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.operators import provenance as R
from foliospark.operators import structured as SD
from foliospark.plans import fts, vocabulary
from foliospark.plans.registry import LINE_SOURCE, SQL_LINE_NORM, SQL_LINES, SQL_NORM, has, query, sql_bm25, t
from foliospark.plans.rows import case, quoted, shaped

# ---- the rule engine in SQL -----------------------------------------------------------

H = "https://h.example/docs/default-source"
SHAPES = [
    f"'{H}/consultation-papers/cp071/feedback-statement-on-cp70-' || doc_id || '.pdf'",
    f"'{H}/consultation-papers/cp93/response-to-cp93-from-' || doc_id || '.pdf'",
    f"'{H}/discussion-papers/dp5/acme-' || doc_id || '---discussion-paper-on-x.pdf'",
    f"'{H}/consultation-papers/cp93/guidance-note-' || doc_id || '.pdf'",
    f"'{H}/consultation-papers/cp71/cp71-paper-' || doc_id || '.pdf'",
    f"'{H}/consultation-papers/cp-86a/acme-' || doc_id || '.pdf'",
    f"'{H}/discussion-papers/disucssion-paper-6/acme-' || doc_id || '.pdf'",
    "'https://h.example/statistics/table-' || doc_id || '.xls'",
    f"'https://h.example{next(iter(R.MIXED_DOCUMENTS))}'",
    *[f"'https://h.example{p}'" for p in R.AUDITED_STAKEHOLDERS],
    f"'{H}/discussion-papers/dp-04/--discussion-paper-' || doc_id || '.pdf'",
    "'https://h.example/regulation/industry/rule-' || doc_id || '.pdf'",
    f"'{H}/consultation-papers/cp93/%43P93.pdf'",
    f"'{H}/discussion-papers/dp7/addendum-' || doc_id || '.pdf'",
]
BODIES = [
    "''", "' '", "'We welcome the opportunity. Yours sincerely'", "'we welcome the opportunity'", "'Our submission. Dear sir, response to CP'", "'Central Bank of Ireland. This consultation paper'", "'plain words ' || left(text, 100)",
    "'This consultation paper. Feedback response. dear madam'", "'Submissions should be sent. This submission, on behalf of our members'",
]
RULE_URL, RULE_TEXT = case("doc_id", SHAPES), case(f"CAST(floor(doc_id / {len(SHAPES)}) AS BIGINT)", BODIES)


def sql_points(markers: dict[str, int]) -> str:
    return " + ".join(f"CASE WHEN contains(low, {quoted(p)}) THEN {w} ELSE 0 END" for p, w in markers.items())


def sql_phrases(markers: dict[str, int]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN contains(low, {quoted(p)}) THEN {quoted(p)} END" for p in markers) + "], lambda p: p IS NOT NULL)"


def sql_any(column: str, parts) -> str:
    return "(" + " OR ".join(f"contains({column}, {quoted(p)})" for p in parts) + ")"


SQL_TOPICAL = "CASE " + " ".join(f"WHEN {sql_any('path', parts)} THEN '{name}'" for name, parts in R.TOPICS) + " ELSE 'other-cbi-material' END"
SQL_BARE = "regexp_replace({0}, '^-+|-+$', '', 'g')"
SUBMISSION = "CASE WHEN disc THEN 'stakeholder-discussion-submission' ELSE 'stakeholder-consultation-submission' END"
MATERIAL = "CASE WHEN disc THEN 'cbi-discussion-material' ELSE 'cbi-consultation-material' END"


def sql_rules() -> str:
    """(authorship, class, basis, confidence) of the first rule that holds."""
    rules = [(f"contains(path, {quoted(p)})", "'mixed'", quoted(c), quoted(b), "'high'") for p, (c, b) in R.MIXED_DOCUMENTS.items()]
    rules += [(f"contains(path, {quoted(p)})", "'stakeholder'", "'stakeholder-consultation-submission'", quoted(f"audited-non-consultation-stakeholder:{e}"), "'high'") for p, e in R.AUDITED_STAKEHOLDERS.items()]
    rules += [
        (f"NOT {sql_any('path', R.CONSULTATION_PATHS)}", "'unresolved'", SQL_TOPICAL, "'host-path-only:non-consultation'", "'low'"),
        ("strong <> ''", "'central-bank'", f"CASE WHEN contains(name, 'feedback-statement') OR contains(name, 'statement-on-cp') THEN 'cbi-consultation-feedback' ELSE {MATERIAL} END", f"'filename-strong-cbi-doctype:' || {SQL_BARE.format('strong')}", "'high'"),
        ("attributed <> ''", "'stakeholder'", SUBMISSION, f"'filename-attribution:' || {SQL_BARE.format('attributed')}", "'high'"),
        ("disc AND cue <> '' AND regexp_matches(name, '-{2,}discussion-paper') AND prefix <> '' AND NOT regexp_full_match(prefix, '(?:dp|discussion-paper)[-_ ]?[0-9]*[a-z]?')", "'stakeholder'", "'stakeholder-discussion-submission'", "'filename-discussion-responder-prefix:' || left(prefix, 80)", "'high'"),
        ("cue <> '' AND has_text AND other >= greatest(issuer + 3, 4)", "'stakeholder'", SUBMISSION, "'content-overrides-generic-doctype(' || other || 'v' || issuer || '):' || array_to_string(other_phrases[1:3], ';')", "'medium'"),
        ("cue <> ''", "'central-bank'", MATERIAL, f"'filename-cbi-doctype:' || {SQL_BARE.format('cue')}", "'high'"),
        (rf"regexp_matches(name, '{R.CP_PREFIXED}')", "'central-bank'", MATERIAL, "'filename-cp-prefix-without-attribution'", "'medium'"),
        ("has_text AND other >= boosted + 3", "'stakeholder'", SUBMISSION, "'content-stakeholder(' || other || 'v' || boosted || '):' || array_to_string(other_phrases[1:3], ';')", "'medium'"),
        ("has_text AND boosted >= other + 3", "'central-bank'", MATERIAL, "'content-cbi(' || boosted || 'v' || other || '):' || array_to_string((issuer_phrases || CASE WHEN boosted > issuer THEN ['cbi-name-in-title-block'] ELSE [] END)[1:3], ';')", "'medium'"),
        ("has_text", "'unresolved'", "'consultation-hosted-unresolved'", "'content-inconclusive(' || boosted || 'v' || other || ')'", "'low'"),
        ("true", "'unresolved'", "'consultation-hosted-unresolved'", "'no-filename-cue-and-no-text'", "'low'"),
    ]
    names = ("authorship", "document_class", "basis", "confidence")
    return ", ".join("CASE " + " ".join(f"WHEN {r[0]} THEN {r[i + 1]}" for r in rules) + f" END AS {n}" for i, n in enumerate(names))


CP, DP = r"/cp[-_ ]?0*(\d+)([a-z]?)/", r"/(?:dp[-_ ]?0*(\d+)[a-z]?|dis(?:cus|ucs)sion-paper[-_ ]?0*(\d+))/"
SQL_ROLE = "CASE WHEN document_class LIKE 'stakeholder-%' THEN 'consultation-submission' " + " ".join(f"WHEN document_class = '{k}' THEN '{v}'" for k, v in R.ROLES.items()) + " ELSE 'other' END"
SQL_VOICE = "CASE authorship " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in R.VOICES.items()) + " END"
SQL_RULES = rf"""WITH a AS (SELECT doc_id, lower(url_decode(regexp_extract({RULE_URL}, '^[a-z]+://[^/?#]*([^?#]*)', 1))) AS path, coalesce({RULE_TEXT}, '') AS body FROM documents),
b AS (SELECT *, string_split(path, '/')[-1] AS name, lower(body) AS low, contains(path, '/discussion-papers/') AS disc, regexp_matches(body, '\S') AS has_text FROM a),
c AS (SELECT *, regexp_extract(name, {quoted(R.STRONG_DOCTYPE)}, 1) AS strong, regexp_extract(name, {quoted(R.DOCTYPE)}, 1) AS cue, regexp_extract(name, {quoted(R.ATTRIBUTED)}, 1) AS attributed,
 {sql_points(R.ISSUER_MARKERS)} AS issuer, {sql_points(R.RESPONDENT_MARKERS)} AS other, {sql_phrases(R.ISSUER_MARKERS)} AS issuer_phrases, {sql_phrases(R.RESPONDENT_MARKERS)} AS other_phrases FROM b),
e AS (SELECT *, CASE WHEN cue <> '' THEN regexp_replace(left(name, strpos(name, cue) - 1), '^[-_ .]+|[-_ .]+$', '', 'g') END AS prefix, issuer + CASE WHEN other = 0 AND {sql_any('left(low, 300)', R.TITLE_MARKERS)} THEN 2 ELSE 0 END AS boosted,
 CASE WHEN contains(path, '/consultation-papers/cp71/') THEN 'cp70' WHEN regexp_matches(path, '{CP}') THEN 'cp' || regexp_extract(path, '{CP}', 1) || regexp_extract(path, '{CP}', 2) END AS cp, regexp_extract(path, '{DP}', 1) || regexp_extract(path, '{DP}', 2) AS dp FROM c),
f AS (SELECT *, {sql_rules()} FROM e), g AS (SELECT *, {SQL_VOICE} AS institutional_voice, basis = 'host-path-only:non-consultation' AS host_only FROM f)
SELECT doc_id, authorship, document_class, basis, confidence, CASE WHEN basis NOT LIKE 'audited-non-consultation%' THEN cp END AS consultation_id, coalesce(cp, 'dp' || CAST(TRY_CAST(dp AS INT) AS VARCHAR)) AS engagement_id,
 CASE WHEN host_only THEN 'central-bank' ELSE authorship END AS legacy_authorship, institutional_voice, CASE WHEN institutional_voice = 'cbi-institutional' THEN 'Central Bank of Ireland' END AS author_org, {SQL_ROLE} AS document_role,
 CASE WHEN regexp_matches(basis, '^(adjudicated:|audited-|manual-)') THEN 'manual-reviewed' WHEN institutional_voice = 'unknown' THEN 'unreviewed' ELSE 'rule-classified' END AS review_status, CASE WHEN host_only THEN {quoted(R.HOST_EVIDENCE)} ELSE basis END AS review_evidence FROM g"""


@query(SQL_RULES)
def rule_engine(spark, d):
    rows = shaped(spark, d, "documents", url=RULE_URL, body=RULE_TEXT).select("doc_id", "url", "body")
    return R.classify(rows, "url", "body").drop("url", "body")


# ---- topic scans with the whole vocabulary ------------------------------------------------


def sql_match(tree) -> str:
    if isinstance(tree, fts.Term):
        return has(tree.phrase)
    parts = [sql_match(p) for p in tree.parts]
    if tree.kind == "not":
        return f"({parts[0]} AND NOT ({' OR '.join(parts[1:])}))"
    return "(" + f" {tree.kind.upper()} ".join(parts) + ")"


def planted(vocabulary_: dict[str, tuple[str, str]]) -> str:
    """The text with the label of a topic at its end, so that topics are met."""
    return f"coalesce(text, '') || ' ' || {case('doc_id', [quoted(label) for label, _ in vocabulary_.values()])}"


def sql_scan(vocabulary_: dict[str, tuple[str, str]]) -> str:
    norm = SQL_NORM.replace("coalesce(text, '')", f"({planted(vocabulary_)})")
    rows = " UNION ALL ".join(f"SELECT '{k}' AS query, count(*) AS matching_pages, count(DISTINCT doc_id) AS matching_documents, count(DISTINCT lang) AS labels FROM n WHERE {sql_match(fts.parse(q))}" for k, (_, q) in vocabulary_.items())
    return f"WITH n AS (SELECT doc_id, lang, {norm} AS norm FROM documents) {rows}"


def _scan(spark, d, vocabulary_) -> DataFrame:
    """Totals of every topic, those without a match as zero."""
    pages = fts.with_norms(t(spark, d, "documents").selectExpr("doc_id", "lang", f"{planted(vocabulary_)} AS text"))
    hits = fts.scan(pages, {k: q for k, (_, q) in vocabulary_.items()}, ["doc_id", "lang"])
    totals = hits.groupBy("query").agg(F.count("*").alias("matching_pages"), F.countDistinct("doc_id").alias("matching_documents"), F.countDistinct("lang").alias("labels"))
    topics = spark.createDataFrame([(k,) for k in vocabulary_], "query string")
    return topics.join(totals, "query", "left").na.fill(0)


@query(sql_scan(vocabulary.TOPICS))
def topic_vocabulary_scan(spark, d):
    return _scan(spark, d, vocabulary.TOPICS)


@query(sql_scan(vocabulary.THEMES))
def theme_vocabulary_scan(spark, d):
    return _scan(spark, d, vocabulary.THEMES)


BUNDLE_QUERIES = vocabulary.BUNDLES["credit_unions"][1]
BUNDLE_TEXTS = ["' credit union restructuring'", "' lending capacity'", "' shared services, common bond'", "' Crédit Union governance and skills'", "' business model of a credit union'", "''", "' transfer of a credit union, collaboration'"]
#: Pages of a query for each voice: the regulator's, and a minority of the industry's for contrast.
QUOTAS = {"en": 26, "de": 6}


def sql_bundle() -> str:
    source = LINE_SOURCE.replace("SELECT doc_id,", "SELECT doc_id, lang,").replace(SQL_LINE_NORM, SQL_NORM.replace("coalesce(text, '')", f"(line || {case('doc_id', BUNDLE_TEXTS)})"))
    parts, picked = [], []
    for i, q in enumerate(BUNDLE_QUERIES):
        tree = fts.parse(q)
        one = sql_bm25(source, "doc_id, page_number, lang", fts.terms(tree), sql_match(tree))
        for word in ("src", "cnt", "scored"):
            one = one.replace(word, f"{word}_{i}")
        parts.append(one.replace("\nst AS", f"\nst_{i} AS").replace(", st WHERE", f", st_{i} WHERE"))
        picked.append(f"SELECT doc_id, page_number, lang, score, {i} AS query_index FROM scored_{i} QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score, doc_id, page_number) <= CASE lang WHEN 'en' THEN 26 WHEN 'de' THEN 6 ELSE 0 END")
    return f"WITH {', '.join(parts)} SELECT doc_id, CAST(page_number AS BIGINT) AS page_number, lang, min(query_index) AS query_index, arg_min(score, query_index) AS score FROM ({' UNION ALL '.join(f'({p})' for p in picked)}) GROUP BY doc_id, page_number, lang"


@query(sql_bundle())
def bundle_with_quotas(spark, d):
    pages = t(spark, d, "documents").select("doc_id", "lang", F.expr(case("doc_id", BUNDLE_TEXTS)).alias("more"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    pages = fts.with_norms(pages.select("doc_id", "lang", (F.col("pos") + 1).cast("long").alias("page_number"), F.concat("line", "more").alias("text")))
    return fts.quota_bundle(pages, BUNDLE_QUERIES, "lang", QUOTAS, ["doc_id", "page_number"])


# ---- published tables ---------------------------------------------------------------------

CODES = [*SD.FRAUD_PARTS, "TOTL", "TOTL1", "OTH"]
FRAUD = dict(
    COUNT_AREA="CASE l_returnflag WHEN 'R' THEN 'A1' ELSE 'W0' END", RL_TRNSCTN="CASE l_linestatus WHEN 'F' THEN '1' ELSE '2' END", FRD_TYP="CASE WHEN l_linenumber % 3 = 0 THEN 'X' ELSE 'F' END", UNIT_MEASURE="'EUR'",
    REPORTINGPERIOD="year(l_shipdate) || '-H1'", TYP_TRNSCTN=case("l_partkey", [quoted(c) for c in CODES]), TYP_TRNSCTN_DESC="'kind'", OBSERVATION="CASE WHEN l_quantity > 45 THEN ' NA ' WHEN l_quantity > 44 THEN '' ELSE CAST(l_quantity AS STRING) END",
)
SQL_FRAUD = "(SELECT year(l_shipdate) AS year, " + FRAUD["TYP_TRNSCTN"] + " AS code, CASE WHEN l_quantity <= 44 THEN l_quantity END AS value FROM lineitem WHERE l_returnflag <> 'R' AND l_linestatus = 'F' AND l_linenumber % 3 <> 0)"
SQL_PARTS = ", ".join(map(quoted, SD.FRAUD_PARTS))


@query(f"SELECT year, code, round(coalesce(sum(value), 0.0), 4) AS known, count(*) AS observations, count(*) - count(value) AS suppressed, count(*) = count(value) AS complete FROM {SQL_FRAUD} GROUP BY ALL")
def payment_fraud_detail(spark, d):
    return SD.payment_fraud(shaped(spark, d, "lineitem", **FRAUD))[0].withColumn("year", F.col("year").cast("long")).withColumn("known", F.round("known", 4))


@query(f"""SELECT year, round(coalesce(sum(value) FILTER (code IN ({SQL_PARTS})), 0.0), 4) AS component_sum, count(*) FILTER (code IN ({SQL_PARTS}) AND value IS NULL) AS suppressed_components,
 round(coalesce(sum(value) FILTER (code = 'TOTL1'), CASE WHEN count(*) FILTER (code = 'TOTL1') > 0 THEN 0.0 END), 4) AS total_without_cash, count(*) FILTER (code = 'TOTL' AND value IS NULL) AS suppressed_totals FROM {SQL_FRAUD} GROUP BY year""")
def payment_fraud_reconciliation(spark, d):
    out = SD.payment_fraud(shaped(spark, d, "lineitem", **FRAUD))[1]
    return out.select(F.col("year").cast("long").alias("year"), F.round("component_sum", 4).alias("component_sum"), "suppressed_components", F.round("total_without_cash", 4).alias("total_without_cash"), "suppressed_totals")


KINDS = ["Number", "Balance € (000)", "Arrears € (000)"]
ARREARS = {
    "`Reporting Date`": "CASE l_orderkey % 4 WHEN 0 THEN '31/03/2026' WHEN 1 THEN '31/12/2025' WHEN 2 THEN '01/09/2025' ELSE '30/06/2025' END", "`Entity Group`": "CASE WHEN l_suppkey % 2 = 0 THEN 'Banks' ELSE 'Non-Banks' END",
    "Format": "CASE l_linestatus WHEN 'F' THEN 'PDH' ELSE 'BTL' END", "Category": "CASE WHEN l_linenumber = 7 THEN 'Other' ELSE 'Arrears' END", "`Row`": "'row ' || l_orderkey", "`Row Position`": "CAST(l_linenumber AS STRING)",
    "`Observation Type`": case("l_partkey", ["'Number'", "'Balance � (000)'", "'Arrears € (000)'"]), "Observation": "CASE WHEN l_quantity > 30 THEN CAST(l_quantity AS STRING) ELSE '' END", "`Number of Accounts`": "CASE WHEN l_discount > 0.02 THEN CAST(l_quantity AS STRING) ELSE 'NULL' END",
}
EXPECTED = [(p, k) for p in (2, 3, 9) for k in KINDS]
LABELS = [f"row {n}" for n in (4, 32, 36, 64, 68)]
SQL_ARREARS = "(SELECT " + ", ".join(f"{e} AS {n.strip('`').replace(' ', '_').lower()}" for n, e in ARREARS.items()).replace("CAST(l_quantity AS STRING)", "CAST(l_quantity AS VARCHAR)") + " FROM lineitem)"
SQL_COUNTED = "(CASE WHEN count(*) FILTER ({0}) = 1 THEN coalesce(max(num) FILTER ({0}), 0) ELSE 0 END)"


def sql_counted(labels: list[str]) -> str:
    rows = [f"now AND format = 'BTL' AND category = 'Arrears' AND observation_type = 'Number' AND entity_group = '{e}' AND \"row\" = '{label}'" for label in labels for e in ("Banks", "Non-Banks")]
    return " + ".join(SQL_COUNTED.format(r) for r in rows)


@query(f"""WITH a AS (SELECT *, reporting_date = '31/03/2026' AS now, TRY_CAST(number_of_accounts AS DOUBLE) AS num, TRY_CAST(observation AS DOUBLE) AS obs, 'row ' || row_position || '/' || replace(observation_type, '�', '€') AS cell FROM {SQL_ARREARS}),
s AS (SELECT count(*) AS n, coalesce(array_to_string(list_sort(list(DISTINCT reporting_date) FILTER (reporting_date LIKE '01/%' AND substr(reporting_date, 4, 2) IN ('03', '06', '09', '12'))), ' | '), '') AS odd, count(*) FILTER (observation_type = 'Number' AND obs IS NOT NULL AND num IS NOT NULL) AS twice,
 coalesce(list(DISTINCT cell) FILTER (now AND entity_group = 'Banks' AND format = 'PDH' AND category = 'Arrears'), []) AS present, {sql_counted(LABELS[:1])} AS total, {sql_counted(LABELS[1:])} AS over90 FROM a),
m AS (SELECT *, array_to_string(list_filter([{', '.join(quoted(f'row {p}/{k}') for p, k in EXPECTED)}], lambda c: NOT list_contains(present, c)), ' | ') AS missing FROM s)
SELECT 'rows_have_expected_width' AS "check", 'pass' AS status, CAST(n AS VARCHAR) AS observed FROM m UNION ALL SELECT 'quarter_end_dates_use_consistent_calendar_dates', CASE WHEN odd = '' THEN 'pass' ELSE 'fail' END, odd FROM m
UNION ALL SELECT 'number_rows_use_only_number_of_accounts_column', CASE WHEN twice = 0 THEN 'pass' ELSE 'fail' END, CAST(twice AS VARCHAR) FROM m UNION ALL SELECT 'bank_headline_cells_present', CASE WHEN missing = '' THEN 'pass' ELSE 'fail' END, missing FROM m
UNION ALL SELECT 'arrears_reconcile_to_release', CASE WHEN total = 5708 AND over90 = 4519 THEN 'pass' ELSE 'fail' END, 'total=' || CAST(total AS BIGINT) || '; over90=' || CAST(over90 AS BIGINT) FROM m""")
def mortgage_arrears_checks(spark, d):
    rows = t(spark, d, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in ARREARS.items()])
    return SD.mortgage_arrears(rows, "31/03/2026", EXPECTED, (5708, 4519), LABELS[0], LABELS[1:], 9)


SME = {
    "Referencedate": "'31/03/' || (2020 + o_orderkey % 5)", "`Economic Activity`": "'sector ' || (o_custkey % 20)", "Outstanding": "CASE WHEN o_orderkey % 6 = 0 THEN 'NULL' ELSE CAST(o_custkey AS STRING) END",
    "Lending": "CASE WHEN o_orderkey % 7 = 0 THEN '-' ELSE CAST(o_custkey % 97 AS STRING) || ',000' END", "Rate": "CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE CAST(o_orderkey % 9 AS STRING) || '.5' END",
}


@query("""WITH x AS (SELECT 2020 + o_orderkey % 5 AS y, CASE WHEN o_orderkey % 6 <> 0 THEN o_custkey END AS a, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey % 97 * 1000 END AS b, CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey % 9 + 0.5 END AS r FROM orders), m AS (SELECT max(y) AS y FROM x)
SELECT m.y || '-03-31' AS latest, CAST(sum(a) FILTER (x.y = m.y) AS DOUBLE) AS outstanding, CAST(sum(b) FILTER (x.y = m.y) AS DOUBLE) AS lending, round((sum(a) FILTER (x.y = m.y) / sum(a) FILTER (x.y = m.y - 1) - 1) * 100, 3) AS outstanding_change,
 round((sum(b) FILTER (x.y = m.y) / sum(b) FILTER (x.y = m.y - 1) - 1) * 100, 3) AS lending_change, count(*) FILTER (x.y = m.y AND a IS NULL) AS suppressed, round(sum(b * r) FILTER (x.y = m.y AND b IS NOT NULL AND r IS NOT NULL) / sum(b) FILTER (x.y = m.y AND b IS NOT NULL AND r IS NOT NULL), 6) AS weighted_rate FROM x, m GROUP BY m.y""")
def sme_lending(spark, d):
    return _sme(spark, d).select(
        "latest", F.col("Outstanding_now").alias("outstanding"), F.col("Lending_now").alias("lending"), F.round("Outstanding_change", 3).alias("outstanding_change"), F.round("Lending_change", 3).alias("lending_change"), F.col("Outstanding_suppressed").alias("suppressed"), F.round("weighted_rate", 6).alias("weighted_rate")
    )


def _sme(spark, d) -> DataFrame:
    rows = t(spark, d, "orders").selectExpr(*[f"{e} AS {n}" for n, e in SME.items()])
    return SD.sme_lending(rows, ["Outstanding", "Lending"], "Rate", "Lending", {"sector 99": ["sector 1", "sector 2"]})


MORTGAGES = {
    "Year": "CAST(2020 + n_nationkey % 5 AS STRING)", "Description": "CASE WHEN n_nationkey < 10 THEN 'Total Lending' ELSE 'FTB Lending' END",
    "Data_Type": "CASE WHEN n_nationkey < 5 OR n_nationkey BETWEEN 10 AND 14 THEN 'Value of Loans' ELSE 'Number of Loans' END", "Observation_Amount": "CAST(n_nationkey * 100 AS STRING)",
}


@query("""WITH x AS (SELECT 2020 + n_nationkey % 5 AS y, n_nationkey < 10 AS whole, n_nationkey < 5 OR n_nationkey BETWEEN 10 AND 14 AS val, n_nationkey * 100.0 AS v FROM nation), c AS (SELECT * FROM x WHERE y = (SELECT max(y) FROM x)),
s AS (SELECT max(y) AS "Year", CASE WHEN count(*) FILTER (whole AND val) = 1 THEN max(v) FILTER (whole AND val) END AS total_value, CASE WHEN count(*) FILTER (whole AND NOT val) = 1 THEN max(v) FILTER (whole AND NOT val) END AS total_loans,
 CASE WHEN count(*) FILTER (NOT whole AND val) = 1 THEN max(v) FILTER (NOT whole AND val) END AS buyer_value, CASE WHEN count(*) FILTER (NOT whole AND NOT val) = 1 THEN max(v) FILTER (NOT whole AND NOT val) END AS buyer_loans FROM c)
SELECT CAST("Year" AS BIGINT) AS year, CAST(total_value AS DOUBLE) AS total_value, CAST(total_loans AS DOUBLE) AS total_loans, CAST(buyer_value AS DOUBLE) AS buyer_value, CAST(buyer_loans AS DOUBLE) AS buyer_loans,
 round(coalesce(CAST(buyer_value AS DOUBLE), 0) / coalesce(nullif(CAST(total_value AS DOUBLE), 0), 1) * 100, 2) AS share_of_value, round(coalesce(CAST(buyer_loans AS DOUBLE), 0) / coalesce(nullif(CAST(total_loans AS DOUBLE), 0), 1) * 100, 2) AS share_of_loans FROM s""")
def new_mortgages(spark, d):
    return _mortgages(spark, d).withColumn("year", F.col("Year").cast("long"))


def _mortgages(spark, d) -> DataFrame:
    return SD.new_mortgages(t(spark, d, "nation").selectExpr(*[f"{e} AS {n}" for n, e in MORTGAGES.items()]))


RATES = {
    "overnight_rate": (["household deposits", "overnight", "interest rate"], []), "overnight_volume": (["household deposits", "overnight", "volumes"], []), "term_rate": (["household deposits", "agreed maturity", "interest rate"], ["overnight"]),
}


def _rates(spark, d) -> DataFrame:
    rows = t(spark, d, "events").select(
        F.date_format("ts", "dd/MM/yyyy").alias("Reporting Date"), F.col("event_id").alias("place"), F.col("event_id").cast("string").alias("Household deposits - overnight - interest rate"),
        F.concat(F.col("user_id").cast("string"), F.lit(",000")).alias("Household deposits - overnight - volumes"), F.when(F.col("user_id") % 2 == 0, "NA").otherwise("2.5").alias("Household deposits - agreed maturity - interest rate"),
    )
    return SD.retail_rates(rows, "Reporting Date", "place", RATES)


@query("""WITH x AS (SELECT CAST(ts AS DATE) AS day, event_id, user_id FROM events), o AS (SELECT * FROM x WHERE day = (SELECT max(day) FROM x) ORDER BY event_id LIMIT 1)
SELECT strftime(day, '%Y-%m-%d') AS period, event_id = (SELECT max(event_id) FROM x) AS in_order, unnest(['overnight_rate', 'overnight_volume', 'term_rate']) AS metric, unnest([CAST(event_id AS DOUBLE), CAST(user_id * 1000 AS DOUBLE), CASE WHEN user_id % 2 = 1 THEN 2.5 END]) AS value FROM o""")
def retail_rates(spark, d):
    return _rates(spark, d)


#: Figures of the statistical releases.
RELEASED = [
    ("Fraudulent payment value", "2024", 160.0, "EUR million"),
    ("Final booked payment-fraud loss", "2024", 66.4, "EUR million"),
    ("Payment-fraud transaction volume", "2024", 815.0, "thousand"),
    ("PDH accounts in arrears", "2026-Q1", 34996.0, "accounts"),
    ("PDH accounts over 90 days in arrears", "2026-Q1", 21302.0, "accounts"),
]


@query(" UNION ALL ".join(f"SELECT {quoted(m)} AS metric, '{p}' AS period, CAST({v} AS DOUBLE) AS value, '{u}' AS unit" for m, p, v, u in RELEASED) + """
UNION ALL SELECT 'Known-sector SME outstanding balance', '2024-03-31', CAST(sum(o_custkey) AS DOUBLE), 'EUR' FROM orders WHERE o_orderkey % 5 = 4 AND o_orderkey % 6 <> 0 UNION ALL SELECT 'Known-sector SME quarterly new lending', '2024-03-31', CAST(sum(o_custkey % 97 * 1000) AS DOUBLE), 'EUR' FROM orders WHERE o_orderkey % 5 = 4 AND o_orderkey % 7 <> 0
UNION ALL SELECT 'Total new mortgage lending', '2024', 400.0, 'EUR million' UNION ALL SELECT 'New mortgage loans', '2024', 900.0, 'loans' UNION ALL SELECT 'FTB lending', '2024', 1400.0, 'EUR million'
UNION ALL SELECT 'Household overnight deposit volume', 'latest', CAST(user_id * 1000 AS DOUBLE), 'EUR million' FROM (SELECT * FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) ORDER BY event_id LIMIT 1) UNION ALL SELECT 'Household overnight deposit rate', 'latest', CAST(event_id AS DOUBLE), 'percent per annum' FROM (SELECT * FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) ORDER BY event_id LIMIT 1)
UNION ALL SELECT 'Household deposits up to 2 years rate', 'latest', CASE WHEN user_id % 2 = 1 THEN 2.5 END, 'percent per annum' FROM (SELECT * FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) ORDER BY event_id LIMIT 1)""")
def key_indicators(spark, d):
    """Thirteen rows from five analyses; released figures where the open data cannot give them."""
    released = [(m, spark.range(1).select(F.lit(v).alias("v")), "v", p, u) for m, p, v, u in RELEASED]
    sme, mortgages, rates = _sme(spark, d), _mortgages(spark, d), _rates(spark, d)
    rate = lambda name: rates.filter(F.col("metric") == name)
    return SD.indicator_rows([
        *released,
        ("Known-sector SME outstanding balance", sme, "Outstanding_now", "2024-03-31", "EUR"),
        ("Known-sector SME quarterly new lending", sme, "Lending_now", "2024-03-31", "EUR"),
        ("Total new mortgage lending", mortgages, "total_value", "2024", "EUR million"),
        ("New mortgage loans", mortgages, "total_loans", "2024", "loans"),
        ("FTB lending", mortgages, "buyer_value", "2024", "EUR million"),
        ("Household overnight deposit volume", rate("overnight_volume"), "value", "latest", "EUR million"),
        ("Household overnight deposit rate", rate("overnight_rate"), "value", "latest", "percent per annum"),
        ("Household deposits up to 2 years rate", rate("term_rate"), "value", "latest", "percent per annum"),
    ])
