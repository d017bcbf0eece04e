"""Scalar functions, rules, screens and sequences on inline rows."""

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions import urls as U
from foliospark.functions import values as V
from foliospark.operators import aggregates as A
from foliospark.operators import compare as C
from foliospark.operators import ingest as I
from foliospark.operators import personal_data as P
from foliospark.operators import provenance as R
from foliospark.operators import sequences as S


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("v,want", [("1,234.5", 1234.5), (" NA ", None), ("-", None), ("", None), ("x", None), (None, None), ("-3", -3.0)])
def test_parse_number(spark, v, want):
    assert one(spark, v, V.parse_number) == want


@pytest.mark.parametrize(
    "f,v,want",
    [
        (V.iso_date, "30/06/2024", "2024-06-30"),
        (V.iso_date, "30/02/2024", None),
        (V.iso_date, "3/6/2024", None),
        (V.prior_year, "2024-06-30", "2023-06-30"),
        (V.parse_bytes, "1.5GiB", 1610612736),
        (V.parse_bytes, "500M", 524288000),
        (V.parse_bytes, "12", 12),
        (V.local_name, "{urn:x}tag", "tag"),
        (U.unquote, "a%20b+c", "a b+c"),
        (U.unquote, "50%zz", "50%zz"),
        (U.extension, "https://h/a/b.PDF?x=1", "pdf"),
        (U.title_from_url, "https://h/a/some-long__title.pdf", "some long title"),
        (U.url_key, "https://www.H.com/A%20b?z=1&a=2#f", "h.com|/a b|a=2&z=1"),
        (U.canonical, "HTTPS://H.com/p?b=1&a=2#f", "https://h.com/p?a=2&b=1"),
        (U.alias_key, "https://h/x/Doc.pdf?sfvrsn=3", "doc.pdf|3"),
        (U.repair, 'https://h/x.pdf?sfvrsn=ab12%22junk">', "https://h/x.pdf?sfvrsn=ab12"),
        (U.safe_segment, "a:b?. ", "a_b_"),
        (U.safe_segment, "CON", "_CON"),
        (U.safe_segment, "CON.txt", "CON.txt"),
        (T.first_heading, "x\n## ** **\n# *Real* title\n", "Real title"),
    ],
)
def test_strings(spark, f, v, want):
    assert one(spark, v, f) == want


def test_links(spark):
    html = """<a href='/x?a=1&amp;b=2'>1</a><img src=i.png><a href="#top"><a href="mailto:a@b"><a data-href="//o.org/p#f"><a href="/x?a=1&amp;b=2">"""
    df = spark.createDataFrame([("https://h.org/d/e", html), (None, "")], "u string, h string")
    got = [r.l for r in df.select(U.resolve_links("u", U.raw_links(F.col("h"))).alias("l")).collect()]
    assert got == [["https://h.org/x?a=1&b=2", "https://h.org/d/i.png", "https://o.org/p"], []]


def test_robots(spark):
    text = "User-agent: *\nDisallow: /a\nAllow: /a/b\nDisallow: /*.pdf$\n\nUser-agent: bot\nDisallow: /"
    rules = [(r.allow, r.pattern) for r in one(spark, text, U.robots_rules)]
    assert rules == [(False, "/a"), (True, "/a/b"), (False, "/*.pdf$")]
    df = spark.createDataFrame([("/a/c",), ("/a/b/c",), ("/x.pdf",), ("/x.pdfx",), ("/",)], "p string")
    assert [r.allowed for r in U.robots_allowed(df, "p", rules).collect()] == [False, True, False, True, True]


@pytest.mark.parametrize(
    "n,dense,bad,empty,want",
    [(0, 500, 0, 0, "empty"), (3, 99, 0, 0, "empty"), (3, 5000, 200, 0, "garbled"), (3, 5000, 10, 0, "garbled"), (10, 9000, 0, 3, "gappy"), (10, 1500, 0, 0, "thin"), (2, 5000, 9, 0, "ok")],
)
def test_grades(spark, n, dense, bad, empty, want):
    assert spark.range(1).select(T.grade(*map(F.lit, (n, dense, bad, empty))).alias("g")).first().g == want


def test_metrics_and_flags(spark):
    df = spark.createDataFrame([(["# Title here\n| a | b |\ntext �", "", " "],)], "p array<string>")
    r = df.select(*[c.alias(n) for n, c in T.page_metrics(F.col("p")).items()]).first()
    assert (r.page_count, r.heading_count, r.table_rows, r.replacement_characters, r.empty_pages, r.low_text) == (3, 1, 1, 1, 3, True)
    flags = spark.range(1).select(T.with_flags(F.lit("ok"), T.semantic_flags(F.lit(6), F.lit(0.1), F.lit(1))).alias("g")).first().g
    assert flags == "suspect"


BASE = "https://h.example/docs/default-source"


@pytest.mark.parametrize(
    "path,text,authorship,basis",
    [
        ("/publications/consultation-papers/cp71/feedback-statement-on-cp70.pdf", "", "central-bank", "filename-strong-cbi-doctype:feedback-statement"),
        ("/publications/consultation-papers/cp93/response-to-cp93-from-a.pdf", "", "stakeholder", "filename-attribution:response-to"),
        ("/publications/discussion-papers/dp5/acme---discussion-paper-on-x.pdf", "", "stakeholder", "filename-discussion-responder-prefix:acme"),
        ("/publications/consultation-papers/cp93/guidance-note.pdf", "We welcome the opportunity. Yours sincerely", "stakeholder", "content-overrides-generic-doctype(5v0):we welcome the opportunity;yours sincerely"),
        ("/publications/consultation-papers/cp93/guidance-note.pdf", "we welcome the opportunity", "central-bank", "filename-cbi-doctype:guidance-note"),
        ("/publications/consultation-papers/cp93/cp93-paper.pdf", "", "central-bank", "filename-cp-prefix-without-attribution"),
        ("/publications/consultation-papers/cp93/acme.pdf", "Our submission. Dear sir", "stakeholder", "content-stakeholder(5v0):dear sir;our submission"),
        ("/publications/consultation-papers/cp93/acme.pdf", "Central Bank of Ireland. This consultation paper", "central-bank", "content-cbi(5v0):this consultation paper;cbi-name-in-title-block"),
        ("/publications/consultation-papers/cp93/acme.pdf", "plain words", "unresolved", "content-inconclusive(0v0)"),
        ("/publications/consultation-papers/cp93/acme.pdf", " ", "unresolved", "no-filename-cue-and-no-text"),
        ("/statistics/table.pdf", "", "unresolved", "host-path-only:non-consultation"),
    ],
)
def test_rules(spark, path, text, authorship, basis):
    r = R.classify(spark.createDataFrame([(BASE + path, text)], "u string, t string"), "u", "t").first()
    assert (r.authorship, r.basis) == (authorship, basis)


@pytest.mark.parametrize("path,cp,engagement", [("/consultation-papers/cp071/x.pdf", "cp71", "cp71"), ("/consultation-papers/cp71/x.pdf", "cp70", "cp70"), ("/consultation-papers/cp-86a/x.pdf", "cp86a", "cp86a"), ("/discussion-papers/disucssion-paper-6/x.pdf", None, "dp6"), ("/other/x.pdf", None, None)])
def test_identifiers(spark, path, cp, engagement):
    r = R.classify(spark.createDataFrame([("https://h" + path, "")], "u string, t string"), "u", "t", audited={"/never/": "x"}).first()
    assert (r.consultation_id, r.engagement_id) == (cp, engagement)


def test_exceptions_come_first(spark):
    df = spark.createDataFrame([("https://h/reports/mix.pdf", ""), ("https://h/talks/joint.pdf", "")], "u string, t string")
    got = {r.authorship: r.review_status for r in R.classify(df, "u", "t", mixed={"/reports/mix": ("c", "audited-composite:x")}, audited={"/talks/joint": "e"}).collect()}
    assert got == {"mixed": "manual-reviewed", "stakeholder": "manual-reviewed"}


def test_personal_data(spark):
    text = "1234567T IE12ABCD12345678901234 jo.bloggs@x.ie info.desk@x.ie 01 123 4567 dob: 1 Yours sincerely, home address, as an individual"
    r = P.document_counts(spark.createDataFrame([(1, text), (1, None), (2, "clean")], "id long, t string"), "id", "t").collect()
    assert len(r) == 1 and r[0].signal_count == 9 and (r[0].email_personal, r[0].email_any) == (1, 2)


def test_sequences(spark):
    df = spark.createDataFrame([(1, p, v) for p, v in ((1, "a"), (2, "a"), (3, "b"), (5, "b"), (6, None), (7, None))], "g long, p long, v string")
    got = sorted((r.range_start, r.range_end, r.n_rows) for r in S.islands(df, "g", "p", ["v"]).collect())
    assert got == [(1, 2, 2), (3, 3, 1), (5, 5, 1), (6, 7, 2)]
    assert [r.p for r in S.budget_prefix(df, "p", "p", 7, 3).orderBy("p").collect()] == [1, 2, 3]
    assert S.budget_prefix(df.limit(0), "p", "p", 7).count() == 0


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "k string, v double")
    got = {r.k: (r.known, r.suppressed, r.complete) for r in A.known_sums(df, ["k"], "v").collect()}
    assert got == {"a": (1.0, 1, False), "b": (0.0, 1, False)}
    with pytest.raises(Exception, match="one expected"):
        A.require_single(df, F.col("k") == "a", "v").collect()
    with pytest.raises(Exception, match="missing comparison"):
        df.select(V.required(F.col("v"), "2023")).collect()
    n = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "v long")
    assert A.nearest_rank_percentiles(n, "v", {"p": 0.5}).first().p == 3  # rank 1.5 rounds to the even 2
    assert spark.range(1).select(V.nearest_rank(F.array(*map(F.lit, (1, 2, 3, 4))), 0.5).alias("r")).first().r == 3


def test_compare_and_ingest(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "k long, v string")
    assert {r.measure: r.n for r in C.columnwise(a, b, ["k"], ["v"]).collect()} == {"only_left": 1, "only_right": 1, "differ_v": 1}
    assert C.find_column(["Total value", "Total"], ["total"], ["value"]) == "Total"
    with pytest.raises(LookupError):
        C.find_column(["a1", "a2"], ["a"])
    with pytest.raises(AssertionError):
        C.same_stats_or_error(a, "rows")
    log = spark.createDataFrame([("s", 1, True), ("s", 2, False), ("t", 3, False), ("t", 4, False)], "k string, seq long, ok boolean")
    assert {r.k: r.seq for r in I.replay_journal(log, "k", ["seq"], "ok").collect()} == {"s": 1, "t": 4}
    good = spark.createDataFrame([("d", "u1"), ("e", "u2"), ("e", "u3")], "alias string, url string")
    fixed = I.repair_aliases(spark.createDataFrame([("d",), ("e",)], "alias string"), good, "alias", "url")
    assert {r.alias: r.repaired for r in fixed.collect()} == {"d": "u1", "e": None}


def test_candidates_listing_and_confidence(spark):
    docs = spark.createDataFrame([("aabb", "DOCX"), ("ccdd", "odd"), ("eeff", "PDF")], "sha string, kind string")
    listing = spark.createDataFrame([("aa/bb/aabb.doc",), ("cc/dd/ccdd.odd",)], "key string")
    got = {r.sha: r.resolved for r in U.first_existing(docs, "sha", "kind", listing, "key").collect()}
    assert got == {"aabb": "aa/bb/aabb.doc", "ccdd": "cc/dd/ccdd.odd", "eeff": None}
    a = spark.createDataFrame([("p", 1, "x"), ("q", 2, "y"), ("r", 3, "z")], "path string, size long, sha string")
    b = spark.createDataFrame([("p", 1, "x"), ("q", 9, "w"), ("s", 3, "z")], "path string, size long, sha string")
    r = C.listing_faults(a, b, "path", "size", "sha").first()
    assert (r.missing, r.uncatalogued, r.size_differs, r.hash_differs) == (1, 1, 1, 1)
    pairs = spark.createDataFrame([("a", "a", "high"), ("a", "b", "high"), ("a", None, "low")], "g string, p string, c string")
    assert {r.c: (r.correct, r.wrong) for r in A.by_confidence(pairs, "g", "p", "c").collect()} == {"high": (1, 1), "low": (0, 1)}


def test_documents(spark):
    from foliospark.operators import documents as D

    df = spark.createDataFrame([("https://h/x.pdf", "D:20110101", ["https://h/published-3-may-2012", "https://h/q"]), ("https://h/published_31_june_2012", "D:1980", None)], "u string, p string, r array<string>")
    got = [(r.published_at, r.analysis_year, r.analysis_year_basis) for r in D.temporal(df, "u", "p", "r", "2024-01-01").collect()]
    assert got == [("2012-05-03", 2012, "referrer-url-explicit-published-date"), (None, None, None)]
    pages = spark.createDataFrame([("m", 1, "mixed"), ("m", 2, "mixed"), ("s", 1, "stakeholder"), ("o", 1, "x")], "sha string, n long, voice string")
    over = spark.createDataFrame([("m", 1, 1, "v"), ("o", 1, 2, "a"), ("o", 1, 1, "b")], "sha string, start_page long, end_page long, voice string")
    rows = {(r.sha, r.n): (r.final_voice, r.fault) for r in D.page_voice(pages, over, "sha", "n", "voice").collect()}
    assert rows[("m", 1)] == ("v", None) and rows[("m", 2)] == ("mixed", "uncovered-page") and rows[("s", 1)] == ("stakeholder", None) and rows[("o", 1)][1] == "overlapping-overrides"
    good, bad = D.valid_overrides(spark.createDataFrame([("a", ""), ("zz", "low")], "authorship string, confidence string"), {"authorship": ["a", "b"], "confidence": ["low", "high"]}, {"confidence": F.lit("high")})
    assert [tuple(r) for r in good.collect()] == [("a", "high")] and bad.first().outside_domain == ["authorship"]
    meta = spark.createDataFrame([({"a": "1", "b": "2"},)], "m map<string,string>")
    r = D.update_front_matter(meta, "m", {"a": F.lit("3")}).first()
    assert r.updated == {"a": "3", "b": "2"} and r.changed
    with pytest.raises(Exception, match="canonical key"):
        D.update_front_matter(meta, "m", {"zz": F.lit("3")}).collect()
    near = spark.createDataFrame([("https://h/docs/default-source/a.pdf", "s1"), ("https://h/x/docs/default-source/a.pdf", "s2")], "u string, sha string")
    assert [(r.sha, r.aliases) for r in D.nested_aliases(near, "u", "sha").collect()] == [("s1", ["https://h/x/docs/default-source/a.pdf"])]
    t = spark.createDataFrame([(" ", "Pdf", "# H", "https://h/a-b.pdf"), (None, "", "# Contents", "https://h/a-b.pdf"), (None, None, "# Heading", "https://h/a")], "m string, p string, t string, u string")
    assert [r.t for r in t.select(D.title(*map(F.col, "mptu")).alias("t")).collect()] == ["Pdf", "a b", "Heading"]
