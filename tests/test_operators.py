"""Merges, overrides, medians, checks, analyses and search folding on inline rows, against plain Python."""

import statistics

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions import urls as U
from foliospark.functions import values as V
from foliospark.operators import aggregates as A
from foliospark.operators import ingest as I
from foliospark.operators import personal_data as P
from foliospark.operators import sequences as S
from foliospark.operators import structured as SD
from foliospark.plans import fts, vocabulary


def test_upsert_keeps_all_sources_and_the_first_referrers(spark):
    """25 sources stay; of 30 referrers the first 20 to arrive do, each once."""
    rows = [("u", i, f"s{i % 25:02}", f"r{(i * 7) % 30:02}", i if i % 2 else None) for i in range(60)] + [("v", 1, "s", None, None), ("v", 2, "s", "", None)]
    got = {r.k: r for r in I.upsert(spark.createDataFrame(rows, "k string, seq long, source string, ref string, v long").repartition(5), "k", ["seq"], ["v"], "source", referrer="ref").collect()}
    assert got["u"].sources == [f"s{i:02}" for i in range(25)] and got["u"].n_sources == 25 and got["u"].v == 59 and got["u"].n_updates == 60
    assert got["u"].referrers == list(dict.fromkeys(f"r{(i * 7) % 30:02}" for i in range(60)))[:20]
    assert got["v"].referrers == [] and got["v"].v is None


def test_overlapping_overrides_do_not_repeat_rows(spark):
    rows = spark.createDataFrame([(1, p, "own") for p in range(5)] + [(2, 0, "own"), (2, 0, "own")], "k long, p long, role string")
    over = spark.createDataFrame([(1, 0, 2, "a"), (1, 2, 3, "b"), (2, 0, 0, "c")], "k long, start_position long, end_position long, override_label string")
    got = sorted((r.k, r.p, r.final_label, r.label_basis) for r in S.range_override(rows, over, "k", "p", "role").collect())
    assert got == [(1, 0, "a", "override"), (1, 1, "a", "override"), (1, 2, "own", "overlapping-overrides"), (1, 3, "b", "override"), (1, 4, "own", "inherited"), (2, 0, "c", "override"), (2, 0, "c", "override")]


def test_unresolved_preferences_are_faults(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y"), ("c", "x"), ("c", "y"), ("d", "x"), ("d", "y")], "k string, c string")
    preferred = spark.createDataFrame([("b", "y"), ("c", "z")], "k string, preferred string")
    assert sorted((r.k, r.c) for r in S.preference_dedupe(rows, "k", "c", preferred).collect()) == [("a", "x"), ("b", "y")]
    assert sorted((r.k, r.n_candidates, r.n_preferred) for r in S.preference_faults(rows, "k", "c", preferred).collect()) == [("c", 2, 0), ("d", 2, 0)]


def test_a_null_key_is_kept_or_a_fault(spark):
    rows = spark.createDataFrame([(None, "x"), (None, "y"), ("a", "x"), ("a", "y")], "k string, c string")
    preferred = lambda c: spark.createDataFrame([(None, c), ("a", "y")], "k string, preferred string")
    results = lambda c: [{(r.k, r.c) for r in S.preference_dedupe(rows, "k", "c", preferred(c)).collect()}, {tuple(r) for r in S.preference_faults(rows, "k", "c", preferred(c)).collect()}]
    assert results("x") == [{(None, "x"), ("a", "y")}, set()]
    assert results("z") == [{("a", "y")}, {(None, 2, 0)}]


def test_latest_row_is_the_first_of_equal_dates(spark):
    rows = spark.createDataFrame([("k", "2024-01-02", 1, "a"), ("k", "2024-01-02", 2, "b"), ("k", "2024-01-01", 3, "c"), ("k", None, 4, "d"), ("m", "2024-01-01", 1, "a"), ("m", "2024-01-02", 2, "b")], "k string, d string, at long, v string")
    got = {r.k: (r.d, r["at"], r.v, r.in_order) for r in S.latest_first_among_ties(rows, ["k"], "d", "at", ["d", "at", "v"]).collect()}
    assert got == {"k": ("2024-01-02", 1, "a", False), "m": ("2024-01-02", 2, "b", True)}


def test_grouped_medians_are_exact(spark):
    import random

    rng = random.Random(2)
    rows = [(g, rng.choice([rng.random(), 0.5, 3.0])) for g in "aabbbc" for _ in range(rng.randrange(1, 400))] + [("d", 1.0), ("e", 1.0), ("e", 2.0), ("a", None)]
    got = {r.g: r.median for r in A.grouped_medians(spark.createDataFrame(rows, "g string, v double").repartition(6), ["g"], "v").collect()}
    assert got == {g: statistics.median(v for x, v in rows if x == g and v is not None) for g in "abcde"}


def test_checks_take_one_pass_a_table(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    out = A.checks(("a", df, F.col("v") > 5), ("b", spark.range(3), F.col("id") < 0), ("c", df, F.col("v") < 0))
    assert sorted(tuple(r) for r in out.collect()) == [("a", 14, False), ("b", 0, True), ("c", 0, True)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range") == 2


def test_most_common_breaks_ties_by_first_appearance(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate("cbbcaad")], "i long, v string")
    assert [(r.v, r.n) for r in A.most_common(rows, "v", 3, "i").collect()] == [("c", 2), ("b", 2), ("a", 2)]


def test_budget_prefix_sorts_what_lies_within(spark):
    rows = spark.createDataFrame([(i, (i * 37) % 11) for i in range(500)], "i long, n long")
    want, total = [], 0
    for i in range(500):
        total += (i * 37) % 11
        if total <= 700:
            want.append((i, total))
    for per in (1_000_000, 3):
        assert sorted((r.i, r.running_total) for r in S.budget_prefix(rows, "i", "n", 700, per).collect()) == want


@pytest.mark.parametrize("word,folded", [("Łódź", "łodz"), ("Žluťoučký", "zlutoucky"), ("Crédit", "credit"), ("Crédit", "credit"), ("Ǻngström", "angstrom"), ("ελληνικά", "ελληνικά"), ("Ñandú", "nandu"), ("ệ", "e")])
def test_search_folds_marks_of_latin_letters(spark, word, folded):
    """Latin letters lose their marks, written in one character or in several; others keep them."""
    assert spark.createDataFrame([(word,)], "t string").select(T.normalised(F.col("t")).alias("n")).first().n == f" {folded} "
    assert fts.fold(word) == folded


def test_whole_vocabulary_parses():
    queries = [q for _, q in (*vocabulary.TOPICS.values(), *vocabulary.THEMES.values())] + [q for _, qs in (*vocabulary.BUNDLES.values(), vocabulary.INDUSTRY[1:]) for q in qs]
    assert len(vocabulary.TOPICS) == 24 and len(vocabulary.THEMES) == 20 and len(vocabulary.BUNDLES) == 11
    assert all(fts.terms(fts.parse(q)) for q in queries)


def test_file_paths(spark):
    long = "https://h.example/" + "very-long/" * 40 + "report.pdf?sfvrsn=1"
    urls = ["https://h.example/docs/Report.pdf", "https://h.example/docs/report.pdf", long, "https://h.example"]
    got = [r.p for r in spark.createDataFrame([(u,) for u in urls], "u string").select(U.file_path(F.col("u")).alias("p")).collect()]
    assert got[0].lower() != got[1].lower() and all(g.startswith("h.example/docs/") and g.endswith(".pdf") for g in got[:2])
    assert got[2].startswith("h.example/_long/") and got[2].endswith(".pdf") and len(got[2]) <= 209
    assert got[3].startswith("h.example/index__u-") and got[3].endswith(".html")


def test_retry_and_byte_limit(spark):
    now = F.lit("2026-10-21 07:28:00").cast("timestamp")
    heads = [("3", 3000), ("-2", 0), ("Wed, 21 Oct 2026 07:28:10 GMT", 10_000), ("Wed, 21 Oct 2025 07:28:10 GMT", 0), ("later", None), ("", None), (None, None)]
    got = [r.w for r in spark.createDataFrame(heads, "h string, want long").select(V.retry_after_ms(F.col("h"), now).alias("w")).collect()]
    assert got == [w for _, w in heads]
    sizes = spark.createDataFrame([([5, 5, 5],), ([20, 1],), ([],)], "s array<long>")
    assert [r.s for r in sizes.select(V.within_byte_limit(F.col("s"), 10).alias("s")).collect()] == [[5, 5], [], []]
    assert [len(r.s) for r in sizes.select(V.within_byte_limit(F.col("s"), 0).alias("s")).collect()] == [3, 2, 0]


def test_types_and_repairs(spark):
    assert I.selected_types(" .PDF, zip,") == ["pdf", "zip"] and "pdf" in I.selected_types() and "png" in I.selected_types(assets=True)
    broken = spark.createDataFrame([("b1", "k1", "g1"), ("b2", "k2", "b2"), ("b3", "k3", "n3"), ("b4", "k4", None)], "key string, alias string, fixed string")
    good = spark.createDataFrame([("g1", "z"), ("g2", "k2"), ("g4", "k4"), ("g5", "k4")], "key string, alias string")
    got = sorted(tuple(r) for r in I.repair_records(broken, good, "alias", "key", "fixed").collect())
    assert got == [("b1", "g1", "merged"), ("b2", "g2", "merged"), ("b3", "n3", "rewritten"), ("b4", None, "left")]


def test_personal_data_tokens_in_one_scan(spark):
    df = spark.createDataFrame([(1, "a.b@x.ie A.B@x.ie info@x.ie"), (2, "a.b@x.ie 1234567T"), (3, None)], "id long, t string")
    got = {r.pattern: (r.distinct_tokens, r.occurrences) for r in P.distinct_tokens(df, "t").collect()}
    assert got == {"email_personal": (1, 3), "email_any": (2, 4), "ppsn": (1, 1)}
    assert P.distinct_tokens(df, "t")._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + P.distinct_tokens(df, "t")._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 1


SME = "Referencedate string, `Economic Activity` string, Out string, Rate string"


def test_sme_lending_guards(spark):
    run = lambda rows: SD.sme_lending(spark.createDataFrame(rows, SME), ["Out"], "Rate", "Out", {"parent": ["child"]}).first()
    r = run([("31/03/2024", "a", "1,100", "2"), ("31/03/2024", "parent", "NULL", "3"), ("31/03/2024", "child", "100", "4"), ("31/03/2023", "a", "600", "9"), ("bad", "a", "5", "5")])
    assert (r.latest, r.Out_now, r.Out_before, r.Out_suppressed, r.Out_change, r.weighted_rate) == ("2024-03-31", 1200.0, 600.0, 1, 100.0, (2200 + 400) / 1200)
    with pytest.raises(Exception, match="children both"):
        run([("31/03/2024", "parent", "1", "1"), ("31/03/2024", "child", "1", "1"), ("31/03/2023", "a", "1", "1")])
    with pytest.raises(Exception, match="missing comparison"):
        run([("31/03/2024", "a", "1", "1")])


def test_retail_rates_find_columns_and_order(spark):
    rows = spark.createDataFrame([("01/02/2024", 1, "1.5", "NA"), ("01/03/2024", 2, "1.7", "9"), ("01/03/2024", 3, "8", "8")], "`Reporting Date` string, at long, `Deposits, overnight rate` string, `Deposits, volumes` string")
    got = {r.metric: (r.period, r.value, r.in_order) for r in SD.retail_rates(rows, "Reporting Date", "at", {"rate": (["overnight"], []), "volume": (["volumes"], ["rate"])}).collect()}
    assert got == {"rate": ("2024-03-01", 1.7, False), "volume": ("2024-03-01", 9.0, False)}
    with pytest.raises(LookupError):
        SD.retail_rates(rows, "Reporting Date", "at", {"x": (["deposits"], [])})


def test_quota_bundle(spark):
    pages = fts.with_norms(spark.createDataFrame([(i, "en" if i % 2 else "de", "credit union transfer" if i < 30 else "plain text here and there") for i in range(200)], "id long, lang string, text string"))
    got = fts.quota_bundle(pages, ['"credit union"', "transfer"], "lang", {"en": 4, "de": 1}, ["id"]).collect()
    assert sorted((r.lang, r.id, r.query_index) for r in got) == [("de", 0, 0), ("en", 1, 0), ("en", 3, 0), ("en", 5, 0), ("en", 7, 0)]
