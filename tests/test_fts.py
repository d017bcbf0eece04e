"""The search sub-language and its ranking on toy rows."""

import math

import pytest
from pyspark.sql import functions as F

from foliospark.plans import fts

ROWS = [(1, "Éclair rules", "the vulnerable consumer and the customer"), (2, "none", "vulnerability of a consumer"), (3, "re-key the data", "manual re-key work; re key"), (4, "x", ""), (5, None, "re re key key and more")]


@pytest.fixture(scope="module")
def pages(spark):
    return fts.with_norms(spark.createDataFrame(ROWS, "id long, title string, text string"), title="title").cache()


def ids(pages, q):
    return sorted(r.id for r in pages.filter(fts.matches(q, F.col("title_norm"), F.col("text_norm"))).collect())


@pytest.mark.parametrize(
    "q,want",
    [
        ("eclair", [1]),
        ('"re-key"', [3, 5]),
        ('"vulnerable" OR "vulnerability" AND (consumer OR customer)', [1, 2]),
        ("vulnerable consumer", [1]),
        ("consumer NOT vulnerable", [2]),
        ("eclair AND customer", [1]),
        ('"rules the"', []),
        ("and", [1, 5]),
    ],
)
def test_matches(pages, q, want):
    assert ids(pages, q) == want


@pytest.mark.parametrize("q", ["re-key", "NOT x", "(a", "a)", '"open', "a AND", "AND a", '""', "a:b", ""])
def test_errors(q):
    with pytest.raises(fts.QueryError):
        fts.parse(q)


@pytest.mark.parametrize("weight", [1.0, 1.5])
def test_bm25_closed_form(pages, weight):
    got = {r.id: r.score for r in fts.bm25(pages, '"re-key" OR the', weight).collect()}
    docs = {i: (fts.fold(t or "").split(), fts.fold(x or "").split()) for i, t, x in ROWS}
    mean = sum(len(a) + len(b) for a, b in docs.values()) / len(docs)
    count = lambda toks, p: sum(toks[i : i + len(p)] == p for i in range(len(toks)))
    for i, (a, b) in docs.items():
        total = 0.0
        for p in (["re", "key"], ["the"]):
            n = sum(bool(count(x, p) or count(y, p)) for x, y in docs.values())
            idf = math.log((len(docs) - n + 0.5) / (n + 0.5))
            f = weight * count(a, p) + count(b, p)
            total += (idf if idf > 0 else 1e-6) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * (len(a) + len(b)) / mean))
        assert (i in got) == (total > 0) and abs(got.get(i, 0) + total) < 1e-6


def test_bundle_first_query_wins_and_snippet(spark, pages):
    rows = fts.bundle(pages, ["key", "re"], 5, ["id"]).collect()
    assert {r.id: r.query_index for r in rows} == {3: 0, 5: 0}
    text = spark.createDataFrame([(" ".join(["w"] * 80 + ["Re-Key"] + ["w"] * 80),), (None,), ("",)], "t string")
    got = [r.s for r in text.select(fts.snippet(["re key"], 10)("t").alias("s")).collect()]
    assert "[Re-Key]" in got[0] and got[0].startswith(" ... ") and got[1] is None and got[2] == ""
