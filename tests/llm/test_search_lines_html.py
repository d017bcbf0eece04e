"""Permutation index, line dedup and HTML extraction against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from foliospark.llm import ann, html_extract, lines

ANN = "vec_id long, embedding array<float>, label int, part long, uid long, w string"


def vectors(n=600, dim=32, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    x[200:400] = x[200]  # a third of all rows are one vector
    return x


@pytest.fixture(scope="module")
def found(spark):
    x = vectors()
    rows = [(i, [float(v) for v in r], 0, 1, 2, "clash") for i, r in enumerate(x)]
    rows += [(1000, None, 0, 1, 2, ""), (1020, [0.0] * 32, 0, 1, 2, ""), (1040, [float("nan")] * 32, 0, 1, 2, ""), (1060, [None] * 32, 0, 1, 2, ""), (1080, [1.0] * 3, 0, 1, 2, ""), (None, [1.0] * 32, 0, 1, 2, ""), (1100, [], 0, 1, 2, ""), (1120, [float("inf")] * 32, 0, 1, 2, "")]
    df = spark.createDataFrame(rows, ANN).repartition(5)
    return {k: {r.rank: (r.vec_id, r.score) for r in rs} for k, rs in group(ann.search(df, lambda v: v % 20 == 0, least=150).collect()).items()}


def group(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query_id, []).append(r)
    return out


def test_ann_scores_order_and_recall(found):
    x = vectors().astype(np.float64)
    assert set(found) == set(range(0, 600, 20))
    hit = 0
    for q, best in found.items():
        assert sorted(best) == list(range(1, 21))
        score = x @ x[q]
        got = [best[i] for i in range(1, 21)]
        assert all(abs(s - score[v]) < 1e-9 for v, s in got) and q not in {v for v, _ in got}
        assert got == sorted(got, key=lambda g: (-g[1], g[0]))
        score[q] = -np.inf
        want = np.sort(score)[::-1][19]
        hit += sum(s >= want - 1e-9 for _, s in got)
    assert hit / (20 * len(found)) >= 0.9


def test_ann_prefers_small_ids_among_copies(found):
    copies = [v for v, _ in found[200].values()]
    assert copies == list(range(201, 221))


def test_ann_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    got = ann.search(few, lambda v: v % 20 == 0).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in got] == [(1, 1), (2, 1)]
    assert ann.search(few.limit(0), lambda v: v % 20 == 0).count() == 0


def test_footrule_identity():
    """Summed posting minima order candidates exactly as the truncated footrule distance does."""
    rng = np.random.default_rng(3)
    x, pivots = rng.standard_normal((40, 8)), rng.standard_normal((20, 8))
    near = ann.nearest_pivots(x, pivots, 10)
    place = np.minimum(np.argsort(np.argsort(-(x @ pivots.T), axis=1, kind="stable"), axis=1), 10)
    assert all((place[i, near[i]] == np.arange(10)).all() for i in range(40))
    shared, full = ann.shared_weights(near[:7], near)
    for i in range(7):
        footrule = np.abs(place - place[i]).sum(1)
        assert len(set((footrule + 2 * shared[i].astype(int)).tolist())) == 1
        assert shared[i, i] == full == 55


def test_ann_reads_files_of_the_query_only():
    """Rows that share no pivot with a query are never met, unless it meets too few."""
    near = np.array([[0, 1], [2, 3], [4, 5], [1, 4]], dtype="<u2")
    shared, _ = ann.shared_weights(near[:1], near)
    assert shared.tolist() == [[3, 0, 0, 1]]
    ids, vecs = np.arange(4), np.eye(4)
    got = ann.search_shard(ids[:1], ids[:1], vecs[:1], near[:1], ids, ids, vecs, near, 2, 0.1, 1)
    assert got[1].tolist() == [1, 2]


def test_ann_recall_with_production_parameters(spark):
    """Against brute force over a whole table of the driver."""
    import os

    path = "/root/testdata/sf0.1/embeddings.parquet"
    if not os.path.isfile(path):
        pytest.skip("no test tables here")
    df = spark.read.parquet(path)
    rows = sorted((r.vec_id, r.embedding) for r in df.collect())
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    got = group(ann.search(df, lambda v: v % 20 == 0).collect())
    hit = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[q] = -np.inf
        edge = np.sort(score)[-20]
        hit += sum(r.score >= edge - 1e-9 for r in got[ids[q]])
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0} and hit / (20 * len(got)) >= 0.9


LINES = "doc_id long, text string, h long, leaf long, uid long, dropped string"


def line_rows():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(60):
        own = [" ".join(word() for _ in range(12)) for _ in range(4)]
        if i % 3 == 0:
            own.insert(1, f"Posted by user{rng.randrange(9999)} on 2024-0{rng.randrange(1, 9)}-11 at noon")
        if i % 4 == 0:
            own.append(f"Read more stories like this one in our daily letter from {word()}")  # 1 of 12 positions varies
        if i % 5 == 0:
            own += ["", "All rights reserved", "All rights reserved"]
        rows.append((i, "\n".join(own)))
    return rows + [(100, None), (101, ""), (102, "\n \n"), (None, "All rights reserved"), (103, "two docs only here"), (104, "two docs only here"), (105, "x " * 30_000)]


def brute_lines(rows, min_docs=5, similarity=0.8):
    """The template rule in plain Python."""
    masked = [[tuple("<*>" if any(c in "0123456789" for c in t) else t for t in re.findall(r"[^\x20\x09-\x0D]+", line)) for line in (b or "").split("\n")] for _, b in rows]
    docs, leaves = Counter(), {}
    for doc in masked:
        docs.update({m for m in doc if m})
    for m in docs:
        leaves.setdefault((len(m), m[:3]), []).append(m)
    root = {}
    for members in leaves.values():
        support = Counter()
        for m in members:
            for at in enumerate(m):
                support[at] += docs[m]
        for m in members:
            order = sorted((support[at, t], -at) for at, t in enumerate(m) if t != "<*>")
            fields = {-at for _, at in order[: int(len(m) * (1 - similarity) + 1e-9)]} if len(members) > 1 else set()
            root[m] = tuple("<*>" if at in fields else t for at, t in enumerate(m))
    held = Counter(r for doc in masked for r in {root[m] for m in doc if m})
    out = []
    for (a, b), doc in zip(rows, masked):
        kept = [x for x, m in zip((b or "").split("\n"), doc) if not m or held[root[m]] < min_docs]
        out.append((str(a), len(doc), len(doc) - len(kept), "\n".join(kept)))
    return sorted(out)


def run_lines(spark, rows, parts):
    df = spark.createDataFrame([(a, b, 1, 2, 3, "clash") for a, b in rows], LINES).repartition(parts)
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in lines.line_dedup(df).collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_line_dedup(spark, parts):
    got = run_lines(spark, line_rows(), parts)
    want = []
    for a, b in line_rows():
        all_lines = (b or "").split("\n")
        kept = [x for x in all_lines if not x.startswith(("Posted by", "Read more", "All rights"))]
        want.append((str(a), len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    assert got == sorted(want) == brute_lines(line_rows())


@pytest.mark.parametrize("spread", [1, 16])
def test_line_dedup_matches_brute_force_on_borderline_lines(spark, monkeypatch, spread):
    """One leaf in which most lines are near others; the same output however the leaf is dealt out."""
    monkeypatch.setattr(lines, "SPREAD", spread)
    rng = random.Random(4)
    near = ["a b c " + " ".join(rng.choice("xxxxxxxxxxyz") for _ in range(12)) for _ in range(400)]
    rows = [(i, "\n".join(near[i * 4 : i * 4 + 4])) for i in range(100)]
    want = brute_lines(rows)
    assert 40 < sum(r[2] for r in want) < 360
    assert run_lines(spark, rows, 3) == run_lines(spark, rows, 9) == want


def test_positions_become_fields(spark):
    """Values of a field go with their template, whether frequent or not."""
    days = ["Monday"] * 6 + ["Tuesday"] * 2 + ["Friday"]
    rows = [(i, f"the weekly letter of our small club came out on {d} as ever\nown line number one of {chr(97 + i) * 6} here today") for i, d in enumerate(days)]
    assert all(r[2:] == (1, f"own line number one of {chr(97 + int(r[0])) * 6} here today") or r[2] == 2 for r in run_lines(spark, rows, 3))
    assert run_lines(spark, rows, 3) == brute_lines(rows)


def test_unlike_tokens_never_share_a_template(spark):
    """Tokens that a short hash would mix up stay apart; four positions of ten may not vary."""
    rows = [(i, "one two three " + " ".join(f"{w}{chr(97 + i)}" for w in ("wxea", "wxfa", "qqra", "ttsa")) + " four five six") for i in range(8)]
    assert all(r[2] == 0 for r in run_lines(spark, rows, 3))


def test_lines_empty(spark):
    assert lines.line_dedup(spark.createDataFrame([], LINES)).count() == 0


PAGES = "page_id long, url string, html string, host string, uid long, blocks string"
ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="with-sidebar">
<header><h2>Site</h2></header><nav><ul><li><a href=/a>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article class="post"><header><h1>Real &amp; true</h1></header><p><b>First&nbsp; para<br>goes on.<p>Second &lt;b&gt; para.</b>
<div class="ad-slot"><p>Buy</p></div><form><p>Name</p></form><ul><li>one<li>two</ul><blockquote>Said</blockquote><table><tr><td>c1<td>c2</table>
<section class=comments><p>Reader words</p></section></article><aside><p>Side</p></aside><!-- <p>gone</p> --><footer>&copy; F</footer></body></html>"""


def texts(spark, rows, **kw):
    df = spark.createDataFrame([(i, u, h, "clash", 1, "clash") for i, (u, h) in enumerate(rows)], PAGES).repartition(4)
    return {r.page_id: r for r in html_extract.extract(df, **kw).collect()}


def test_html_blocks(spark):
    got = texts(spark, [("https://h/1", ARTICLE), ("https://h/2", None), ("not a url", ""), (None, "plain  words < 3"), ("https://h/3", "<p>a<p>b<div>c</div>d"), ("https://[bad", "<b>x</b>"), ("https://h/4", "<article><p>" + "w " * 50_000)])
    assert got[0].text == "Real & true\nFirst para goes on.\nSecond <b> para.\none\ntwo\nSaid\nc1\nc2"
    assert [got[i].text for i in (1, 2, 3, 4, 5)] == ["", "", "plain words < 3", "a\nb\nc\nd", "x"]
    assert all(r.n_chars == len(r.text) for r in got.values()) and got[6].n_chars == 99_999


def test_site_templates_are_counted_per_host(spark):
    page = lambda i: f"<body><div><p>Welcome to our site</p></div><div><p>story {i}</p><p>Common line</p></div><div><p>twice {i // 2}</p></div></body>"
    rows = [("https://big/x", page(i)) for i in range(40)] + [("https://small/x", page(i)) for i in range(3)]
    got = texts(spark, rows)
    assert all(got[i].text == f"story {i}\ntwice {i // 2}" for i in range(40))  # both recurring paragraphs go
    assert all(got[40 + i].text == f"Welcome to our site\nstory {i}\nCommon line\ntwice {i // 2}" for i in range(3))
    marked = [("https://big/x", f"<article><p>Same</p><p>own {i}</p><div>Join us</div></article>") for i in range(20)]
    assert Counter(r.text.replace("own", "").strip() == "" for r in texts(spark, marked).values())[True] == 0
    assert all(r.text == f"Same\nown {i}" for i, r in texts(spark, marked).items())


def test_html_empty(spark):
    assert html_extract.extract(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("body", ["for(i=0;i<n;i++){}", "<!-- not closed", 'w("<p a=\'>x</scripted>")', "a<b", ""])
def test_html_script_bodies_end_at_their_own_tag(spark, body):
    rows = [("https://h/1", f"<p>Before</p><script>{body}</script><p>Text</p><STYLE>{body}</Style ><p>Last</p>"), ("https://h/2", f"<p>Before</p><script>{body}")]
    got = texts(spark, rows)
    assert [got[i].text for i in (0, 1)] == ["Before\nText\nLast", "Before"]


def test_html_counts_decide_beside_and_inside_articles(spark):
    page = lambda i: f"<article><h1>Title</h1><p>own {i}</p><ul><li>link {i}<li>more</ul><ul><li>See also</ul></article><div>part two of {i}</div><div>Our shop</div>"
    rows = [("https://big/x", page(i)) for i in range(20)] + [("https://small/x", page(i)) for i in range(3)]
    got = texts(spark, rows)
    assert all(got[i].text == f"Title\nown {i}\nlink {i}\nmore\npart two of {i}" for i in range(20))
    assert all(got[20 + i].text == f"Title\nown {i}\nlink {i}\nmore\nSee also\npart two of {i}\nOur shop" for i in range(3))


INLINE = [
    ('<p>text <span class="ad">Buy now</span> more</p>', "text more"),
    ('<p>a <select><option>x</select> b <button>Go</button> c <svg><text>t</text></svg> d</p>', "a b c d"),
    ('<p>one <span hidden>two</span> three <a class="share" href=x>Tweet</a></p>', "one three"),
    ('<article><p class="share-price">The price rose.</p><p class="notice">Gone</p></article>', "The price rose."),
    ('<p data-hidden-for="x" title="hidden id ad">Shown <i data-class="ad">too</i></p>', "Shown too"),
    ('<div><span class="ad">only</span></div><p>rest</p>', "rest"),
]


def test_html_inline_furniture(spark):
    got = texts(spark, [("https://h/1", h) for h, _ in INLINE])
    assert [got[i].text for i in range(len(INLINE))] == [want for _, want in INLINE]


def brute_template(rows, min_pages=5, min_share=0.2):
    """What the counts alone delete, in plain Python: blocks with a subtree around them that recurs on the host."""
    parsed = [(html_extract.host_of(u), *html_extract.parse(h or "", False)) for u, h in rows]
    pages, seen = Counter(host for host, *_ in parsed), Counter((host, t) for host, trees, _ in parsed for t in trees)
    recurs = lambda host, t: seen[host, t] >= min_pages and seen[host, t] >= pages[host] * min_share
    return ["\n".join(t for t, path, gone in blocks if not gone and not any(recurs(host, h) for h in path)) for host, _, blocks in parsed]


def test_html_counts_alone_match_brute_force(spark):
    """Without lists the counts delete menus, footers and notices that recur, and nothing else."""
    page = lambda i: f"<head><title>T</title></head><nav><ul><li>Home<li>Shop {i}</ul></nav><div class=ad>Ad {i % 3}</div><article><p>Same words</p><p>own {i}</p></article><footer><p>Our firm</p></footer><script>x{i}</script>"
    rows = [("https://big/x", page(i)) for i in range(30)] + [("https://small/x", page(i)) for i in range(3)] + [("https://big/x", None)]
    got = texts(spark, rows, lists=False)
    assert [got[i].text for i in range(len(rows))] == brute_template(rows)
    assert got[0].text == "Shop 0\nSame words\nown 0" and "Home" in got[30].text and "Our firm" in got[30].text
    df = spark.createDataFrame([(i, u, h, "clash", 1, "clash") for i, (u, h) in enumerate(rows)], PAGES)
    n = html_extract.deletions(df).groupBy().sum("n_blocks", "by_counts", "by_lists", "by_both").first()
    assert tuple(n) == (33 * 6, 30 * 3, 33 * 4, 30 * 3)


def test_html_counts_on_real_pages(spark):
    import os

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables here")
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in df.collect()]
    got = {r.page_id: r.text for r in html_extract.extract(df, lists=False).collect()}
    assert got == dict(zip((r[0] for r in rows), brute_template([r[1:] for r in rows])))
