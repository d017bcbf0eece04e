"""Each stage of the pipeline against plain Python on its own input."""

import random
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from foliospark.llm import simhash
from foliospark.llm.queries import tokenizer_file

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    odd = spark.createDataFrame([(900001, None, "en", "s", 0), (900002, "", None, "s", 0), (900003, "same words", "en", None, 0), (900003, "same words", "en", None, 0), (None, "no id at all", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").union(odd)
    out = [docs]
    for i, (_, f) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        f(spark, out[-1], DATA).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def key(r):
    return str(r.doc_id), str(r.text), str(r.lang), str(r.source)


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "packing"]
    for s in stages[1:-1]:
        assert s.columns == stages[0].columns


def test_quality_keeps_labelled_documents(spark, stages):
    good = {r.doc_id for r in spark.read.parquet(f"{DATA}/labels.parquet").filter("quality = 1").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    assert len(good - kept) <= 0.02 * len(good)
    assert {key(r) for r in stages[1].collect()} <= {key(r) for r in stages[0].collect()}


def test_exact_stage(stages):
    groups = {}
    for r in stages[1].collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), 2**63 if r.doc_id is None else r.doc_id, key(r)))
    assert sorted(key(r) for r in stages[2].collect()) == sorted(min(g)[2] for g in groups.values())


def test_near_stage(stages):
    """Against Jaccard similarities of all pairs: every row that goes has a kept one that is alike, and no two kept rows are alike."""
    rows = stages[2].collect()
    sets = [simhash.shingle_set((r.text or "").encode(), 5) for r in rows]
    like = [[len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets]
    kept = Counter(map(key, stages[3].collect()))
    stays = []
    for r in rows:
        stays.append(kept[key(r)] > 0)
        kept[key(r)] -= stays[-1]
    assert not +kept
    goes = [i for i, s in enumerate(stays) if not s]
    assert all(any(like[i][j] and stays[j] for j in range(len(rows))) for i in goes)
    pairs = sum(like[i][j] for i in range(len(rows)) for j in range(i))
    left = sum(like[i][j] for i in range(len(rows)) for j in range(i) if stays[i] and stays[j])
    assert pairs and left == 0


def test_near_stage_on_one_large_group(spark):
    """A third of all rows are near copies of one text; one of them stays, and what is merely linked through others stays, too."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(200)]
    copies = []
    for _ in range(60):
        c = list(base)
        c[rng.randrange(200)] = word()
        copies.append(" ".join(c))
    far = " ".join([word() for _ in range(60)] + base[60:])
    texts = [*copies, far, *(" ".join(word() for _ in range(50)) for _ in range(120))]
    docs = spark.createDataFrame([(i, x, "en", "s", 0) for i, x in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, DATA).collect()}
    assert got == {0, *range(60, 181)}


def test_packing_stage(stages):
    tok = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    want = {str(r.doc_id): len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in stages[3].collect()}
    got = {}
    for r in stages[4].collect():
        got[str(r.doc_id)] = got.get(str(r.doc_id), 0) + r.length
    assert got == want


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, DATA).count() > 0


def test_near_stage_keeps_unlike_texts_of_repeated_ids(spark):
    """Two unlike groups may have the same smallest id; neither may swallow the other."""
    rows = [(7, "one text about apples and pears"), (7, "quite another tale of rivers and stones"), (8, "a third thing with nothing in common at all"), (9, "one text about apples and pears"), (None, "no id here")]
    docs = spark.createDataFrame([(a, b, "en", "s", 0) for a, b in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(key(r)[:2] for r in corpus_pipeline.near_dedup(spark, docs, DATA).collect())
    assert got == sorted((str(a), b) for a, b in rows if a != 9)


def test_stages_on_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert all(f(spark, docs, DATA).count() == 0 for _, f in corpus_pipeline.STAGES)


def near_texts(rng, n):
    """Texts in small families at similarities around 0.8, with a line that a third of all texts hold."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    line = " ".join(word() for _ in range(12))
    out = []
    while len(out) < n:
        base = [word() for _ in range(rng.randrange(3, 250))]
        for _ in range(rng.randrange(1, 6)):
            c = list(base)
            for _ in range(rng.randrange(0, 4)):
                c[rng.randrange(len(c))] = word()
            out.append(" ".join(c) + (" " + line if rng.random() < 0.3 else ""))
    return out[:n]


def test_similar_pairs_are_those_of_all_comparisons(spark):
    from foliospark.llm import jaccard
    from foliospark.llm.common import Scratch

    texts = ["", None, "A b", "a B", *near_texts(random.Random(11), 500)]
    sets = [simhash.shingle_set((t or "").encode(), 5) for t in texts]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(5)
    got = [tuple(r) for r in jaccard.similar_pairs(docs, "row", "text", Scratch(spark, "pairs")).collect()]
    assert len(want) > 100 and sorted(got) == sorted(want)


def test_near_stage_leaves_out_no_pair(spark):
    """Rows that SimHash misses, or that are alike to each other but not to the row that stays, go as well."""
    rng = random.Random(3)
    texts = near_texts(rng, 600)
    docs = spark.createDataFrame([(i, x, "en", "s", 0) for i, x in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    stays = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, DATA).collect())
    sets = [simhash.shingle_set(t.encode(), 5) for t in texts]
    alike = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    assert len(stays) == len(set(stays)) and len(stays) < len(texts)
    assert not [(i, j) for j in stays for i in stays if i < j and alike(i, j)]
    assert all(any(alike(i, j) for j in stays) for i in set(range(len(texts))) - set(stays))


def test_near_stage_thins_out_a_large_component(spark):
    """Copies of one text at all distances: more rows than LARGE are alike to others but not to the one with the smallest id."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(120)]
    texts = []
    for i in range(260):
        c = list(base)
        for _ in range(rng.randrange(0, 4) + 3 * (i < 3)):
            c[rng.randrange(120)] = word()
        texts.append(" ".join(c))
    docs = spark.createDataFrame([(i, x, "en", "s", 0) for i, x in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    stays = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, DATA).collect()}
    sets = [simhash.shingle_set(t.encode(), 5) for t in texts]
    alike = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    assert sum(not alike(0, i) for i in range(260)) > corpus_pipeline.LARGE
    assert not [(i, j) for j in stays for i in stays if i < j and alike(i, j)]
    assert all(any(alike(i, j) for j in stays) for i in set(range(260)) - stays)


def test_parities_rule_out_no_pair_that_is_alike():
    """Parities differ in no more bits than sets differ in shingles, whatever their sizes."""
    import numpy as np

    from foliospark.llm import jaccard

    sets = [jaccard.shingle_hashes(t.encode(), 5) for t in ["", "a b", *near_texts(random.Random(5), 150)]]
    marks = [jaccard.parity(x) for x in sets]
    apart = {(i, j): len(np.setxor1d(sets[i], sets[j])) for i in range(len(sets)) for j in range(i + 1)}
    bits = {(i, j): jaccard.bits_apart(marks[i], marks[j]) for i, j in apart}
    assert all(bits[p] <= apart[p] for p in apart)
    unlike = [(i, j) for i, j in apart if len(sets[j]) >= 0.8 * len(sets[i]) >= 0.64 * len(sets[j]) and apart[i, j] > (len(sets[i]) + len(sets[j])) / 2]
    assert len({len(m) for m in marks}) > 2 and len(unlike) > 100
    assert sum(bits[i, j] > (len(sets[i]) + len(sets[j])) / 9 for i, j in unlike) > 0.99 * len(unlike)


def test_texts_that_share_a_passage_do_not_meet(spark, monkeypatch):
    """Passages of 30 texts each, in 80,000 texts: they are frequent at any size, and no texts are compared that cannot be alike."""
    from foliospark.llm import jaccard
    from foliospark.llm.common import Scratch

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passages = [" ".join(word() for _ in range(8)) for _ in range(80_000 // 30)]
    texts = [f"{passages[i % len(passages)]} {' '.join(word() for _ in range(6))}" for i in range(80_000)]
    copies = [t + " end" for t in texts[:50]]
    docs = spark.createDataFrame(list(enumerate(texts + copies)), "row long, text string").repartition(8)
    compared = []
    confirmed = jaccard.confirmed
    monkeypatch.setattr(jaccard, "confirmed", lambda pairs, *a, **k: compared.append(pairs.count()) or confirmed(pairs, *a, **k))
    scratch = Scratch(spark, "passages")
    got = sorted(tuple(r) for r in jaccard.similar_pairs(docs, "row", "text", scratch).collect())
    met = spark.read.parquet(f"{scratch.root}/met").count()
    assert got == [(i, 80_000 + i) for i in range(50)]
    assert met < 80_000 and sum(compared) < 1000
