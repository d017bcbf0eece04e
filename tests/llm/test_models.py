"""LM scoring, quality classifier, sentence pieces and edit counts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import edit_counts, kneser_ney, lm, sentencepiece_codec
from foliospark.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, word string, c long, h long, uid long, carried string"
JSON, RANKS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken")
ODD = ["", None, " \n\t", "A a A", "x" * 3000, "word " * 30_000, "naïve Ωmega 日本語 😀", "1,234.5 tokens-and_more"]


def sentences(rng, n):
    """A small grammar: what follows depends on the word before, so context pays."""
    follow = {"the": ["cat", "dog", "old"], "old": ["cat", "dog"], "cat": ["sat", "ran"], "dog": ["sat", "ran"], "sat": ["on", "."], "ran": ["to", "."], "on": ["the"], "to": ["the"], ".": ["the"]}
    w, out = "the", []
    for _ in range(n):
        out.append(w)
        w = rng.choice(follow[w])
    return " ".join(out)


def table_rows():
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "the cat"), (3, "A a A"), (3, "A a A")]
    rows += [(100 + i, sentences(rng, rng.randrange(5, 120)) + f" rare{i}" * (i % 3 == 0)) for i in range(300)]
    return [(a, b, "en" if (a or 0) % 2 else None, "clash", 1, 2, 3, "clash") for a, b in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(table_rows(), SCHEMA).repartition(6)


def test_lm_base_and_score(docs):
    toks = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    counts = {}
    for d, t, *_ in table_rows():
        if not held(d):
            for w in toks(t):
                counts[w] = counts.get(w, 0) + 1
    total, vocabulary = sum(counts.values()), len(counts)
    got = lm.score(docs).collect()
    want = sorted((str(d), held(d), len(toks(t)), sum(w in counts for w in toks(t)), round(sum(math.log10((counts.get(w, 0) + 1) / (total + vocabulary + 1)) for w in toks(t)), 4)) for d, t, *_ in table_rows())
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert {r.train_tokens for r in got} == {total}
    unseen = [r for r in got if r.held_out and (r.doc_id or 0) >= 100]
    assert sum(r.score for r in unseen) > 0.8 * sum(r.base_score for r in unseen)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_lm_normalises():
    rng = np.random.default_rng(0)
    model = lm.LogBilinear(rng.random(40) + 0.1)
    model.train(rng.integers(0, 40, (5000, 3)), rng)
    near, far, lnz = model.tables()
    for a, b in ((0, 0), (3, 39), (17, 5)):
        assert abs(np.exp(near[b] + far[a] - lnz[a, b]).sum() - 1) < 1e-3


def test_lm_without_training_rows(spark):
    held = [d for d in range(200) if zlib.crc32(str(d).encode()) % 7 == 2][:3]
    got = lm.score(spark.createDataFrame([(d, "a b") for d in held], "doc_id long, text string")).collect()
    assert all(r.held_out and r.n_known == 0 and r.n_tokens == 3 and r.base_score == 0 for r in got)
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def fitted(docs, monkeypatch):
    """(scored rows, what ``fit`` was given, its model)."""
    seen, fit = {}, lm.fit

    def kept(train, vocabulary, unigram, scratch):
        seen["vocabulary"], seen["unigram"], seen["model"] = vocabulary, unigram, fit(train, vocabulary, unigram, scratch)
        return seen["model"]

    monkeypatch.setattr(lm, "fit", kept)
    return lm.score(docs).collect(), seen


def test_lm_trains_on_long_texts_alone(spark, monkeypatch):
    """Very long texts give spans to the warm start and train the model."""
    rng = random.Random(3)
    long = spark.createDataFrame([(i, sentences(rng, 90_000)) for i in range(5)], "doc_id long, text string")
    warm, train = [], lm.LogBilinear.train
    monkeypatch.setattr(lm.LogBilinear, "train", lambda self, rows, *a: (warm.append(len(rows)), train(self, rows, *a))[1])
    got, seen = fitted(long, monkeypatch)
    start = lm.LogBilinear(seen["unigram"])
    assert len(warm) >= 6 and min(warm[:6]) > 500
    assert any((a != b).any() for a, b in zip(start.params, seen["model"].params))
    assert sum(r.score for r in got) > 0.5 * sum(r.base_score for r in got)  # context pays


def brute_lm(vocabulary, model, counts, text):
    """log10 probability of a text, token by token with every normaliser written out."""
    r, c1, c2, b, m, mb = (p.astype(np.float64) for p in model.params)
    place = {w: i for i, w in enumerate(vocabulary.words)}
    n_tail, v_tail = Counter(), Counter()
    for w, c in counts.items():
        if w not in place:
            n_tail[lm.shape(w)] += c
            v_tail[lm.shape(w)] += 1
    far = near = vocabulary.end
    total = 0.0
    for w in lm.tokens(text):
        i, k = place.get(w), lm.shape(w)
        c, member = (vocabulary.tail_class[k], vocabulary.tail_member[k]) if i is None else (vocabulary.classes[i], vocabulary.members[i])
        q = r[near] @ c1 + r[far] @ c2
        s = r @ q + b
        total += s[c] - np.log(np.exp(s - s.max()).sum()) - s.max()
        if member >= 0:
            ((_, first, end),) = [f for f in vocabulary.families if f[0] == c]
            s = m[first:end] @ q + mb[first:end]
            total += s[member - first] - np.log(np.exp(s).sum())
        if i is None:
            total += math.log((counts.get(w, 0) + 1) / (n_tail[k] + v_tail[k] + 1))
        far, near = near, c
    return total / math.log(10)


@pytest.mark.parametrize("top", [900, 4])
def test_lm_score_matches_token_by_token_sums(docs, monkeypatch, top):
    """Few top words and small families, so that families and rare words carry the text."""
    monkeypatch.setattr(lm, "TOP", top)
    monkeypatch.setattr(lm, "FAMILY", 3)
    got, seen = fitted(docs, monkeypatch)
    counts = Counter(w for d, t, *_ in table_rows() if zlib.crc32(b"" if d is None else str(d).encode()) % 7 != 2 for w in lm.tokens((t or "").encode()))
    assert top == 900 or len(seen["vocabulary"].families) > lm.SHAPES
    want = sorted((str(d), brute_lm(seen["vocabulary"], seen["model"], counts, (t or "").encode())) for d, t, *_ in table_rows() if len(t or "") < 5000)
    have = sorted((str(r.doc_id), r.score) for r in got if r.n_tokens < 5000)
    assert [a for a, _ in want] == [a for a, _ in have]
    assert all(abs(x - y) < 1e-3 * max(1, abs(x)) for (_, x), (_, y) in zip(want, have))


def test_lm_probabilities_sum_to_one():
    """Over all known words and one unknown word of each shape, in any context."""
    rng = random.Random(5)
    words = sorted({("".join(rng.choice("abcdé1.,") for _ in range(rng.randrange(1, 11)))).encode() for _ in range(300)} - {b""})
    counts = {w: rng.randrange(1, 50) for w in words} | {lm.END: 9}
    rows = [lm.Row(word=w, shape=lm.shape(w), c=c) for w, c in counts.items() if c > 5]
    tail = np.zeros(lm.SHAPES)
    for w, c in counts.items():
        tail[lm.shape(w)] += c if c <= 5 else 0
    vocabulary = lm.Vocabulary(rows, 20, tail)
    model = lm.LogBilinear(vocabulary.class_counts() + 1.0, vocabulary.families, vocabulary.member_counts)
    npr = np.random.default_rng(0)
    classes = npr.integers(0, len(vocabulary.class_counts()), (5000, 3))
    members = np.array([npr.integers(*vocabulary.families[c - vocabulary.top][1:]) if c >= vocabulary.top else -1 for c in classes[:, 2]])
    model.train(np.column_stack([classes, members]), npr)
    near, far, lnz = model.tables()
    for a, b in ((0, 3), (25, 1), (7, 30)):
        total = sum(float(np.exp(near[b, c] + far[a, c] - lnz[a, b])) for c in range(vocabulary.top))
        for c, s, e in vocabulary.families:
            inside = np.exp(model.members_ln(np.full(e - s, a), np.full(e - s, b), np.arange(s, e))).sum()
            assert abs(inside - 1) < 1e-3
            total += float(np.exp(near[b, c] + far[a, c] - lnz[a, b])) * inside
        assert abs(total - 1) < 1e-3


@pytest.mark.parametrize("copy_tokens", [2_000_000, 5_000])
def test_lm_does_not_depend_on_partitions(docs, monkeypatch, copy_tokens):
    """One copy of the model or several: the same scores however the rows are dealt."""
    monkeypatch.setattr(lm, "COPY_TOKENS", copy_tokens)
    runs = [sorted((str(r.doc_id), r.n_tokens, r.score, r.base_score) for r in lm.score(docs.repartition(n)).collect()) for n in (2, 9)]
    for x, y in zip(*runs):
        assert x[:2] == y[:2] and abs(x[2] - y[2]) <= 1e-4 * abs(x[2]) + 1e-6 and abs(x[3] - y[3]) < 1e-6 * abs(x[3]) + 1e-9


def kn_reference(train_texts, text):
    """Interpolated modified Kneser-Ney by dictionaries, for one text."""
    from collections import Counter

    words = [t.encode().split() for t in train_texts]
    often = {w for w, c in Counter(w for t in words for w in t).items() if c > 1}
    name = lambda w: w if w in often else kneser_ney.shape(w)
    s, e = kneser_ney.START, kneser_ney.END
    tri = Counter(g for t in words for x in [[s, s, *map(name, t), e]] for g in zip(x, x[1:], x[2:]))
    bi = Counter((v, w) for _, v, w in tri)
    uni = Counter(w for _, w in bi)

    def cuts(c):
        n = Counter(c.values())
        if not (n[1] and n[2] and n[3]):
            return 0.5, 1.0, 1.5
        y = n[1] / (n[1] + 2 * n[2])
        return [min(max(k + 1 - (k + 2) * y * n[k + 2] / n[k + 1], 0.05), k + 1.0) for k in range(3)]

    d3, d2, d1 = cuts(tri), cuts(bi), cuts(uni)
    cut = lambda c, d: 0 if not c else d[min(c, 3) - 1]
    size = 2 + len(kneser_ney.SHAPES) + len(often)
    mass = sum(cut(c, d1) for c in uni.values())
    p1 = lambda w: (uni[w] - cut(uni[w], d1)) / sum(uni.values()) + mass / sum(uni.values()) / size

    def p2(v, w):
        c = {k: n for k, n in bi.items() if k[0] == v}
        t = sum(c.values())
        return (bi[v, w] - cut(bi[v, w], d2)) / t + sum(cut(n, d2) for n in c.values()) / t * p1(w) if t else p1(w)

    def p3(u, v, w):
        c = {k: n for k, n in tri.items() if k[:2] == (u, v)}
        t = sum(c.values())
        return (tri[u, v, w] - cut(tri[u, v, w], d3)) / t + sum(cut(n, d3) for n in c.values()) / t * p2(v, w) if t else p2(v, w)

    x = [s, s, *map(name, text.encode().split()), e]
    return sum(math.log10(p3(*g)) for g in zip(x, x[1:], x[2:]))


def test_kneser_ney_matches_dictionaries(spark):
    from foliospark.llm.common import Scratch

    rng = random.Random(8)
    texts = [sentences(rng, rng.randrange(3, 40)) + rng.choice(["", f" odd{i}", " Big,"]) for i in range(60)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select(F.col("text").cast("binary"))
    model = kneser_ney.train(frame, Scratch(spark, "kn"))
    tests = ["the cat sat on the dog .", "", "zebra ### the", "old old old", texts[0]]
    got, n = model.log10([t.encode() for t in tests])
    assert list(n) == [len(t.split()) + 1 for t in tests]
    assert np.allclose(got, [kn_reference(texts, t) for t in tests], atol=1e-5)


def test_classifier_keeps_clean_and_drops_noise(spark):
    rng = random.Random(4)
    noise = lambda: " ".join("".join(rng.choice("#$%&*") for _ in range(4)) + str(rng.random()) for _ in range(40))
    rows = [(i, sentences(rng, rng.randrange(20, 90)), "en") for i in range(400)] + [(1000 + i, noise(), "en") for i in range(30)] + [(2000, None, None), (2001, "", "xx"), (None, "the cat", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = docs.filter("doc_id < 300").select("doc_id")
    got = kneser_ney.classify(docs, trusted, carry=docs["doc_id"]).collect()
    assert len(got) == len(rows)
    assert sum(r.keep for r in got if (r.doc_id or 0) < 1000) >= 395
    assert not any(r.keep for r in got if 1000 <= (r.doc_id or 0) < 2000)
    assert all(r.carried == r.doc_id for r in got)
    nobody = kneser_ney.classify(docs, trusted.limit(0)).collect()
    assert len(nobody) == len(rows) and all(r.keep for r in nobody)
    assert kneser_ney.classify(docs.limit(0), trusted).count() == 0


def test_classifier_bounds_its_sample_and_handles_odd_rows(spark, docs):
    """Whole documents in hash order up to the bound train; clashing columns, repeats and long texts pass."""
    sample = spark.createDataFrame([(i, "x" * 10) for i in range(50)] + [(50, "y" * 500)], "doc_id long, text string")
    chosen = {r.doc_id for r in kneser_ney.bounded(sample, 300).collect()}
    assert 0 < len(chosen) <= 30 and chosen == {r.doc_id for r in kneser_ney.bounded(sample.repartition(7), 300).collect()}
    assert kneser_ney.bounded(sample, 10**9).count() == 51 and kneser_ney.bounded(sample, 0).count() == 0
    trusted = docs.filter("doc_id >= 100").select("doc_id")
    got = kneser_ney.classify(docs, trusted).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in table_rows())
    repeated = [(r.n_tokens, r.log_perplexity, r.keep) for r in got if r.doc_id == 3]
    assert len(repeated) == 3 and len(set(repeated)) == 1
    assert max(r.n_tokens for r in got) == 30_001


def test_threshold_is_the_quantile_of_documents_outside_the_sample(spark):
    """Against sorted perplexities; slack 1 is the quantile itself."""
    rng = random.Random(12)
    docs = spark.createDataFrame([(i, sentences(rng, rng.randrange(20, 60)), "en" if i < 300 else "de") for i in range(500)], "doc_id long, text string, lang string")
    got = kneser_ney.classify(docs, docs.select("doc_id"), quantile=0.9, slack=1.0, chars=2000).collect()
    for lang in ("en", "de"):
        own = [r for r in got if r.lang == lang]
        (cut,) = {r.threshold for r in own}
        # The few training documents lie in the same range, so the share below the cut is the quantile.
        assert abs(sum(r.log_perplexity <= cut for r in own) / len(own) - 0.9) < 0.05
        assert cut in {r.log_perplexity for r in own}
        assert all(r.keep == (r.log_perplexity <= cut) for r in own)


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(tokenizer_file("piece_bpe_32k.model"))


def varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def as_unigram(blob):
    """The model file with its type set to unigram; the library's own Viterbi then checks ours."""

    def fields(b):
        i = 0
        while i < len(b):
            start, key, shift = i, 0, 0
            while True:
                key |= (b[i] & 127) << shift
                shift += 7
                i += 1
                if b[i - 1] < 128:
                    break
            kind, begin = key & 7, i
            if kind == 0:
                while b[i] >= 128:
                    i += 1
                i += 1
            elif kind == 2:
                n = shift = 0
                while True:
                    n |= (b[i] & 127) << shift
                    shift += 7
                    i += 1
                    if b[i - 1] < 128:
                        break
                begin, i = i, i + n
            else:
                i += 4 if kind == 5 else 8
            yield key >> 3, b[start:i], b[begin:i]

    out = b""
    for number, whole, body in fields(blob):
        if number == 2:
            body = b"".join(w for n, w, _ in fields(body) if n != 3) + varint(3 << 3) + varint(1)
            whole = varint(2 << 3 | 2) + varint(len(body)) + body
        out += whole
    return out


def test_pieces_match_the_library(codec):
    import sentencepiece

    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        sp = sentencepiece.SentencePieceProcessor(model_proto=as_unigram(f.read()))
    rng = random.Random(1)
    texts = [t for t in ODD if t and len(t) < 5000 and "x" * 99 not in t] + ["two  spaces", " lead", "trail ", "a\n\nb\n c", "tab\tx", "▁mark"]
    texts += ["".join(rng.choice("abcdefgh éü  \n.,日😀") for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    for t in texts:
        want = sp.encode(t)
        got = codec.encode(t)
        score = lambda ids: sum(codec.scores[i] if not sp.is_byte(i) else 0 for i in ids)
        assert got == want or (score(got) == score(want) and len(got) == len(want)), t


def test_pieces_round_trip(docs, codec):
    coded = sentencepiece_codec.encode(docs, codec)
    back = sentencepiece_codec.decode(coded, codec).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(a), b or "") for a, b, *_ in table_rows())
    got = sentencepiece_codec.digest(docs, codec).collect()
    assert all(r.round_trip for r in got) and len(got) == len(table_rows())
    ids = sorted((str(r.doc_id), len(r.ids), zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())) for r in coded.collect())
    assert sorted((str(r.doc_id), r.n_ids, r.ids_crc32) for r in got) == ids


def test_best_path_is_best(codec):
    """Against every segmentation of short strings."""
    pieces = {codec.surface[i].decode("utf-8", "ignore").replace(" ", "▁"): codec.scores[i] for i in range(len(codec.scores)) if codec.surface[i] and i not in codec.byte_ids}

    def best(t):
        if not t:
            return 0.0
        return max((pieces[t[:n]] + best(t[n:]) for n in range(1, len(t) + 1) if t[:n] in pieces), default=-math.inf)

    for w in ("▁cat", "▁undo", "abcab", "▁the"):
        assert sum(codec.scores[i] for i in codec.best_path(w)) == best(w)


def test_edit_tree_equals_full_encoding():
    count = edit_counts.counter(JSON, RANKS)
    rng = random.Random(6)
    alphabet = ["the", " cat", "  ", "\n", "'s", " 12", "é", "!!", " ", "日本", "\t", "x"]
    for turn in range(60):
        text = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 60, 900])))
        tree = edit_counts.SegmentTree(text, count)
        for _ in range(12):
            a, d = rng.randrange(-2, len(text) + 3), rng.choice([0, 0, 1, 3, 40, 2000])
            new = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 30])))
            tree.edit(a, d, new)
            a = min(max(a, 0), len(text))
            text = text[:a] + new + text[a + d :]
            want = edit_counts.SegmentTree(text, count)
            assert tree.text == text and tree.total == want.total == len(count.encode(text))
            assert tree.to_bytes() == want.to_bytes()


def test_long_text_re_encodes_little():
    tree = edit_counts.SegmentTree("some words here. " * 20_000, edit_counts.counter(JSON, RANKS))
    tree.edit(150_000, 3, "else")
    assert tree.reencoded < 100


def test_edit_frame(docs):
    edit = F.array(F.struct(F.lit(1).cast("long").alias("start"), F.lit(2).cast("long").alias("delete"), F.lit(" new").alias("insert")))
    edits = F.when(F.col("doc_id") % 2 == 0, edit)
    first = edit_counts.count_edited(docs, edits, JSON, RANKS)
    encode = edit_counts.counter(JSON, RANKS).encode
    want = []
    for a, b, *_ in table_rows():
        b = b or ""
        after = b[:1] + " new" + b[3:] if a is not None and a % 2 == 0 else b
        want.append((str(a), len(encode(b)), len(encode(after)), len(after)))
    assert sorted((str(r.doc_id), r.tokens_before, r.tokens_after, r.n_chars) for r in first.collect()) == sorted(want)
    again = edit_counts.count_edited(first, F.lit(None), JSON, RANKS, tree_col="tree")
    assert sorted((str(r.doc_id), r.tokens_before) for r in again.collect()) == sorted((a, n) for a, _, n, _ in want)


def test_kept_trees_are_read_again(docs, monkeypatch):
    """Edits of kept documents re-encode what they touch only, and count like full encoding."""
    kept = edit_counts.keep_trees(docs, JSON, RANKS)
    # Clashing columns of the input are gone, the kept tree is what its text gives.
    assert kept.columns == ["doc_id", "text", "tree"]
    count = edit_counts.counter(JSON, RANKS)
    assert all(bytes(r.tree) == edit_counts.SegmentTree(r.text, count).to_bytes() for r in kept.collect())
    edit = F.array(F.struct((F.length("text") / 2).cast("long").alias("start"), F.lit(1).cast("long").alias("delete"), F.lit(" new").alias("insert")))
    got = edit_counts.count_edited(kept, edit, JSON, RANKS, tree_col="tree", digest=True).collect()
    want = []
    for a, b, *_ in table_rows():
        b = b or ""
        at = len(b) // 2
        after = b[:at] + " new" + b[at + 1 :]
        want.append((str(a), len(count.encode(b)), len(count.encode(after)), len(after)))
    assert sorted((str(r.doc_id), r.tokens_before, r.tokens_after, r.n_chars) for r in got) == sorted(want)
    assert all(r.reencoded_chars < 100 for r in got if r.n_chars > 100_000)
    assert edit_counts.keep_trees(docs.limit(0), JSON, RANKS).count() == 0


def test_classifier_counts_all_trusted_text_of_its_half(spark, tmp_path, monkeypatch):
    """Sharded scores equal those of dictionaries over every trusted document of the training half, however many there are."""
    rng = random.Random(21)
    rows = [(i, sentences(rng, rng.randrange(3, 25)) + rng.choice(["", f" odd{i}", " Big,"]), "en") for i in range(2600)] + [(5000, None, None), (5001, "zebra ### the", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    trusted = docs.filter("doc_id < 2600").select("doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / (1 << 20) < 0.5
    texts = [r.text for r in docs.filter(half & (F.col("doc_id") < 2600)).collect()]
    assert len(texts) > 1200
    got = {r.doc_id: r for r in kneser_ney.classify(docs, trusted).collect()}
    assert len(got) == len(rows)
    for i, text in [(5000, ""), (5001, rows[-1][1]), *[(i, rows[i][1]) for i in range(0, 2600, 650)]]:
        assert got[i].n_tokens == len(text.split()) + 1
        assert abs(-got[i].log_perplexity * got[i].n_tokens - kn_reference(texts, text)) < 1e-5 * got[i].n_tokens


def test_thresholds_are_exact_for_any_number_of_languages(spark):
    """Values of rank ceil(q n) of each language, more of them than had a threshold of their own before."""
    rng = random.Random(5)
    rows = [(f"l{i % 211}", rng.random()) for i in range(211 * 60)] + [("big", rng.random()) for _ in range(40_000)]
    held = spark.createDataFrame(rows, "lang string, x double")
    got = {r.lang: r for r in kneser_ney.quantiles(held, "lang", "x", 0.9).collect()}
    assert len(got) == 212
    for lang, r in got.items():
        own = sorted(x for a, x in rows if a == lang)
        assert r.n == len(own) and r.cut == own[math.ceil(0.9 * len(own)) - 1]
