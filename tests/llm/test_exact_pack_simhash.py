"""Exact dedup, packing and SimHash against plain Python on a fixture with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from foliospark.llm import exact_dedup as exact
from foliospark.llm import packing, simhash
from foliospark.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, fp long, uid long, part long, norm string"
JSON, RANKS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken")


def rows():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "délta", "Ωmega", "x", "the", "of"]
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "ab"), (6, " a\nb "), (7, "A b"), (8, "a b"), (9, "<|endoftext|> tail"), (None, "ab"), (4, "a b"), (10, "one two")]
    for i in range(20, 60):
        out.append((i, " ".join(rng.choice(words) + rng.choice(["", ".", "\n", "  "]) for _ in range(rng.randrange(1, 300)))))
    out += [(100 + i, out[15][1]) for i in range(5)] + [(200, "long " * 40_000)]
    return [(a, b, "en", 0, 0, 0, "clash") for a, b in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs):
    groups = {}
    for a, b, *_ in rows():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", b or ""), []).append((-len(b or ""), 2**63 if a is None else a, a))
    want = sorted(
        (str(a), str(min(g)[2]), len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for *_, a in g
    )
    got = exact.exact_dedup(docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_golomb_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 100, 5000):
        values = np.unique(rng.integers(0, 2**60, n, dtype=np.uint64))
        k = exact.rice_parameter(n, 2**60)
        assert np.array_equal(exact.golomb_decode(exact.golomb_encode(values, k), len(values), k), values)
    small = np.array([0, 1, 5, 9], dtype=np.uint64)
    assert np.array_equal(exact.golomb_decode(exact.golomb_encode(small, 0), 4, 0), small)


def test_packing(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(JSON)
    ids = sorted((str(a), tuple(tok.encode(b or "", add_special_tokens=False).ids) + (0,)) for a, b, *_ in rows())
    got = packing.pack(docs, JSON, RANKS, window=256, with_ids=True).collect()
    by_seq, by_doc = {}, {}
    for r in got:
        piece = np.frombuffer(bytes(r.ids), dtype="<u4")
        assert len(piece) == r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.sequence_id, r.offset), (r.doc_id, r.start, r.doc_tokens, piece))
    for s, parts in by_seq.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == 256 or s == max(by_seq)
    docs_back, held = [], []
    for key in sorted(by_doc):
        doc, start, total, piece = by_doc[key]
        assert start == sum(map(len, held))
        held.append(piece)
        if start + len(piece) == total:
            docs_back.append((str(doc), tuple(np.concatenate(held).tolist())))
            held = []
    assert not held and sorted(docs_back) == ids


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(pairs):
    low = {f: f for f in {f for _, f in pairs}}
    changed = True
    while changed:
        changed = False
        for x in low:
            for y in low:
                if (x ^ y).bit_count() <= 2 and low[y] < low[x]:
                    low[x], changed = low[y], True
    ids = {}
    for d, f in pairs:
        if d is not None:
            ids[low[f]] = min(ids.get(low[f], d), d)
    return sorted((str(d), f"{f:016x}", str(ids.get(low[f]))) for d, f in pairs)


def test_simhash(docs):
    pairs = [(a, brute_fingerprint(b)) for a, b, *_ in rows()]
    got = simhash.simhash_components(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == brute_components(pairs)


@pytest.mark.parametrize("hot", [20_000, 40])
def test_near_edges_reach_every_link(spark, hot):
    """Dense clusters, with and without dealing hot buckets out again."""
    from foliospark.llm.common import Scratch
    from foliospark.llm.components import connected_components

    rng = np.random.default_rng(3)
    words = []
    for _ in range(12):
        w = int(rng.integers(0, 2**63))
        for _ in range(40):
            words.append(w)
            for b in rng.integers(0, 64, rng.integers(1, 3)):
                w ^= 1 << int(b)
    words = sorted(set(words))
    df = spark.createDataFrame([(w - 2**64 if w >= 2**63 else w,) for w in words], "fp long")
    scratch = Scratch(spark, "t")
    comp = {r.node: r.root for r in connected_components(simhash.near_edges(df, scratch, hot=hot), scratch).collect()}
    got = {}
    for w in words:
        s = w - 2**64 if w >= 2**63 else w
        got.setdefault(comp.get(s, s), set()).add(w)
    want = {}
    for d, _, c in brute_components([(w, w) for w in words]):
        want.setdefault(c, set()).add(int(d))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = rng.choice(["new", "other", "third"]) + str(rng.randrange(999))
    return out


@pytest.mark.parametrize("bits", [4, 12])
def test_similar_components(spark, bits, monkeypatch):
    """Near copies by five-word shingles against brute force over the fingerprints; a third of all rows is one dense group."""
    monkeypatch.setattr(simhash, "SAMPLE_BITS", bits)
    monkeypatch.setattr(simhash, "SMALL", 16)
    rng = random.Random(7)
    texts = []
    for _ in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 400))]
        texts += [" ".join(words), " ".join(edited(rng, words, len(words) // 60))]
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts += [" ".join(edited(rng, base, 2)) for _ in range(60)] + [None, "", " ", "one", "one"]
    df = spark.createDataFrame([(i % 50, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, fp string").repartition(5)
    got = {}
    for r in simhash.similar_components(df, carry=df["text"]).collect():
        got.setdefault(r.root, []).append(str(r.carried))
    prints = [simhash.wide_fingerprint((t or "").encode().lower().split(), 5) for t in texts]
    words = np.array([np.frombuffer(p, dtype=np.uint64) for p in prints])
    near = np.bitwise_count(words[:, None, :] ^ words[None, :, :]).sum(2) <= 51
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        low = [min(root[j] for j in np.flatnonzero(near[i])) for i in range(len(texts))]
        if low == root:
            break
        root = low
    want = {}
    for t, r in zip(texts, root):
        want.setdefault(r, []).append(str(t))
    whole = sorted(map(sorted, want.values()))
    found = sorted(map(sorted, got.values()))
    assert sorted(sum(found, [])) == sorted(map(str, texts))
    # Nothing unlike is linked; of what is alike at most a tenth is missed.
    names = {x: i for i, g in enumerate(whole) for x in g}
    assert all(len({names[x] for x in g}) == 1 for g in found)
    assert len(found) - len(whole) <= 0.1 * (len(texts) - len(whole))
    assert max(map(len, found)) >= 60
    assert simhash.similar_components(df.limit(0)).count() == 0


def test_wide_gray_index_matches_scan():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**64, (10, 4), dtype=np.uint64)
    words = np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, (10, 4), dtype=np.uint64)) for _ in range(30)])
    words = words[np.argsort(words[:, 0])]
    a, b = simhash.GrayIndex(words, leaf=8).search(words, 8)
    x, y = np.nonzero(np.bitwise_count(words[:, None] ^ words[None, :]).sum(2) <= 8)
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(x.tolist(), y.tolist()))


def test_gray_index_matches_scan():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 20, dtype=np.uint64)
    words = np.unique(np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 20, dtype=np.uint64)) for _ in range(40)]))
    a, b = simhash.GrayIndex(words, leaf=8).search(words, 2)
    x, y = np.nonzero(np.bitwise_count(words[:, None] ^ words[None, :]) <= 2)
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(x.tolist(), y.tolist()))


def test_empty(empty):
    assert exact.exact_dedup(empty).count() == 0
    assert packing.pack(empty, JSON, RANKS).count() == 0
    assert simhash.simhash_components(empty).count() == 0
