"""Log-bilinear language model trained with noise-contrastive estimation.

Words are lower-cased (A-Z) runs of ``[^\\x20\\x09-\\x0D]``; one end token
closes each text.  Word counts cover the whole training side.  Output is
factored over classes: the ``TOP`` most frequent words are their own class, and
the other frequent words, as many as have a share ``SHARE`` of the tokens, form
families of one shape and like frequency, of ``FAMILY`` words or more if there are
over ``FAMILIES`` of them; so the number of classes grows with the vocabulary up to
a bound, and from there the families do.  With q the vector that the two words before
predict (``r1 C1 + r2 C2`` over class vectors),

    p(w | h) = p(class(w) | h) * p(w | class(w), h)

where both factors are log-bilinear in q: a softmax over all classes and one over
the members of the family.  The rarer words of a shape are one member of its last
family, shared out among them and one unknown word by ``(c + 1) / (N + V + 1)``, so
all known words and an unknown one for each shape have probabilities that sum to
one.  Training is NCE in numpy on both levels: a warm start on a bounded sample of
spans, then one pass over all tokens.  For it and for scoring each document is
coded once as numbers of words; codes are dealt by hash to one copy of the model for each ``COPY_TOKENS`` tokens; a copy takes
its documents in hash order, and the copies are averaged by tokens, in a tree of
merges.  So the model does not depend on partitions (but for the rounding of sums).  For
scoring, two class-by-class matrix products give all bilinear terms between
classes, batched products of all contexts give the exact normalisers, and batched
products over each family's members give its normaliser for each token.

Counts beyond the broadcast ones (at most ``1 / SHARE`` words can hold a share
``SHARE`` of the tokens) are joined by word hash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import Scratch

END = b"\n"  # holds white space, so no word equals it
TOP = 900
SHARE = 1 / 200_000
DIM = 24
NOISE = 24
BATCH = 2048
WARM_DOCS = 400
#: Tokens of the span, at a place chosen by hash, that a document of the warm sample gives.
WARM_SPAN = 700
#: Words of a family at least, and families of full size at most: beyond, families grow.
FAMILY = 64
FAMILIES = 200
FAMILY_NOISE = 16
FAMILY_BATCH = 1 << 17
FAMILY_RATE = 0.1
FAMILY_FLOOR = 1e-4
MERGE_WIDTH = 16
#: Tokens that one copy of the model trains on, about.
COPY_TOKENS = 2_000_000
FLUSH = 400_000
SHAPES = 4 * 2 * 3 + 1


def tokens(text: bytes) -> list[bytes]:
    out = text.lower().split()
    out.append(END)
    return out


def shape(word: bytes) -> int:
    """A class for infrequent words: digits, or last character, script and length."""
    if any(48 <= c <= 57 for c in word):
        return SHAPES - 1
    last = word[-1:]
    end = 1 if last == b"," else 2 if last == b"." else 0 if last.isalpha() or last >= b"\x80" else 3
    size = 0 if len(word) <= 5 else 1 if len(word) <= 9 else 2
    return (end * 2 + (not word.isascii())) * 3 + size


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts; flushed often enough to keep the dictionary small."""

    def out(held: Counter) -> pa.RecordBatch:
        words = list(held)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([shape(w) for w in words], pa.int32()), pa.array(list(held.values()), pa.int64())], names=["word", "shape", "c"])

    held: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update(tokens(text))
            if len(held) > FLUSH:
                yield out(held)
                held = Counter()
    if held:
        yield out(held)


class Codes(dict):
    """word -> index among the frequent words, or -(1 + shape); remembers a bounded number of others."""

    def __init__(self, frequent: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(frequent))
        self.room = len(frequent) + FLUSH

    def __missing__(self, word: bytes) -> int:
        code = -1 - shape(word)
        if len(self) < self.room:
            self[word] = code
        return code


def _sums(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices and the sums of their rows; 16-bit keys sort by radix."""
    order = np.argsort(index.astype(np.uint16), kind="stable")
    ranked = index[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    return ranked[starts], np.add.reduceat(values[order], starts, axis=0)


class LogBilinear:
    """Class vectors ``r``, two context matrices ``c1`` (nearer word) and ``c2``, bias ``b``; member vectors ``m`` and bias ``mb``.

    ``families`` are (class, first member, end) with the members' counts; members start at their unigram share.
    """

    def __init__(self, unigram: np.ndarray, families: list[tuple[int, int, int]] = [], member_counts: np.ndarray | None = None, dim: int = DIM, seed: int = 11):  # noqa: B006
        rng = np.random.default_rng(seed)
        n = len(unigram)
        self.noise = (unigram / unigram.sum()).astype(np.float64)
        self.params = [
            (rng.standard_normal((n, dim)) * 0.1).astype(np.float32),
            (np.eye(dim) * 0.5).astype(np.float32),
            (np.eye(dim) * 0.5).astype(np.float32),
            np.log(self.noise).astype(np.float32),
        ]
        self.squares = [np.full_like(p, 0.01) for p in self.params]
        self.lnkq = np.log(NOISE * self.noise).astype(np.float32)
        self.cut = np.cumsum(self.noise)
        self.families = families
        share = np.zeros(0) if member_counts is None else member_counts + 1.0
        for _, s, e in families:
            share[s:e] /= share[s:e].sum()
        self.share, self.starts = share, np.array([s for _, s, _ in families], dtype=np.int64)
        self.params += [np.zeros((len(share), dim), dtype=np.float32), np.log(share).astype(np.float32)]
        self.member_squares = np.full((len(share), 2), FAMILY_FLOOR, dtype=np.float32)
        self.member_lnkq = np.log(FAMILY_NOISE * share).astype(np.float32)

    def train(self, stream: np.ndarray, rng: np.random.Generator, rate: float = 0.05) -> None:
        """One NCE pass over (w2, w1, w) class rows in mini-batches that share their noise words; a fourth column names members (-1: none)."""
        for at in range(0, len(stream), BATCH):
            self._step(stream[at : at + BATCH], rng, rate)
        if stream.shape[1] > 3:
            for at in range(0, len(stream), FAMILY_BATCH):
                self._family_step(stream[at : at + FAMILY_BATCH], rng, FAMILY_RATE)

    def context(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        r, c1, c2 = self.params[:3]
        return (r @ c1)[near] + (r @ c2)[far]

    def _family_step(self, rows: np.ndarray, rng: np.random.Generator, rate: float) -> None:
        """NCE inside families: the noise of a word are members of its own family."""
        rows = rows[rows[:, 3] >= 0]
        rows = rows[np.argsort(rows[:, 3], kind="stable")]
        member = rows[:, 3]
        m, mb = self.params[4:]
        q = self.context(rows[:, 0], rows[:, 1])
        cuts = np.searchsorted(member, np.append(self.starts, len(m)))
        for f in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            a, b = cuts[f], cuts[f + 1]
            _, s, e = self.families[f]
            w, x = member[a:b], q[a:b]
            noise = s + np.searchsorted(np.cumsum(self.share[s:e]), rng.random(FAMILY_NOISE)).clip(0, e - s - 1)
            up = 1 / (1 + np.exp(np.clip(np.einsum("ij,ij->i", x, m[w]) + mb[w] - self.member_lnkq[w], -30, 30)))
            down = -1 / (1 + np.exp(-np.clip(x @ m[noise].T + (mb[noise] - self.member_lnkq[noise]), -30, 30)))
            first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            g, gb = np.zeros((e - s, x.shape[1]), dtype=np.float32), np.zeros(e - s, dtype=np.float32)
            g[w[first] - s] = np.add.reduceat(up[:, None] * x, first, axis=0)
            gb[w[first] - s] = np.add.reduceat(up, first)
            np.add.at(g, noise - s, down.T @ x)
            np.add.at(gb, noise - s, down.sum(0))
            g, gb = g / np.float32(b - a), gb / np.float32(b - a)
            self.member_squares[s:e, 0] += (g * g).mean(1)
            self.member_squares[s:e, 1] += gb * gb
            m[s:e] += np.float32(rate) * g / np.sqrt(self.member_squares[s:e, :1])
            mb[s:e] += np.float32(rate) * gb / np.sqrt(self.member_squares[s:e, 1])

    def _step(self, rows: np.ndarray, rng: np.random.Generator, rate: float) -> None:
        r, c1, c2, b = self.params[:4]
        far, near, word = rows[:, 0], rows[:, 1], rows[:, 2]
        noise = np.searchsorted(self.cut, rng.random(NOISE)).clip(0, len(b) - 1)
        rw, rz = r[word], r[noise]
        # Classes are few: products by the context matrices are taken once a class, not once a row.
        q = (r @ c1)[near] + (r @ c2)[far]
        up = 1 / (1 + np.exp(np.clip(np.einsum("ij,ij->i", q, rw) + b[word] - self.lnkq[word], -30, 30)))  # 1 - sigma
        down = -1 / (1 + np.exp(-np.clip(q @ rz.T + (b[noise] - self.lnkq[noise]), -30, 30)))  # -sigma
        dq = down @ rz
        dq += up[:, None] * rw
        near_at, near_sum = _sums(near, dq)
        far_at, far_sum = _sums(far, dq)
        word_at, word_sum = _sums(word, up[:, None] * q)
        g = np.zeros_like(r)
        g[near_at] += near_sum @ c1.T
        g[far_at] += far_sum @ c2.T
        g[word_at] += word_sum
        np.add.at(g, noise, down.T @ q)
        gb = np.bincount(word, weights=up, minlength=len(b)) + np.bincount(noise, weights=down.sum(0), minlength=len(b))
        for i, grad in enumerate((g, r[near_at].T @ near_sum, r[far_at].T @ far_sum, gb.astype(np.float32))):
            grad = grad * np.float32(1 / len(rows))
            self.squares[i] += grad * grad
            self.params[i] += np.float32(rate) * grad / np.sqrt(self.squares[i])

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(near, far, lnz): ln p(w | far, near) = near[near, w] + far[far, w] - lnz[far, near]; the bias is inside near."""
        r, c1, c2, b = self.params[:4]
        near = (r @ c1) @ r.T + b
        far = (r @ c2) @ r.T
        lnz = np.empty_like(far)
        for f in range(len(r)):  # all contexts that begin with f in one batch
            s = near + far[f]
            top = s.max(axis=1, keepdims=True)
            lnz[f] = top[:, 0] + np.log(np.exp(s - top).sum(axis=1))
        return near, far, lnz


    def members_ln(self, far: np.ndarray, near: np.ndarray, member: np.ndarray) -> np.ndarray:
        """ln p(member | its family, context) of each row: batched products over all members of a family."""
        m, mb = self.params[4:]
        r1, r2 = self.params[0] @ self.params[1], self.params[0] @ self.params[2]
        out = np.empty(len(member), dtype=np.float32)
        order = np.argsort(member, kind="stable")
        cuts = np.searchsorted(member[order], np.append(self.starts, len(m)))
        for f in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            _, s, e = self.families[f]
            for at in range(cuts[f], cuts[f + 1], 8192):
                rows = order[at : min(at + 8192, cuts[f + 1])]
                x = (r1[near[rows]] + r2[far[rows]]) @ m[s:e].T + mb[s:e]
                top = x.max(axis=1)
                out[rows] = x[np.arange(len(rows)), member[rows] - s] - top - np.log(np.exp(x - top[:, None]).sum(axis=1))
        return out


class Vocabulary:
    """The broadcast part: frequent words with counts, classes and members of families."""

    def __init__(self, rows, top: int, tail: np.ndarray | None = None):
        """``tail`` holds, for each shape, the tokens of words that are not in ``rows``."""
        rows = sorted(rows, key=lambda x: (-x.c, x.word)) or [Row(word=END, shape=shape(END), c=0)]
        self.words = [bytes(x.word) for x in rows]
        self.counts = np.array([x.c for x in rows], dtype=np.int64)
        self.top = min(top, len(rows))
        self.classes, self.members = np.arange(len(rows)), np.full(len(rows), -1)
        self.tail_class, self.tail_member = np.zeros(SHAPES, dtype=np.int64), np.zeros(SHAPES, dtype=np.int64)
        self.families: list[tuple[int, int, int]] = []
        counts: list[float] = []
        by_shape: list[list[int]] = [[] for _ in range(SHAPES)]
        for i in range(self.top, len(rows)):
            by_shape[rows[i]["shape"]].append(i)
        width = max(FAMILY, -(-(len(rows) - self.top) // FAMILIES))
        for k, own in enumerate(by_shape):
            # Words of like frequency share a family; the last one has the tail, too.
            for at in range(0, max(1, len(own)), width):
                part, start, name = own[at : at + width], len(counts), self.top + len(self.families)
                for i in part:
                    self.classes[i], self.members[i] = name, len(counts)
                    counts.append(float(self.counts[i]))
                if at + width >= len(own):
                    self.tail_class[k], self.tail_member[k] = name, len(counts)
                    counts.append(0.0 if tail is None else float(tail[k]))
                self.families.append((name, start, len(counts)))
        self.member_counts = np.array(counts)
        place = self.words.index(END) if END in self.words else 0
        self.end, self.end_count = int(self.classes[place]), int(self.counts[place])

    def class_counts(self) -> np.ndarray:
        return np.concatenate([self.counts[: self.top], [self.member_counts[s:e].sum() for _, s, e in self.families]])

    def outputs(self, got: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(classes, members or -1) of places among the frequent words or -(1 + shape)."""
        rare, known = -1 - np.minimum(got, -1), np.maximum(got, 0)
        return np.where(got < 0, self.tail_class[rare], self.classes[known]), np.where(got < 0, self.tail_member[rare], self.members[known])

    def contexts(self, codes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows of two classes before, class and member; codes; first row of each document); documents begin behind end tokens."""
        sizes = np.array([len(c) // 4 for c in codes])
        got = np.frombuffer(b"".join(codes), dtype="<i4")
        starts = np.cumsum(sizes) - sizes
        rows = np.empty((len(got), 4), dtype=np.int32)
        rows[:, 2], rows[:, 3] = self.outputs(got)
        rows[1:, 1] = rows[:-1, 2]
        rows[starts, 1] = self.end
        rows[1:, 0] = rows[:-1, 1]
        rows[starts, 0] = self.end
        return rows, got, starts


def _code(vocabulary: Vocabulary):
    """Reads every text once: its codes, tokens, those known so far, sum of logarithms of counts, and hashes and numbers of rarer words."""
    log_c1 = np.log10(vocabulary.counts + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(vocabulary.words)
        hashed = xxhash.xxh64_intdigest
        for batch in batches:
            blobs, n_tokens, n_known, base, hashes, counts = [], [], [], [], [], []
            for text in batch.column(3).to_pylist():
                toks = tokens(text)
                got = np.fromiter(map(codes.__getitem__, toks), dtype=np.int32, count=len(toks))
                blobs.append(got.astype("<i4").tobytes())
                n_tokens.append(len(toks))
                known = got[got >= 0]
                n_known.append(int((vocabulary.counts[known] > 0).sum()))
                base.append(float(log_c1[known].sum()))
                tail = Counter([toks[i] for i in np.flatnonzero(got < 0).tolist()])
                hashes.append(np.fromiter((hashed(w, 42) for w in tail), dtype=np.uint64, count=len(tail)).view(np.int64))
                counts.append(list(tail.values()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(blobs, pa.binary()), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(hashes, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32()))],
                names=["doc_id", "id", "held_out", "codes", "n_tokens", "n_known", "base", "h", "n"],
            )

    return run


CODED = "doc_id long, id string, held_out boolean, codes binary, n_tokens long, n_known long, base double, h array<long>, n array<int>"


def _train(model: LogBilinear, vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (copy, codes) with each copy's rows together."""
        import copy

        name, own, rng, seen, held, size = None, None, None, 0, [], 0

        def learn() -> None:
            nonlocal seen, held, size
            if held:
                rows = vocabulary.contexts(held)[0]
                own.train(rows[rng.permutation(len(rows))], rng, 0.1)
                seen, held, size = seen + size, [], 0

        def finished() -> pa.RecordBatch:
            learn()
            flat = np.concatenate([p.ravel() for p in own.params]).astype(np.float64) * seen
            return pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([flat.astype("<f8").tobytes()], pa.binary())], names=["seen", "flat"])

        for batch in batches:
            for key, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != name:
                    if own is not None:
                        yield finished()
                    name, own, rng, seen, held, size = key, copy.deepcopy(model), np.random.default_rng(1), 0, [], 0
                held.append(blob)
                size += len(blob) // 4
                if size >= FAMILY_BATCH:
                    learn()
        if own is not None:
            yield finished()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen = None, 0
    for batch in batches:
        for n, flat in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = np.frombuffer(flat, dtype="<f8")
            total, seen = (x.copy() if total is None else total + x), seen + n
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["seen", "flat"])


def fit(train: DataFrame, vocabulary: Vocabulary, unigram: np.ndarray, scratch: Scratch) -> LogBilinear:
    """Warm start on a span of at most WARM_SPAN tokens of about WARM_DOCS documents picked by hash, then one averaged pass over all of ``train`` (id, codes)."""
    model = LogBilinear(unigram, vocabulary.families, vocabulary.member_counts)
    turned = train.withColumn("turn", F.xxhash64("id", "codes"))
    # One end token closes each training document; a hash below this share picks about WARM_DOCS of them.
    share = WARM_DOCS / max(1, vocabulary.end_count)
    place = F.pmod(F.xxhash64("id", F.lit(6)), F.greatest(F.length("codes") / 4 - WARM_SPAN, F.lit(0)).cast("long") + 1)
    span = F.substring("codes", (place * 4 + 1).cast("int"), F.lit(4 * WARM_SPAN)).alias("codes")
    sample = turned.filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < share * (1 << 30)).select("turn", span).orderBy("turn").collect()
    rng = np.random.default_rng(0)
    if sample:
        rows = vocabulary.contexts([bytes(x.codes) for x in sample])[0]
        for _ in range(6):
            model.train(rows[rng.permutation(len(rows))], rng, 0.3)
    copies = max(1, -(-int(unigram.sum()) // COPY_TOKENS))
    dealt = turned.withColumn("copy", F.pmod("turn", F.lit(copies)).cast("int")).repartitionById(copies, "copy").sortWithinPartitions("copy", "turn").select("copy", "codes")
    parts = scratch.save(dealt.mapInArrow(_train(model, vocabulary), "seen long, flat binary"), "parts")
    # Copies are added up in a tree, so each task adds a fixed number and the driver gets one sum.
    width, level = parts.count(), 0
    while width > 1:
        width, level = -(-width // MERGE_WIDTH), level + 1
        parts = scratch.save(parts.repartition(width).mapInArrow(_merge, "seen long, flat binary"), f"merged-{level}")
    merged = parts.collect()
    if not merged:
        return model
    mean = sum(np.frombuffer(bytes(x.flat), dtype="<f8") for x in merged) / sum(x.seen for x in merged)
    at = 0
    for i, p in enumerate(model.params):
        model.params[i] = mean[at : at + p.size].reshape(p.shape).astype(np.float32)
        at += p.size
    return model


def _score(vocabulary: Vocabulary, model: LogBilinear, tables, tail_log: np.ndarray):
    near_t, far_t, lnz = tables

    def log10(codes: list[bytes]) -> np.ndarray:
        """The model's log10 probability of each document but for the counts of rarer words, which a join adds."""
        rows, got, starts = vocabulary.contexts(codes)
        far, near, word, member = rows.T
        ln = (near_t[near, word] + far_t[far, word] - lnz[far, near]).astype(np.float64)
        inside = np.flatnonzero(member >= 0)
        ln[inside] += model.members_ln(far[inside], near[inside], member[inside])
        ln /= np.log(10)
        rare = np.flatnonzero(got < 0)
        ln[rare] -= tail_log[-1 - got[rare]]
        return np.add.reduceat(ln, starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, lm, at = batch.column(1).to_pylist(), [], 0
            while at < len(codes):
                end, size = at, 0
                while end < len(codes) and (end == at or size < FLUSH):
                    size += len(codes[end]) // 4
                    end += 1
                lm.append(log10(codes[at:end]))
                at = end
            if lm:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(lm))], names=["uid", "lm"])

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_fold: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Rows whose crc32(id as text) mod ``folds`` is ``held_fold`` are held out;
    a null id counts as the empty text.  Null text counts as empty (its only
    token is the end).  Without training rows every word is unknown.  Repeated
    rows train and are scored once each; an empty table gives an empty result;
    extra columns are not read; texts of any length are taken whole.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    ident = F.coalesce(docs[id_col].cast("string"), F.lit(""))
    picked = docs.select(
        docs[id_col].cast("long").alias("doc_id"), (F.crc32(ident.cast("binary")) % folds == held_fold).alias("held_out"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"), ident.alias("id")
    )
    train = picked.filter(~F.col("held_out"))
    counted = train.select("text").mapInArrow(_count, "word binary, shape int, c long")
    counted = scratch.save(counted.groupBy("word", "shape").agg(F.sum("c").alias("c")).select("word", "shape", "c", F.xxhash64("word").alias("h")), "counts")
    by_shape = counted.groupBy("shape").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    n_all, v_all = sum(x.n for x in by_shape), sum(x.v for x in by_shape)
    floor = max(2, int(np.ceil(n_all * SHARE)))
    frequent = (F.col("c") >= floor) | (F.col("word") == F.lit(END))
    rows = counted.filter(frequent).select("word", "shape", "c").collect()
    n_tail, v_tail = np.zeros(SHAPES), np.zeros(SHAPES)
    for x in by_shape:
        n_tail[x["shape"]], v_tail[x["shape"]] = x.n, x.v
    for x in rows:
        n_tail[x["shape"]] -= x.c
        v_tail[x["shape"]] -= 1
    vocabulary = Vocabulary(rows, TOP, n_tail)
    # A class that the training side never shows still gets one pseudo-count.
    coded = scratch.save(picked.select("doc_id", "id", "held_out", "text").mapInArrow(_code(vocabulary), CODED).withColumn("uid", F.monotonically_increasing_id()), "coded")
    model = fit(coded.filter(~F.col("held_out")).select("id", "codes"), vocabulary, vocabulary.class_counts() + 1.0, scratch)
    tail_log = np.log10(n_tail + v_tail + 1)

    scored = scratch.save(coded.select("uid", "codes").mapInArrow(_score(vocabulary, model, model.tables(), tail_log), "uid long, lm double"), "scored")
    tail = coded.select("uid", F.explode(F.arrays_zip("h", "n")).alias("t")).select("uid", "t.h", "t.n")
    counts = counted.filter(~frequent).select("h", "c")
    joined = tail.join(counts, "h", "left").groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("tail_log"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("tail_known")
    )
    none = F.lit(0)
    out = coded.select("uid", "doc_id", "held_out", "n_tokens", "n_known", "base").join(scored, "uid").join(joined, "uid", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", none)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_log", none) - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))).alias("base_score"),
        (F.col("lm") + F.coalesce("tail_log", none)).alias("score"),
    )
