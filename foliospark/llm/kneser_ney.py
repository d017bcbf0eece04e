"""Quality classifier: interpolated modified Kneser-Ney trigram model of trusted text.

Counts, continuation counts and discounts are DataFrame aggregations whose
rows are sharded by n-gram.  The trusted documents are split in two by a hash of
their id: one half gives all counts, the other all thresholds, and no document of
either is left out, so the tables grow with the corpus and stay sharded.

The log probability of a text is a sum over its n-grams.  With all back-off
weights written into the n-grams they belong to, a token t of context (u, v) adds
A[t] (unigrams, known to every task), B[v, t] and C[u, v, t], and an n-gram that
training has not seen adds nothing.  So each token of a document becomes one
entry, dealt to the shard of (v, t), where the sorted entries of many documents
meet the shard's sorted tables; what comes back are sums for each document.
Entries travel as sorted, difference-coded blocks.  Sums are of integers
(2^-30 of a decade), so they do not depend on any order.

The vocabulary (words seen twice or more in training) is known to every task.

A document is rejected when its perplexity lies above a quantile of its
language's trusted documents outside the training half.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, dealt, shuffle_partitions, squeeze, unsqueeze

START, END, SHAPE = b"\x01 ", b"\x02 ", b"\x03 "  # hold a space, so no word equals them
#: Words and shapes that a worker remembers at most.
MEMORY = 600_000
#: Share of the trusted documents that gives the counts; the rest gives the thresholds.
TRAIN_SHARE = 0.5
QUANTILE = 0.995
SLACK = 1.05
LEAST = 50
#: Accuracy of the sketch that brackets a quantile.
SKETCH = 10_000
#: Prime above any number of words: a pair of words is first * PRIME + second.
PRIME = (1 << 31) - 1
#: Unit of the summed logarithms.
UNIT = float(1 << 30)
#: Documents of a chunk at most; tokens of a chunk, about; n-grams of the model dealt at once; sums that a task holds.
BLOCK, TOKENS, PACKED, HELD = 8192, 1_500_000, 1 << 20, 1 << 23
#: Parts in which documents are scored, one after the other.
ROUNDS = 5
PAIRS, CONTEXTS, TRIPLES, ENTRIES, DOCUMENTS = range(5)


def words(text: bytes) -> list[bytes]:
    return text.split()


def shape(word: bytes) -> bytes:
    """The class that stands for a word seen once or never: kinds of characters, case, ending and length."""
    text = word.decode("utf-8", "replace")
    core = text.rstrip(".,")
    if core.isalpha():
        kind = b"l" if core.islower() else b"T" if core[1:].islower() or len(core) == 1 else b"U" if core.isupper() else b"m"
    elif core.isdigit():
        kind = b"d"
    elif core.isalnum():
        kind = b"n"
    else:
        kind = b"s" if any(c.isalpha() for c in core) else b"p"
    return SHAPE + kind + b"%d%d" % (len(text) - len(core) > 0, min(len(core) // 4, 3))


SHAPES = [SHAPE + bytes([k]) + b"%d%d" % (e, n) for k in b"lTUmdnsp" for e in (0, 1) for n in range(4)]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: Counter = Counter()
        for text in batch.column(0).to_pylist():
            held.update(words(text))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["w", "c"])


class Ids(dict):
    """word -> number; other words by their shape.  Remembers a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        n = self[shape(word)]
        if len(self) < MEMORY:
            self[word] = n
        return n


def _grams(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids((w, i) for i, w in enumerate(shared.value))
        for batch in batches:
            held: Counter = Counter()
            for text in batch.column(0).to_pylist():
                w = [0, 0, *map(ids.__getitem__, words(text)), 1]
                held.update(zip(w, w[1:], w[2:]))
            if held:
                grams = np.array(list(held), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(grams[:, i])) for i in range(3)), pa.array(list(held.values()), pa.int64())], names=["u", "v", "w", "c"])

    return run


def discounts(counts: DataFrame, col: str = "c") -> tuple[float, float, float]:
    """D1, D2, D3+ by the closed form from the counts of counts; plain 0.5, 1, 1.5 where those are zero."""
    n = {int(r[col]): r["n"] for r in counts.filter(F.col(col) <= 4).groupBy(col).agg(F.count("*").alias("n")).collect()}
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    clip = lambda d, top: min(max(d, 0.05), top)
    return clip(1 - 2 * y * n2 / n1, 1.0), clip(2 - 3 * y * n3 / n2, 2.0), clip(3 - 4 * y * n4 / n3, 3.0)


def _discounted(col: str, d):
    c = F.col(col)
    return c - F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def _left(d):
    """Back-off mass of a context from its n-grams seen once, twice and more often."""
    return F.col("k1") * d[0] + F.col("k2") * d[1] + F.col("k3") * d[2]


def _seen(col: str) -> list[Column]:
    c = F.col(col)
    return [F.sum(c).alias("total"), F.count(F.when(c == 1, 1)).alias("k1"), F.count(F.when(c == 2, 1)).alias("k2"), F.count(F.when(c > 2, 1)).alias("k3")]


class Model:
    """Sorted n-gram arrays of a model that fits one process.  Keys of bigrams are v * V + w; of trigrams, bigram number * V + w."""

    def __init__(self, vocabulary: list[bytes], a1: np.ndarray, bi: np.ndarray, a2, g3, g2, tri: np.ndarray, a3):
        self.ids = Ids((w, i) for i, w in enumerate(vocabulary))
        self.a1, self.bi, self.a2, self.g3, self.g2, self.tri, self.a3 = a1, bi, a2, g3, g2, tri, a3
        self.size = len(vocabulary)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted key, or -1: a merge join of two sorted sides."""
        if not len(keys) or not len(wanted):
            return np.full(len(wanted), -1)
        order = np.argsort(wanted)
        at = np.searchsorted(keys, wanted[order])
        at[at == len(keys)] = 0
        out = np.empty(len(wanted), dtype=np.int64)
        out[order] = np.where(keys[at] == wanted[order], at, -1)
        return out

    def log10(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability, tokens with the end) of each text."""
        get = self.ids.__getitem__
        s, e = 0, 1
        runs = []
        for t in texts:
            w = words(t)
            x = np.empty(len(w) + 3, dtype=np.int64)
            x[:2], x[-1] = s, e
            x[2:-1] = list(map(get, w))
            runs.append(x)
        sizes = np.array([len(x) for x in runs])
        x = np.concatenate(runs) if runs else np.empty(0, dtype=np.int64)
        pair = np.full(len(x), -1)  # number of the bigram that ends here
        pair[1:] = self._find(self.bi, x[:-1] * self.size + x[1:])
        p1 = self.a1[x]
        before = np.concatenate([[0], x[:-1]])
        p2 = np.where(pair >= 0, self.a2[pair], 0) + self.g2[before] * p1
        context = np.concatenate([[-1], pair[:-1]])
        seen = np.flatnonzero(context >= 0)
        p3 = p2.copy()
        triple = self._find(self.tri, context[seen] * self.size + x[seen])
        p3[seen] = np.where(triple >= 0, self.a3[triple], 0) + self.g3[context[seen]] * p2[seen]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        logs = np.log10(p3)
        logs[starts] = 0
        logs[starts + 1] = 0
        # Sums of their own: equal texts have equal perplexities wherever they lie.
        return np.add.reduceat(logs, starts) if len(starts) else logs, sizes - 2


class Tables:
    """A trained model.  By word: ``a1``, its probability, and ``g2``, its back-off weight.  DataFrames:
    ``pairs`` (v, w, a), ``contexts`` (u, v, g) and ``triples`` (u, v, w, a, g), g being the weight of (u, v)."""

    def __init__(self, vocabulary: list[bytes], a1: np.ndarray, g2: np.ndarray, pairs: DataFrame, triples: DataFrame):
        self.vocabulary, self.a1, self.g2, self.pairs, self.triples = vocabulary, a1, g2, pairs, triples
        self.contexts = triples.select("u", "v", "g").distinct()


def tables(texts: DataFrame, scratch: Scratch) -> Tables:
    """Modified Kneser-Ney over the column ``text`` (binary).  What reaches the driver are rows a word of the vocabulary."""
    texts = scratch.settle(texts, "training")
    often = texts.mapInArrow(_words, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c")).filter("c > 1").orderBy(F.desc("c"), "w").select("w").toArrow()
    # Frequent words have small numbers, which pack well.
    vocabulary = [START, END, *SHAPES, *often.column(0).to_pylist()]
    n = len(vocabulary)
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)
    # Dealt by context once: counts of n-grams and sums over contexts need no further exchange.
    grams = texts.mapInArrow(_grams(shared), "u int, v int, w int, c long").repartition("u", "v").groupBy("u", "v", "w").agg(F.sum("c").alias("c"))
    by = Window.partitionBy("u", "v")
    tri = scratch.settle(grams.select("*", *[x.over(by).alias(k) for x, k in zip([F.sum("c"), F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1)), F.count(F.when(F.col("c") > 2, 1))], ["total", "k1", "k2", "k3"])]), "tri")
    scratch.drop("training")
    bi = scratch.settle(tri.groupBy("v", "w").agg(F.count("*").alias("c")), "bi")
    uni = scratch.settle(bi.groupBy("w").agg(F.count("*").alias("c")), "uni")
    d3, d2, d1 = discounts(tri), discounts(bi), discounts(uni)
    c2 = scratch.save(bi.groupBy("v").agg(*_seen("c")).select("v", "total", (_left(d2) / F.col("total")).alias("gamma")), "c2")

    def columns(df: DataFrame, *names: str) -> list[np.ndarray]:
        got = df.select(*names).toArrow()
        return [got.column(c).to_numpy() for c in names]

    word, found = columns(uni, "w", "c")
    count = np.zeros(n)
    count[word] = found
    cut = np.select([count == 0, count == 1, count == 2], [0, d1[0], d1[1]], d1[2])
    a1 = (count - cut) / max(count.sum(), 1) + (cut.sum() / count.sum() if count.sum() else 1.0) / n
    g2 = np.ones(n)
    v, gamma = columns(c2, "v", "gamma")
    g2[v] = gamma
    # One row for each word of the vocabulary; frequent words would crowd one task of a shuffled join.
    pairs = bi.join(F.broadcast(c2), "v").select("v", "w", (_discounted("c", d2) / F.col("total")).alias("a"))
    triples = tri.select("u", "v", "w", (_discounted("c", d3) / F.col("total")).alias("a"), (_left(d3) / F.col("total")).alias("g"))
    return Tables(vocabulary, a1, g2, pairs, triples)


def train(texts: DataFrame, scratch: Scratch) -> Model:
    """The whole model in one process, for texts whose tables fit there; ``scores`` keeps them sharded."""
    t = tables(texts, scratch)
    n = len(t.vocabulary)

    def columns(df: DataFrame, *names: str) -> list[np.ndarray]:
        got = df.toArrow()
        return [got.column(c).to_numpy() for c in names]

    pad = lambda x: x if len(x) else np.zeros(1)
    both = t.pairs.join(t.contexts.select(F.col("u").alias("v"), F.col("v").alias("w"), "g"), ["v", "w"], "full").select("v", "w", F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("g", F.lit(1.0)).alias("g"))
    v, w, a2, g3 = columns(both, "v", "w", "a", "g")
    key = v.astype(np.int64) * n + w
    order = np.argsort(key)
    bi_keys, a2, g3 = key[order], pad(a2[order]), pad(g3[order])
    u, v, w, a3 = columns(t.triples, "u", "v", "w", "a")
    key = np.searchsorted(bi_keys, u.astype(np.int64) * n + v) * n + w
    order = np.argsort(key)
    return Model(t.vocabulary, t.a1, bi_keys, a2, g3, t.g2, key[order], pad(a3[order]))


# ---- sharded scoring ----------------------------------------------------------------------


def _blocks(schema: pa.Schema, kind: int, chunk: int, parts) -> pa.RecordBatch:
    shard, block = zip(*parts)
    given = {"shard": pa.array(shard, pa.int32()), "kind": pa.array([kind] * len(shard), pa.int32()), "chunk": pa.array([chunk] * len(shard), pa.int64()), "block": pa.array(block, pa.binary())}
    return pa.RecordBatch.from_arrays([given[f.name] if f.name in given else pa.nulls(len(shard), f.type) for f in schema], schema=schema)


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return v.astype(np.int64) * PRIME + w


def _pack_pairs(shards: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for v, w, a in _gathered(batches):
            yield _blocks(schema, PAIRS, 0, dealt(_pair(v, w), shards, a.astype(np.float32)))

    return run


def _pack_triples(shards: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, v, w, a, g in _gathered(batches):
            yield _blocks(schema, TRIPLES, 0, dealt(_pair(v, w), shards, u, a.astype(np.float32), g.astype(np.float32)))
            # Contexts that several blocks hold come several times, with one value.
            keys, first = np.unique(_pair(u, v), return_index=True)
            yield _blocks(schema, CONTEXTS, 0, dealt(keys, shards, g[first].astype(np.float32)))

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    held, rows = [], 0
    for batch in batches:
        held.append([np.asarray(c) for c in batch.columns])
        rows += batch.num_rows
        if rows >= PACKED:
            yield [np.concatenate(x) for x in zip(*held)]
            held, rows = [], 0
    if rows:
        yield [np.concatenate(x) for x in zip(*held)]


def _entries(shared, shards: int, schema: pa.Schema):
    """Blocks of (pair, word before, document) and a row a document with its sum over single words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocabulary, a1, g2, always = shared.value
        ids = Ids((w, i) for i, w in enumerate(vocabulary))
        single = np.rint((np.log10(a1) + np.log10(g2)) * UNIT).astype(np.int64)
        # Each text begins with the weights of its start and ends with the end.
        ends = int(np.rint((always + np.log10(g2[0]) + np.log10(a1[1])) * UNIT))
        chunk = TaskContext.get().partitionId() << 32
        get = ids.__getitem__

        def emit(runs: list[np.ndarray], rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sizes = np.array([len(x) - 2 for x in runs])
            base = [int(single[x[2:-1]].sum()) + ends for x in runs]
            keys = np.concatenate([_pair(x[1:-1], x[2:]) for x in runs])
            before = np.concatenate([x[:-2] for x in runs])
            of = np.repeat(np.arange(len(runs), dtype=np.uint16), sizes)
            yield _blocks(schema, ENTRIES, chunk, dealt(keys, shards, before, of))
            n = len(runs)
            given = {"shard": pa.array([chunk % shards] * n, pa.int32()), "kind": pa.array([DOCUMENTS] * n, pa.int32()), "chunk": pa.array([chunk] * n, pa.int64()), "at": pa.array(range(n), pa.int32()), "base": pa.array(base, pa.int64()), "n_tokens": pa.array(sizes, pa.int64())}
            held = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            given |= {name: held.column(name).cast(schema.field(name).type) for name in held.schema.names}
            yield pa.RecordBatch.from_arrays([given[f.name] if f.name in given else pa.nulls(n, f.type) for f in schema], schema=schema)

        runs, rows, tokens = [], [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                got = [np.array([0, 0, *map(get, words(t)), 1], dtype=np.int32) for t in batch.column(2).to_pylist()]
                if runs and (len(runs) + len(got) > BLOCK or tokens > TOKENS):
                    yield from emit(runs, rows)
                    runs, rows, tokens = [], [], 0
                    chunk += 1
                runs += got
                tokens += sum(map(len, got))
                rows.append(batch.select([0, 1, *range(3, batch.num_columns)]))
        if runs:
            yield from emit(runs, rows)

    return run


class Shard:
    """The tables of one shard; ``values`` are those of its entries."""

    def __init__(self, a1: np.ndarray, g2: np.ndarray, blocks: dict[int, list[bytes]]):
        def load(kind: int, *types):
            got = [unsqueeze(b, *types) for b in blocks.get(kind, [])]
            return [np.concatenate(x) for x in zip(*got)] if got else [np.zeros(0, t) for t in (np.int64, *types)]

        pair, a = load(PAIRS, np.float32)
        context, g = load(CONTEXTS, np.float32)
        self.keys = np.union1d(pair, context)
        lower = np.log10(g2[pair // PRIME] * a1[pair % PRIME])
        p2 = np.log10(a + g2[pair // PRIME] * a1[pair % PRIME])
        adds = np.zeros(len(self.keys))
        at = np.searchsorted(self.keys, pair)
        adds[at] = p2 - lower
        full = np.zeros(len(self.keys))
        full[at] = p2
        weight = np.zeros(len(self.keys))
        weight[np.searchsorted(self.keys, context)] = np.log10(g)
        self.adds = np.rint((adds + weight) * UNIT).astype(np.int64)
        key, u, a, g = load(TRIPLES, np.int32, np.float32, np.float32)
        at = np.searchsorted(self.keys, key)
        p2 = full[at]
        self.triples = at * PRIME + u
        more = np.rint((np.log10(a + g * 10.0**p2) - np.log10(g) - p2) * UNIT).astype(np.int64)
        order = np.argsort(self.triples)
        self.triples, self.more = self.triples[order], more[order]

    def values(self, keys: np.ndarray, before: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=np.int64)
        if not len(self.keys):
            return out
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[at] == keys)
        out[hit] = self.adds[at[hit]]
        found = Model._find(self.triples, at[hit] * PRIME + before[hit])
        out[hit[found >= 0]] += self.more[found[found >= 0]]
        return out


def _look_up(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, a1, g2, _ = shared.value
        now, blocks, shard = None, {}, None
        sums: dict[int, np.ndarray] = {}

        def emit():
            chunks, rows = [c for c in sums if sums[c].any()], []
            for c in chunks:
                (docs,) = np.nonzero(sums[c])
                rows.append(squeeze(docs, sums[c][docs]))
            given = {"kind": pa.array([ENTRIES] * len(chunks), pa.int32()), "chunk": pa.array(chunks, pa.int64()), "block": pa.array(rows, pa.binary())}
            sums.clear()
            return pa.RecordBatch.from_arrays([given[f.name] if f.name in given else pa.nulls(len(chunks), f.type) for f in schema], schema=schema)

        for batch in batches:
            kinds = np.asarray(batch.column(1))
            chosen = np.flatnonzero(kinds < DOCUMENTS)
            columns = [batch.column(i).take(pa.array(chosen)).to_pylist() for i in range(4)]
            for s, kind, chunk, block in zip(*columns):
                if s != now:
                    now, blocks, shard = s, {}, None
                if kind < ENTRIES:
                    blocks.setdefault(kind, []).append(block)
                    continue
                if shard is None:
                    shard, blocks = Shard(a1, g2, blocks), {}
                keys, before, of = unsqueeze(block, np.int32, np.uint16)
                if chunk not in sums:
                    sums[chunk] = np.zeros(BLOCK, dtype=np.int64)
                np.add.at(sums[chunk], of, shard.values(keys, before))
            if len(chosen) < batch.num_rows:
                rest = batch.filter(pa.array(kinds == DOCUMENTS))
                yield pa.RecordBatch.from_arrays([rest.column(f.name).cast(f.type) for f in schema], schema=schema)
            if len(sums) * BLOCK >= HELD:
                yield emit()
        if sums:
            yield emit()

    return run


def _total(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(BLOCK, dtype=np.int64)
        for batch in batches:
            chunk, kind = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            out = []
            starts = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1])))
            for s, e in zip(starts, [*starts[1:], len(chunk)]):
                if chunk[s] != now:
                    now, sums = chunk[s], np.zeros(BLOCK, dtype=np.int64)
                if kind[s] == ENTRIES:
                    for block in batch.column(2).slice(s, e - s).to_pylist():
                        docs, adds = unsqueeze(block, np.int64)
                        sums[docs] += adds
                    continue
                rest = batch.slice(s, e - s)
                n = np.asarray(rest.column("n_tokens"))
                logs = (np.asarray(rest.column("base")) + sums[np.asarray(rest.column("at"))]) / UNIT
                given = {"log_perplexity": pa.array(-logs / n)}
                out.append(pa.RecordBatch.from_arrays([given[f.name] if f.name in given else rest.column(f.name).cast(f.type) for f in schema], schema=schema))
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    return run


def scores(picked: DataFrame, model: Tables, scratch: Scratch) -> DataFrame:
    """doc_id, lang, n_tokens, log_perplexity and, where there, carried of every row of ``picked`` (doc_id, lang, text as binary).

    A task of the first step numbers its batches, so rows of ``picked`` must come
    the same when a lost partition is read again, as those of tables do.  Documents
    go in ROUNDS parts, so that only the entries of one lie on disk at a time.
    The tables of ``model`` are gone afterwards.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StringType, StructField, StructType, _parse_datatype_string

    spark = picked.sparkSession
    shards = max(shuffle_partitions(spark), picked.rdd.getNumPartitions()) | 1
    # The weight of the context (start, start) counts once in every text.
    first = model.triples.filter("u = 0 and v = 0").select("g").first()
    shared = spark.sparkContext.broadcast((model.vocabulary, model.a1, model.g2, float(np.log10(first.g)) if first else 0.0))
    carried = [f for f in picked.schema if f.name == "carried"]
    row = StructType([*_parse_datatype_string("at int, base long, n_tokens long, doc_id long, lang string"), *carried])
    back = StructType([*_parse_datatype_string("chunk long, kind int, block binary"), *row])
    sent = StructType([*_parse_datatype_string("shard int, kind int, chunk long, block binary"), *row])
    done = StructType([StructField("doc_id", LongType()), StructField("lang", StringType()), *_parse_datatype_string("n_tokens long, log_perplexity double"), *carried])
    arrow = to_arrow_schema(sent)
    blocks = model.pairs.select("v", "w", "a").mapInArrow(_pack_pairs(shards, arrow), sent)
    blocks = scratch.settle(blocks.union(model.triples.select("u", "v", "w", "a", "g").mapInArrow(_pack_triples(shards, arrow), sent)), "model")
    scratch.drop("tri", "bi")
    parts = []
    for i in range(ROUNDS):
        some = picked.filter(F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(ROUNDS)) == i)
        sides = blocks.union(some.mapInArrow(_entries(shared, shards, arrow), sent))
        summed = sides.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_look_up(shared, to_arrow_schema(back)), back)
        total = summed.repartition("chunk").sortWithinPartitions("chunk", "kind").mapInArrow(_total(to_arrow_schema(done)), done)
        parts.append(scratch.settle(total, f"scored-{i}"))
    scratch.drop("model")
    return reduce(DataFrame.union, parts)


def bounded(sample: DataFrame, chars: int) -> DataFrame:
    """The texts of the sample (doc_id, text) in hash order while they hold ``chars`` characters at most together.

    One task adds up their lengths, so the sample must have few documents; texts
    are not moved for it.
    """
    sizes = sample.select("doc_id", F.length("text").cast("long").alias("n"), F.xxhash64("doc_id", F.lit(29)).alias("turn"))
    order = Window.orderBy("turn", "doc_id", "n").rowsBetween(Window.unboundedPreceding, 0)
    return sizes.withColumn("upto", F.sum("n").over(order)).filter(F.col("upto") <= chars).select("doc_id").distinct()


def quantiles(scored: DataFrame, key: str, col: str, q: float) -> DataFrame:
    """(key, cut, n): the exact quantile of each key, a value of rank ceil(q n); a sketch brackets it, then ranks are counted."""
    near = 2 / SKETCH
    edge = lambda p: F.percentile_approx(col, min(max(p, 0.0), 1.0), SKETCH)
    low = F.min(col) if q - near <= 0 else edge(q - near)
    high = F.max(col) if q + near >= 1 else edge(q + near)
    brackets = scored.groupBy(key).agg(F.count("*").alias("n"), low.alias("low"), high.alias("high"))
    x = F.col(col)
    counted = scored.join(brackets, key).groupBy(key).agg(F.first("n").alias("n"), F.count(F.when(x < F.col("low"), 1)).alias("below"), F.sort_array(F.collect_list(F.when((x >= F.col("low")) & (x <= F.col("high")), x))).alias("inside"))
    return counted.select(key, "n", F.expr(f"element_at(inside, cast(greatest(ceil({q}D * n), 1) - below as int))").alias("cut"))


def classify(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE, slack: float = SLACK, chars: int | None = None, carry: Column | None = None) -> DataFrame:
    """doc_id, lang, n_tokens, log_perplexity (log10 a token), threshold, keep for every row.

    ``trusted`` has the ids (column ``doc_id``) of documents known to be good.
    Half of them, by hash, train the model, with all their text unless ``chars``
    bounds it; all others set the language's threshold: the
    ``quantile`` of their perplexity (in log10 a token) times ``slack``, as the
    quantile of a finite sample lies too low.  A language with fewer than LEAST
    of these uses that of all languages together; without any trusted document
    nothing is rejected.
    Null and empty texts consist of the end alone; null languages count as one
    language; repeated rows give repeated results; an empty table gives an empty
    one; extra columns are not read; texts of any length are scored whole.  ``carry`` is a Column that comes back as ``carried``; it
    travels with the scores, so it should be narrow.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit(""))
    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), lang.alias("lang"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"), *([] if carry is None else [carry.alias("carried")]))
    good = scratch.save(picked.select("doc_id", "lang").join(trusted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi").distinct(), "good")
    sampled = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / (1 << 20) < TRAIN_SHARE
    training = picked.filter(sampled).join(good.filter(sampled).select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")
    held = good.filter(~sampled)
    if chars is not None:
        training = scratch.save(training, "candidates")
        chosen = scratch.save(bounded(training, chars), "chosen")
        training = training.join(chosen, "doc_id", "left_semi")
        held = good.join(chosen, "doc_id", "left_anti")
    scored = scores(picked, tables(training.select("text"), scratch), scratch)
    # What did not train the model sets the thresholds.
    held = scratch.save(scored.select("doc_id", "lang", "log_perplexity").join(held, ["doc_id", "lang"], "left_semi"), "held")
    own = scratch.save(quantiles(held, "lang", "log_perplexity", quantile).filter(F.col("n") >= LEAST).select("lang", (F.col("cut") * slack).alias("own")), "thresholds")
    every = quantiles(held.withColumn("all", F.lit(0)), "all", "log_perplexity", quantile).first()
    common = F.lit(every["cut"] * slack if every else float("inf"))
    judged = scored.join(own, "lang", "left").withColumn("threshold", F.coalesce("own", common)).drop("own")
    judged = judged.select("doc_id", "lang", "n_tokens", "log_perplexity", *([] if carry is None else ["carried"]), "threshold")
    return judged.withColumn("keep", F.col("log_perplexity") <= F.col("threshold"))
