"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints are deduplicated first: a large group of copies is one index
entry.  Two words at Hamming distance <= 2 agree on one of three segments, so
the index is dealt out by (segment, value); inside each such bucket the words
are sorted by Gray rank, which puts words that share long patterns side by
side.  Consecutive words form leaves whose agreeing bits are factored out as
(mask, pattern); consecutive leaves form upper nodes holding the pattern that
all below share, and a child keeps only what its parent lacks.  A search adds
up differences on the way down and drops a whole group once the sum passes the
limit.  Buckets above ``HOT`` words are dealt out once more by three parts of
the remaining bits, which is exact by the same argument.

A bucket emits a spanning star for each linked set, never its pairs;
components of those edges equal components of all links.

``similar_components`` takes a wider neighbourhood: fingerprints of 256 bits that
agree in ``similarity`` of them (0.8: up to 51 bits differ).  No split into
segments finds all of these, so the fingerprints are dealt out by several samples
of their bits; the buckets are searched by the same index.  Sample size and number
follow from the number of fingerprints, so that a link at the very limit is met with
the same probability at any size (``REACH``; nearer links with more), and the cost
grows with a power of about 1.3.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, signed
from .components import connected_components

SEED = 42
SEGMENTS = ((0, 21), (21, 21), (42, 22))
HOT = 20_000
LEAF = 32


def fingerprint(words: list[bytes], width: int = 3) -> int:
    """64 bits, each set if set in over half the XXH64 of the shingles (repeats included); 0 without words."""
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    shingles = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width))))
    votes = np.zeros(64, dtype=np.int64)
    hashes = np.fromiter((h(s, SEED) for s in shingles), dtype=np.uint64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.lower() and bytes.split() know ASCII only: A-Z and [\x20\x09-\x0D].
            found = [fingerprint(t.lower().split(), width) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(signed(np.array(found, dtype=np.uint64))), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "carried"][: len(columns)])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, carry: Column | None = None) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of every row, and ``carry`` as ``carried``; null text counts as empty."""
    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"), *([] if carry is None else [carry.alias("carried")]))
    schema = "doc_id long, fp long"
    if carry is not None:
        schema += f", carried {picked.schema['carried'].dataType.simpleString()}"
    return picked.mapInArrow(_fingerprints(width), schema)


def gray_rank(word):
    """The rank of a 64-bit word among Gray codes: each bit is the parity of itself and all higher bits."""
    for by in (1, 2, 4, 8, 16, 32):
        word = word.bitwiseXOR(F.shiftrightunsigned(word, by))
    return word


def bits_in(words: np.ndarray) -> np.ndarray:
    """Set bits of each row of one or several words."""
    return np.bitwise_count(words).sum(axis=1, dtype=np.int64)


class GrayIndex:
    """Hierarchical index over rows of one or several uint64 words, sorted by Gray rank."""

    def __init__(self, words: np.ndarray, leaf: int = LEAF):
        words = words if words.ndim > 1 else words[:, None]
        self.words = words
        self.levels = []
        values, masks, counts = words, np.full(words.shape, ~np.uint64(0)), len(words)
        while counts > 1:
            starts = np.arange(0, counts, leaf)
            first = np.repeat(values[starts], np.diff(np.append(starts, counts)), axis=0)
            firstmask = np.repeat(masks[starts], np.diff(np.append(starts, counts)), axis=0)
            differ = (values ^ first) | ~masks | ~firstmask
            shared = ~np.bitwise_or.reduceat(differ, starts, axis=0)
            self.levels.append((values, masks, starts, shared))
            values, masks, counts = values[starts] & shared, shared, len(starts)
        self.root = values, masks
        self.leaf = leaf

    def search(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, word number) within the limit."""
        queries = queries if queries.ndim > 1 else queries[:, None]
        q = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        value, mask = self.root
        diff = bits_in((queries[q] ^ value[node]) & mask[node])
        live = diff <= limit
        q, node, diff = q[live], node[live], diff[live]
        for values, masks, starts, shared in reversed(self.levels):
            ends = np.append(starts[1:], len(values))
            size = ends[node] - starts[node]
            child = np.repeat(starts[node] - np.cumsum(size) + size, size) + np.arange(size.sum())
            q, parent, diff = np.repeat(q, size), np.repeat(node, size), np.repeat(diff, size)
            rest = masks[child] & ~shared[parent]
            diff = diff + bits_in((queries[q] ^ values[child]) & rest)
            live = diff <= limit
            q, node, diff = q[live], child[live], diff[live]
        return q, node


class Union:
    """Linked sets of numbered items, united by arrays of links; the smallest number names a set."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            x, y = root[a], root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while np.any(root[root] != root):
                root[:] = root[root]

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        moved = np.flatnonzero(self.root != np.arange(len(self.root)))
        return moved, self.root[moved]


def link(words: np.ndarray, limit: int, sets: Union, base: int = 0, block: int = 512) -> None:
    """Unites all rows within the limit of each other; rows sorted by Gray rank, numbered from ``base``."""
    index = GrayIndex(words)
    for at in range(0, len(words), block):
        a, b = index.search(index.words[at : at + block], limit)
        a = a + at
        sets.unite(a[a < b] + base, b[a < b] + base)


def linked_stars(words: np.ndarray, limit: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) pairs that connect all words within the limit of each other; words sorted by Gray rank."""
    sets = Union(len(words))
    if len(words) <= 64:
        sets.unite(*np.nonzero(np.triu(np.bitwise_count(words[:, None] ^ words[None, :]) <= limit, 1)))
    else:
        link(words, limit, sets)
    moved, root = sets.stars()
    return words[moved], words[root]


def _search(limit: int):
    def emit(key: np.ndarray, words: np.ndarray):
        cuts = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(words))
        a, b = [], []
        pairs = ends - starts == 2  # most shared buckets
        x, y = words[starts[pairs]], words[starts[pairs] + 1]
        near = np.bitwise_count(x ^ y) <= limit
        a.append(x[near])
        b.append(y[near])
        for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            m, r = linked_stars(words[s:e], limit)
            a.append(m)
            b.append(r)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a).view(np.int64)), pa.array(np.concatenate(b).view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_words = [], []
        for batch in batches:
            key = np.stack([np.asarray(batch.column(i)) for i in range(4)], axis=1)
            words = np.asarray(batch.column(4)).view(np.uint64)
            if not len(words):
                continue
            # All but the last run of equal keys is complete.
            at = len(words) - int(np.argmax(np.any(key[::-1] != key[-1], axis=1))) if np.any(key != key[-1]) else 0
            if at:
                yield emit(np.concatenate([*held_key, key[:at]]), np.concatenate([*held_words, words[:at]]))
                held_key, held_words = [], []
            elif held_key and np.any(held_key[-1][-1] != key[0]):
                yield emit(np.concatenate(held_key), np.concatenate(held_words))
                held_key, held_words = [], []
            held_key.append(key[at:])
            held_words.append(words[at:])
        if held_key:
            yield emit(np.concatenate(held_key), np.concatenate(held_words))

    return run


def _part(word, at: int, width: int):
    return F.shiftrightunsigned(word, at).bitwiseAND(F.lit((1 << width) - 1))


def near_edges(words: DataFrame, scratch: Scratch, limit: int = 2, hot: int = HOT) -> DataFrame:
    """Edges (a, b) that connect all distinct words (column fp) within the limit; needs limit <= 2."""
    if limit > len(SEGMENTS) - 1:
        raise ValueError("three segments find distances up to 2")
    fp = F.col("fp")
    segment = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("seg"), _part(fp, at, w).alias("val")) for i, (at, w) in enumerate(SEGMENTS)]))
    first = words.select("fp", segment.alias("s")).select("s.seg", "s.val", "fp")
    sizes = first.groupBy("seg", "val").count()
    shared = scratch.save(sizes.filter("count > 1").select("seg", "val", (F.col("count") > hot).alias("hot")), "shared")
    kept = first.join(shared, ["seg", "val"])
    # The bits outside the segment, turned to the low end, in three parts.
    rest = None
    for i, (at, w) in enumerate(SEGMENTS):
        turned = F.shiftrightunsigned(fp, at + w) if at + w < 64 else F.lit(0).cast("long")
        joined = F.shiftleft(turned, at).bitwiseOR(_part(fp, 0, at)) if at else turned
        rest = F.when(F.col("seg") == i, joined) if rest is None else rest.when(F.col("seg") == i, joined)
    parts = ((0, 14), (14, 14), (28, 15))
    again = F.explode(F.array(*[F.struct(F.lit(j + 1).cast("long").alias("sub"), _part(F.col("rest"), at, w).alias("subval")) for j, (at, w) in enumerate(parts)]))
    none = F.lit(0).cast("long")
    cool = kept.filter("not hot").select("seg", "val", none.alias("sub"), none.alias("subval"), "fp")
    warm = kept.filter("hot").withColumn("rest", rest).select("seg", "val", again.alias("t"), "fp").select("seg", "val", "t.sub", "t.subval", "fp")
    keys = ["seg", "val", "sub", "subval"]
    dealt = cool.union(warm).withColumn("rank", gray_rank(fp))
    # The unsigned order of the rank is the signed order with the top bit turned.
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, F.col("rank").bitwiseXOR(F.lit(-(2**63))))
    return dealt.select(*keys, "fp").mapInArrow(_search(limit), "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, limit: int = 2, carry: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable) and root.

    ``root`` is the component's smallest fingerprint as a signed number: it names
    the component where ids repeat, as two components may share their smallest id.
    Null and empty texts have fingerprint zero and link like any other.
    Repeated rows give repeated results; null ids count as absent when the
    smallest id is taken (null only if a component has no other).  An empty table
    gives an empty result; extra columns are not read.  ``carry`` is a Column of
    the input that comes back as ``carried``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    marked = scratch.save(fingerprints(docs, id_col, text_col, width, carry), "marked")
    words = scratch.save(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "words")
    edges = scratch.save(near_edges(words.select("fp"), scratch, limit), "edges")
    roots = connected_components(edges, scratch)
    named = words.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    index = scratch.save(named.join(lows, "root").select("fp", "root", "component_id"), "index")
    return marked.join(index, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root", *([] if carry is None else ["carried"]))


# ---- wider neighbourhoods -----------------------------------------------------------------

BITS = 256
#: Rows of a bucket up to which its pairs are compared side by side with other buckets'.
SMALL = 256
#: Chance that a link at the very limit meets in some sample; and the bits of a sample at least.
REACH = 0.95
SAMPLE_BITS = 12
CHUNK = 1 << 16


def wide_fingerprint(words: list[bytes], width: int) -> bytes:
    """As ``fingerprint``, with the 256 bits of two XXH3-128 of each shingle."""
    if not words:
        return bytes(BITS // 8)
    h = xxhash.xxh3_128_digest
    shingles = [b" ".join(words)] if len(words) < width else list(map(b" ".join, zip(*(words[i:] for i in range(width)))))
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(shingles), 1 << 14):
        part = shingles[at : at + (1 << 14)]
        hashes = np.frombuffer(b"".join([h(x, 1) + h(x, 2) for x in part]), dtype=np.uint8).reshape(len(part), -1)
        votes += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(votes * 2 > len(shingles)).tobytes()


def _wide(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wide_fingerprint(t.lower().split(), width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2)], names=["doc_id", "fp", "carried"])

    return run


#: The Gray rank of the first 60 bits of a fingerprint, as SQL: each bit is the parity of itself and all higher bits.
GRAY_BYTES = "aggregate(array(1, 2, 4, 8, 16, 32), cast(conv(substring(hex(fp), 1, 15), 16, 10) as long), (w, by) -> w ^ shiftrightunsigned(w, by))"


def bit_samples(count: int, bits: int) -> list[np.ndarray]:
    """Places of the bits of each sample; the same for every task."""
    rng = np.random.default_rng(8)
    return [np.sort(rng.permutation(BITS)[:bits]) for _ in range(count)]


def _deal(count: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples, weights = bit_samples(count, bits), np.int64(1) << np.arange(bits, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = np.unpackbits(np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1), axis=1)
            for i, places in enumerate(samples):
                key = flat[:, places].astype(np.int64) @ weights
                yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, i), pa.int32()), pa.array(key), batch.column(0), batch.column(1)], names=["sample", "key", "node", "fp"])

    return run


def _search_wide(limit: int):
    def emit(keys: np.ndarray, nodes: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        starts = np.append(0, cuts)
        sizes = np.diff(np.append(starts, len(nodes)))
        sets = Union(len(nodes))
        bucket, size = np.repeat(np.arange(len(starts)), sizes), np.repeat(sizes, sizes)
        for apart in range(1, min(SMALL, int(sizes.max()))):
            a = np.flatnonzero((bucket[:-apart] == bucket[apart:]) & (size[:-apart] <= SMALL))
            if len(a):
                a = a[bits_in(words[a] ^ words[a + apart]) <= limit]
                sets.unite(a, a + apart)
        for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
            link(words[s : s + n], limit, sets, s)
        moved, root = sets.stars()
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(0)).astype(np.int64), np.asarray(batch.column(1))], axis=1)
            words = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint64).reshape(batch.num_rows, -1)
            held.append([keys, np.asarray(batch.column(2)), words])
            rows += batch.num_rows
            if rows >= CHUNK:
                keys, nodes, words = (np.concatenate(x) for x in zip(*held))
                # All but the last bucket is complete.
                last = np.flatnonzero(np.any(keys != keys[-1], axis=1))
                at = int(last[-1]) + 1 if len(last) else 0
                if at:
                    yield emit(keys[:at], nodes[:at], words[:at])
                held, rows = [[keys[at:], nodes[at:], words[at:]]], len(nodes) - at
        if held:
            yield emit(*(np.concatenate(x) for x in zip(*held)))

    return run


def similar_edges(words: DataFrame, count: int, similarity: float, bits: int | None = None) -> DataFrame:
    """Edges (a, b) between nodes of ``words`` (node, fp: 32 bytes; ``count`` rows) whose fingerprints agree in ``similarity`` of their bits."""
    limit = int(np.floor(BITS * (1 - similarity) + 1e-9))
    bits = bits or max(SAMPLE_BITS, int(np.ceil(np.log2(max(count, 2)))) - 6)
    samples = int(np.ceil(np.log(1 / (1 - REACH)) / similarity**bits))
    dealt = words.select("node", "fp").mapInArrow(_deal(samples, bits), "sample int, key long, node long, fp binary")
    dealt = dealt.withColumn("rank", F.expr(GRAY_BYTES)).repartition("sample", "key").sortWithinPartitions("sample", "key", "rank").drop("rank")
    return dealt.mapInArrow(_search_wide(limit), "a long, b long")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, carry: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, root (the same number for all rows of a component) and ``carry`` as ``carried``.

    Fingerprints of 256 bits over ``width``-word shingles link when they agree in
    ``similarity`` of their bits.  Two texts whose sets of five-word shingles have
    a Jaccard similarity of 0.8 differ in about 39 bits, unrelated ones in 128.
    Null and empty texts have fingerprint zero and link like any other; repeated
    rows give repeated results; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "similar")
    extra = F.lit(None).cast("long") if carry is None else carry
    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"), extra.alias("carried"))
    schema = f"doc_id long, fp binary, carried {picked.schema['carried'].dataType.simpleString()}"
    marked = scratch.save(picked.mapInArrow(_wide(width), schema), "marked")
    words = scratch.save(marked.select("fp").distinct().withColumn("node", F.monotonically_increasing_id()), "words")
    edges = scratch.settle(similar_edges(words, words.count(), similarity).distinct(), "edges")
    roots = connected_components(edges, scratch)
    named = words.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("root"))
    return marked.join(named, "fp").select("doc_id", "root", *([] if carry is None else ["carried"]))


def shingle_set(text: bytes, width: int) -> frozenset[bytes]:
    words = text.lower().split()
    return frozenset([b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width)))))


def _confirm(width: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, frozenset()
        for batch in batches:
            keep = []
            for text, other in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if other != last:  # rows with one other text lie together as a rule
                    last, held = other, shingle_set(other, width)
                own = shingle_set(text, width)
                both = len(own & held)
                keep.append(both >= similarity * (len(own) + len(held) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0])

    return run


def confirmed(pairs: DataFrame, key: str, text_col: str, other_col: str, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """Keys (long) of the pairs whose sets of shingles have a Jaccard similarity of ``similarity`` or more; null counts as empty, and two empty texts are alike."""
    binary = lambda c: F.coalesce(F.col(c), F.lit("")).cast("binary")
    return pairs.select(key, binary(text_col), binary(other_col)).mapInArrow(_confirm(width, similarity), f"{key} long")
