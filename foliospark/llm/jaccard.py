"""All pairs of texts whose sets of shingles have a given Jaccard similarity: an exact prefix-filter join.

Shingles are put in one order for all texts.  Two sets that are similar enough share
a shingle among the first ``n - ceil(similarity * n) + 1`` of each, so only these are
dealt out, as sorted blocks; where two texts meet, their sizes and the places of the
shared shingle bound the overlap.  Pairs that met are first held against the parity
bits of their sets, which bound the shingles they do not share, and what is left is
compared shingle by shingle.  The order is by hash, with shingles that are frequent
in a sample of the texts last: the sample decides how many texts meet in vain, never
which pairs are found.  It is a share of the texts, so that frequent means the same
number of texts at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, dealt, shuffle_partitions, unsqueeze
from .simhash import confirmed

#: One text in so many is in the sample; how many of them make a shingle frequent.
ONE_IN, FREQUENT = 4, 4
#: Shingles dealt at once, about.
PACKED = 1 << 20


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``simhash.shingle_set``."""
    words = text.lower().split()
    h = xxhash.xxh3_64_intdigest
    if len(words) <= width:
        return np.array([h(b" ".join(words))], dtype=np.uint64)
    one = np.fromiter(map(h, words), dtype=np.uint64, count=len(words))
    n = len(words) - width + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        mixed = (mixed ^ one[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _hashes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(text, width).view(np.int64))], names=["h"])

    return run


def _prefixes(shared, width: int, similarity: float, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        base, held, rows = 0, [], 0

        def emit():
            keys, of, size, place = (np.concatenate(x) for x in zip(*held))
            shard, block = zip(*dealt(keys, shards, of, size, place))
            return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array([base] * len(shard), pa.int64()), pa.array(block, pa.binary())], names=["shard", "base", "block"])

        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = shingle_hashes(text, width)
                n = len(x)
                at = np.searchsorted(frequent, x)
                at[at == len(frequent)] = 0
                last = frequent[at] == x if len(frequent) else np.zeros(n, dtype=bool)
                x = np.concatenate([x[~last], x[last]])[: n - int(np.ceil(similarity * n - 1e-9)) + 1]
                if held and (not 0 <= row - base < 1 << 16 or rows >= PACKED):
                    yield emit()
                    held, rows = [], 0
                if not held:
                    base = row
                # Half of a hash deals as well; pairs that meet by chance are told apart later.
                k = len(x)
                held.append(((x >> np.uint64(24)).astype(np.int64), np.full(k, row - base, dtype=np.uint16), np.full(k, n, dtype=np.int32), np.arange(k, dtype=np.int32)))
                rows += k
        if held:
            yield emit()

    return run


def _meet(similarity: float):
    """Pairs (a, b) of rows that share a shingle of their prefixes and may be similar enough."""
    share = similarity / (1 + similarity)

    def pairs(blocks: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        got = []
        for base, block in blocks:
            keys, of, size, place = unsqueeze(block, np.uint16, np.int32, np.int32)
            got.append((keys, base + of.astype(np.int64), size, place))
        keys, row, size, place = (np.concatenate(x) for x in zip(*got))
        order = np.lexsort((size, keys))
        keys, row, size, place = keys[order], row[order], size[order], place[order]
        left = np.arange(len(keys))
        apart = 0
        while len(left):
            # Sizes grow inside a run of equal keys, so a row that fails once fails for all that follow.
            apart += 1
            left = left[left + apart < len(keys)]
            other = left + apart
            near = (keys[left] == keys[other]) & (size[left] >= similarity * size[other] - 1e-9)
            left, other = left[near], other[near]
            most = np.minimum(size[left] - place[left], size[other] - place[other])
            able = (most >= share * (size[left].astype(np.int64) + size[other]) - 1e-6) & (row[left] != row[other])
            if able.any():
                a, b = row[left[able]], row[other[able]]
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for shard, base, block in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != now and held:
                    yield from pairs(held)
                    held = []
                now = shard
                held.append((base, block))
        if held:
            yield from pairs(held)

    return run


def parity(hashes: np.ndarray) -> bytes:
    """One bit for each place a hash may take, set if an odd number of them take it; two sets differ in as many shingles at least as in bits."""
    places = max(64, 1 << (len(hashes) - 1).bit_length())
    taken = np.bincount((hashes & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(taken.astype(np.uint8), bitorder="little").tobytes()


def _parities(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(text, width) for text in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([len(x) for x in sets], pa.int32()), pa.array(map(parity, sets), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n", "bits"])

    return run


def bits_apart(one: bytes, two: bytes) -> int:
    """Bits in which two parities differ, the longer one folded to the length of the other."""
    x, y = sorted((np.frombuffer(one, dtype=np.uint64), np.frombuffer(two, dtype=np.uint64)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def _able(similarity: float):
    """Pairs whose parities do not rule out the similarity."""
    share = (1 - similarity) / (1 + similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, m, two = (batch.column(i).to_pylist() for i in range(2, 6))
            keep = [bits_apart(x, y) <= share * (i + j) + 1e-6 for i, x, j, y in zip(n, one, m, two)]
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return run


def similar_pairs(docs: DataFrame, row: str, text_col: str, scratch: Scratch, width: int = 5, similarity: float = 0.8, only: DataFrame | None = None) -> DataFrame:
    """(a, b), a < b: all pairs of rows (distinct longs in ``row``) with a Jaccard similarity of ``similarity`` or more.

    With ``only`` (column ``row``), those with one of these rows at least.  Null counts
    as empty; two empty texts are alike.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(row).alias("row"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    count = texts.select("row").count()
    part = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(ONE_IN)) == 0
    often = scratch.settle(texts.filter(part).select("text").mapInArrow(_hashes(width), "h long").groupBy("h").count().filter(F.col("count") >= FREQUENT).select("h"), "often").toArrow()
    shared = spark.sparkContext.broadcast(np.sort(often.column(0).to_numpy().view(np.uint64)))
    shards = max(shuffle_partitions(spark), count // 2000) | 1
    blocks = texts.mapInArrow(_prefixes(shared, width, similarity, shards), "shard int, base long, block binary")
    met = blocks.repartition("shard").sortWithinPartitions("shard").mapInArrow(_meet(similarity), "a long, b long").distinct()
    if only is not None:
        new = scratch.save(only.select(F.col("row").alias("new")).distinct(), "new")
        met = met.join(new, met.a == new.new, "left_semi").union(met.join(new, met.b == new.new, "left_semi")).distinct()
    met = scratch.settle(met, "met")
    marks = scratch.save(texts.mapInArrow(_parities(width), "row long, n int, bits binary"), "marks")
    end = lambda of, row, *names: of.select(F.col("row").alias(row), *(F.col(x).alias(f"{row}_{x}") for x in names))
    both = met.join(end(marks, "a", "n", "bits"), "a").join(end(marks, "b", "n", "bits"), "b").select("a", "b", "a_n", "a_bits", "b_n", "b_bits")
    able = scratch.settle(both.mapInArrow(_able(similarity), "a long, b long").withColumn("pair", F.monotonically_increasing_id()), "able")
    scratch.drop("marks")
    # Texts of the few rows that are left; written first, so that their size decides how they are joined.
    ends = scratch.save(able.select(F.col("a").alias("row")).union(able.select(F.col("b").alias("row"))).distinct(), "ends")
    held = scratch.settle(texts.join(ends, "row", "left_semi"), "held")
    both = able.join(end(held, "a", "text"), "a").join(end(held, "b", "text"), "b")
    alike = scratch.settle(confirmed(both, "pair", "a_text", "b_text", width, similarity), "alike")
    scratch.drop("held")
    return able.join(alike, "pair").select("a", "b")


def first_of(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (column ``row``) that go when the edges (stays, goes) are followed in order: a row goes if and only if
    a row before it is alike and stays.  Each round settles all rows that have no open row before them."""
    left = scratch.settle(edges, "open-0")
    gone = None
    turn = 0
    while left.count():
        turn += 1
        sure = left.select(F.col("stays").alias("row")).distinct().join(left.select(F.col("goes").alias("row")).distinct(), "row", "left_anti")
        out = scratch.settle(left.join(sure.select(F.col("row").alias("stays")), "stays", "left_semi").select(F.col("goes").alias("row")).distinct(), f"goes-{turn}")
        gone = out if gone is None else gone.union(out)
        left = scratch.settle(left.join(out.select(F.col("row").alias("stays")), "stays", "left_anti").join(out.select(F.col("row").alias("goes")), "goes", "left_anti"), f"open-{turn}")
    return left.select(F.col("goes").alias("row")) if gone is None else gone
