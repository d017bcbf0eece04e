"""Approximate nearest neighbours by a permutation index.

A vector is represented by its pivots in order of nearness.  It is posted,
with the weight ``length - position``, in the inverted file of each of its
first ``length`` pivots, out of ``16 * sqrt(rows)`` (256 to ``MAX_PIVOTS``).  The
footrule distance between two such lists (an absent pivot counts as position
``length``) is a constant minus twice ``sum over shared pivots of min(weight,
weight)``, so a search walks the files of the query's own pivots only, adds up
what it meets there, and takes the ``fraction`` of a shard with the smallest
footrule (at least ``least``, ties included) for exact reranking in double
precision.  All vectors whose lists are almost the query's are reranked too,
however many; a query that meets fewer than ``k`` in a shard is compared with
all of it.

The index is dealt into shards by row, not by vector, so a common vector
spreads evenly.  Blocks of the stated query set visit the shards; each shard
returns its best ``k`` only.  Pivots are drawn from a sample of about ``SAMPLE``
vectors (a documented bound); every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SAMPLE = 8192
MAX_PIVOTS = 4096
SHARD_ROWS = 8192
BLOCK_ROWS = 512
#: Cosine from which a sampled vector is too near to a pivot to become one.
APART = 0.9
#: Share of the largest posting sum from which a vector is reranked in any case: members of a dense group.
ALIKE = 0.85


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and embedding of the rows that take part: finite, not zero, of the commonest length."""
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    v = v.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine)
    length = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return v.filter(F.size("embedding") == (length.n if length else 0))


def pick_pivots(vectors: DataFrame, rows: int, count: int, seed: int = 7) -> np.ndarray:
    """Up to ``count`` distinct vectors, scaled to length one, from about SAMPLE of the ``rows`` rows, picked by hash of their id."""
    share = SAMPLE / max(1, rows)
    rows = vectors.filter(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 30)) < share * (1 << 30)).collect()
    if not rows:
        return np.zeros((0, 0))
    found = np.unique(np.array([r.embedding for r in rows]), axis=0)
    found = found[np.random.default_rng(seed).permutation(len(found))]
    found = found / np.linalg.norm(found, axis=1, keepdims=True)
    # A dense group gets one pivot, or its copies would fill the lists of all vectors near it.
    near, chosen = np.full(len(found), -1.0), []
    for i in range(len(found)):
        if near[i] < APART:
            chosen.append(i)
            near = np.maximum(near, found @ found[i])
            if len(chosen) == count:
                break
    return found[chosen]


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The first ``length`` pivots of each vector, nearest first, ties to the smaller number."""
    near = -(x @ pivots.T)
    length = min(length, len(pivots))
    if length < len(pivots):
        # Ties at the cut may fall either way; what is inside is put in order.
        some = np.sort(np.argpartition(near, length - 1, axis=1)[:, :length], axis=1)
    else:
        some = np.broadcast_to(np.arange(length), near.shape)
    order = np.argsort(np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1).astype("<u2")


def _code(pivots: np.ndarray, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, -1)
            near = nearest_pivots(x, pivots, length)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in near], pa.binary())], names=["vec_id", "vec", "near"]
            )

    return run


class Files:
    """Inverted files of the rows of a shard or block: for each pivot the rows that list it and their weights."""

    def __init__(self, near: np.ndarray):
        rows, length = near.shape
        flat = near.ravel()
        order = np.argsort(flat, kind="stable")
        self.pivots, starts = np.unique(flat[order], return_index=True)
        self.bounds = np.append(starts, len(flat))
        self.rows = order // length
        self.weights = (length - order % length).astype(np.uint16)
        self.full = length * (length + 1) // 2

    def at(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.bounds[i], self.bounds[i + 1])
        return self.rows[part], self.weights[part]


def shared_weights(queries: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, int]:
    """(sum of smaller weights over shared pivots of each query and row, that of equal lists); only files of the queries' pivots are read."""
    asked, held = Files(queries), Files(near)
    acc = np.zeros((len(queries), len(near)), dtype=np.uint16)
    _, i, j = np.intersect1d(asked.pivots, held.pivots, assume_unique=True, return_indices=True)
    for a, b in zip(i.tolist(), j.tolist()):
        q, qw = asked.at(a)
        v, vw = held.at(b)
        acc[np.ix_(q, v)] += np.minimum.outer(qw, vw)
    return acc, held.full


def _pack(key, rows: pd.DataFrame) -> pd.DataFrame:
    """One row for a shard or block, in order of vec_id."""
    rows = rows.sort_values(["vec_id", "uid"])
    return pd.DataFrame(
        {
            "part": [key[0]],
            "ids": [rows.vec_id.to_numpy(np.int64).tobytes()],
            "uids": [rows.uid.to_numpy(np.int64).tobytes()],
            "vecs": [b"".join(rows.vec)],
            "near": [b"".join(rows.near)],
        }
    )


PACKED = "part long, ids binary, uids binary, vecs binary, near binary"


def search_shard(q_ids, q_uids, q_vecs, q_near, ids, uids, vecs, near, k: int, fraction: float, least: int):
    """(query ids, vec ids, scores): the best k of one shard for each query; ids ascending in the shard."""
    take = min(len(ids), max(least, int(np.ceil(fraction * len(ids)))))
    out_q, out_v, out_s = [], [], []
    if take < len(ids):
        acc, full = shared_weights(q_near, near)
        edges = np.partition(acc, len(ids) - take, axis=1)[:, len(ids) - take]
        edges = np.clip(edges, 1, int(ALIKE * full))
    for i in range(len(q_ids)):
        chosen = np.flatnonzero(acc[i] >= edges[i]) if take < len(ids) else np.arange(len(ids))
        if len(chosen) <= k:
            chosen = np.arange(len(ids))
        chosen = chosen[uids[chosen] != q_uids[i]]
        score = (vecs[chosen] * q_vecs[i]).sum(axis=1)
        best = np.lexsort((ids[chosen], -score))[:k]
        out_q.append(np.full(len(best), q_ids[i]))
        out_v.append(ids[chosen[best]])
        out_s.append(score[best])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _search(k: int, fraction: float, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: np.frombuffer(batch.column(n)[at].as_buffer(), dtype=t) for n, t in (("q_ids", "i8"), ("q_uids", "i8"), ("q_vecs", "f8"), ("q_near", "<u2"), ("ids", "i8"), ("uids", "i8"), ("vecs", "f8"), ("near", "<u2"))}
                nq, n = len(row["q_ids"]), len(row["ids"])
                q, v, s = search_shard(
                    row["q_ids"], row["q_uids"], row["q_vecs"].reshape(nq, -1), row["q_near"].reshape(nq, -1),
                    row["ids"], row["uids"], row["vecs"].reshape(n, -1), row["near"].reshape(n, -1), k, fraction, least,
                )
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, is_query, k: int = 20, pivots: int | None = None, length: int = 48, fraction: float = 0.14, least: int = 400, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by inner product, ties to the smaller vec_id.

    ``is_query`` maps the id column to a boolean Column.  Rows that are null,
    zero, or hold null or non-finite components take no part; nor do rows of
    another length than the commonest.  A query's own row is no candidate,
    another row with the same id is.  An empty table gives an empty result;
    extra columns are not read.  ``pivots`` is their number, by default
    ``16 * sqrt(rows)``.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    good = scratch.save(usable(vectors, id_col, vec_col), "usable")
    rows = good.count()
    number = pivots or min(MAX_PIVOTS, max(256, int(16 * np.sqrt(rows))))
    chosen = pick_pivots(good, rows, number)
    coded = good.mapInArrow(_code(chosen, length), "vec_id long, vec binary, near binary")
    coded = scratch.save(coded.withColumn("uid", F.monotonically_increasing_id()), "coded")
    shards = max(1, -(-rows // SHARD_ROWS))
    deal = lambda n: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("long")
    index = scratch.save(coded.groupBy(deal(shards).alias("part")).applyInPandas(_pack, PACKED), "index")
    asked = coded.filter(is_query(F.col("vec_id")))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    asked = scratch.save(asked.groupBy(deal(blocks).alias("part")).applyInPandas(_pack, PACKED), "asked")
    visit = asked.select(*[F.col(c).alias(f"q_{c}") for c in ("ids", "uids", "vecs", "near")], F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("part"))
    near = visit.join(index, "part").drop("part").mapInArrow(_search(k, fraction, least), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
