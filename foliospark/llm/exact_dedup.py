"""Exact deduplication by a Golomb-coded fingerprint exchange.

1. One scan writes a slim row per document (length, SHA-256 and a 64-bit
   fingerprint of the text without white space).
2. Every partition sorts its distinct fingerprints, cuts them into owner
   ranges and sends each owner one Golomb-Rice coded message, with a bit for
   those that the sender itself holds twice.
3. Owners merge their messages and return to each sender a bitmap of the
   fingerprints that exist twice anywhere.
4. Senders decode the bitmaps into suspects.  Only suspects' rows are grouped
   and only their texts shuffled; equality is decided on their bytes (the text
   is the grouping key, combined before the shuffle, so a hot text costs one row
   per task).  All other rows are alone and go out as they stand.

Nothing of corpus size reaches the driver.  The suspects' prefix bitmap that
tells the two kinds of rows apart has a fixed size (2**22 bits); saturation
sends more rows through the exact joins, never loses one.  Senders and owners
each hold about ``OWNER_ROWS`` fingerprints, so their messages number
(rows / OWNER_ROWS) squared and stay large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, shuffle_partitions, task_id

SPACES = (" ", "\t", "\n", "\v", "\f", "\r")
#: Aimed number of fingerprints that one sender codes and one owner merges.
OWNER_ROWS = 4_000_000


def normalised(text):
    """The text without any character of [\\x20\\x09-\\x0D]."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def golomb_encode(sorted_values: np.ndarray, k: int) -> bytes:
    """Rice code of the gaps of sorted distinct uint64 values: unary quotients, then k-bit remainders."""
    if not len(sorted_values):
        return b""
    gaps = np.diff(sorted_values, prepend=np.uint64(0))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
    unary[ends] = 1
    parts = [np.packbits(unary).tobytes()]
    if k:
        bits = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        parts.append(np.packbits(bits.ravel()).tobytes())
    return len(parts[0]).to_bytes(8, "little") + b"".join(parts)


def golomb_decode(blob: bytes, n: int, k: int) -> np.ndarray:
    if not n:
        return np.empty(0, dtype=np.uint64)
    size = int.from_bytes(blob[:8], "little")
    unary = np.unpackbits(np.frombuffer(blob, dtype=np.uint8, count=size, offset=8))
    ends = np.flatnonzero(unary)[:n]
    quotient = np.diff(ends, prepend=-1) - 1
    gaps = quotient.astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(blob, dtype=np.uint8, offset=8 + size))[: n * k].reshape(n, k)
        gaps |= (bits.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def rice_parameter(n: int, span: int) -> int:
    """The remainder width that suits n values spread over a span."""
    return max(0, int(span // max(n, 1)).bit_length() - 1)


def _owner_start(owner: int, owners: int) -> int:
    return -(-(owner << 64) // owners)


def _messages(owners: int):
    starts = np.array([_owner_start(o, owners) for o in range(owners)], dtype=np.uint64)
    span = 2**64 // owners

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [np.asarray(b.column(0)).view(np.uint64) for b in batches]
        if not got:
            return
        values, counts = np.unique(np.concatenate(got), return_counts=True)
        cuts = np.append(np.searchsorted(values, starts), len(values))
        rows = []
        for o in range(owners):
            own = values[cuts[o] : cuts[o + 1]]
            if len(own):
                k = rice_parameter(len(own), span)
                twice = np.packbits(counts[cuts[o] : cuts[o + 1]] > 1).tobytes()
                rows.append((task_id(), o, len(own), k, golomb_encode(own - starts[o], k), twice))
        for at in range(0, len(rows), 512):
            part = list(zip(*rows[at : at + 512]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[0], pa.int64()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.int64()), pa.array(part[3], pa.int32()), pa.array(part[4], pa.binary()), pa.array(part[5], pa.binary())],
                names=["sender", "owner", "n", "k", "blob", "twice"],
            )

    return run


def _reply(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmaps, one for each message: does this fingerprint exist twice anywhere?"""
    lists = [golomb_decode(b, n, k) for b, n, k in zip(messages.blob, messages.n, messages.k)]
    weights = [1 + np.unpackbits(np.frombuffer(t, dtype=np.uint8))[:n].astype(np.int64) for t, n in zip(messages.twice, messages.n)]
    values, back = np.unique(np.concatenate(lists), return_inverse=True)
    dup = np.bincount(back, weights=np.concatenate(weights), minlength=len(values)) > 1
    bitmaps = [np.packbits(dup[np.searchsorted(values, x)]).tobytes() for x in lists]
    return pd.DataFrame({"sender": messages.sender, "owner": messages.owner, "bitmap": bitmaps})


def _suspects(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start = np.uint64(_owner_start(row["owner"], owners))
                own = golomb_decode(row["blob"], row["n"], row["k"]) + start
                hit = np.unpackbits(np.frombuffer(row["bitmap"], dtype=np.uint8))[: row["n"]].astype(bool)
                yield pa.RecordBatch.from_arrays([pa.array(own[hit].view(np.int64))], names=["fp"])

    return run


def suspect_fingerprints(fps: DataFrame, scratch: Scratch, owners: int) -> DataFrame:
    """Fingerprints (column fp) that occur on two rows or more, found by the coded exchange."""
    sent = scratch.save(fps.select("fp").mapInArrow(_messages(owners), "sender long, owner long, n long, k int, blob binary, twice binary"), "messages")
    replies = sent.groupBy("owner").applyInPandas(_reply, "sender long, owner long, bitmap binary")
    home = sent.select("sender", "owner", "n", "k", "blob").join(replies, ["sender", "owner"])
    return home.mapInArrow(_suspects(owners), "fp long").distinct()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without [\\x20\\x09-\\x0D]; null counts as
    empty.  Of equal texts the one with most code points stays, then the
    smallest id (null ids last); of repeated rows exactly one stays.  An empty
    table gives an empty result; extra columns are not read.  ``carry`` is a
    Column of the input that comes back as ``carried``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    text = F.coalesce(docs[text_col], F.lit(""))
    extra = [] if carry is None else ["carried"]
    seen = docs.select(docs[id_col].cast("long").alias("doc_id"), F.length(text).alias("n_cp"), normalised(text).alias("norm"), *([] if carry is None else [carry.alias("carried")]))
    slim = scratch.save(
        seen.select("doc_id", "n_cp", F.sha2("norm", 256).alias("text_sha256"), F.xxhash64("norm").alias("fp"), F.monotonically_increasing_id().alias("uid"), *extra), "slim"
    )
    rows = slim.count()
    owners = max(shuffle_partitions(spark), -(-rows // OWNER_ROWS))
    # Never more senders than owners: small files would send as many small messages.
    suspects = scratch.save(suspect_fingerprints(slim.select("fp").coalesce(owners), scratch, owners), "suspects")

    # 2**16 words of 64 bits at most: a proven bound for the broadcast.
    bit = F.expr("shiftleft(1L, cast(shiftright(fp, 42) & 63 as int))")
    words = F.broadcast(suspects.groupBy(F.shiftrightunsigned("fp", 48).alias("word")).agg(F.bit_or(bit).alias("mask")))

    def marked(df: DataFrame) -> DataFrame:
        found = df.withColumn("word", F.shiftrightunsigned("fp", 48)).join(words, "word", "left")
        return found.withColumn("suspect", F.coalesce(F.col("mask").bitwiseAND(bit) != 0, F.lit(False))).drop("word", "mask")

    hit = marked(seen.select("norm").withColumn("fp", F.xxhash64("norm"))).filter("suspect")
    verified = hit.groupBy("norm").agg(F.count("*").alias("same_bytes")).filter("same_bytes > 1").select(F.sha2("norm", 256).alias("text_sha256"), "same_bytes")
    sorted_out = marked(slim)
    doubtful = sorted_out.filter("suspect").drop("suspect")

    last = 2**63 - 1
    best = doubtful.groupBy("text_sha256").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct((-F.col("n_cp")).alias("len"), F.coalesce("doc_id", F.lit(last)).alias("ord"), "uid", "doc_id")).alias("best"),
    ).filter("group_size > 1")
    groups = scratch.save(
        best.join(verified, "text_sha256").select(
            "text_sha256",
            F.when(F.col("group_size") == F.col("same_bytes"), F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share a SHA-256")).cast("long")).alias("group_size"),
            F.col("best.doc_id").alias("best_id"),
            F.col("best.uid").alias("best_uid"),
        ),
        "groups",
    )
    scratch.drop("messages")
    grouped = doubtful.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("best_uid").isNull(), F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("best_uid").isNull() | (F.col("best_uid") == F.col("uid"))).alias("kept"),
        "text_sha256",
        *extra,
    )
    alone = sorted_out.filter("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", *extra)
    return alone.union(grouped)
