"""Packing by concatenate-and-cut, with offsets from two-pass prefix sums.

Pass 1 tokenises every document once and writes its ids with the tokens that
precede it inside its partition.  The partition totals (one number each) are
prefix-summed; pass 2 adds them, so each document knows its place in the one
global stream without any shuffle of ids, and windows of fixed length cut it
into pieces.  Pieces at a window's edge are the boundary records: the same
document goes on at offset 0 of the next sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, task_id
from .tokenizer import load_byte_bpe

END_ID = 0


def _encode(json_path: str, rank_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_byte_bpe(json_path, rank_path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        before = 0
        for batch in batches:
            starts, counts, blobs = [], [], []
            for text in batch.column(1).to_pylist():
                ids = np.array(encode(text), dtype="<u4")
                blobs.append(ids.tobytes() + end)
                starts.append(before)
                counts.append(len(ids) + 1)
                before += len(ids) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([task_id()] * len(counts), pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())],
                names=["doc_id", "part", "local_start", "doc_tokens", "ids"],
            )

    return run


def encode_documents(docs: DataFrame, json_path: str, rank_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, part, local_start, doc_tokens and ids (little-endian unsigned 32 bits, ended by id 0)."""
    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return picked.mapInArrow(_encode(json_path, rank_path), "doc_id long, part long, local_start long, doc_tokens long, ids binary")


def pack(docs: DataFrame, json_path: str, rank_path: str, window: int = 1024, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and the piece's ids, if asked for).

    Null text counts as empty and gives the single id 0; null and repeated ids
    are packed like any other row.  Sequences are full but for the last.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    coded = scratch.save(encode_documents(docs, json_path, rank_path, id_col, text_col), "coded")
    # One total for each input partition: as many numbers as there are tasks.
    totals = coded.groupBy("part").agg(F.sum("doc_tokens").alias("total")).orderBy("part").collect()
    bases, base = [], 0
    for row in totals:
        bases.append((row.part, base))
        base += row.total
    offsets = spark.createDataFrame(bases, "part long, base long")
    placed = coded.join(F.broadcast(offsets), "part").withColumn("g", F.col("base") + F.col("local_start"))
    w = int(window)
    cut = f"""transform(sequence(g div {w}, (g + doc_tokens - 1) div {w}), s -> named_struct(
        'start', greatest(s * {w} - g, 0L),
        'length', least((s + 1) * {w} - g, doc_tokens) - greatest(s * {w} - g, 0L),
        'sequence_id', s, 'offset', greatest(g - s * {w}, 0L)))"""
    # The checksum is taken inside the array, so the ids are not repeated for each piece.
    piece = "substring(ids, cast(4 * p.start + 1 as int), cast(4 * p.length as int))"
    extra = f", 'ids', {piece}" if with_ids else ""
    cut = f"transform({cut}, p -> named_struct('start', p.start, 'length', p.length, 'ids_crc32', crc32({piece}), 'sequence_id', p.sequence_id, 'offset', p.offset{extra}))"
    pieces = placed.select("doc_id", "doc_tokens", F.expr(cut).alias("pieces")).select("doc_id", "doc_tokens", F.explode("pieces").alias("p"))
    names = ["start", "length", "ids_crc32"], ["sequence_id", "offset"] + ["ids"] * with_ids
    return pieces.select("doc_id", *[F.col(f"p.{c}").alias(c) for c in names[0]], "doc_tokens", *[F.col(f"p.{c}").alias(c) for c in names[1]])
