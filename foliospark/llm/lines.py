"""Line dedup with a log-template tree.

A line's tokens with digits are fields from the start.  The tree is fixed in
depth: token count, then the first ``DEPTH`` tokens.  Inside a leaf, what varies
becomes a field too.  The support of a token at a position is the number of
documents of all the leaf's distinct lines that have it there, and the template
of a line is the line with its ``allowed`` least supported tokens as fields, the
later one first among equals; ``allowed`` is the share ``1 - similarity`` of its
positions, rounded down.  Lines of one template have the same constants with the
same supports, so they give the same template, and two lines that share one agree
in ``similarity`` of their positions at least.

Supports are sums, so the templates depend neither on partitions nor on the
order or number of a leaf's lines: every leaf, of two lines or of a billion, is
handled by the same combinable groupings, and none lands in one task.

Hashes have 64 bits and are compared within a leaf only; tokens are compared as
they are.  Leaves on fewer than ``min_docs`` documents hold no recurring
template and are put aside first, by a bitmap of fixed size (2**22 bits, false
hits cost time only).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

DEPTH = 3
SIMILARITY = 0.8
MIN_DOCS = 5
SPREAD = 16
FIELD = b"<*>"
DIGIT = re.compile(rb"[0-9]")


def mask(line: bytes) -> list[bytes]:
    """The tokens of a line, those with a digit as variable fields."""
    toks = line.split()
    if DIGIT.search(line):
        toks = [FIELD if DIGIT.search(t) else t for t in toks]
    return toks


def _signed(h: int) -> int:
    return h - 2**64 if h >= 2**63 else h


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: hash and leaf of each distinct masked line, and for each line the number of its distinct one (-1: blank)."""
    h = xxhash.xxh64_intdigest
    for batch in batches:
        places, hashes, leaves = [], [], []
        for text in batch.column(1).to_pylist():
            at, seen, ls = [], {}, []
            for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
                toks = mask(line)
                if not toks:
                    at.append(-1)
                    continue
                name = _signed(h(b" ".join(toks), 3))
                place = seen.get(name)
                if place is None:
                    place = seen[name] = len(seen)
                    ls.append(_signed(h(b"%d " % len(toks) + b" ".join(toks[:DEPTH]), 5)))
                at.append(place)
            places.append(at)
            hashes.append(list(seen))
            leaves.append(ls)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(places, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64())), pa.array(leaves, pa.list_(pa.int64()))], names=["doc_id", "text", "at", "h", "leaf"]
        )


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toks = [mask(line.encode("utf-8", "surrogatepass")) for line in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(toks, pa.list_(pa.binary()))], names=["leaf", "h", "docs", "toks"])


def _in_bitmap(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """Rows whose leaf may be among ``leaves``; at most 2**16 words of 64 bits are broadcast."""
    word, bit = F.shiftrightunsigned("leaf", 48), F.expr("shiftleft(1L, cast(shiftright(leaf, 42) & 63 as int))")
    bitmap = leaves.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("mask"))
    return rows.withColumn("word", word).join(F.broadcast(bitmap), "word").filter(F.col("mask").bitwiseAND(bit) != 0).drop("word", "mask")


def templates(lines: DataFrame, similarity: float) -> DataFrame:
    """leaf, h and root (the template's name inside the leaf) of distinct lines (leaf, h, docs, toks)."""
    field = F.lit(FIELD)
    each = lines.select("leaf", "h", "docs", F.posexplode("toks").alias("pos", "tok"))
    known = each.filter(F.col("tok") != field)
    # What only one line has is supported by that line's own documents.
    support = known.groupBy("leaf", "pos", "tok").agg(F.sum("docs").alias("support"), F.count("*").alias("lines")).filter("lines > 1").drop("lines")
    # A constant of a large leaf meets all its lines, so both sides are salted.
    salt = F.pmod(F.col("h"), F.lit(SPREAD)).cast("int")
    support = support.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    held = each.withColumn("salt", salt).join(support, ["leaf", "pos", "tok", "salt"], "left")
    token = F.struct("pos", F.coalesce("support", "docs").alias("support"), "tok")
    whole = held.groupBy("leaf", "h").agg(F.array_sort(F.collect_list(token)).alias("toks"))
    rank = lambda t: F.struct(t["support"].alias("support"), (-t["pos"]).alias("place"))
    ranks = F.array_sort(F.transform(F.filter("toks", lambda t: t["tok"] != field), rank))
    allowed = F.least(F.floor(F.size("toks") * F.lit(1 - similarity) + 1e-9).cast("int"), F.size("ranks"))
    whole = whole.withColumn("ranks", ranks).withColumn("edge", F.when(allowed > 0, F.get("ranks", allowed - 1)))
    pattern = F.transform("toks", lambda t: F.when(F.coalesce(rank(t) <= F.col("edge"), F.lit(False)), field).otherwise(t["tok"]))
    return whole.select("leaf", "h", F.xxhash64(pattern).alias("root"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_lines, n_dropped and text (the lines that stay) of every row.

    Lines end at \\n; blank lines are never templates.  Null text counts as
    empty (one blank line).  A line that repeats inside one document counts
    once for it; repeated rows count as documents of their own.  An empty table
    gives an empty result; extra columns are not read.  Lines and texts of any
    length are taken whole.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    parsed = picked.mapInArrow(_parse, "doc_id long, text string, at array<int>, h array<long>, leaf array<long>")
    parsed = scratch.save(parsed.withColumn("uid", F.monotonically_increasing_id()), "parsed")

    busy = parsed.select(F.explode(F.array_distinct("leaf")).alias("leaf")).groupBy("leaf").count().filter(F.col("count") >= min_docs).select("leaf")
    busy = scratch.save(busy, "busy")
    present = _in_bitmap(parsed.select("uid", F.explode(F.arrays_zip("leaf", "h")).alias("x")).select("uid", "x.leaf", "x.h"), busy)
    distinct = scratch.save(present.groupBy("leaf", "h").agg(F.count("*").alias("docs")).join(busy, "leaf", "left_semi"), "distinct")

    # Only leaves with several lines have anything to generalise.
    crowded = scratch.save(distinct.groupBy("leaf").count().filter("count > 1").select("leaf"), "crowded")
    numbered = F.filter(F.zip_with(F.split("text", "\n", -1), "at", lambda line, at: F.struct(line.alias("line"), at.alias("at"))), lambda x: x["at"] >= 0)
    placed = parsed.select("leaf", "h", F.explode(numbered).alias("x")).select(F.get("leaf", F.col("x.at")).alias("leaf"), F.get("h", F.col("x.at")).alias("h"), "x.line")
    texts = _in_bitmap(placed, crowded).dropDuplicates(["leaf", "h"])
    full = distinct.join(crowded, "leaf", "left_semi").join(texts, ["leaf", "h"]).select("leaf", "h", "docs", "line")
    grown = templates(full.mapInArrow(_tokens, "leaf long, h long, docs long, toks array<binary>"), similarity)
    single = distinct.join(crowded, "leaf", "left_anti").select("leaf", "h", F.col("h").alias("root"))
    named = scratch.save(grown.union(single), "named")

    carried = present.join(named, ["leaf", "h"]).select("uid", "leaf", "root").distinct()
    recurring = carried.groupBy("leaf", "root").count().filter(F.col("count") >= min_docs).select("leaf", "root")
    # A very common line is looked up in several tasks.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt")
    gone = scratch.save(named.join(recurring, ["leaf", "root"], "left_semi").select("leaf", "h"), "gone").select("leaf", "h", salts)
    hit = present.withColumn("salt", F.pmod("uid", F.lit(SPREAD)).cast("int")).join(gone, ["leaf", "h", "salt"], "left_semi")
    dropped = hit.groupBy("uid").agg(F.collect_set("h").alias("dropped"))
    # Most documents lose some line, so the smaller side is no candidate for a broadcast.
    out = parsed.select("uid", "doc_id", "text", "at", "h").join(dropped.hint("merge"), "uid", "left")
    lost = F.array_sort(F.filter(F.transform("h", lambda x, i: F.when(F.array_contains("dropped", x), i)), lambda i: i.isNotNull()))
    out = out.withColumn("lost", F.when(F.col("dropped").isNotNull(), lost))
    zipped = F.zip_with(F.split("text", "\n", -1), "at", lambda line, at: F.struct(line.alias("line"), at.alias("at")))
    stays = F.filter(zipped, lambda x: ~F.array_contains("lost", x["at"]))
    lines = F.when(F.col("lost").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stays, lambda x: x["line"]), "\n"))
    count = F.when(F.col("lost").isNull(), 0).otherwise(F.size(F.filter("at", lambda at: F.array_contains("lost", at))))
    return out.select("doc_id", F.size("at").cast("long").alias("n_lines"), count.cast("long").alias("n_dropped"), lines.alias("text"))
