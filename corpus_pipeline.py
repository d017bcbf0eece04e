"""The corpus pipeline: quality classifier, exact dedup, SimHash near-dedup with an exact join of what is left, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; all but the last return the columns of ``docs``.  Rows are told apart by
an id of their own, so repeated and null document ids are handled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import exact_dedup as exact
from foliospark.llm import jaccard, kneser_ney, packing, simhash
from foliospark.llm.common import Scratch, table
from foliospark.llm.queries import tokenizer_file

ROW = "__row"
SPREAD = 16
#: Rows of a group that one task compares with the row that stays, about.
PORTION = 2000
#: Unsettled rows from which a component is thinned out before the exact join, and how often.
LARGE, THINNED = 64, 3


def without(marked: DataFrame, gone: DataFrame, columns: list[str], scratch: Scratch) -> DataFrame:
    """The rows of ``marked`` that are not in ``gone``.  What goes is written first, so that its size decides how it is joined."""
    return marked.join(scratch.save(gone, "gone"), ROW, "left_anti").select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text is not above their language's quantile."""
    scratch = Scratch(spark, "stage-quality")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")
    marked = scratch.save(docs.withColumn(ROW, F.monotonically_increasing_id()), "marked")
    gone = kneser_ney.classify(marked, trusted, carry=marked[ROW]).filter("not keep").select(F.col("carried").alias(ROW))
    return without(marked, gone, docs.columns, scratch)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of each group of equal texts that has the longest original."""
    scratch = Scratch(spark, "stage-exact")
    marked = scratch.save(docs.withColumn(ROW, F.monotonically_increasing_id()), "marked")
    gone = exact.exact_dedup(marked, carry=marked[ROW]).filter("not kept").select(F.col("carried").alias(ROW))
    return without(marked, gone, docs.columns, scratch)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies: five-word shingles with a Jaccard similarity of 0.8 or more.

    Every row that goes has a row that stays and is alike, and no two rows that stay
    are alike.  SimHash components go first: the row with the smallest id stays, null
    ids last, and those alike to it go; large components are thinned out further by
    rows drawn from them.  An exact join then finds all pairs alike among
    the rest, of which rows that stood for others stay first, then smaller ids; where
    such a row goes itself, the rows it stood for come back and are joined to all others.
    """
    scratch = Scratch(spark, "stage-near")
    marked = scratch.save(docs.withColumn(ROW, F.monotonically_increasing_id()), "marked")
    found = simhash.similar_components(marked, carry=marked[ROW])
    # Components are told apart by their root: two of them may have the same smallest id.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.col("carried").alias(ROW))
    groups = found.groupBy("root").agg(F.count("*").alias("n"), F.min(order).alias("best")).filter("n > 1").select("root", "n", F.col(f"best.{ROW}").alias("best"))
    # A large group meets its row that stays in several tasks; texts are repeated once for each PORTION rows of their group only.
    portions = lambda n: F.floor(n / PORTION).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt")
    salted = found.withColumn("salt", F.pmod(F.xxhash64("carried"), F.lit(SPREAD)).cast("int")).join(groups.select("root", "best", "n", salts), ["root", "salt"])
    part = F.pmod(F.xxhash64("carried", F.lit(1)), portions(F.col("n")) + 1).cast("int")
    alike = scratch.save(salted.filter("carried <> best").select(F.col("carried").alias(ROW), "best", "n", part.alias("part")), "alike")
    texts = marked.select(ROW, "text")
    best = scratch.save(alike.groupBy(F.col("best").alias(ROW)).agg(F.max("n").alias("n")), "best")
    stays = scratch.settle(texts.join(best, ROW).select(F.col(ROW).alias("best"), F.col("text").alias("other"), "n"), "stays")
    asked = scratch.settle(texts.join(alike.drop("n"), ROW), "asked")
    pairs = asked.join(stays.select("best", "other", F.explode(F.sequence(F.lit(0), portions(F.col("n")))).alias("part")), ["best", "part"])
    claimed = scratch.settle(simhash.confirmed(pairs, ROW, "text", "other").distinct(), "claimed")
    scratch.drop("asked", "stays")
    stood = scratch.save(alike.join(claimed, ROW, "left_semi").select(ROW, "best").distinct(), "stood")
    settled = scratch.save(stood.select(F.col("best").alias(ROW)).distinct(), "settled")
    # Rows of small components have no part in this.
    members = scratch.save(found.select("root", F.col("carried").alias(ROW), "doc_id").join(groups.filter(F.col("n") > LARGE).select("root"), "root", "left_semi"), "crowded")
    for i in range(THINNED):
        open_rows = scratch.save(members.join(claimed.union(settled), ROW, "left_anti"), f"open-{i}")
        sizes = scratch.save(open_rows.groupBy("root").agg(F.count("*").alias("n")).filter(F.col("n") > LARGE), f"sizes-{i}")
        if sizes.isEmpty():
            break
        more, heads = thinned(open_rows, sizes, texts, scratch, i)
        stood = scratch.save(stood.union(more), f"stood-{i}")
        claimed = scratch.save(stood.select(ROW).distinct(), f"claimed-{i}")
        settled = scratch.save(settled.union(heads).distinct(), f"settled-{i}")
    rest = marked.join(claimed, ROW, "left_anti")
    gone = exact_near(spark, rest, settled.select(F.col(ROW).alias("row")), None)
    gone = scratch.save(gone, "gone-first")
    back = scratch.save(stood.join(gone.select(F.col("row").alias("best")), "best", "left_semi").select(F.col(ROW).alias("row")).distinct(), "back")
    gone = gone.select(F.col("row").alias(ROW)).union(claimed.select(ROW).join(back.select(F.col("row").alias(ROW)), ROW, "left_anti"))
    if not back.isEmpty():
        gone = scratch.save(gone, "gone-last")
        again = marked.join(gone, ROW, "left_anti")
        others = again.select(F.col(ROW).alias("row")).join(back, "row", "left_anti")
        gone = gone.union(exact_near(spark, again, others, back).select(F.col("row").alias(ROW)))
    return without(marked, gone, docs.columns, scratch)


def thinned(rows: DataFrame, sizes: DataFrame, texts: DataFrame, scratch: Scratch, turn: int) -> tuple[DataFrame, DataFrame]:
    """(row, best) of rows that go, and the rows that stay for them, of large components (root, n in ``sizes``).

    About sqrt(n) rows of each, by hash, are compared with all others of theirs, so
    that a component of rows more or less alike does not meet in all its pairs.
    """
    member = scratch.save(rows.join(sizes, "root").withColumn("drawn", F.pmod(F.xxhash64(ROW, F.lit(turn + 7)), F.lit(1 << 20)) < F.sqrt("n") / F.col("n") * (1 << 20)), f"member-{turn}")
    some = scratch.save(member.filter("drawn").select("root", F.col(ROW).alias("best"), F.col("doc_id").alias("head_id")).join(texts.select(F.col(ROW).alias("best"), F.col("text").alias("other")), "best"), f"heads-{turn}")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt")
    pairs = member.join(texts, ROW).withColumn("salt", F.pmod(F.xxhash64(ROW), F.lit(SPREAD)).cast("int")).join(some.select("*", salts), ["root", "salt"]).filter(F.col(ROW) != F.col("best")).withColumn("pair", F.monotonically_increasing_id())
    pairs = scratch.save(pairs.select("pair", ROW, "best", "drawn", F.struct(F.col("doc_id").isNull(), "doc_id", ROW).alias("place"), F.struct(F.col("head_id").isNull(), F.col("head_id").alias("doc_id"), F.col("best").alias(ROW)).alias("head"), "text", "other"), f"compared-{turn}")
    sure = scratch.save(pairs.drop("text", "other").join(simhash.confirmed(pairs, "pair", "text", "other"), "pair"), f"sure-{turn}")
    scratch.drop(f"compared-{turn}")
    # Of the rows drawn, smaller ids stay first; then all that are alike to one that stays go.
    between = sure.filter(F.col("drawn") & (F.col("head") < F.col("place"))).select(F.col("best").alias("stays"), F.col(ROW).alias("goes"))
    out = jaccard.first_of(between, Scratch(scratch.spark, "stage-thinned"))
    heads = scratch.save(some.select(F.col("best").alias(ROW)).join(out.select(F.col("row").alias(ROW)), ROW, "left_anti"), f"stay-{turn}")
    more = sure.select(ROW, "best").join(heads.select(F.col(ROW).alias("best")), "best", "left_semi").select(ROW, "best").join(heads, ROW, "left_anti")
    return more, heads


def exact_near(spark: SparkSession, rows: DataFrame, ahead: DataFrame, only: DataFrame | None) -> DataFrame:
    """Rows (column ``row``) that go, as another is alike and stays: those of ``ahead`` come first, then smaller ids."""
    scratch = Scratch(spark, "stage-exact-near")
    pairs = scratch.settle(jaccard.similar_pairs(rows, ROW, "text", scratch, only=only), "pairs")
    ends = pairs.select(F.col("a").alias("row")).union(pairs.select(F.col("b").alias("row"))).distinct()
    named = rows.select(F.col(ROW).alias("row"), "doc_id").join(ends, "row").join(ahead.withColumn("ahead", F.lit(True)), "row", "left")
    order = scratch.settle(named.select("row", F.struct(F.col("ahead").isNull().alias("late"), F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("place")), "order")
    both = pairs.join(order.select(F.col("row").alias("a"), F.col("place").alias("pa")), "a").join(order.select(F.col("row").alias("b"), F.col("place").alias("pb")), "b")
    edges = both.select(F.least("pa", "pb")["row"].alias("stays"), F.greatest("pa", "pb")["row"].alias("goes"))
    return jaccard.first_of(edges, scratch)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 1024-token sequences."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", pack)]

#: The classifier and the tokenizer have no SQL form; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written in the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.save(docs, name)
    return docs
