"""Crawl and conversion state as batch merges: upserts, repairs, candidates, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_REFERRERS = 20


def upsert(rows: DataFrame, key: str, order: list[str], values: list[str], source: str, referrer: str | None = None) -> DataFrame:
    """One record for each key: all sources sorted, latest non-null value of each field.

    With ``referrer`` also the first MAX_REFERRERS distinct referrers in order of
    arrival, picked before they are collected, so a key with very many costs no task.
    """
    latest = [F.max_by(v, F.when(F.col(v).isNotNull(), F.struct(*order))).alias(v) for v in values]
    out = rows.groupBy(key).agg(F.array_sort(F.collect_set(source)).alias("sources"), F.count("*").alias("n_updates"), *latest)
    out = out.withColumn("n_sources", F.size("sources").cast("long"))
    if referrer is None:
        return out
    firsts = rows.filter(F.coalesce(F.col(referrer), F.lit("")) != "").groupBy(key, F.col(referrer).alias("_r")).agg(F.min(F.struct(*order)).alias("_at"))
    few = firsts.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_at", "_r"))).filter(F.col("_n") <= MAX_REFERRERS)
    listed = few.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_r"))), lambda x: x["_r"]).alias("referrers"))
    return out.join(listed, key, "left").withColumn("referrers", F.coalesce("referrers", F.array().cast("array<string>")))


def source_matches(sources, only: str):
    """Whether a record belongs to a source; ``all`` takes every record."""
    return F.lit(True) if only == "all" else F.array_contains(sources, only)


#: File types that are fetched by default, and the assets that may be added.
DEFAULT_TYPES = ("pdf", "csv", "xlsx", "xls", "docx", "doc", "zip", "json", "xml", "ods", "pptx", "ppt", "txt", "rtf", "tsv", "parquet", "geojson")
ASSET_TYPES = ("jpg", "jpeg", "png", "gif", "svg", "webp", "avif", "mp3", "mp4", "wav", "webm", "css", "js", "woff", "woff2", "ttf", "eot")


def selected_types(names: str | None = None, assets: bool = False) -> list[str]:
    """File types of a comma-separated choice, in lower case without dots; the default types without one."""
    chosen = DEFAULT_TYPES if names is None else [n.strip().lower().removeprefix(".") for n in names.split(",")]
    return sorted({n for n in chosen if n} | (set(ASSET_TYPES) if assets else set()))


def repair_records(broken: DataFrame, good: DataFrame, alias: str, key: str, repaired_key: str) -> DataFrame:
    """Failed records settled: key, new_key and action.

    The repaired address goes first, else the one good record with the same alias
    key; a record whose new address is a good record's is merged into it, any
    other is rewritten, and one without a new address is left.
    """
    found = repair_aliases(broken, good.select(alias, F.col(key).alias("_target")), alias, "_target")
    target = F.coalesce(F.when(F.col(repaired_key) != F.col(key), F.col(repaired_key)), F.when(F.col("repaired") != F.col(key), F.col("repaired")))
    known = good.select(F.col(key).alias("new_key"), F.lit(True).alias("_known")).distinct()
    out = found.withColumn("new_key", target).join(known, "new_key", "left")
    action = F.when(F.col("_known"), "merged").when(F.col("new_key").isNotNull(), "rewritten").otherwise("left")
    return out.select(key, "new_key", action.alias("action"))


def replay_journal(journal: DataFrame, key: str, order: list[str], ok: str) -> DataFrame:
    """Last success of each key; a key without one keeps its last failure for retry."""
    rank = F.struct(F.coalesce(F.col(ok), F.lit(False)).alias("_ok"), *order)
    columns = [c for c in journal.columns if c != key]
    return journal.groupBy(key).agg(F.max_by(F.struct(*columns), rank).alias("_r")).select(key, "_r.*")


def pending(items: DataFrame, journal: DataFrame, key: str, ok: str, force: bool = False) -> DataFrame:
    return items if force else items.join(journal.filter(F.col(ok)), key, "left_anti")


def repair_aliases(broken: DataFrame, good: DataFrame, alias: str, target: str) -> DataFrame:
    """Broken records joined to the one good record with their alias key; several candidates repair nothing."""
    single = good.groupBy(alias).agg(F.count("*").alias("_n"), F.max(target).alias("repaired")).filter("_n = 1").drop("_n")
    return broken.join(single, alias, "left")


def download_candidates(files: DataFrame, status: str, retry_failed: bool) -> DataFrame:
    return files.filter(F.col(status).isin(["pending", "failed"] if retry_failed else ["pending"]))


def replay_with_outputs(journal: DataFrame, outputs: DataFrame, key: str, order: list[str], ok: str, output: str) -> DataFrame:
    """As ``replay_journal``, but a success counts only if its output is in the listing (column ``output``)."""
    there = outputs.select(output).distinct().withColumn("_there", F.lit(True))
    checked = journal.join(there, output, "left").withColumn(ok, F.coalesce(F.col(ok), F.lit(False)) & F.col("_there").isNotNull()).drop("_there")
    return replay_journal(checked, key, order, ok)


def summarise_sources(files: DataFrame, sources: str, size: str) -> DataFrame:
    """As ``summarise``, a file once for each of its sources."""
    return summarise(files.withColumn("_source", F.explode(F.array_distinct(sources))).withColumnRenamed("_source", "source"), "source", size)


def next_status(attempted, blocked, ok):
    """pending -> blocked, downloaded or failed."""
    return F.when(~attempted, "pending").when(blocked, "blocked").when(ok, "downloaded").otherwise("failed")


def summarise(files: DataFrame, dimension: str, size: str) -> DataFrame:
    return files.groupBy(dimension).agg(F.count("*").alias("files"), F.coalesce(F.sum(size), F.lit(0)).alias("known_bytes"))


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Keyed table in which a later row replaces an earlier one."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).filter("_n = 1").drop("_n")
