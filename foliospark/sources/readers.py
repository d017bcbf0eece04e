"""Readers: keyed and tolerant CSV, JSON lines, crawl state, catalogues, Markdown pages, optional columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.operators.ingest import last_wins

#: The page marker of Markdown artefacts.
PAGE_MARKER = r"<!-- source-page: (\d+) -->\s*\n<a id=\"page-\d+\"></a>\s*\n"


def read_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """All-string CSV with a header; quoted line breaks, NUL characters and a byte order mark are tolerated.  Reads .gz and .zst alike."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(path)
    df = df.toDF(*[clean_header(c) for c in df.columns])
    return df.select(*[F.translate(F.col(f"`{c}`"), "\0", "").alias(c) for c in df.columns])


def clean_header(name: str) -> str:
    """A header without a byte order mark; a broken currency sign is repaired."""
    return name.replace("﻿", "").replace("�", "€").strip()


def read_keyed_csv(spark: SparkSession, path: str, key: str) -> DataFrame:
    """CSV in which a later row replaces an earlier one with the same key (file order)."""
    return last_wins(read_csv(spark, path).withColumn("_seq", F.monotonically_increasing_id()), key, "_seq").drop("_seq")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with their order (``seq``); blank lines are skipped."""
    lines = spark.read.text(path).withColumn("seq", F.monotonically_increasing_id()).filter(F.trim("value") != "")
    return lines.select("seq", F.from_json("value", schema).alias("r")).select("seq", "r.*")


def read_json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def crawl_files(state: DataFrame, status: str = "downloaded", kind: str | None = None) -> DataFrame:
    """One row for each file of a crawl state whose ``files`` is a map of structs."""
    rows = state.select(F.explode("files").alias("canonical_url", "f")).select("canonical_url", "f.*").filter(F.col("status") == status)
    return rows.filter(F.col("format") == kind) if kind else rows


CKAN = "struct<result:struct<results:array<struct<name:string,title:string,resources:array<struct<id:string,name:string,url:string,format:string>>>>>>"


def ckan_resources(responses: DataFrame, body: str) -> DataFrame:
    """Data sets x resources of package searches; web addresses only."""
    sets = responses.select(F.explode(F.from_json(body, CKAN)["result"]["results"]).alias("p"))
    rows = sets.select(F.col("p.name").alias("dataset"), F.col("p.title").alias("dataset_title"), F.explode("p.resources").alias("r"))
    return rows.select("dataset", "dataset_title", F.col("r.id").alias("resource_id"), F.col("r.name").alias("resource"), F.col("r.url").alias("url"), F.upper("r.format").alias("format")).filter(F.col("url").rlike("(?i)^https?://"))


def corpora(frames: dict[str, DataFrame], statuses=("success", "low_text")) -> DataFrame:
    """Manifests of several roots under one schema, tagged by corpus, usable rows only."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn("corpus", F.lit(n)) for n, f in frames.items()]).filter(F.col("status").isin(*statuses))


def front_matter(text: Column) -> Column:
    """Map of key -> JSON text of the block between --- lines; NULL without such a block at the very start."""
    block = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---\n", 1)
    lines = F.filter(F.split(block, "\n"), lambda line: line.contains(":"))
    entries = F.transform(lines, lambda line: F.struct(F.trim(F.substring_index(line, ":", 1)).alias("k"), F.trim(F.substring(line, F.instr(line, ":") + 1, F.length(line))).alias("v")))
    return F.when(text.rlike(r"(?s)\A---\n.*?\n---\n"), F.map_from_entries(entries))


def body(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\A---\n.*?\n---\n", "")


def pages(text: Column) -> Column:
    """Array of {page_number, text} between page markers, stripped of all white space around."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(PAGE_MARKER), 1), lambda n: n.cast("int"))
    parts = F.slice(F.split(text, PAGE_MARKER, -1), 2, 1_000_000)
    strip = lambda t: F.regexp_replace(t, r"(?U)\A[\s\x1c-\x1f\x85]+|[\s\x1c-\x1f\x85]+\z", "")
    return F.zip_with(numbers, parts, lambda n, t: F.struct(n.alias("page_number"), strip(t).alias("text")))


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """One row for each page of each Markdown artefact: path, front matter and page; a file without front matter is an error row."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value"))
    parsed = files.select("path", front_matter(F.col("value")).alias("meta"), pages(body(F.col("value"))).alias("pages"))
    return parsed.select("path", "meta", F.when(F.col("meta").isNull(), "no front matter").alias("error"), F.explode_outer("pages").alias("p")).select("path", "meta", "error", "p.*")


def structure_faults(markdown_pages: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Files whose pages are not numbered 1..N or whose N differs from the expected page count."""
    found = markdown_pages.groupBy(key).agg(F.count("page_number").alias("n"), F.array_sort(F.collect_set("page_number")).alias("numbers"))
    joined = expected.join(found, key, "left")
    fault = F.when(F.col("n").isNull(), "missing").when(F.col("numbers") != F.sequence(F.lit(1), F.greatest(F.col("n"), F.lit(1)).cast("int")), "numbering").when(F.col("n") != F.col("page_count"), "page-count")
    return joined.withColumn("fault", fault).filter("fault is not null").select(key, "fault")


def published(spark: SparkSession, folder: str, wanted: list[str]) -> tuple[DataFrame, list[str]]:
    """A published table with the wanted columns it has (older releases lack some) and the names of the others."""
    df = spark.read.parquet(folder)
    return df.select(*[c for c in wanted if c in df.columns]), [c for c in wanted if c not in df.columns]


def audit_sample(pages_: Column) -> Column:
    """Up to five sampled page numbers, counted from 0."""
    last = pages_ - 1
    return F.array_distinct(F.array_sort(F.transform(F.array(F.lit(0), F.floor(pages_ / 4), F.floor(pages_ / 2), F.floor(3 * pages_ / 4), last), lambda n: F.least(n.cast("int"), last.cast("int")))))


def audit_status(encrypted: Column, pages_: Column, sampled_characters: Column, error: Column) -> Column:
    return F.when(error.isNotNull(), "error").when(encrypted, "encrypted").when(pages_ <= 0, "zero_pages").when(sampled_characters < 30, "likely_ocr").otherwise("ok")
