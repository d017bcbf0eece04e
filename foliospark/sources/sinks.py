"""Sinks: published Parquet tables, manifests, Markdown artefacts, content-addressed layout and summaries."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.urls import blob_key
from foliospark.operators.sequences import budget_prefix


def write_documents(df: DataFrame, path: str, order: str, level: int = 9) -> None:
    """Range-sorted zstd Parquet: files and row groups cover disjoint key ranges, so key look-ups skip most of them."""
    df.repartitionByRange(F.col(order)).sortWithinPartitions(order).write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)


def write_pages(pages: DataFrame, documents: DataFrame, path: str, key: str, number: str, carried: list[str], block_bytes: int = 8 << 20) -> None:
    """Pages with document columns carried in, sorted by document and page, in small row groups for selective reads."""
    joined = pages.join(documents.select(key, *carried), key)
    joined.repartitionByRange(F.col(key), F.col(number)).sortWithinPartitions(key, number).write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", block_bytes).parquet(path)


def flattened(df: DataFrame, separator: str = " | ") -> DataFrame:
    """List columns as joined text, other nested columns as JSON, for tabular sinks."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        out.append(F.array_join(f.name, separator).alias(f.name) if kind == "array<string>" else F.to_json(f.name).alias(f.name) if kind.startswith(("array", "map", "struct")) else F.col(f.name))
    return df.select(*out)


def write_manifest(df: DataFrame, path: str, order: str, fields: list[str] | None = None, codec: str | None = None) -> None:
    """CSV manifest in a fixed field order, sorted; ``codec`` may be gzip or bzip2 (for zstd see ``binary.zstd_bytes``)."""
    rows = flattened(df.select(*fields) if fields else df).repartitionByRange(F.col(order)).sortWithinPartitions(order)
    writer = rows.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("lineSep", "\n").option("emptyValue", "")
    (writer.option("compression", codec) if codec else writer).csv(path)


def csv_escape(value: Column) -> Column:
    """RFC 4180: quoted if it holds a comma, quote or line break; null is empty."""
    v = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(v.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)


def yaml_scalar(value: Column) -> Column:
    """A front-matter value: JSON text, null spelled out."""
    return F.when(value.isNull(), "null").otherwise(F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r'^\{"v":(.*)\}$', 1))


def markdown(pages: DataFrame, key: str, number: str, text: str, meta: dict[str, str]) -> DataFrame:
    """One artefact for each document: front matter and pages behind their anchors, in page order."""
    head = F.concat_ws("\n", F.lit("---"), *[F.concat(F.lit(f"{name}: "), F.coalesce(F.first(F.to_json(F.struct(F.col(c).alias("v")))), F.lit("{}"))) for name, c in meta.items()], F.lit("---"))
    head = F.regexp_replace(F.regexp_replace(head, r"(?m)^(\w+): \{\"v\":(.*)\}$", "$1: $2"), r"(?m)^(\w+): \{\}$", "$1: null")
    page = F.concat(F.lit("<!-- source-page: "), F.col(number), F.lit(' -->\n<a id="page-'), F.col(number), F.lit('"></a>\n'), F.col(text), F.lit("\n"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), page.alias("t"))))
    return pages.groupBy(key).agg(head.alias("head"), ordered.alias("parts")).select(key, F.concat("head", F.lit("\n"), F.array_join(F.transform("parts", lambda p: p["t"]), "\n")).alias("markdown"))


def write_markdown(artefacts: DataFrame, path: str, key: str) -> None:
    """Text of each artefact in a folder of its own, sharded by the first four digits of the key."""
    shards = artefacts.select("markdown", F.substring(key, 1, 2).alias("a"), F.substring(key, 3, 2).alias("b"), F.col(key).alias("sha"))
    shards.write.mode("overwrite").partitionBy("a", "b", "sha").option("lineSep", "\n").text(path)


def blob_layout(files: DataFrame) -> DataFrame:
    """Content-addressed keys: one row for each hash with its paths, and the bytes that copies would have taken."""
    named = files.withColumn("suffix", F.lower(F.regexp_extract("path", r"(\.[A-Za-z0-9]+)$", 1)))
    out = named.groupBy("sha256").agg(F.min("path").alias("path"), F.min("suffix").alias("suffix"), F.max("length").alias("bytes"), F.count("*").alias("copies"), F.array_sort(F.collect_set("path")).alias("paths"))
    return out.withColumn("key", blob_key(F.col("sha256"), F.col("suffix"), F.lit("bin"))).withColumn("bytes_saved", (F.col("copies") - 1) * F.col("bytes"))


def extraction_preferences(candidates: DataFrame, sha: str, url: str, corpus: str) -> DataFrame:
    """For hashes in several corpora: office if the URL path names an office format, else pdf."""
    office = F.lower(F.col(url)).rlike(r"\.(docx|doc|pptx|zip)([?#]|$)")
    many = candidates.groupBy(sha).agg(F.countDistinct(corpus).alias("n"), F.max(office).alias("_office")).filter("n > 1")
    return many.select(sha, F.when(F.col("_office"), "office").otherwise("pdf").alias("preferred"))


def bundle_text(rows: DataFrame, order: str | list[str], header: Column, text: str, cap: int) -> DataFrame:
    """Excerpts of 200 characters and more behind headers, as long as the running total of text stays within a cap.

    ``order`` is the numeric column of places in the bundle; the running total is taken in two
    steps, so excerpts beyond the cap are not sorted.
    """
    body = F.regexp_replace(F.regexp_replace(F.col(text), r"\n{3,}", "\n\n"), r"(?m)[ \t]+$", "")
    kept = rows.withColumn("_t", F.trim(body)).filter(F.length("_t") >= 200).withColumn("_size", F.length("_t").cast("long"))
    within = budget_prefix(kept, order if isinstance(order, str) else order[0], "_size", cap).withColumnRenamed("running_total", "running")
    return within.withColumn("excerpt", F.concat(header, F.lit("\n"), F.col("_t"), F.lit("\n"))).drop("_t", "_size")


def summary(df: DataFrame, **measures: Column) -> str:
    """One aggregation as sorted JSON, to lie next to its table."""
    row = df.agg(*[c.alias(n) for n, c in measures.items()]).first()
    return json.dumps(row.asDict(), sort_keys=True, default=str)
