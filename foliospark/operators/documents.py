"""Document metadata: dates, years, titles, aliases, page voices, ledgers and front-matter updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions import urls as U

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
GENERIC_TITLES = ("contents", "table of contents", "introduction")


def published_date(url: Column) -> Column:
    """ISO date that the word published introduces in a URL; impossible dates are NULL."""
    pattern = r"(?i)published[-_ ]+([0-3]?\d)[-_ ]+([a-z]+)[-_ ]+(20\d{2})"
    plain = U.unquote(F.coalesce(url, F.lit("")))
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(plain, pattern, 2)))
    parts = F.concat_ws("-", F.regexp_extract(plain, pattern, 3), month.cast("string"), F.regexp_extract(plain, pattern, 1))
    return F.when(month > 0, F.date_format(F.try_to_date(parts, "yyyy-M-d"), "yyyy-MM-dd"))


def pdf_year(stamp: Column, latest: int) -> Column:
    """Year of a PDF date stamp from 1990 to the latest year allowed."""
    year = F.regexp_extract(stamp, r"^D:([12]\d{3})", 1).try_cast("int")
    return F.when(year.between(1990, latest), year)


def temporal(df: DataFrame, url: str, pdf_date: str, referrers: str, snapshot: str) -> DataFrame:
    """Adds published_at, analysis_year, their bases, retrieved_at and source_page_url; a URL's date goes before referrers' dates."""
    own = published_date(F.col(url))
    dates = F.filter(F.transform(F.coalesce(F.col(referrers), F.array().cast("array<string>")), published_date), lambda d: d.isNotNull())
    other = F.try_element_at(dates, F.lit(1))
    year = pdf_year(F.col(pdf_date), int(snapshot[:4]))
    out = df.withColumn("published_at", F.coalesce(own, other))
    out = out.withColumn("published_at_basis", F.when(own.isNotNull(), "source-url-explicit-published-date").when(other.isNotNull(), "referrer-url-explicit-published-date"))
    out = out.withColumn("analysis_year", F.coalesce(F.substring("published_at", 1, 4).cast("int"), year))
    out = out.withColumn("analysis_year_basis", F.coalesce("published_at_basis", F.when(year.isNotNull(), "pdf-creation-date-proxy")))
    return out.withColumn("retrieved_at", F.lit(snapshot)).withColumn("source_page_url", F.try_element_at(F.col(referrers), F.lit(1)))


def title(materialised: Column, pdf_title: Column, text: Column, url: Column) -> Column:
    """Materialised title, else the PDF's, else the first heading unless generic, else one made from the URL."""
    heading = T.first_heading(text)
    return F.coalesce(F.nullif(F.trim(materialised), F.lit("")), F.nullif(F.trim(pdf_title), F.lit("")), F.when(~F.lower(heading).isin(*GENERIC_TITLES), heading), F.nullif(U.title_from_url(url), F.lit("")))


def aliases(front: Column, crawled: Column) -> Column:
    """Sorted distinct addresses of both sources; the first is canonical."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(front, none), F.coalesce(crawled, none)))


def source_metadata(files: DataFrame, sha: str, url: str, referrers: str, modified: str, order: str) -> DataFrame:
    """Per hash: sorted distinct URLs and referrers, and the first non-null modification stamp in file order."""
    return files.groupBy(sha).agg(
        F.array_sort(F.collect_set(url)).alias("urls"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(referrers)))).alias("referrers"),
        F.min_by(modified, F.when(F.col(modified).isNotNull(), F.col(order))).alias("last_modified"),
    )


def nested_aliases(docs: DataFrame, url: str, sha: str) -> DataFrame:
    """Malformed URLs that hold another document's path become that document's aliases."""
    keyed = docs.withColumn("_own", F.lower(U.unquote(U.path(F.col(url))))).withColumn("_nested", U.nested_key(F.col(url)))
    broken = keyed.filter("_nested is not null").select(F.col("_nested").alias("_own"), F.col(url).alias("alias"), F.col(sha).alias("_other"))
    return keyed.join(broken, "_own").filter(F.col(sha) != F.col("_other")).groupBy(sha).agg(F.array_sort(F.collect_set("alias")).alias("aliases"))


def page_voice(pages: DataFrame, overrides: DataFrame, key: str, number: str, voice: str) -> DataFrame:
    """Voice of each page: its one override, else the document's; mixed documents need an override for every page.

    Adds ``final_voice``, ``voice_basis`` and ``fault`` (overlapping overrides, uncovered page of a mixed document).
    """
    on = (F.col(f"p.{key}") == F.col(f"o.{key}")) & F.col(f"p.{number}").between(F.col("o.start_page"), F.col("o.end_page"))
    hit = pages.alias("p").join(overrides.alias("o"), on, "left").groupBy(*[F.col(f"p.{c}").alias(c) for c in pages.columns]).agg(F.count("o.voice").alias("_n"), F.min("o.voice").alias("_v"))
    fault = F.when(F.col("_n") > 1, "overlapping-overrides").when((F.col(voice) == "mixed") & (F.col("_n") == 0), "uncovered-page")
    basis = F.when(F.col("_n") > 0, "page-override").otherwise(F.concat(F.lit("document:"), voice))
    return hit.withColumn("fault", fault).withColumn("final_voice", F.coalesce("_v", voice)).withColumn("voice_basis", basis).drop("_n", "_v")


def valid_overrides(rows: DataFrame, domains: dict[str, list[str]], defaults: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Override rows with blanks defaulted, and those whose values lie outside their domains."""
    out = rows
    for c in domains:
        out = out.withColumn(c, F.nullif(F.trim(F.col(c)), F.lit("")))
    for c, default in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), default))
    bad = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & ~F.col(c).isin(*v), F.lit(c)) for c, v in domains.items()]))
    marked = out.withColumn("_bad", bad)
    return marked.filter(F.size("_bad") == 0).drop("_bad"), marked.filter(F.size("_bad") > 0).withColumnRenamed("_bad", "outside_domain")


def merge_ledger(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Union of two ledgers in which a new row replaces an old one with the same key."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"))


def update_front_matter(df: DataFrame, meta: str, values: dict[str, Column]) -> DataFrame:
    """Front matter with canonical keys replaced, and whether anything changed; a key that is not there is an error."""
    there = F.lit(True)
    for k in values:
        there = there & F.map_contains_key(meta, k)
    fresh = F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*values.values()))
    merged = F.map_concat(F.map_filter(meta, lambda k, v: ~k.isin(*values)), fresh)
    same = F.lit(True)
    for k, v in values.items():
        same = same & F.col(meta)[k].eqNullSafe(v)
    return df.withColumn("updated", F.when(there, merged).otherwise(F.raise_error(F.lit("a canonical key is missing")).cast("map<string,string>"))).withColumn("changed", ~same)


def published_or_derived(df: DataFrame, materialised: Column, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Fields of materialised documents as published, of others as derived; published values are not classified again."""
    return df.select(*df.columns, *[F.when(materialised, F.col(published)).otherwise(F.col(derived)).alias(name) for name, (published, derived) in pairs.items()])
