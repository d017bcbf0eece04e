"""URL keys, canonical forms, links, paths and robots rules; native but for relative link resolution."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Characters that no file name may hold, and device names of one operating system.
RESERVED = r'[<>:"/\\|?*\x00-\x1f]'
DEVICES = r"(?i)^(con|prn|aux|nul|com[1-9]|lpt[1-9])$"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def unquote(value: Column) -> Column:
    """Percent-decoding that leaves + alone; bad escapes leave the value as it is."""
    return F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)


def sorted_query(url: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(query(url), "&"), lambda p: p != "")), "&")


def url_key(url: Column) -> Column:
    """host without www. | decoded lower path | sorted query pairs."""
    return F.concat_ws("|", F.regexp_replace(host(url), r"^www\.", ""), F.lower(unquote(path(url))), sorted_query(url))


def canonical(url: Column) -> Column:
    """Without fragment, host in lower case, query pairs sorted."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    pairs = sorted_query(url)
    return F.concat(scheme, F.lit("://"), host(url), F.when(path(url) == "", "/").otherwise(path(url)), F.when(pairs != "", F.concat(F.lit("?"), pairs)).otherwise(""))


def extension(url: Column) -> Column:
    """Up to ten letters or digits behind the last dot of the decoded lower path, else empty."""
    return F.regexp_extract(F.lower(unquote(path(url))), r"\.([a-z0-9]{1,10})$", 1)


def title_from_url(url: Column) -> Column:
    """Stem of the last path segment, runs of - and _ as spaces, at most 500 characters."""
    stem = F.regexp_replace(F.substring_index(unquote(path(url)), "/", -1), r"\.[A-Za-z0-9]{1,10}$", "")
    return F.left(F.trim(F.regexp_replace(stem, r"[-_ ]+", " ")), F.lit(500))


def nested_key(url: Column, marker: str = "/docs/default-source/") -> Column:
    """Path from a marker on, if the marker is not at the start of the path."""
    p = F.lower(unquote(path(url)))
    at = F.instr(p, marker)
    return F.when(at > 1, F.substring(p, at, F.length(p)))


def alias_key(url: Column, parameter: str = "sfvrsn") -> Column:
    """Base name and revision parameter; NULL without the parameter."""
    value = F.regexp_extract(query(url), rf"(?:^|&){parameter}=([^&]*)", 1)
    return F.when(value != "", F.concat_ws("|", F.lower(F.substring_index(path(url), "/", -1)), value))


def repair(url: Column, parameter: str = "sfvrsn") -> Column:
    """Cut at a quote or angle bracket and trim junk behind the revision value."""
    cut = F.regexp_extract(url, "^[^\"'<>]*", 0)
    return F.regexp_replace(cut, rf"([?&]{parameter}=[A-Za-z0-9]+)[^&#]*", "$1")


def file_suffix(name: Column) -> Column:
    """The extension of a file name with its dot; empty for names that only begin with one."""
    return F.regexp_extract(name, r"(?s)[^.].*(\.[^.]*)$", 1)


def _stem(name: Column) -> Column:
    return F.left(name, F.length(name) - F.length(file_suffix(name)))


def safe_segment(value: Column) -> Column:
    """A portable file name: reserved characters as _, no dots or spaces at the end, at most 90 characters (a long one keeps its suffix behind a hash)."""
    decoded = unquote(value)
    v = F.trim(F.regexp_replace(F.regexp_replace(decoded, RESERVED, "_"), r"[. ]+$", ""))
    v = F.when(v == "", "_").when(v.rlike(DEVICES), F.concat(F.lit("_"), v)).otherwise(v)
    short = F.left(v, F.greatest(F.lit(1), 70 - F.length(file_suffix(v))))
    return F.when(F.length(v) > 90, F.concat(short, F.lit("__"), F.left(F.sha2(decoded, 256), F.lit(10)), file_suffix(v))).otherwise(v)


def file_path(url: Column, root_length: int = 20) -> Column:
    """host/segments below a folder whose path has ``root_length`` characters.

    The last name gets a hash of the query, if there is one, and one of the canonical
    address, so names that differ in case only stay apart; a path that is too long is
    replaced by a hash of the address and the file's name, cut.
    """
    parts = F.filter(F.split(path(url), "/"), lambda s: s != "")
    names = F.when(F.size(parts) == 0, F.array(F.lit("index.html"))).otherwise(F.transform(parts, safe_segment))
    last, q = F.element_at(names, -1), query(url)
    tail = F.concat(F.when(q != "", F.concat(F.lit("__q-"), F.left(F.sha2(F.concat(F.lit("?"), q), 256), F.lit(10)))).otherwise(""), F.lit("__u-"), F.left(F.sha2(canonical(url), 256), F.lit(12)))
    final = F.concat(_stem(last), tail, file_suffix(last))
    whole = F.concat_ws("/", host(url), F.array_join(F.slice(names, F.lit(1), F.size(names) - 1), "/"), final)
    whole = F.regexp_replace(whole, "//", "/")
    most = max(70, 230 - root_length - 1)
    folder = F.concat(host(url), F.lit("/_long/"), F.left(F.sha2(url, 256), F.lit(24)), F.lit("/"))
    room = F.greatest(F.lit(4), most - F.length(folder) - F.length(file_suffix(final)))
    return F.when(F.length(whole) > most, F.concat(folder, F.left(_stem(final), room), file_suffix(final))).otherwise(whole)


def snapshot_key(content: Column) -> Column:
    sha = F.sha2(content, 256)
    return F.concat(F.lit("pages/"), F.left(sha, F.lit(2)), F.lit("/"), sha, F.lit(".html"))


def blob_key(sha: Column, suffix: Column, fallback: Column) -> Column:
    """ab/cd/<sha><suffix>, with .<fallback> where there is no suffix."""
    tail = F.when(F.coalesce(suffix, F.lit("")) != "", suffix).otherwise(F.concat(F.lit("."), F.lower(fallback)))
    return F.concat(F.substring(sha, 1, 2), F.lit("/"), F.substring(sha, 3, 2), F.lit("/"), sha, tail)


#: Extensions under which a source format may be stored, in the order they are tried.
EXTENSIONS = {"PDF": [".pdf"], "DOCX": [".docx", ".doc"], "DOC": [".doc", ".docx"], "PPTX": [".pptx"], "XLSX": [".xlsx", ".xls"], "XLS": [".xls", ".xlsx"], "ZIP": [".zip"], "CSV": [".csv"], "XML": [".xml"]}


def extension_candidates(source_format: Column) -> Column:
    """Extensions to try for a format, in order; an unknown format gives its own name."""
    known = F.create_map(*[x for k, v in EXTENSIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.coalesce(known[F.upper(source_format)], F.array(F.concat(F.lit("."), F.lower(source_format))))


def first_existing(df: DataFrame, sha: str, source_format: str, listing: DataFrame, key: str) -> DataFrame:
    """Adds ``resolved``: the first candidate blob key that the listing holds, or NULL."""
    tried = df.select(sha, F.posexplode(extension_candidates(F.col(source_format))).alias("_at", "_ext")).distinct()
    keyed = tried.withColumn("_key", blob_key(F.col(sha), F.col("_ext"), F.lit("bin")))
    found = keyed.join(listing.select(F.col(key).alias("_key")).distinct(), "_key", "left_semi").groupBy(sha).agg(F.min_by("_key", "_at").alias("resolved"))
    return df.join(found, sha, "left")


def blob_url(base: str, key: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), key)


def portable_path(value: Column) -> Column:
    return F.replace(value, F.lit("\\"), F.lit("/"))


def decode_xml(value: Column) -> Column:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        value = F.replace(value, F.lit(name), F.lit(char))
    return value


def sitemap_locations(xml: Column) -> Column:
    return F.transform(F.regexp_extract_all(xml, F.lit(r"(?i)<loc>\s*([^<]+?)\s*</loc>")), decode_xml)


def sitemap_closure(documents: DataFrame, start: list[str], most: int = 100) -> DataFrame:
    """Page addresses under the start sitemaps, following sitemap indexes in ``documents`` (url, xml); at most ``most`` files are opened.

    Opened addresses are a bounded list, so they are kept on the driver; pages are not.
    """
    parsed = documents.select("url", F.col("xml").rlike(r"(?i)<sitemapindex[\s>]").alias("is_index"), sitemap_locations(F.col("xml")).alias("locations"))
    opened: list[str] = []
    queue = list(dict.fromkeys(start))
    while queue and len(opened) < most:
        fresh = queue[: most - len(opened)]
        opened += fresh
        children = parsed.filter(F.col("url").isin(fresh) & F.col("is_index")).select(F.explode("locations").alias("l")).distinct().filter(~F.col("l").isin(opened)).orderBy("l").limit(most).collect()
        queue = [r.l for r in children]
    pages = parsed.filter(F.col("url").isin(opened) & ~F.col("is_index"))
    return pages.select(F.explode("locations").alias("url")).distinct()


def raw_links(html: Column) -> Column:
    """Values of link attributes in page order, decoded, without fragments-only and non-web schemes."""
    pattern = r"""(?i)\s(?:href|src|data-src|data-href)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    found = F.transform(F.regexp_extract_all(html, F.lit(pattern), 1), lambda v: decode_xml(F.trim(F.regexp_replace(v, "^[\"']|[\"']$", ""))))
    return F.filter(found, lambda v: (v != "") & ~v.rlike(r"(?i)^(?:#|mailto:|tel:|javascript:|data:)"))


@F.pandas_udf(ArrayType(StringType()))
def resolve_links(base: pd.Series, links: pd.Series) -> pd.Series:
    """Absolute links without fragments, distinct in order; relative resolution has no native form."""
    from urllib.parse import urldefrag, urljoin

    def one(b, found):
        out = []
        for v in [] if found is None else found:
            try:
                out.append(urldefrag(urljoin(b or "", v))[0])
            except ValueError:
                continue
        return list(dict.fromkeys(out))

    return pd.Series([one(b, f) for b, f in zip(base, links)])


def robots_rules(text: Column, agent: str = "*") -> Column:
    """Array of {allow, pattern} of one agent's group in a robots file."""
    group = F.regexp_extract(F.replace(text, F.lit("\r"), F.lit("")), rf"(?is)user-agent:\s*{agent.replace('*', chr(92) + '*')}\s*\n(.*?)(?=\nuser-agent:|\z)", 1)
    lines = F.filter(F.split(group, "\n"), lambda line: line.rlike(r"(?i)^\s*(allow|disallow):\s*\S"))
    return F.transform(lines, lambda line: F.struct(line.rlike(r"(?i)^\s*allow:").alias("allow"), F.regexp_extract(line, r"^[^:]*:\s*(\S+)", 1).alias("pattern")))


def robots_like(pattern: str) -> str:
    """A robots pattern as a LIKE pattern: * any run, $ the end, else a prefix."""
    body = pattern.rstrip("$").replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")
    return body if pattern.endswith("$") else body + "%"


def robots_allowed(pages: DataFrame, path_col: str, rules: list[tuple[bool, str]]) -> DataFrame:
    """Adds ``allowed``: the longest matching pattern wins, Allow wins ties, no match allows."""
    best = F.array_max(
        F.array_compact(F.array(*[F.when(F.col(path_col).like(robots_like(p)), F.struct(F.lit(len(p)).alias("n"), F.lit(a).alias("allow"))) for a, p in rules]))
    )
    return pages.withColumn("allowed", F.coalesce(best["allow"], F.lit(True)))


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")
