"""Full-text search: boolean phrase queries compiled to Columns, BM25, scans, bundles and snippets.

The sub-language has bare words, quoted phrases, AND, OR, NOT (binary) and
parentheses; AND binds tighter than OR, NOT tighter than AND, and neighbours are
joined by AND.  A phrase lies inside one column; the terms of a conjunction may
lie in different columns of a row.  All queries of a scan are evaluated in one
pass over the text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import FOLD_TABLE, normalised, phrase_count, tokens_of
from foliospark.sources.shared import materialised


class QueryError(ValueError):
    """A query that the sub-language does not know."""


@dataclass(frozen=True)
class Term:
    phrase: str


@dataclass(frozen=True)
class Op:
    kind: str  # and, or, not
    parts: tuple


_TOKEN = re.compile(r'\s*(?:"((?:[^"]|"")*)"|([()])|([^\s()"]+))')


def fold(text: str) -> str:
    """The tokens of a phrase, as ``normalised`` makes them."""
    return " ".join(re.findall(r"[^\W_]+", text.lower().translate(FOLD_TABLE)))


def _lex(query: str):
    at, out = 0, []
    while query[at:].strip():
        m = _TOKEN.match(query, at)
        if not m:
            raise QueryError(f"unterminated string at {at}: {query!r}")
        at = m.end()
        if m[1] is not None:
            out.append(("term", m[1].replace('""', '"')))
        elif m[2]:
            out.append((m[2], m[2]))
        elif m[3] in ("AND", "OR", "NOT"):
            out.append((m[3], m[3]))
        elif re.fullmatch(r"[\w\u0080-￿]+", m[3]):
            out.append(("term", m[3]))
        else:
            raise QueryError(f"syntax error near {m[3]!r}")
    return out


def parse(query: str):
    """The tree of a query; raises QueryError."""
    tokens = _lex(query)
    at = 0

    def peek():
        return tokens[at][0] if at < len(tokens) else None

    def chain(kind: str, word: str, below):
        nonlocal at
        parts = [below()]
        while peek() == word:
            at += 1
            parts.append(below())
        return parts[0] if len(parts) == 1 else Op(kind, tuple(parts))

    def primary():
        nonlocal at
        kind = peek()
        if kind == "term":
            at += 1
            phrase = fold(tokens[at - 1][1])
            if not phrase:
                raise QueryError("a phrase without a word")
            return Term(phrase)
        if kind == "(":
            at += 1
            inner = either()
            if peek() != ")":
                raise QueryError("missing )")
            at += 1
            return inner
        raise QueryError(f"unexpected {kind or 'end'} in {query!r}")

    def run():
        parts = [primary()]
        while peek() in ("term", "("):
            parts.append(primary())
        return parts[0] if len(parts) == 1 else Op("and", tuple(parts))

    def without():
        return chain("not", "NOT", run)

    def both():
        return chain("and", "AND", without)

    def either():
        return chain("or", "OR", both)

    tree = either()
    if at < len(tokens):
        raise QueryError(f"unexpected {tokens[at][1]!r}")
    return tree


def terms(tree) -> list[str]:
    """Distinct phrases in order."""
    if isinstance(tree, Term):
        return [tree.phrase]
    return list(dict.fromkeys(t for p in tree.parts for t in terms(p)))


def matches(query: str, *norms: Column) -> Column:
    """The query as a boolean Column over normalised columns of a row."""

    def build(tree) -> Column:
        if isinstance(tree, Term):
            return reduce(Column.__or__, [n.contains(f" {tree.phrase} ") for n in norms])
        parts = [build(p) for p in tree.parts]
        if tree.kind == "or":
            return reduce(Column.__or__, parts)
        if tree.kind == "and":
            return reduce(Column.__and__, parts)
        return parts[0] & ~reduce(Column.__or__, parts[1:])

    return build(parse(query))


def with_norms(pages: DataFrame, text: str = "text", title: str | None = None) -> DataFrame:
    """Adds text_norm and title_norm (empty without a title)."""
    out = pages.withColumn("text_norm", normalised(F.coalesce(F.col(text), F.lit(""))))
    return out.withColumn("title_norm", normalised(F.coalesce(F.col(title), F.lit(""))) if title else F.lit("  "))


def write_index(pages: DataFrame, path: str, key: list[str], text: str = "text", title: str | None = None) -> None:
    """The index as a Parquet table: normalised title and text and their token counts beside every column, sorted by key.

    It is written whole each time, so a rebuild of the same pages holds the same rows.
    """
    norms = with_norms(pages, text, title)
    counted = norms.withColumn("token_count", tokens_of(F.col("title_norm")) + tokens_of(F.col("text_norm")))
    counted.repartitionByRange(*key).sortWithinPartitions(*key).write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_index(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def bm25_many(pages: DataFrame, queries: dict[str, str], keep: list[str], title_weight: float = 1.0, k1: float = 1.2, b: float = 0.75, once: bool = True) -> DataFrame:
    """One row for each (query, matching row) of ``with_norms`` output: the kept columns, ``query`` and ``score``; lower is better.

    The text is read in one pass: lengths, occurrences and matches of all queries
    are written beside the kept columns (``once``), and both the statistics (row
    count, mean length, rows of each distinct phrase: a single row, broadcast back)
    and the scores come from there.
    """
    trees = {name: parse(q) for name, q in queries.items()}
    phrases = list(dict.fromkeys(p for tree in trees.values() for p in terms(tree)))
    at = {p: i for i, p in enumerate(phrases)}
    title, text = F.col("title_norm"), F.col("text_norm")
    length = F.col("token_count") if "token_count" in pages.columns else tokens_of(title) + tokens_of(text)
    counted = pages.select(
        *keep,
        length.alias("_len"),
        *[(F.lit(float(title_weight)) * phrase_count(title, p) + phrase_count(text, p)).alias(f"_f{i}") for p, i in at.items()],
        *[matches(q, title, text).alias(f"_m{i}") for i, q in enumerate(queries.values())],
    )
    if once:
        counted = materialised(counted, "terms")
    stats = counted.agg(F.count("*").alias("_n"), F.avg("_len").alias("_avg"), *[F.count_if(F.col(f"_f{i}") > 0).alias(f"_n{i}") for i in at.values()])

    def score(tree) -> Column:
        total = F.lit(0.0)
        for p in terms(tree):
            i = at[p]
            raw = F.ln((F.col("_n") - F.col(f"_n{i}") + 0.5) / (F.col(f"_n{i}") + 0.5))
            f = F.col(f"_f{i}")
            total = total + F.when(raw <= 0, 1e-6).otherwise(raw) * f * (k1 + 1) / (f + k1 * (1 - b + b * F.col("_len") / F.col("_avg")))
        return -total

    hit = [F.col(f"_m{i}") for i in range(len(queries))]
    joined = counted.filter(reduce(Column.__or__, hit)).join(F.broadcast(stats))
    hits = F.array_compact(F.array(*[F.when(m, F.struct(F.lit(n).alias("query"), score(tree).alias("score"))) for m, (n, tree) in zip(hit, trees.items())]))
    return joined.select(*keep, F.explode(hits).alias("_h")).select(*keep, "_h.query", "_h.score")


def bm25(pages: DataFrame, query: str, title_weight: float = 1.0) -> DataFrame:
    """Matching rows of ``with_norms`` output, all their columns, with ``score``."""
    kept = [c for c in pages.columns if c not in ("title_norm", "text_norm", "token_count")]
    return bm25_many(pages, {"q": query}, kept, title_weight, once=False).drop("query")


def evidence(pages: DataFrame, topics: dict[str, str], signal: str, document: str, order: list[str], keep: list[str], top: int = 15, title_weight: float = 1.5) -> DataFrame:
    """For each topic the best page of the ``top`` best documents, by relevance and again among pages that also show a signal."""
    queries = {f"{n}|relevance": q for n, q in topics.items()} | {f"{n}|signal": f"({q}) AND ({signal})" for n, q in topics.items()}
    # Ranks by bounded windows: row_number() <= n is cut to n rows a task before the shuffle.
    scored = bm25_many(pages, queries, keep, title_weight).withColumn("score", F.round("score", 6))
    best = scored.withColumn("_p", F.row_number().over(Window.partitionBy("query", document).orderBy("score", *order))).filter("_p = 1").drop("_p")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("score", document))).filter(F.col("rank") <= top)
    return ranked.withColumn("topic", F.substring_index("query", "|", 1)).withColumn("ranking", F.substring_index("query", "|", -1)).drop("query")


def scan(pages: DataFrame, queries: dict[str, str], keep: list[str]) -> DataFrame:
    """One row for each (query, matching row): ``query`` and the kept columns, in one pass over the text."""
    norms = F.col("title_norm"), F.col("text_norm")
    hits = F.array_compact(F.array(*[F.when(matches(q, *norms), F.lit(name)) for name, q in queries.items()]))
    return pages.select(*keep, F.explode(hits).alias("query"))


def topic_totals(hits: DataFrame, document: str, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Matching pages and distinct documents for each query (and label)."""
    return hits.groupBy("query", *by).agg(F.count("*").alias("matching_pages"), F.countDistinct(document).alias("matching_documents"))


def persistence(hits: DataFrame, documents: DataFrame, document: str, voice: str, engagement: str, year: str, voices: tuple[str, str]) -> DataFrame:
    """Per query: pages, documents, engagements and years of two voices, their shares, ratio and persistence score."""
    totals = documents.agg(*[F.countDistinct(F.when(F.col(voice) == v, F.col(document))).alias(f"_all{i}") for i, v in enumerate(voices)])
    own = lambda c, v: F.when(F.col(voice) == v, F.col(c))
    cells = []
    for i, v in enumerate(voices):
        cells += [
            F.count(own(document, v)).alias(f"pages_{i}"),
            F.countDistinct(own(document, v)).alias(f"documents_{i}"),
            F.countDistinct(own(engagement, v)).alias(f"engagements_{i}"),
            F.countDistinct(own(year, v)).alias(f"years_{i}"),
            F.min(own(year, v)).alias(f"first_{i}"),
            F.max(own(year, v)).alias(f"last_{i}"),
        ]
    out = hits.groupBy("query").agg(*cells).join(F.broadcast(totals))
    for i in (0, 1):
        out = out.withColumn(f"share_{i}", F.when(F.col(f"_all{i}") > 0, F.round(100.0 * F.col(f"documents_{i}") / F.col(f"_all{i}"), 1)).otherwise(0.0))
    ratio = F.when(F.col("share_1") != 0, F.round(F.col("share_0") / F.col("share_1"), 2))
    return out.withColumn("ratio", ratio).withColumn("score", F.col("engagements_0") * F.col("years_0")).drop("_all0", "_all1")


def best_page_per_document(ranked: DataFrame, document: str, order: list, limit: int) -> DataFrame:
    """First page of each document in rank order; of those the first ``limit`` documents, ranked from 1."""
    one = ranked.withColumn("_n", F.row_number().over(Window.partitionBy(document).orderBy(*order))).filter("_n = 1").drop("_n")
    one = one.orderBy(*order).limit(limit)  # each partition sends its best rows only
    return one.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def bundle(pages: DataFrame, queries: list[str], k: int, key: list[str]) -> DataFrame:
    """Top k rows of each query by BM25; a row that several queries return belongs to the first."""
    scored = bm25_many(pages, {str(i): q for i, q in enumerate(queries)}, key).withColumn("score", F.round("score", 6))
    top = scored.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy("score", *key))).filter(F.col("_n") <= k)
    top = top.select(*key, F.col("query").cast("int").alias("query_index"), "score")
    return top.groupBy(*key).agg(F.min("query_index").alias("query_index"), F.min_by("score", "query_index").alias("score"))


def quota_bundle(pages: DataFrame, queries: list[str], voice: str, quotas: dict[str, int], key: list[str], title_weight: float = 1.0) -> DataFrame:
    """Top rows of each query by BM25, a quota for each voice; a row that several queries return belongs to the first."""
    scored = bm25_many(pages, {str(i): q for i, q in enumerate(queries)}, [*key, voice], title_weight).withColumn("score", F.round("score", 6))
    asked = scored.filter(F.col(voice).isin(list(quotas)))
    # Cut to the largest quota by a bounded window before the smaller ones are applied.
    order = Window.partitionBy("query", voice).orderBy("score", *key)
    top = asked.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= max(quotas.values()))
    quota = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])[F.col(voice)]
    top = top.filter(F.col("_n") <= quota).select(*key, voice, F.col("query").cast("int").alias("query_index"), "score")
    return top.groupBy(*key, voice).agg(F.min("query_index").alias("query_index"), F.min_by("score", "query_index").alias("score"))


def rendered(rank: Column, title: Column, page: Column, url: Column, snippet_: Column, ocr: Column) -> Column:
    """A search hit as three lines of text."""
    head = F.concat(rank.cast("string"), F.lit(". "), F.coalesce(F.nullif(title, F.lit("")), F.lit("(untitled)")), F.lit(" - page "), page.cast("string"), F.when(ocr, " [OCR]").otherwise(""))
    return F.concat(head, F.lit("\n   "), url, F.lit("\n   "), F.replace(snippet_, F.lit("\n"), F.lit(" ")))


def snippet(phrases: list[str], width: int = 36, marks: tuple[str, str] = ("[", "]"), dots: str = " ... "):
    """A pandas UDF: the window of ``width`` words that holds most phrase hits, with those marked."""
    wanted = [p.split() for p in phrases]

    @F.pandas_udf("string")
    def make(text: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            if t is None:
                return None
            spans = [(m.start(), m.end()) for m in re.finditer(r"[^\W_][^\W_\u0300-\u036f]*(?:[\u0300-\u036f]+[^\W_]*)*", t)]
            words = [t[a:b].lower().translate(FOLD_TABLE) for a, b in spans]
            hit = [False] * len(words)
            for w in wanted:
                for i in range(len(words) - len(w) + 1):
                    if words[i : i + len(w)] == w:
                        hit[i : i + len(w)] = [True] * len(w)
            if not spans:
                return ""
            total = [0]
            for h in hit:
                total.append(total[-1] + h)
            start = max(range(max(1, len(words) - width + 1)), key=lambda i: (total[min(i + width, len(words))] - total[i], -i))
            end = min(start + width, len(words))
            out, at = [], spans[start][0]
            for i in range(start, end):
                a, b = spans[i]
                out += [t[at:a], marks[0] if hit[i] and not (i > start and hit[i - 1]) else "", t[a:b], marks[1] if hit[i] and not (i + 1 < end and hit[i + 1]) else ""]
                at = b
            return (dots if start else "") + "".join(out) + (dots if end < len(words) else "")

        return text.map(one)

    return make
