"""Grouped counts, suppression-aware sums, comparisons, look-ups and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def label_counts(df: DataFrame, *labels: str) -> DataFrame:
    return df.groupBy(*labels).agg(F.count("*").alias("n"))


def known_sums(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Known sum (0.0 if all is suppressed), rows, suppressed rows and whether the group is complete."""
    out = df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("known"), F.count("*").alias("observations"), F.count_if(F.col(value).isNull()).alias("suppressed"))
    return out.withColumn("complete", F.col("suppressed") == 0)


def weighted_mean(df: DataFrame, keys: list[str], amount: str, rate: str) -> DataFrame:
    """Amount-weighted rate over rows that have both."""
    both = df.filter(F.col(amount).isNotNull() & F.col(rate).isNotNull())
    return both.groupBy(*keys).agg((F.sum(F.col(amount) * F.col(rate)) / F.sum(amount)).alias("weighted_mean"))


def year_over_year(df: DataFrame, year: str, value: str, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """Each year beside the one before it (equi-join on year - 1) and the change in per cent."""
    before = df.select(*keys, (F.col(year) + 1).alias(year), F.col(value).alias("prior"))
    out = df.join(before, [*keys, year], "left")
    return out.withColumn("change_pct", F.when(F.col("prior") != 0, (F.col(value) / F.col("prior") - 1) * 100))


def single_match(df: DataFrame, condition: Column, value: str) -> DataFrame:
    """The value if exactly one row matches, else NULL, with the number of matches."""
    return df.filter(condition).agg(F.count("*").alias("matches"), F.max(value).alias("_v")).select("matches", F.when(F.col("matches") == 1, F.col("_v")).alias("value"))


def require_single(df: DataFrame, condition: Column, value: str) -> DataFrame:
    """As ``single_match``, but any other number of matches is an error."""
    one = single_match(df, condition, value)
    return one.select(F.when(F.col("matches") == 1, F.col("value")).otherwise(F.raise_error(F.format_string("%s matches, one expected", "matches"))).alias("value"))


def reconcile(parts: DataFrame, totals: DataFrame, keys: list[str], part: str, total: str) -> DataFrame:
    """Component sum against the published total; NULL where a side is missing or any component is suppressed."""
    summed = parts.groupBy(*keys).agg(F.when(F.count_if(F.col(part).isNull()) == 0, F.sum(part)).alias("component_sum"))
    return totals.select(*keys, F.col(total).alias("published")).join(summed, keys, "left").withColumn("difference", F.col("component_sum") - F.col("published"))


def checks(*named: tuple[str, DataFrame, Column]) -> DataFrame:
    """One row for each check: its name, the number of violating rows and whether it passed; one pass for all checks of a table."""
    frames: list[DataFrame] = []
    for _, df, _ in named:
        if not any(df is f for f in frames):
            frames.append(df)
    rows = []
    for f in frames:
        own = [(name, bad) for name, df, bad in named if df is f]
        counts = f.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, bad) in enumerate(own)])
        each = F.explode(F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"_{i}").alias("violations")) for i, (name, _) in enumerate(own)]))
        rows.append(counts.select(each.alias("c")).select("c.check_name", "c.violations", (F.col("c.violations") == 0).alias("passed")))
    return reduce(DataFrame.unionByName, rows)


def hierarchy_guard(parents: DataFrame, children: DataFrame, keys: list[str], parent_value: str, child_value: str) -> DataFrame:
    """Groups in which the parent and a child are both known, so adding them up would count twice."""
    known = children.filter(F.col(child_value).isNotNull()).select(*keys).distinct()
    return parents.filter(F.col(parent_value).isNotNull()).join(known, keys, "left_semi")


def long_metrics(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    return df.unpivot(keys, metrics, "metric", "value")


def dense_coverage(df: DataFrame, number: str, label: str, labels: list[str], top: int) -> DataFrame:
    """Counts by label over the dense numbers 1..top, gaps as zero, and whether every label is present."""
    spark = df.sparkSession
    pivot = df.groupBy(number).pivot(label, labels).agg(F.count(F.lit(1)))
    out = spark.range(1, top + 1).select(F.col("id").alias(number)).join(pivot, number, "left").na.fill(0)
    return out.withColumn("complete_loop", reduce(Column.__and__, [F.col(c) > 0 for c in labels]))


def confusion(pairs: DataFrame, gold: str, predicted: str) -> DataFrame:
    return pairs.groupBy(gold, predicted).agg(F.count("*").alias("n"))


def accuracy(pairs: DataFrame, gold: str, predicted: str, least: float) -> DataFrame:
    """Share of gold rows predicted right; a missing prediction counts as wrong."""
    right = F.coalesce(F.col(gold) == F.col(predicted), F.lit(False))
    return pairs.agg(F.count("*").alias("gold"), F.count_if(right).alias("correct")).withColumn("accuracy", F.round(F.col("correct") / F.col("gold"), 4)).withColumn("passed", F.col("correct") / F.col("gold") >= least)


def by_confidence(pairs: DataFrame, gold: str, predicted: str, confidence: str) -> DataFrame:
    """Right and wrong predictions at each confidence; a missing prediction is wrong."""
    right = F.coalesce(F.col(gold) == F.col(predicted), F.lit(False))
    return pairs.groupBy(confidence).agg(F.count_if(right).alias("correct"), F.count_if(~right).alias("wrong"))


def histogram_of_reasons(df: DataFrame, reasons: Column) -> DataFrame:
    return df.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def nearest_rank_percentiles(df: DataFrame, value: str, fractions: dict[str, float], slack: float = 0.005) -> DataFrame:
    """Exact values at rank round_half_even((n - 1) * f), without sorting the column.

    A mergeable sketch brackets each rank; one pass counts what lies below the
    bracket and the distinct values inside it, and only those are ranked.
    """
    known = df.filter(F.col(value).isNotNull()).select(F.col(value).alias("v"))
    names = list(fractions)
    edges = [F.struct(F.percentile_approx("v", max(0.0, f - slack), 10_000).alias("lo"), F.percentile_approx("v", min(1.0, f + slack), 10_000).alias("hi")).alias(n) for n, f in fractions.items()]
    bounds = known.agg(F.count("*").alias("n"), *edges)
    # One row of bounds, then at most a band of distinct values for each fraction.
    tagged = known.join(F.broadcast(bounds)).select(
        "v", "n", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(fractions[n]).alias("f"), F.col(f"{n}.lo").alias("lo"), F.col(f"{n}.hi").alias("hi")) for n in names])).alias("b")
    )
    # Everything below a bracket is one group.
    cell = F.when(F.col("v") < F.col("b.lo"), F.lit(None)).otherwise(F.col("v"))
    counts = tagged.filter(F.col("v") <= F.col("b.hi")).groupBy("b.name", "b.f", "n", cell.alias("cell")).agg(F.count("*").alias("c"))
    upto = counts.withColumn("upto", F.sum("c").over(Window.partitionBy("name").orderBy(F.col("cell").asc_nulls_first())))
    hit = upto.filter(F.col("cell").isNotNull() & (F.col("upto") > F.bround((F.col("n") - 1) * F.col("f"), 0)))
    return hit.agg(*[F.min(F.when(F.col("name") == n, F.col("cell"))).alias(n) for n in names])


def value_cross_tab(df: DataFrame, label: str, counts: list[str]) -> DataFrame:
    """Documents with a positive count, for each (label, pattern)."""
    return df.unpivot([label], counts, "pattern", "hits").filter("hits > 0").groupBy(label, "pattern").agg(F.count("*").alias("documents"))


def grouped_medians(df: DataFrame, keys: list[str], value: str, name: str = "median", slack: float = 0.005) -> DataFrame:
    """Exact median of each group (mean of the middle two of an even number), without holding its values.

    A mergeable sketch brackets the middle of each group; one pass counts what
    lies below the bracket and the distinct values inside it.
    """
    known = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    edge = lambda f: F.percentile_approx("_v", f, 10_000)
    bounds = known.groupBy(*keys).agg(F.count("*").alias("_n"), edge(0.5 - slack).alias("_lo"), edge(0.5 + slack).alias("_hi"))
    inside = known.join(bounds, keys).filter(F.col("_v") <= F.col("_hi"))
    cell = F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_cell")
    counts = inside.groupBy(*keys, "_n", cell).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy(F.col("_cell").asc_nulls_first()))
    ranked = counts.withColumn("_upto", upto).filter(F.col("_cell").isNotNull())
    at = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("_cell")))
    return ranked.groupBy(*keys).agg(((at(F.floor((F.col("_n") - 1) / 2)) + at(F.floor(F.col("_n") / 2))) / 2).alias(name))


def most_common(df: DataFrame, label: str, top: int, first: str | None = None) -> DataFrame:
    """The ``top`` most frequent labels with their counts; ties by first appearance in ``first``, else by label."""
    seen = F.min(first) if first else F.min(label)
    return df.groupBy(label).agg(F.count("*").alias("n"), seen.alias("_first")).orderBy(F.desc("n"), "_first").limit(top).drop("_first")


def audit_summary(df: DataFrame, status: str, size: str, flags: dict[str, Column]) -> DataFrame:
    """Rows of measure and value: status histogram, flag sums, total, maximum and exact percentiles of a size."""
    value = lambda c: F.col(c).cast("double").alias("value")
    histogram = df.groupBy(status).agg(F.count("*").alias("n")).select(F.concat(F.lit("status:"), status).alias("measure"), value("n"))
    sums = {**{n: F.count_if(c) for n, c in flags.items()}, "total": F.sum(size), "max": F.max(size)}
    whole = df.agg(*[c.cast("double").alias(n) for n, c in sums.items()]).unpivot([], list(sums), "measure", "value")
    ranks = nearest_rank_percentiles(df, size, {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    ranked = ranks.select(*[F.col(c).cast("double").alias(c) for c in ranks.columns]).unpivot([], ["p50", "p90", "p99"], "measure", "value")
    return histogram.unionByName(whole).unionByName(ranked)
