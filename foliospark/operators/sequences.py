"""Window-like operators: islands, latest rows, first-seen dedupe, budgets, clusters and repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, group: str, position: str, labels: list[str]) -> DataFrame:
    """Contiguous ranges of equal labels: start, end and rows."""
    order = Window.partitionBy(group).orderBy(position)
    same = F.lit(True)
    for c in labels:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(order))
    near = F.lag(position).over(order) == F.col(position) - 1
    marked = df.withColumn("_island", F.sum(F.when(same & near, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(group, "_island", *labels).agg(F.min(position).alias("range_start"), F.max(position).alias("range_end"), F.count("*").alias("n_rows")).drop("_island")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The row with the largest order tuple of each key, by a combinable maximum instead of a sort."""
    rest = [c for c in columns if c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def latest_first_among_ties(df: DataFrame, keys: list[str], date: str, position: str, columns: list[str]) -> DataFrame:
    """The row with the largest date of each key, the earliest of equal ones, and ``in_order``: whether it is the last row that has a date."""
    rest = [c for c in columns if c not in (date, position)]
    dated = df.filter(F.col(date).isNotNull())
    best = F.max(F.struct(F.col(date), (-F.col(position)).alias("_at"), *rest)).alias("_row")
    out = dated.groupBy(*keys).agg(best, F.max(position).alias("_last"))
    value = lambda c: -F.col("_row._at") if c == position else F.col(f"_row.{c}")
    return out.select(*keys, *[value(c).alias(c) for c in columns], (F.col("_last") == -F.col("_row._at")).alias("in_order"))


def first_wins(df: DataFrame, key: str, order: list[str], alias: str) -> DataFrame:
    """First row of each key in order, its sorted distinct aliases and the number of rows it stands for."""
    agg = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_row"), F.array_sort(F.collect_set(alias)).alias("aliases"), F.count("*").alias("n_rows"))
    return agg.select(key, *[F.col(f"_row.{c}").alias(c) for c in order], "aliases", "n_rows")


def _with_preference(candidates: DataFrame, key: str, preference: DataFrame) -> DataFrame:
    """Candidates with what their key prefers; a null key is a key like any other."""
    named = preference.withColumnRenamed(key, "_key")
    return candidates.join(named, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def preference_dedupe(candidates: DataFrame, key: str, choice: str, preference: DataFrame) -> DataFrame:
    """One candidate for each key: the only one, or the one that ``preference`` (key, preferred) names.

    Keys with several candidates of which none is preferred give no row here but one of ``preference_faults``, which must be empty for a whole result.
    """
    sized = candidates.withColumn("n_candidates", F.count("*").over(Window.partitionBy(key)))
    joined = _with_preference(sized, key, preference)
    kept = joined.filter((F.col("n_candidates") == 1) | (F.col(choice) == F.col("preferred")))
    return kept.withColumn("selection_basis", F.when(F.col("n_candidates") == 1, "only-candidate").otherwise("explicit-preference")).withColumn("alternates", F.col("n_candidates") - 1).drop("n_candidates", "preferred")


def preference_faults(candidates: DataFrame, key: str, choice: str, preference: DataFrame) -> DataFrame:
    """Keys with several candidates and not exactly one that ``preference`` names: their candidates and how many are named."""
    chosen = F.count_if(F.coalesce(F.col(choice) == F.col("preferred"), F.lit(False)))
    out = _with_preference(candidates, key, preference).groupBy(key).agg(F.count("*").alias("n_candidates"), chosen.alias("n_preferred"))
    return out.filter((F.col("n_candidates") > 1) & (F.col("n_preferred") != 1))


def clusters(df: DataFrame, text: Column, key: str) -> DataFrame:
    """content_sha256, its cluster's size and first member; sizes come from a combined count, so a hot text costs no window."""
    hashed = df.withColumn("content_sha256", F.sha2(text, 256))
    sizes = hashed.groupBy("content_sha256").agg(F.count("*").alias("cluster_size"), F.min(key).alias("cluster_first"))
    return hashed.join(sizes, "content_sha256")


def duplicate_excess(df: DataFrame, text: Column) -> DataFrame:
    """Rows and characters beyond the first of each exact text, and their share of all characters."""
    per = df.select(F.sha2(text, 256).alias("h"), F.length(text).cast("long").alias("n")).groupBy("h").agg(F.count("*").alias("c"), F.max("n").alias("n"))
    out = per.agg(F.sum("c").alias("pages"), F.sum(F.col("c") - 1).alias("duplicate_pages"), F.sum((F.col("c") - 1) * F.col("n")).alias("duplicate_characters"), F.sum(F.col("c") * F.col("n")).alias("characters"))
    return out.withColumn("duplicate_share", F.round(F.col("duplicate_characters") / F.col("characters"), 4))


def repeated_line_share(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per document: characters of lines seen before in it, over those of all lines with 20 letters or digits at least."""
    line = F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
    lines = df.select(key, line.alias("line")).withColumn("line", F.lower(F.trim(F.regexp_replace("line", r"[ \t]+", " "))))
    long = lines.filter(F.length(F.regexp_replace("line", r"[^\p{L}\p{N}]", "")) >= 20)
    per = long.groupBy(key, "line").agg(F.count("*").alias("c"))
    sums = per.groupBy(key).agg(F.sum(F.col("c") * F.length("line")).alias("line_characters"), F.sum((F.col("c") - 1) * F.length("line")).alias("repeated_characters"))
    return sums.withColumn("repeated_share", F.round(F.col("repeated_characters") / F.col("line_characters"), 4))


def budget_prefix(df: DataFrame, order: str, size: str, budget: int, rows_per_range: int = 1_000_000) -> DataFrame:
    """Rows in order while the running total stays within a budget.

    The running sum is taken in two steps: totals of ranges of the order column
    first, then inside each range that begins within the budget, so no task
    sorts all rows and what lies beyond the budget is not sorted at all.  The
    number of ranges grows with the rows (64 at least); an order column whose
    values crowd in one range makes that range's task longer, not the result wrong.
    """
    span = df.agg(F.min(order).alias("lo"), F.max(order).alias("hi"), F.greatest(F.lit(64.0), F.ceil(F.count("*") / rows_per_range).cast("double")).alias("ranges"))
    ranged = df.join(F.broadcast(span)).withColumn("_b", F.floor((F.col(order) - F.col("lo")) / ((F.col("hi") - F.col("lo") + 1) / F.col("ranges"))).cast("long")).drop("lo", "hi", "ranges")
    totals = ranged.groupBy("_b").agg(F.sum(size).alias("_t"))
    before = totals.withColumn("_before", F.coalesce(F.sum("_t").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_b", "_before")
    # At most one row for each million rows.
    reached = F.broadcast(before.filter(F.col("_before") <= budget))
    run = F.sum(size).over(Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.join(reached, "_b").withColumn("running_total", F.col("_before") + run).filter(F.col("running_total") <= budget).drop("_b", "_before")


def range_override(rows: DataFrame, overrides: DataFrame, key: str, position: str, label: str) -> DataFrame:
    """Override whose [start_position, end_position] holds the row, else the row's own label.

    Each row comes back once: where several overrides hold it, ``label_basis`` is
    ``overlapping-overrides`` and the row keeps its own label.  ``overrides`` is a
    reviewed table of small size; whether it is broadcast is left to its statistics.
    """
    hit = (F.col(f"r.{key}") == F.col(f"o.{key}")) & F.col(f"r.{position}").between(F.col("o.start_position"), F.col("o.end_position"))
    found = rows.alias("r").join(overrides.alias("o"), hit).groupBy(F.col(f"r.{key}").alias("_key"), F.col(f"r.{position}").alias("_position")).agg(F.countDistinct("o.start_position", "o.end_position", "o.override_label").alias("_n"), F.min("o.override_label").alias("_label"))
    out = rows.join(found, (F.col(key) == F.col("_key")) & (F.col(position) == F.col("_position")), "left")
    basis = F.when(F.col("_n") == 1, "override").when(F.col("_n") > 1, "overlapping-overrides").otherwise("inherited")
    return out.select(*[F.col(c) for c in rows.columns], F.when(F.col("_n") == 1, F.col("_label")).otherwise(F.col(label)).alias("final_label"), basis.alias("label_basis"))
