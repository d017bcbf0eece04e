"""Set algebra, column-wise comparison, change tracking and violation queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_both_ways(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """Keys of one side only, with the side they are missing from."""
    a = left.select(key).distinct().join(right, key, "left_anti").select(key, F.lit(f"missing_from_{names[1]}").alias("status"))
    b = right.select(key).distinct().join(left, key, "left_anti").select(key, F.lit(f"missing_from_{names[0]}").alias("status"))
    return a.unionByName(b)


def columnwise(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of either side only and, for each column, the pairs whose text forms differ; one pass."""
    a = left.select(*keys, *[F.col(c).cast("string").alias(f"a_{c}") for c in columns], F.lit(True).alias("in_a"))
    b = right.select(*keys, *[F.col(c).cast("string").alias(f"b_{c}") for c in columns], F.lit(True).alias("in_b"))
    both = F.col("in_a") & F.col("in_b")
    out = a.join(b, keys, "full").agg(
        F.count_if(F.col("in_b").isNull()).alias("only_left"),
        F.count_if(F.col("in_a").isNull()).alias("only_right"),
        *[F.count_if(both & ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))).alias(f"differ_{c}") for c in columns],
    )
    names = ["only_left", "only_right", *[f"differ_{c}" for c in columns]]
    return out.unpivot([], names, "measure", "n")


def changes(now: DataFrame, before: DataFrame, key: str, label: str) -> DataFrame:
    """new-document, reclassified or unchanged for each row of the newer release."""
    old = before.select(key, F.col(label).alias("old_label"), F.lit(True).alias("_known"))
    status = F.when(F.col("_known").isNull(), "new-document").when(~F.col(label).eqNullSafe(F.col("old_label")), "reclassified").otherwise("unchanged")
    return now.join(old, key, "left").withColumn("change", status).drop("_known")


def drifted(stored: DataFrame, computed: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows whose stored fields differ from computed ones as text, with the names of those fields."""
    pair = stored.select(key, *[F.col(c).cast("string").alias(f"s_{c}") for c in fields]).join(computed.select(key, *[F.col(c).cast("string").alias(f"c_{c}") for c in fields]), key)
    names = F.array_compact(F.array(*[F.when(~F.col(f"s_{c}").eqNullSafe(F.col(f"c_{c}")), F.lit(c)) for c in fields]))
    return pair.select(key, names.alias("changed")).filter(F.size("changed") > 0)


def violations(*named: tuple[str, DataFrame]) -> DataFrame:
    """Counts of the rows that violation queries return; conditions on rows of one table go through ``aggregates.checks`` in one pass."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("invariant"), "n") for name, df in named])


def listing_faults(catalogue: DataFrame, listing: DataFrame, path: str, size: str, digest: str) -> DataFrame:
    """Counts of catalogued paths that a listing lacks or holds with another size or hash, and of paths nobody catalogued."""
    a = catalogue.select(path, F.col(size).alias("_s"), F.col(digest).alias("_d"), F.lit(True).alias("_a"))
    b = listing.select(path, F.col(size).alias("_t"), F.col(digest).alias("_e"), F.lit(True).alias("_b"))
    both = F.col("_a") & F.col("_b")
    return a.join(b, path, "full").agg(
        F.count_if(F.col("_b").isNull()).alias("missing"),
        F.count_if(F.col("_a").isNull()).alias("uncatalogued"),
        F.count_if(both & ~F.col("_s").eqNullSafe(F.col("_t"))).alias("size_differs"),
        F.count_if(both & ~F.col("_d").eqNullSafe(F.col("_e"))).alias("hash_differs"),
    )


def uneven_clusters(df: DataFrame, cluster: str, size: str) -> DataFrame:
    """Clusters whose stored size is not their row count."""
    return df.groupBy(cluster).agg(F.count("*").alias("n"), F.min(size).alias("lo"), F.max(size).alias("hi")).filter((F.col("n") != F.col("lo")) | (F.col("lo") != F.col("hi")))


def union_by_name(frames: list[DataFrame], tag: str, names: list[str]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn(tag, F.lit(n)) for f, n in zip(frames, names)])


def optional(df: DataFrame, wanted: list[str]) -> tuple[DataFrame, list[str]]:
    """Projection to the wanted columns that exist, and the names of the others."""
    have = [c for c in wanted if c in df.columns]
    return df.select(*have), [c for c in wanted if c not in df.columns]


def find_column(columns: list[str], required: list[str], excluded: list[str] = []) -> str:  # noqa: B006
    """The one column whose lower-case name holds all required and no excluded fragments."""
    found = [c for c in columns if all(r in c.lower() for r in required) and not any(x in c.lower() for x in excluded)]
    if len(found) != 1:
        raise LookupError(f"{len(found)} columns match {required} without {excluded}")
    return found[0]


def same_stats_or_error(df: DataFrame, message: str) -> None:
    """Raises if a violation query returns a row."""
    first = df.limit(1).collect()
    if first:
        raise AssertionError(f"{message}: {first[0].asDict()}")


def hash_triangle(files: DataFrame, manifest: DataFrame, index: DataFrame, key: str, digest: str) -> DataFrame:
    """Counts over three sides that should hold the same hash of each key: what a side lacks, and which pairs disagree."""
    sides = {"file": files, "manifest": manifest, "index": index}
    tagged = [df.select(key, F.lit(n).alias("_side"), F.col(digest).alias("_d")) for n, df in sides.items()]
    # One grouping for all sides; a key has at most a row of each.
    pick = lambda n: F.max(F.when(F.col("_side") == n, F.col("_d"))).alias(n)
    rows = reduce(DataFrame.unionByName, tagged).groupBy(key).agg(*map(pick, sides))
    differ = lambda a, b: F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    return rows.agg(
        *[F.count_if(F.col(n).isNull()).alias(f"missing_{n}") for n in sides],
        differ("file", "manifest").alias("file_manifest"),
        differ("manifest", "index").alias("manifest_index"),
        differ("file", "index").alias("file_index"),
        F.count_if((F.col("file") == F.col("manifest")) & (F.col("manifest") == F.col("index"))).alias("agree"),
    )


def fact_faults(claims: DataFrame, truth: DataFrame, key: str, value: str) -> DataFrame:
    """Displayed facts whose value is not the computed one, unknown facts, and computed facts that no document shows."""
    a = claims.select(key, F.replace(F.trim(value), F.lit(","), F.lit("")).try_cast("decimal(38,10)").alias("_shown"), F.lit(True).alias("_a"))
    b = truth.select(key, F.col(value).cast("decimal(38,10)").alias("_true"), F.lit(True).alias("_b"))
    fault = F.when(F.col("_b").isNull(), "unknown-fact").when(F.col("_a").isNull(), "not-shown").when(~F.col("_shown").eqNullSafe(F.col("_true")), "wrong-value")
    return a.join(b, key, "full").withColumn("fault", fault).filter("fault is not null").select(key, "fault")


def summary_faults(stored: DataFrame, computed: DataFrame, key: str, fields: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Keys and fields in which a stored summary is not what its detail gives; a key of one side only is a fault of every field."""
    a = stored.select(key, *[F.col(c).cast("double").alias(f"s_{c}") for c in fields])
    b = computed.select(key, *[F.col(c).cast("double").alias(f"c_{c}") for c in fields])
    same = lambda c: F.coalesce(F.abs(F.col(f"s_{c}") - F.col(f"c_{c}")) <= tolerance, F.col(f"s_{c}").isNull() & F.col(f"c_{c}").isNull())
    names = F.array_compact(F.array(*[F.when(~same(c), F.lit(c)) for c in fields]))
    return a.join(b, key, "full").select(key, F.explode(names).alias("field"))


def journal_faults(journal: DataFrame, manifest: DataFrame, exclusions: DataFrame, key: str) -> DataFrame:
    """Keys that break journal = manifest + exclusions: journalled only, not journalled, and in both of the other two; one grouping."""
    sides = {"j": journal, "m": manifest, "x": exclusions}
    rows = reduce(DataFrame.unionByName, [df.select(key, F.lit(n).alias("_s")) for n, df in sides.items()])
    has = {n: F.count_if(F.col("_s") == n) > 0 for n in sides}
    held = rows.groupBy(key).agg(*[c.alias(n) for n, c in has.items()])
    fault = F.when(F.col("m") & F.col("x"), "excluded-but-listed").when(F.col("j") & ~F.col("m") & ~F.col("x"), "journalled-only").when(~F.col("j"), "not-journalled")
    return held.withColumn("fault", fault).filter("fault is not null").select(key, "fault")
