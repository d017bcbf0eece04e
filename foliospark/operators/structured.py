"""Analyses of published tables, with suppression kept apart from zero."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.values import iso_date, parse_number, prior_year, required
from foliospark.operators import aggregates as A
from foliospark.operators.compare import find_column
from foliospark.operators.sequences import latest_first_among_ties, latest_per_key


def slice_of(df: DataFrame, **codes: str) -> DataFrame:
    """Rows with the given dimension codes."""
    return df.filter(reduce(Column.__and__, [F.col(k) == v for k, v in codes.items()]))


def component_totals(df: DataFrame, keys: list[str], code: str, value: str, parts: list[str], totals: list[str]) -> DataFrame:
    """Known, observed and suppressed cells of the parts of each group, reconciled with each published total."""
    own = F.col(code).isin(*parts)
    out = df.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(own, F.col(value))), F.lit(0.0)).alias("known"),
        F.count_if(own).alias("observations"),
        F.count_if(own & F.col(value).isNull()).alias("suppressed"),
        *[F.max(F.when(F.col(code) == c, F.col(value))).alias(f"published_{c}") for c in totals],
    )
    out = out.withColumn("complete", (F.col("suppressed") == 0) & (F.col("observations") == len(parts)))
    for c in totals:
        out = out.withColumn(f"difference_{c}", F.when(F.col("complete"), F.col("known") - F.col(f"published_{c}")))
    return out


def missing_cells(df: DataFrame, dimensions: dict[str, list[str]]) -> DataFrame:
    """Combinations of the expected codes that have no row; the expected set is the product of short literal lists."""
    spark, names = df.sparkSession, list(dimensions)
    arrays = [F.explode(F.array(*map(F.lit, dimensions[n]))) for n in names]
    expected = spark.range(1)
    for n, a in zip(names, arrays):
        expected = expected.withColumn(n, a)
    return expected.drop("id").join(df, names, "left_anti")


def odd_dates(df: DataFrame, date: str) -> DataFrame:
    """Counts of each date string, marking first days of quarter-end months."""
    odd = F.col(date).startswith("01/") & F.substring(date, 4, 2).isin("03", "06", "09", "12")
    return df.groupBy(date).agg(F.count("*").alias("n")).withColumn("odd", odd)


def two_periods(df: DataFrame, keys: list[str], period: str, value: str, now: str, before: str, strict: bool = False) -> DataFrame:
    """Known sums of two periods and the change in per cent; strict raises where a side is missing."""
    pick = lambda p: F.sum(F.when(F.col(period) == p, F.col(value)))
    out = df.filter(F.col(period).isin(now, before)).groupBy(*keys).agg(pick(now).alias("now"), pick(before).alias("before"))
    change = F.when(F.col("before") != 0, (F.col("now") / F.col("before") - 1) * 100)
    return out.withColumn("change_pct", required(change, before) if strict else change)


def latest_year(df: DataFrame, year: str) -> DataFrame:
    """Rows of the largest year; the maximum is one row."""
    return df.join(F.broadcast(df.agg(F.max(year).alias(year))), year, "left_semi")


def latest_snapshot(df: DataFrame, series: str, date: str, metrics: list[str]) -> DataFrame:
    """Long metrics of the latest row of each series."""
    latest = latest_per_key(df, [series], [date], [date, *metrics])
    return A.long_metrics(latest, [series, date], metrics)


def key_indicators(named: dict[str, DataFrame]) -> DataFrame:
    """One table of indicator rows from one-row results."""
    rows = [df.select(F.lit(name).alias("indicator"), F.col(df.columns[-1]).cast("double").alias("value")) for name, df in named.items()]
    return reduce(DataFrame.unionByName, rows)


def width_faults(rows: DataFrame, cells: Column, width: int) -> DataFrame:
    return rows.filter(F.size(cells) != width)


# ---- the published tables, end to end; columns and labels are fixed values of the sources


FRAUD_PARTS = ("CP0", "CT0", "CW1", "DD", "EMP0", "MREM", "CHQ", "SER")


def payment_fraud(rows: DataFrame, parts: tuple[str, ...] = FRAUD_PARTS) -> tuple[DataFrame, DataFrame]:
    """(known sums by year and transaction code, reconciliation by year) of the fraudulent payments in euro."""
    own = slice_of(rows, COUNT_AREA="W0", RL_TRNSCTN="1", FRD_TYP="F", UNIT_MEASURE="EUR")
    own = own.select(F.left("REPORTINGPERIOD", F.lit(4)).cast("int").alias("year"), F.col("TYP_TRNSCTN").alias("code"), F.col("TYP_TRNSCTN_DESC").alias("description"), parse_number(F.col("OBSERVATION")).alias("value"))
    detail = A.known_sums(own, ["year", "code"], "value").withColumn("known", F.round("known", 8))
    known = lambda c: F.sum(F.when(c, F.coalesce("value", F.lit(0.0))))
    part, total = F.col("code").isin(*parts), F.col("code") == "TOTL1"
    by_year = own.groupBy("year").agg(
        F.round(F.coalesce(known(part), F.lit(0.0)), 8).alias("component_sum"),
        F.count_if(part & F.col("value").isNull()).alias("suppressed_components"),
        F.round(known(total), 8).alias("total_without_cash"),
        F.count_if((F.col("code") == "TOTL") & F.col("value").isNull()).alias("suppressed_totals"),
    )
    return detail, by_year.withColumn("difference", F.round(F.col("component_sum") - F.col("total_without_cash"), 8))


def mortgage_arrears(rows: DataFrame, latest: str, expected: list[tuple[int, str]], published: tuple[int, int], total_label: str, over_labels: list[str], width: int) -> DataFrame:
    """The five named checks of the arrears table: check, status, observed."""
    number = parse_number(F.col("Number of Accounts"))
    kind = F.regexp_replace("Observation Type", "\ufffd", "€")
    now, date = F.col("Reporting Date") == latest, F.col("Reporting Date")
    odd = date.startswith("01/") & F.substring(date, 4, 2).isin("03", "06", "09", "12")
    twice = (F.col("Observation Type") == "Number") & parse_number(F.col("Observation")).isNotNull() & number.isNotNull()
    cell = F.concat_ws("/", F.concat(F.lit("row "), F.col("Row Position")), kind)
    headline = now & (F.col("Entity Group") == "Banks") & (F.col("Format") == "PDH") & (F.col("Category") == "Arrears")
    account = now & (F.col("Format") == "BTL") & (F.col("Category") == "Arrears") & (F.col("Observation Type") == "Number")

    def counted(entity: str, label: str) -> Column:
        """The figure if exactly one row has it, else 0."""
        own = account & (F.col("Entity Group") == entity) & (F.col("Row") == label)
        return F.when(F.count_if(own) == 1, F.coalesce(F.max(F.when(own, number)), F.lit(0.0))).otherwise(0.0)

    entities = ("Banks", "Non-Banks")
    wanted = [f"row {p}/{k}" for p, k in expected]
    # Distinct dates and cells are as few as the table has quarters and headline rows.
    one = rows.agg(
        F.count("*").alias("n"),
        F.array_sort(F.collect_set(F.when(odd, date))).alias("odd"),
        F.count_if(twice).alias("twice"),
        F.collect_set(F.when(headline & cell.isin(*wanted), cell)).alias("present"),
        reduce(Column.__add__, [counted(e, total_label) for e in entities]).alias("total"),
        reduce(Column.__add__, [counted(e, label) for e in entities for label in over_labels]).alias("over"),
    )
    missing = F.array_except(F.array(*map(F.lit, wanted)), "present")
    status = lambda ok: F.when(ok, "pass").otherwise("fail")
    row = lambda name, ok, seen: F.struct(F.lit(name).alias("check"), status(ok).alias("status"), seen.cast("string").alias("observed"))
    seen = F.concat(F.lit("total="), F.col("total").cast("long"), F.lit("; over90="), F.col("over").cast("long"))
    checks = F.array(
        row("rows_have_expected_width", F.lit(len(rows.columns) == width), F.col("n")),
        row("quarter_end_dates_use_consistent_calendar_dates", F.size("odd") == 0, F.array_join("odd", " | ")),
        row("number_rows_use_only_number_of_accounts_column", F.col("twice") == 0, F.col("twice")),
        row("bank_headline_cells_present", F.size(missing) == 0, F.array_join(missing, " | ")),
        row("arrears_reconcile_to_release", (F.col("total") == published[0]) & (F.col("over") == published[1]), seen),
    )
    return one.select(F.explode(checks).alias("c")).select("c.*")


def sme_lending(rows: DataFrame, amounts: list[str], rate: str, weight: str, parents: dict[str, list[str]]) -> DataFrame:
    """One row: latest period, known sums of it and of the year before, changes, suppressed sectors and the weighted rate.

    A parent sector with a value beside a child's, in either period, is an error, as is a missing comparison.
    """
    dated = rows.select(iso_date(F.col("Referencedate")).alias("period"), F.col("Economic Activity").alias("sector"), *[parse_number(F.col(c)).alias(c) for c in dict.fromkeys([*amounts, rate])])
    latest = F.broadcast(dated.agg(F.max("period").alias("latest")).withColumn("before", prior_year(F.col("latest"))))
    both = dated.join(latest, (F.col("period") == F.col("latest")) | (F.col("period") == F.col("before")))
    now, then = F.col("period") == F.col("latest"), F.col("period") == F.col("before")
    double = []
    for c in amounts:
        for when in (now, then):
            for parent, children in parents.items():
                double.append((F.count_if(when & (F.col("sector") == parent) & F.col(c).isNotNull()) > 0) & (F.count_if(when & F.col("sector").isin(*children) & F.col(c).isNotNull()) > 0))
    cells = []
    for c in amounts:
        cells += [F.sum(F.when(now, F.col(c))).alias(f"{c}_now"), F.sum(F.when(then, F.col(c))).alias(f"{c}_before"), F.count_if(now & F.col(c).isNotNull()).alias(f"{c}_present"), F.count_if(now & F.col(c).isNull()).alias(f"{c}_suppressed")]
    pair = now & F.col(weight).isNotNull() & F.col(rate).isNotNull()
    mean = F.sum(F.when(pair, F.col(weight) * F.col(rate))) / F.sum(F.when(pair, F.col(weight)))
    out = both.groupBy("latest").agg(*cells, mean.alias("weighted_rate"), (reduce(Column.__or__, double) if double else F.lit(False)).alias("_double"))
    for c in amounts:
        base = required(F.when(F.col(f"{c}_before") != 0, F.col(f"{c}_before")), c)
        out = out.withColumn(f"{c}_change", (F.col(f"{c}_now") / base - 1) * 100)
    guard = F.when(F.col("_double"), F.raise_error(F.lit("a parent sector and its children both carry values")).cast("string")).otherwise(F.col("latest"))
    return out.withColumn("latest", guard).drop("_double")


def new_mortgages(rows: DataFrame) -> DataFrame:
    """One row: latest year, total and first-time-buyer lending (value if exactly one row matches) and the buyers' shares."""
    current = latest_year(rows.withColumn("Year", F.col("Year").cast("int")), "Year").withColumn("_v", parse_number(F.col("Observation_Amount")))

    def value(description: str, kind: str) -> Column:
        own = (F.col("Description") == description) & (F.col("Data_Type") == kind)
        return F.when(F.count_if(own) == 1, F.max(F.when(own, F.col("_v"))))

    out = current.groupBy("Year").agg(
        value("Total Lending", "Value of Loans").alias("total_value"), value("Total Lending", "Number of Loans").alias("total_loans"), value("FTB Lending", "Value of Loans").alias("buyer_value"), value("FTB Lending", "Number of Loans").alias("buyer_loans")
    )
    share = lambda a, b: F.round(F.coalesce(a, F.lit(0.0)) / F.when(F.coalesce(b, F.lit(0.0)) == 0, 1.0).otherwise(b) * 100, 2)
    return out.withColumn("share_of_value", share(F.col("buyer_value"), F.col("total_value"))).withColumn("share_of_loans", share(F.col("buyer_loans"), F.col("total_loans")))


def retail_rates(rows: DataFrame, date: str, position: str, wanted: dict[str, tuple[list[str], list[str]]]) -> DataFrame:
    """Metrics of the latest dated row, columns found by fragments of their names: period, metric, value and whether the file is in date order."""
    found = {name: find_column(rows.columns, *fragments) for name, fragments in wanted.items()}
    dated = rows.select(F.lit(1).alias("_k"), iso_date(F.col(date)).alias("period"), F.col(position).alias("_at"), *[parse_number(F.col(f"`{c}`")).alias(n) for n, c in found.items()])
    latest = latest_first_among_ties(dated, ["_k"], "period", "_at", ["period", "_at", *found])
    return latest.drop("_k", "_at").unpivot(["period", "in_order"], list(found), "metric", "value")


def indicator_rows(named: list[tuple[str, DataFrame, str, str, str]]) -> DataFrame:
    """Key indicators: (metric, one-row table, its value column, period, unit) as rows of metric, period, value and unit."""
    rows = [df.select(F.lit(metric).alias("metric"), F.lit(period).alias("period"), F.col(c).cast("double").alias("value"), F.lit(unit).alias("unit")) for metric, df, c, period, unit in named]
    return reduce(DataFrame.unionByName, rows)
