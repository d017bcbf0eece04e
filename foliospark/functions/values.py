"""Numbers, dates, hashes and small string functions of tabular sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(value: Column) -> Column:
    """A number with thousands commas; blanks, NA, N/A, NULL, - and anything unreadable are NULL."""
    v = F.replace(F.trim(value), F.lit(","), F.lit(""))
    return F.when(~F.upper(v).isin("", "NULL", "NA", "N/A", "-"), v.try_cast("double"))


def decimal_value(value: Column) -> Column:
    return F.replace(F.trim(value), F.lit(","), F.lit("")).try_cast("decimal(38,10)")


def iso_date(value: Column) -> Column:
    """Strict dd/MM/yyyy as an ISO date; anything else is NULL."""
    return F.date_format(F.try_to_date(F.when(F.trim(value).rlike(r"^\d{2}/\d{2}/\d{4}$"), F.trim(value)), "dd/MM/yyyy"), "yyyy-MM-dd")


def prior_year(value: Column) -> Column:
    """The same string one year earlier (29 February gives a date that does not exist)."""
    return F.concat(F.lpad((F.substring(value, 1, 4).cast("int") - 1).cast("string"), 4, "0"), F.substring(value, 5, 100))


def token(value: Column, digits: int = 12) -> Column:
    """The first hex digits of the SHA-256 of the lower-cased value: counts without keeping values."""
    return F.left(F.sha2(F.lower(value), 256), F.lit(digits))


def short_hash(value: Column, digits: int = 10) -> Column:
    return F.left(F.sha2(value, 256), F.lit(digits))


def parse_bytes(value: Column) -> Column:
    """``500M`` or ``1.5GiB`` in bytes; every unit is a power of 1024."""
    number = F.regexp_extract(F.trim(value), r"(?i)^([0-9]+(?:\.[0-9]+)?)\s*([KMGT]?)(?:I?B)?$", 1)
    unit = F.upper(F.regexp_extract(F.trim(value), r"(?i)^([0-9]+(?:\.[0-9]+)?)\s*([KMGT]?)(?:I?B)?$", 2))
    power = F.pow(F.lit(1024.0), (F.instr(F.lit("KMGT"), unit) * (unit != "").cast("int")).cast("double"))
    return F.floor(number.try_cast("double") * power).cast("long")


def format_bytes(n: Column) -> Column:
    out = F.concat(n.cast("string"), F.lit(" B"))
    for i, unit in enumerate(("KiB", "MiB", "GiB", "TiB"), 1):
        out = F.when(n >= 1024**i, F.concat(F.format_string("%.2f", n / 1024**i), F.lit(f" {unit}"))).otherwise(out)
    return out


def pct_change(now: Column, before: Column) -> Column:
    """Per cent change; NULL if a side is NULL or the base is zero."""
    return F.when(before != 0, (now / before - 1) * 100)


def required(value: Column, label: str) -> Column:
    """A missing comparison is an error, never zero per cent."""
    return F.coalesce(value, F.raise_error(F.lit(f"missing comparison period: {label}")).cast("double"))


def local_name(tag: Column) -> Column:
    return F.substring_index(tag, "}", -1)


def fact_markers(text: Column) -> Column:
    """Array of {key, value} of ``<!-- fact:key --> value <!-- /fact -->``."""
    pattern = r"<!--\s*fact:([\w.-]+)\s*-->(.*?)<!--\s*/fact\s*-->"
    return F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), 1).alias("key"), F.transform(F.regexp_extract_all(text, F.lit(pattern), 2), lambda v: F.trim(v)).alias("value"))


def number_near(text: Column, keyword: str, reach: int = 160) -> Column:
    """First standalone number within ``reach`` characters of a keyword."""
    at = F.instr(F.lower(text), keyword.lower())
    window = F.substring(text, F.greatest(at - reach, F.lit(1)), F.lit(2 * reach + len(keyword)))
    return F.when(at > 0, decimal_value(F.regexp_extract(window, r"(?<![\w.,])(\d[\d,]*(?:\.\d+)?)(?![\w])", 1)))


def nearest_rank(values: Column, fraction: float) -> Column:
    """Element at the half-even rounded rank (n - 1) * fraction of a sorted array."""
    rank = F.bround((F.size(values) - 1) * F.lit(fraction), 0).cast("int")
    return F.try_element_at(values, rank + 1)


def retry_after_ms(header: Column, now: Column) -> Column:
    """Milliseconds to wait by a Retry-After header: seconds, or a date after ``now``; NULL if unreadable, never below zero."""
    seconds = F.trim(header).try_cast("double")
    date = F.try_to_timestamp(F.regexp_extract(header, r"^\s*\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2}) GMT\s*$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    wait = F.when(seconds.isNotNull(), seconds * 1000).otherwise((F.unix_timestamp(date) - F.unix_timestamp(now)) * 1000)
    return F.when(wait.isNotNull(), F.greatest(F.lit(0).cast("long"), wait.cast("long")))


def backoff_ms(attempt: Column, base: int = 1000, most: int = 60_000) -> Column:
    """Exponential wait before an attempt, counted from 0."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt)).cast("long")


def within_byte_limit(sizes: Column, limit: int) -> Column:
    """The chunks of a transfer (array of sizes) that pass before the one that would exceed the limit; 0 means no limit."""
    if limit <= 0:
        return sizes
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(True).alias("open"), F.lit(0).alias("n"))

    def step(acc, size):
        total = acc["sum"] + size
        passes = acc["open"] & (total <= limit)
        return F.struct(F.when(passes, total).otherwise(acc["sum"]).alias("sum"), passes.alias("open"), (acc["n"] + passes.cast("int")).alias("n"))

    return F.slice(sizes, F.lit(1), F.aggregate(sizes, start, step)["n"])
