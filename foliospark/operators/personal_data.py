"""Screen for personal data: counts and hashed tokens only, values are never kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.values import token

# The patterns of the screen and the local parts that are roles.
PATTERNS = {
    "ppsn": r"\b\d{7}[A-W][A-IW]?\b",
    "iban": r"\bIE\d{2}[A-Z]{4}\d{14}\b",
    "email_personal": r"\b[A-Za-z]+[._][A-Za-z]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "email_any": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "phone_ie": r"\b(?:\+353|0)\s?(?:1|2\d|4\d|5\d|6\d|7\d|9\d|8[35679])\s?\d{3}\s?\d{3,4}\b",
    "dob": r"(?i)\b(?:date of birth|d\.o\.b\.|dob)\b[\s:]*\d",
    "signature": r"(?i)\b(?:yours sincerely|yours faithfully|kind regards|signed)\b",
    "home_address": r"(?i)\b(?:home address|private address|residential address)\b",
    "personal_capacity": r"(?i)\b(?:in a personal capacity|as a private individual|as a member of the public|i am writing as a|private citizen|as an individual)\b",
}
ROLE_LOCAL = (
    r"(?i)^(?:info|admin|office|enquiries|enquiry|contact|support|hello|general|reception|secretary|compliance|legal|press|media|policy"
    r"|consultation|consultations|submissions|feedback|mail|post|help|sales|accounts)$"
)


def found(text: Column, name: str) -> Column:
    """All matches of a pattern; personal mail addresses without role local parts."""
    hits = F.regexp_extract_all(text, F.lit(PATTERNS[name]), 0)
    if name == "email_personal":
        hits = F.filter(hits, lambda v: ~F.substring_index(F.substring_index(v, "@", 1), ".", 1).rlike(ROLE_LOCAL))
    return hits


def count_of(text: Column, name: str) -> Column:
    """Number of matches; only personal mail addresses are looked at one by one."""
    return (F.size(found(text, name)) if name == "email_personal" else F.regexp_count(text, F.lit(PATTERNS[name]))).cast("long")


def page_counts(df: DataFrame, text: str) -> DataFrame:
    """One count column for each pattern."""
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select("*", *[count_of(body, n).alias(n) for n in PATTERNS])


def document_counts(pages: DataFrame, key: str, text: str) -> DataFrame:
    """Counts summed by document, signal_count (patterns that occur), documents without any left out."""
    sums = page_counts(pages.select(key, text), text).groupBy(key).agg(*[F.sum(n).alias(n) for n in PATTERNS])
    signals = sum((F.when(F.col(n) > 0, 1).otherwise(0) for n in PATTERNS), F.lit(0))
    return sums.withColumn("signal_count", signals.cast("long")).filter("signal_count > 0")


def report_order(key: str) -> list[Column]:
    """Most signals first, then most personal mail addresses and telephone numbers, then the key."""
    return [F.desc("signal_count"), F.desc("email_personal"), F.desc("phone_ie"), F.col(key)]


#: Patterns whose distinct values are counted as tokens.
TOKENISED = ("ppsn", "iban", "email_personal", "email_any")


def distinct_tokens(pages: DataFrame, text: str, names: tuple[str, ...] = TOKENISED) -> DataFrame:
    """Distinct values of each pattern, compared as 12-digit tokens; one scan for all patterns, hits combined before the count."""
    body = F.coalesce(F.col(text), F.lit(""))

    def tagged(n: str) -> Column:
        return F.transform(found(body, n), lambda v: F.struct(F.lit(n).alias("pattern"), token(v).alias("t")))

    each = F.flatten(F.array(*map(tagged, names)))
    hits = pages.select(F.explode(each).alias("h")).groupBy("h.pattern", "h.t").agg(F.count("*").alias("c"))
    return hits.groupBy("pattern").agg(F.count("*").alias("distinct_tokens"), F.sum("c").alias("occurrences"))
