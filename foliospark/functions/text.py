"""Text metrics, token normalisation and extraction-quality columns; all native expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: White space that Python's str.isspace knows, as a Java character class.
SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
#: The combining marks that a search drops.
MARKS = "".join(map(chr, range(0x300, 0x370)))


def _folds() -> dict[str, str]:
    """Lower-case Latin letters with any marks -> the letter under them, by Unicode decomposition."""
    out = {}
    for c in map(chr, range(0xC0, 0x1F00)):
        parts = unicodedata.normalize("NFD", c)
        if c == c.lower() and "a" <= parts[0] <= "z" and len(parts) > 1 and all(map(unicodedata.combining, parts[1:])):
            out[c] = parts[0]
    return out


FOLDS = _folds()
#: Arguments of TRANSLATE: what has no counterpart in PLAIN is deleted.
MARKED, PLAIN = "".join(FOLDS) + MARKS, "".join(FOLDS.values())
FOLD_TABLE = str.maketrans(FOLDS) | dict.fromkeys(map(ord, MARKS))


def nonspace(text: Column) -> Column:
    """Number of characters that are not white space."""
    return F.length(F.regexp_replace(text, SPACE, "")).cast("long")


def normalised(text: Column) -> Column:
    """`` tok tok `` in lower case without diacritics (letters and marks decomposed or not), one space around every token; a phrase is then a substring."""
    folded = F.translate(F.lower(text), MARKED, PLAIN)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(folded, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def tokens_of(norm: Column) -> Column:
    """Number of tokens of a normalised text."""
    return F.when(norm == "  ", 0).otherwise(F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) - 1).cast("long")


def phrase_count(norm: Column, phrase: str) -> Column:
    """Occurrences of a phrase in a normalised text; neighbours may share their separating space."""
    doubled = F.replace(norm, F.lit(" "), F.lit("  "))
    needle = " " + phrase.replace(" ", "  ") + " "
    return ((F.length(doubled) - F.length(F.replace(doubled, F.lit(needle), F.lit("")))) / len(needle)).cast("long")


def page_metrics(pages: Column) -> dict[str, Column]:
    """Canonical metrics of an array of page texts."""
    joined = F.array_join(F.transform(pages, lambda p: F.coalesce(p, F.lit(""))), "\n")
    per_page = F.transform(pages, lambda p: nonspace(F.coalesce(p, F.lit(""))))
    count = F.size(pages).cast("long")
    dense = nonspace(joined)
    return {
        "page_count": count,
        "characters": F.length(joined).cast("long"),
        "nonspace_characters": dense,
        "line_count": F.when(F.length(joined) == 0, 0).otherwise(F.size(F.split(joined, "\n", -1))).cast("long"),
        "heading_count": F.regexp_count(joined, F.lit(r"(?m)^#{1,6}[ \t]+")).cast("long"),
        "table_rows": F.regexp_count(joined, F.lit(r"(?m)^\|.*\|[ \t]*$")).cast("long"),
        "replacement_characters": (F.length(joined) - F.length(F.replace(joined, F.lit("�"), F.lit("")))).cast("long"),
        "empty_pages": F.size(F.filter(per_page, lambda n: n < 30)).cast("long"),
        "low_text": dense < F.greatest(F.lit(100), 40 * count),
    }


def office_metrics(pages: Column) -> dict[str, Column]:
    """Metrics of converted office files: those of pages, the longest page, and low text by a fixed bound."""
    base = page_metrics(pages)
    longest = F.array_max(F.transform(pages, lambda p: F.length(F.coalesce(p, F.lit("")))))
    return base | {"max_page_characters": F.coalesce(longest, F.lit(0)).cast("long"), "low_text": base["nonspace_characters"] < 100}


def grade(pages: Column, dense: Column, replacements: Column, empty_pages: Column) -> Column:
    """Quality ladder: empty, garbled, gappy, thin, ok; the first that holds."""
    return (
        F.when((pages <= 0) | (dense < 100), "empty")
        .when((replacements > 0) & ((replacements >= 200) | (replacements * 500 >= dense)), "garbled")
        .when(empty_pages / pages >= 0.30, "gappy")
        .when(dense / pages < 200, "thin")
        .otherwise("ok")
    )


def semantic_flags(expansion: Column, repeated_share: Column, longest_page: Column) -> Column:
    """Names of the suspicious properties of a text."""
    return F.array_compact(F.array(F.when(expansion > 5, "expansion"), F.when(repeated_share > 0.5, "repetition"), F.when(longest_page > 500_000, "long-page")))


def with_flags(graded: Column, flags: Column) -> Column:
    """Flags turn ok into suspect and leave every other grade."""
    return F.when((graded == "ok") & (F.size(flags) > 0), "suspect").otherwise(graded)


def worst_first(df: DataFrame, grade_col: str, density: str, key: str, top: int) -> DataFrame:
    """The ``top`` rows to look at, ok last and thin text first, with their place; ranked behind the limit."""
    order = [F.col(grade_col) == "ok", F.col(density), F.col(key)]
    return df.orderBy(*order).limit(top).withColumn("place", F.row_number().over(Window.orderBy(*order)))


def first_heading(text: Column) -> Column:
    """First Markdown heading that still has text without its marks, cut to 500 characters."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"(?m)^#{1,6}[ \t]+(.*)$")), lambda h: F.trim(F.regexp_replace(h, "[*_`#<>]", "")))
    return F.left(F.try_element_at(F.filter(found, lambda h: h != ""), F.lit(1)), F.lit(500))


def opening(pages: Column) -> Column:
    """First two pages, at most 20,000 characters."""
    return F.left(F.array_join(F.slice(pages, 1, 2), "\n"), F.lit(20_000))


def recovery_action(page_nonspace: Column, replacement_rate: Column, text_layer: Column, ocr: Column, forced: Column) -> Column:
    """Page recovery policy: an empty page takes its text layer, else OCR; a garbled page is replaced only when forced."""
    layer, seen = F.length(F.trim(text_layer)) > 0, F.length(F.trim(ocr)) > 0
    return (
        F.when((page_nonspace < 30) & layer, "text-layer")
        .when((page_nonspace < 30) & seen, "ocr")
        .when(page_nonspace < 30, "skip:no-candidate")
        .when((replacement_rate >= 0.20) & ~forced, "skip:garbled-not-forced")
        .when((replacement_rate >= 0.20) & layer, "text-layer")
        .when((replacement_rate >= 0.20) & seen, "ocr")
        .when(replacement_rate >= 0.20, "skip:no-candidate")
        .otherwise("skip:readable")
    )
