"""Column expressions over texts: character classes, words, lines and tokens.

They follow Python's rules for white space, digits and case where these differ from Java's. Counts of characters of any
class come from one table of the text's characters (``histogram``), not from a scan of the text for each class.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"\t-\r\x1c-\x20\x85\xa0  -     　"
DIGIT = r"\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒"
UPPER, LOWER = r"\p{IsUppercase}", r"\p{IsLowercase}"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
TOKEN = r"(?U)\w(?:[\w'-]*\w)?"


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def count_literal(text: Column, literal: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))) / F.lit(len(literal))).cast("int")


def per(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def words(text: Column) -> Column:
    """Pieces between white space."""
    return F.filter(F.split(text, f"[{WS}]+"), lambda w: w != "")


def tokens(text: Column) -> Column:
    """Words of letters, digits and underscores, with apostrophes and hyphens inside."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{WS}]+|[{WS}]+$", "")


def blank(text: Column) -> Column:
    return ~text.rlike(f"[^{WS}]")


def lines(text: Column) -> Column:
    """Lines without their ends; a line end at the very end opens no further line."""
    parts = F.split(text, LINE_END, -1)
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def characters(text: Column) -> Column:
    return F.split(text, "")


def sum_lengths(items: Column) -> Column:
    return F.aggregate(items, F.lit(0), lambda s, w: s + F.length(w))


def bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a value that is computed once, however often it is used there, within lambdas too."""
    return F.transform(F.array(value), make)[0]


def multiplicities(items: Column) -> Column:
    """array<struct<c, n>>: each distinct item and how often it occurs, in order; one sort within the row, no shuffle."""

    def tabled(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda w, i: F.when((i == 0) | (w != F.get(s, i - 1)), i)), lambda i: i.isNotNull())
        return bound(starts, lambda b: F.transform(b, lambda at, k: F.struct(s[at].alias("c"), (F.coalesce(F.get(b, k + 1), F.size(s)) - at).alias("n"))))

    return bound(F.array_sort(items), tabled)


def histogram(text: Column) -> Column:
    """The distinct characters of a text and how often each occurs."""
    return multiplicities(F.filter(characters(text), lambda c: c != ""))


def count_where(hist: Column, test: Callable[[Column], Column]) -> Column:
    """Characters for which the test holds."""
    return F.aggregate(F.filter(hist, lambda h: test(h["c"])), F.lit(0), lambda s, h: s + h["n"])


def count_class(hist: Column, pattern: str) -> Column:
    """Characters that a pattern for one character matches."""
    return count_where(hist, lambda c: c.rlike(pattern))


def count_signs(hist: Column, *signs: str) -> Column:
    return count_where(hist, lambda c: c.isin(*signs))


def entropy(hist: Column, n: Column) -> Column:
    """Shannon entropy of the ``n`` characters in bits."""
    return F.when(n == 0, 0.0).otherwise(bound(n.cast("double"), lambda m: -F.aggregate(hist, F.lit(0.0), lambda s, h: s + h["n"] / m * F.log2(h["n"] / m))))
