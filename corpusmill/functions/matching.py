"""Term counts on normalised text, links, amounts and the like, as column expressions."""

from __future__ import annotations

import unicodedata
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx
from . import text as tx


def _plain(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c.lower()) if not unicodedata.combining(x))


#: Characters whose decomposition without marks has a Latin letter or digit, by rule: one other character, or several.
_FOLDS = {c: p for c in map(chr, [*range(0xA0, 0xD800), *range(0xE000, 0x1F000)]) if (p := _plain(c)) != c.lower() and any(x.isascii() and x.isalnum() for x in p)}
_FOLDED = {c: p for c, p in _FOLDS.items() if len(p) == 1}
_UNFOLDED = {c: p for c, p in _FOLDS.items() if len(p) > 1}
#: A few ranges with all of the latter: a class of hundreds of single characters would be tried one by one.
_MAY_UNFOLD = "[" + "".join(c for c in _UNFOLDED if c < "₨") + r"₨℀-\x{10ffff}]"
_MARKS = r"[̀-ͯ]"
_OTHER = r"[^0-9a-zA-ZÀ-ÖØ-öø-ÿ]+"


def normalised(text: Column) -> Column:
    """Lower case, accents dropped, compatible forms spelt out, everything but Latin letters and digits one space, trimmed."""
    low = F.lower(text)
    folded = F.translate(low, "".join(_FOLDED), "".join(_FOLDED.values()))
    long, spelt = F.lit(list(_UNFOLDED)), F.lit(list(_UNFOLDED.values()))
    there = F.filter(F.sequence(F.lit(0), F.lit(len(_UNFOLDED) - 1)), lambda i: F.contains(low, long[i]))
    whole = F.aggregate(there, folded, lambda t, i: F.replace(t, long[i], spelt[i]))
    low = F.when(low.rlike(_MAY_UNFOLD), whole).otherwise(folded)
    return F.trim(F.regexp_replace(F.regexp_replace(low, _MARKS, ""), _OTHER, " "))


def normal_term(term: str) -> str:
    import re

    return re.sub(r"[^0-9a-zA-ZÀ-ÖØ-öø-ÿ]+", " ", _plain(term)).strip()


def padded(text: Column) -> Column:
    return F.concat(F.lit(" "), normalised(text), F.lit(" "))


def term_hits(pad: Column, terms: list[str]) -> Column:
    """Non-overlapping occurrences of all terms, each between spaces of ``pad``; equal candidates count once each."""
    total = F.lit(0)
    for term, n in sorted(Counter(normal_term(t) for t in terms).items()):
        candidate = f" {term} "
        total = total + F.lit(n) * ((F.length(pad) - F.length(F.replace(pad, F.lit(candidate), F.lit("")))) / F.lit(len(candidate))).cast("int")
    return total


def term_table(pad: Column, categories: dict[str, list[str]]) -> Column:
    """array<struct<n, w>> of the terms that occur: their count, and how often each category lists them.

    Only terms whose first word is in the text are counted, so a text costs little however long the lists are.
    """
    named: dict[str, list[int]] = {}
    for k, terms in enumerate(categories.values()):
        for t in terms:
            named.setdefault(normal_term(t), [0] * len(categories))[k] += 1
    by_first: dict[str, list[str]] = {}
    for t in named:
        by_first.setdefault(t.split(" ")[0], []).append(t)
    entry = lambda t: F.struct(F.lit(f" {t} ").alias("t"), F.array(*[F.lit(n) for n in named[t]]).alias("w"))
    listed = F.create_map(*[x for first, terms in sorted(by_first.items()) for x in (F.lit(first), F.array(*[entry(t) for t in terms]))])
    there = F.array_intersect(F.split(F.trim(pad), " "), F.array(*[F.lit(x) for x in sorted(by_first)]))
    found = F.flatten(F.transform(there, lambda first: F.element_at(listed, first)))
    counted = F.transform(found, lambda c: F.struct(((F.length(pad) - F.length(F.replace(pad, c["t"], F.lit("")))) / F.length(c["t"])).cast("int").alias("n"), c["w"].alias("w")))
    return F.filter(counted, lambda c: c["n"] > 0)


def category_hits(table: Column, categories: dict[str, list[str]], name: str) -> Column:
    k = list(categories).index(name)
    return F.aggregate(table, F.lit(0), lambda s, c: s + c["n"] * c["w"][k])


def any_term(pad: Column, terms: list[str]) -> Column:
    """Whether any of the terms occurs; ``pad`` is computed once."""

    def found(p: Column) -> Column:
        out = F.lit(False)
        for term in sorted({normal_term(t) for t in terms}):
            out = out | F.contains(p, F.lit(f" {term} "))
        return out

    return tx.bound(pad, found)


URL = "(?iU)" + lx.URL


def emails(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("@")), F.regexp_extract_all(text, F.lit("(?U)" + lx.EMAIL), F.lit(0))).otherwise(F.array().cast("array<string>"))


def fixed_scheme(url: Column) -> Column:
    """A scheme with one slash gets two, in lower case."""
    for scheme in ("https", "http"):
        url = F.regexp_replace(url, f"(?i)^{scheme}:/(?=[^/])", f"{scheme}://")
    return url


def urls(text: Column) -> Column:
    """Links and bare domains outside e-mail addresses."""
    without = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, "(?U)" + lx.EMAIL, " ")).otherwise(text)
    edge = r"[.,;:!?()\[\]{}<>\"']"
    # every link has a scheme with a slash, or a dot before what is no space
    found = F.when(F.contains(without, F.lit(":/")) | without.rlike(r"\.[^ \t\n\r]"), F.regexp_extract_all(without, F.lit(URL), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return F.transform(found, lambda u: fixed_scheme(F.regexp_replace(tx.stripped(u), f"^{edge}+|{edge}+$", "")))


def has_url(text: Column) -> Column:
    return F.size(urls(text)) > 0


def domain(url: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.lower(url), "^https?://", ""), r"^www\.", "")
    return F.substring_index(F.substring_index(bare, "/", 1), ":", 1)


def suspicious(found: Column) -> Column:
    ends = "|".join(t.replace(".", r"\.") for t in lx.SUSPICIOUS_TLDS)
    return F.size(F.filter(found, lambda u: domain(u).rlike(f"(?:{ends})$")))


def shorteners(found: Column) -> Column:
    def short(u: Column) -> Column:
        hit = F.lit(False)
        for s in lx.SHORTENERS:
            hit = hit | F.contains(F.lower(u), F.lit(s))
        return hit

    return F.size(F.filter(found, short))


def upper_tokens(toks: Column) -> Column:
    return F.size(F.filter(toks, lambda t: (F.regexp_count(t, F.lit(r"\p{L}")) >= 2) & (F.upper(t) == t) & (F.lower(t) != t)))


def short_lines(text: Column, most: int = 40) -> Column:
    return F.size(F.filter(tx.lines(text), lambda x: F.length(tx.stripped(x)).between(1, most)))


def short_tokens(toks: Column) -> Column:
    return F.size(F.filter(toks, lambda t: t.rlike(r"^[\p{L}\p{N}]{2}$")))


def amounts(text: Column) -> Column:
    return tx.count(text, "(?iU)" + lx.AMOUNT)


def promo_codes(text: Column) -> Column:
    return tx.count(text, "(?iU)" + lx.PROMO_CODE_PATTERN)


def signatures(text: Column) -> Column:
    return tx.count(text, "(?iU)" + lx.SIGNATURE)


def digit_runs(text: Column) -> Column:
    return tx.count(text, r"(?U)\b\d{4,}\b")


def chunks(text: Column) -> Column:
    return F.filter(F.split(text, r"[\n.!?]+"), lambda c: ~tx.blank(c))


def chunks_with(text: Column, *tests) -> Column:
    """Number of chunks for which all tests hold; a test is a function of a chunk."""

    def both(c: Column) -> Column:
        out = tests[0](c)
        for t in tests[1:]:
            out = out & t(c)
        return out

    return F.size(F.filter(chunks(text), both))
