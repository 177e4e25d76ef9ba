"""The 52 text-quality statistics, as columns of one struct per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx

# The feature names and their order.
BASE = ["length", "white_space_ratio", "non_alpha_digit_ratio", "digit_ratio", "uppercase_ratio", "elipsis_ratio", "punctuation_ratio"]
LINGUISTIC = ["word_count", "sentence_count", "vocabulary_size", "lowercase_ratio", "vowel_ratio", "consonant_ratio", "avg_word_length", "avg_sentence_length", "quote_ratio", "parenthesis_ratio", "comma_ratio", "period_ratio", "question_mark_ratio", "exclamation_ratio", "colon_ratio", "semicolon_ratio", "stopword_ratio"]
STRUCTURAL = ["line_count", "paragraph_count", "avg_line_length", "avg_paragraph_length", "empty_line_ratio", "bullet_point_count", "bullet_point_ratio", "url_count", "url_density", "email_count", "email_density", "html_tag_count", "html_tag_ratio", "special_char_ratio"]
ANOMALY = ["most_common_word_freq", "repeated_word_count", "repeated_word_ratio", "repeated_char_count", "repeated_char_ratio", "repeated_sequence_count", "text_entropy", "unique_word_count", "unique_word_ratio", "all_caps_word_ratio", "all_lowercase_word_ratio", "mixed_case_word_ratio", "consecutive_spaces_count", "consecutive_punctuation_count"]
# End of the fixed values.
FEATURES = [*BASE, *LINGUISTIC, *STRUCTURAL, *ANOMALY]
MODEL_FEATURES = ["language_score", *FEATURES]
VOWELS = "aeiouàèéìòù"


def prepared(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds what several features share: t, n, ws (words), low (lower-cased words), wc, hist and often (the characters and the lower-cased words with their counts), sc (sentences)."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("t", t).withColumn("n", F.length("t")).withColumn("ws", tx.words(F.col("t")))
    out = out.withColumn("low", F.transform("ws", lambda w: F.lower(w))).withColumn("wc", F.size("ws"))
    out = out.withColumn("hist", tx.histogram(F.col("t"))).withColumn("often", tx.multiplicities(F.col("low")))
    return out.withColumn("sc", F.greatest(F.lit(1), tx.count_signs(F.col("hist"), ".", "?", "!")))


def expressions() -> dict[str, Column]:
    """Feature name -> expression over the columns of ``prepared``; every ratio is 0 where it has nothing to divide by."""
    t, n, ws, low, wc, sc, hist, often = (F.col(c) for c in ("t", "n", "ws", "low", "wc", "sc", "hist", "often"))
    share = lambda pattern: tx.per(tx.count_class(hist, pattern), n)
    signs = lambda *which: tx.per(tx.count_signs(hist, *which), n)
    some = lambda test: tx.per(F.size(F.filter(ws, test)), wc)
    where = lambda hint, pattern: F.when(F.contains(t, F.lit(hint)), tx.count(t, pattern)).otherwise(0)
    lines, paragraphs = tx.lines(t), F.size(F.filter(F.split(t, "\n\n"), lambda p: ~tx.blank(p)))
    upper, lower = lambda w: w.rlike(tx.UPPER), lambda w: w.rlike(tx.LOWER)
    bullets, urls = tx.count(t, f"(?md)^[{tx.WS}]*[-*•][{tx.WS}]"), where("://", lx.PLAIN_URL)
    emails, tags = where("@", "(?U)" + lx.EMAIL_WITH_BAR), where("<", lx.HTML_TAG)
    runs = tx.count(t, r"(?d)(.)\1{2,}")
    repeated, distinct = F.size(F.filter(often, lambda x: x["n"] > 1)), F.size(often)
    letters = tx.count_class(hist, rf"[\p{{L}}&&[^{VOWELS}{VOWELS.upper()}]]")
    out = {
        "length": n,
        "white_space_ratio": share(f"[{tx.WS}]"),
        "non_alpha_digit_ratio": share(r"[^\p{L}\p{N}]"),
        "digit_ratio": share(f"[{tx.DIGIT}]"),
        "uppercase_ratio": share(tx.UPPER),
        "elipsis_ratio": tx.per(tx.count_literal(t, "...") + tx.count_signs(hist, "…"), n),
        "punctuation_ratio": signs(*".,;:!?()[]\"'"),
        "word_count": wc,
        "sentence_count": F.when(n == 0, 0).otherwise(sc),
        "vocabulary_size": distinct,
        "lowercase_ratio": share(tx.LOWER),
        "vowel_ratio": share(f"[{VOWELS}{VOWELS.upper()}]"),
        "consonant_ratio": tx.per(letters, n),
        "avg_word_length": tx.per(tx.sum_lengths(ws), wc),
        "avg_sentence_length": tx.per(wc, sc),
        "quote_ratio": signs('"', "'", "«", "»"),
        "parenthesis_ratio": signs("(", ")"),
        "comma_ratio": signs(","),
        "period_ratio": signs("."),
        "question_mark_ratio": signs("?"),
        "exclamation_ratio": signs("!"),
        "colon_ratio": signs(":"),
        "semicolon_ratio": signs(";"),
        "stopword_ratio": tx.per(F.size(F.filter(low, lambda w: w.isin(*lx.STOPWORDS))), wc),
        "line_count": F.size(lines),
        "paragraph_count": paragraphs,
        "avg_line_length": tx.per(n, F.size(lines)),
        "avg_paragraph_length": tx.per(n, paragraphs),
        "empty_line_ratio": tx.per(F.size(F.filter(lines, tx.blank)), F.size(lines)),
        "bullet_point_count": bullets,
        "bullet_point_ratio": tx.per(bullets, n),
        "url_count": urls,
        "url_density": tx.per(urls, wc),
        "email_count": emails,
        "email_density": tx.per(emails, wc),
        "html_tag_count": tags,
        "html_tag_ratio": tx.per(tags, n),
        "special_char_ratio": signs(*"@#$%^&*+="),
        "most_common_word_freq": F.coalesce(F.array_max(F.transform(often, lambda x: x["n"])), F.lit(0)),
        "repeated_word_count": repeated,
        "repeated_word_ratio": tx.per(repeated, wc),
        "repeated_char_count": runs,
        "repeated_char_ratio": tx.per(runs, n),
        "repeated_sequence_count": tx.count(t, rf"(?iU)(\b\w+\b[{tx.WS}]+)\1+"),
        "text_entropy": tx.entropy(hist, n),
        "unique_word_count": distinct,
        "unique_word_ratio": tx.per(distinct, wc),
        "all_caps_word_ratio": some(lambda w: upper(w) & ~lower(w) & (F.length(w) > 1)),
        "all_lowercase_word_ratio": some(lambda w: lower(w) & ~upper(w)),
        "mixed_case_word_ratio": some(lambda w: lower(w) & upper(w)),
        "consecutive_spaces_count": where("  ", " {2,}"),
        "consecutive_punctuation_count": tx.count(t, "[.!?,;:]{2,}"),
    }
    return {k: out[k].cast("int" if k == "length" or k.endswith(("_count", "_size", "_freq")) else "double") for k in FEATURES}


def quality_features(docs: DataFrame, names: list[str] | None = None, text: str = "text", out: str = "quality") -> DataFrame:
    """All columns of ``docs`` plus the struct ``out`` of the named features; a null text counts as empty."""
    every = expressions()
    ready = prepared(docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text")), "_text")
    made = ready.select("_row", F.struct(*[every[k].alias(k) for k in names or FEATURES]).alias("_made"))
    return made.select(*[F.col("_row")[c].alias(c) for c in docs.columns], F.col("_made").alias(out))
