"""Filters and decisions: language, spam, quality, and the heuristic filter, as columns that keep and explain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx

LANGUAGE_THRESHOLD, SPAM_THRESHOLD, QUALITY_THRESHOLD = 0.75, 0.75, 0.65
CERTAIN = 0.90


def language_keep(language: Column, score: Column, wanted: str | Column = "it", threshold: float = LANGUAGE_THRESHOLD) -> Column:
    return F.coalesce((language == wanted) & (score > threshold), F.lit(False))


def heuristic_keep(text: Column, least: int = 120, pipes: int = 6, menu: int = 3) -> Column:
    """False for short texts, many vertical bars, and pages that look like a menu."""
    low = F.lower(F.coalesce(text, F.lit("")))
    items = sum((F.when(F.contains(low, F.lit(w)), 1).otherwise(0) for w in lx.MENU_WORDS), F.lit(0))
    return (F.length(low) >= least) & (tx.count_literal(low, "|") <= pipes) & (items < menu)


def strong_evidence(spam: Column, score: Column) -> Column:
    """Ten rules, any of which confirms a high spam score; a missing count is 0."""
    v = lambda k: F.coalesce(spam[k].cast("double"), F.lit(0.0))
    has = lambda k: v(k) > 0
    cta, urgency, money, url = has("cta_keyword_hits"), has("urgency_keyword_hits"), has("money_keyword_hits"), has("url_count_text")
    rules = [
        has("suspicious_tld_count"),
        has("shortener_url_count") & cta,
        has("cta_plus_url_score"),
        has("urgency_cta_url_combo"),
        has("money_cta_combo"),
        has("account_keyword_hits") & has("security_keyword_hits"),
        has("delivery_keyword_hits") & url,
        has("brand_keyword_hits") & url & cta,
        (v("spam_keyword_hits") >= 4) & (cta | urgency | money),
        (score >= CERTAIN) & (v("ham_business_hits") == 0) & (v("ham_strength_score") == 0),
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out | r
    return F.coalesce(out, F.lit(False))


def spam_decision(spam: Column, score: Column, threshold: float = SPAM_THRESHOLD) -> Column:
    """struct: keep, reason, pred_label, pred_score (6 digits), strong_evidence, uncertain_reason.

    A null score (a feature that is no number) counts as ham with score 0.
    """
    s = F.coalesce(score, F.lit(0.0))
    is_spam, strong = s >= threshold, strong_evidence(spam, s)
    return F.struct(
        (~(is_spam & strong)).alias("keep"),
        F.when(is_spam & strong, "spam_detected").alias("reason"),
        F.when(is_spam, "spam").otherwise("ham").alias("pred_label"),
        F.round(s, 6).alias("pred_score"),
        strong.alias("strong_evidence"),
        F.when(is_spam & ~strong, "high_score_but_weak_spam_evidence").alias("uncertain_reason"),
    )


def quality_decision(score: Column, complete: Column, threshold: float = QUALITY_THRESHOLD) -> Column:
    """struct: keep, reason, label, score (4 digits). An incomplete feature row is bad with score 0."""
    s = F.when(complete, score)
    good = F.coalesce(s >= threshold, F.lit(False))
    reason = F.when(~complete, "quality_missing_features").when(~good, "quality_bad")
    return F.struct(good.alias("keep"), reason.alias("reason"), F.when(good, "good").otherwise("bad").alias("label"), F.round(F.coalesce(s, F.lit(0.0)), 4).alias("score"))


def tagged(df: DataFrame, spam: Column | None = None, quality: Column | None = None) -> DataFrame:
    """The steps that tag and never drop: all rows, with the labels and scores of the decisions (``spam_decision``,
    ``quality_decision``) that are given as columns."""
    out = df
    if spam is not None:
        out = out.withColumns({"spam_pred_label": spam["pred_label"], "spam_pred_score": spam["pred_score"]})
    if quality is not None:
        out = out.withColumns({"quality_label": quality["label"], "quality_score": quality["score"]})
    return out


def complete(struct: Column, names: list[str]) -> Column:
    out = F.lit(True)
    for k in names:
        out = out & struct[k].isNotNull()
    return out


def valid_labels(df: DataFrame, label: str, allowed: tuple[str, ...] = ("ham", "spam")) -> DataFrame:
    """Rows whose label, trimmed and lower-cased, is one of ``allowed``; the label is replaced by that form."""
    clean = F.lower(tx.stripped(F.col(label).cast("string")))
    return df.withColumn(label, clean).filter(F.col(label).isin(*allowed))


def reject_audit(rejects: DataFrame, text: str, label: str, stage: str) -> DataFrame:
    """Rejected rows by gold label: text, label_rilevata, scartato_da, file (good or bad).

    Rows without a label, and stages that only serve inspection, are left out.
    """
    rejects = rejects.filter(~F.coalesce(F.contains(F.col(stage), F.lit("inspection")), F.lit(False)))
    clean = F.lower(tx.stripped(F.col(label).cast("string")))
    rows = rejects.filter(F.col(label).isNotNull() & (F.col(label).cast("string") != ""))
    return rows.select(F.col(text).alias("text"), clean.alias("label_rilevata"), F.col(stage).alias("scartato_da"), F.when(clean == "good", "good").otherwise("bad").alias("file"))
