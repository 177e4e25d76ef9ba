"""The 84-column spam feature row: characters, tokens, links, lexicons, their combinations, and the language score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import matching as mt
from ..functions import text as tx

# The column names and their order.
COLUMNS = """doc_id target_label spam_target_label char_count word_count unique_word_count unique_word_ratio avg_word_length
digit_count digit_ratio uppercase_ratio punctuation_ratio whitespace_ratio exclamation_count question_count newline_count
currency_symbol_count url_count_text unique_url_count_text unique_domain_count_text email_count_text url_density email_density
amount_pattern_count promo_code_pattern_count short_line_count short_token_count suspicious_tld_count shortener_url_count
cta_plus_url_score brand_plus_link_score ham_business_hits ham_formal_hits ham_admin_doc_hits ham_technical_business_hits
business_signature_hits action_phrase_count promo_symbol_count uppercase_token_count digit_run_count has_link_and_cta
has_urgency_and_cta has_brand_and_link has_money_and_cta has_account_and_security has_delivery_and_link has_ham_and_no_url
has_formal_and_no_cta has_admin_doc_and_no_url has_technical_business_and_no_cta has_signature_and_no_cta
symbol_pressure_score urgency_cta_url_combo money_cta_combo spam_keyword_hits urgency_keyword_hits money_keyword_hits
cta_keyword_hits account_keyword_hits security_keyword_hits delivery_keyword_hits brand_keyword_hits
unsubscribe_keyword_hits promo_keyword_hits lang_score lang_is_ita ham_to_spam_keyword_ratio ham_to_cta_ratio
ham_strength_to_spam_ratio ham_strength_score noise_score spam_intent_score noise_without_spam_intent
promo_symbol_count_clip exclamation_count_clip digit_run_count_clip uppercase_token_count_clip safe_security_ham_hits
safe_security_to_spam_ratio spam_keyword_density cta_keyword_density money_keyword_density urgency_keyword_density
ham_business_density""".split()
# End of the fixed values.
# Columns that the model does not see. ``shortner_url_count`` is misspelt in the lists that results are
# compared with, so ``shortener_url_count`` stays an input.
EXCLUDED = """doc_id target_label spam_target_label lang_score lang_is_ita noise_without_spam_intent unsubscribe_keyword_hits
char_count digit_count short_line_count short_token_count amount_pattern_count uppercase_token_count shortner_url_count
word_count newline_count email_count_text promo_symbol_count brand_plus_link_score has_money_and_cta
has_account_and_security has_delivery_and_link has_brand_and_link has_urgency_and_cta urgency_cta_url_combo
money_cta_combo has_admin_doc_and_no_url unique_url_count_text unique_domain_count_text
has_technical_business_and_no_cta""".split()
# End of the fixed values.
MODEL_FEATURES = [c for c in COLUMNS if c not in EXCLUDED]


def number(x: Column) -> Column:
    return x.cast("double")


def flag(test: Column) -> Column:
    return F.when(test, 1.0).otherwise(0.0)


def spam_label(*keys: Column) -> Column:
    """ham, spam or the empty text, from the first key that names either."""

    def known(k: Column) -> Column:
        v = F.lower(tx.stripped(k.cast("string")))
        return F.when(v.isin(*lx.HAM_LABELS), "ham").when(v.isin(*lx.SPAM_LABELS), "spam")

    return F.coalesce(*[known(k) for k in keys], F.lit("")) if keys else F.lit("")


def clip01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def ramp(x: Column, a: float, b: float, c: float, d: float) -> Column:
    """1 between b and c, falling to 0 at a and d."""
    return F.when(x.between(b, c), 1.0).when((x >= a) & (x < b), (x - a) / (b - a)).when((x > c) & (x <= d), 1 - (x - c) / (d - c)).otherwise(0.0)


def language_parts(text: Column, toks: Column, language_score: Column, hist: Column) -> Column:
    """struct of the ratios that the language score weighs; ``text`` is stripped, ``toks`` lower-cased, ``hist`` its characters."""
    n, k = F.length(text), F.size(toks)
    member = lambda listed: F.size(F.filter(toks, lambda w: w.isin(*listed)))
    parts = F.filter(F.transform(F.split(text, r"[.!?\n\r;:]+"), tx.stripped), lambda c: c != "")
    return F.struct(
        tx.per(tx.count_class(hist, r"\p{L}"), n).alias("alpha"),
        tx.per(tx.count_class(hist, f"[{tx.DIGIT}]"), n).alias("digit"),
        tx.per(tx.count_class(hist, rf"[^\p{{L}}\p{{N}}{tx.WS}]"), n).alias("punct"),
        tx.per(tx.count_class(hist, f"[{lx.ACCENTED}{lx.ACCENTED.upper()}]"), n).alias("accented"),
        tx.per(member(lx.MINI_STOPWORDS), k).alias("stop"),
        tx.per(member(lx.COMMON_WORDS), k).alias("common"),
        tx.per(F.size(F.filter(toks, lambda w: F.length(w) >= 4)), k).alias("long"),
        tx.per(F.size(F.filter(toks, lambda w: F.length(w) <= 2)), k).alias("short"),
        tx.per(tx.sum_lengths(toks), k).alias("word"),
        F.when(F.size(parts) > 0, tx.per(tx.sum_lengths(parts), F.size(parts))).otherwise(n.cast("double")).alias("chunk"),
        clip01(F.coalesce(language_score.cast("double"), F.lit(0.0))).alias("raw"),
        ((n > 0) & (k > 0)).alias("any"),
    )


def language_score(p: Column, digits: int | None = 4) -> Column:
    """Weighted evidence for Italian prose minus penalties, between 0.15 and 0.90, and 0 for a text without tokens."""
    gain = F.lit(0.22) * clip01(p["alpha"] / 0.75) + F.lit(0.22) * clip01(p["stop"] / 0.18) + F.lit(0.12) * clip01(p["common"] / 0.08)
    gain = gain + F.lit(0.10) * clip01(ramp(p["word"], 3.0, 4.0, 8.5, 11.0)) + F.lit(0.08) * clip01(p["long"] / 0.45)
    gain = gain + F.lit(0.08) * clip01(ramp(p["chunk"], 10.0, 20.0, 180.0, 260.0)) + F.lit(0.04) * clip01(p["accented"] / 0.01) + F.lit(0.06) * p["raw"]
    loss = F.lit(0.10) * clip01(p["digit"] / 0.20) + F.lit(0.08) * clip01(p["punct"] / 0.22) + F.lit(0.06) * clip01(p["short"] / 0.45)
    score = clip01(F.lit(0.15) + F.lit(0.75) * clip01(gain - loss))
    return F.when(p["any"], score if digits is None else F.round(score, digits)).otherwise(0.0)


def prepared(docs: DataFrame, text: str, doc_id: Column, labels: list[Column], language: Column, score: Column) -> DataFrame:
    """Shared columns, in stages so that none is computed twice."""
    held = F.struct(*docs.columns).alias("_row")
    out = docs.select(held, doc_id.cast("string").alias("id"), spam_label(*labels).alias("label"), language.cast("string").alias("language"), score.cast("double").alias("lid"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    out = out.withColumn("n", F.length("t")).withColumn("hist", tx.histogram(F.col("t"))).withColumn("toks", tx.tokens(F.col("t"))).withColumn("pad", mt.padded(F.col("t"))).withColumn("urls", mt.urls(F.col("t")))
    out = out.withColumn("hits", mt.term_table(F.col("pad"), lx.CATEGORIES))
    return out.withColumn("low", F.transform("toks", lambda w: F.lower(w))).withColumn("wc", F.size("toks"))


def counts() -> dict[str, Column]:
    """Base counts over the columns of ``prepared``; all other columns are algebra over these."""
    t, toks, hits, found, low, n, hist = (F.col(c) for c in ("t", "toks", "hits", "urls", "low", "n", "hist"))
    digits, others = f"[{tx.DIGIT}]", rf"[^\p{{L}}\p{{N}}{tx.WS}]"
    has_cta, has_link = lambda c: mt.any_term(mt.padded(c), lx.CTA), mt.has_url
    cta, linked = mt.category_hits(hits, lx.CATEGORIES, "cta"), F.size(found) > 0
    guard = lambda test, x: F.when(test, x).otherwise(0)
    return {
        "char_count": n,
        "digit_count": tx.count_class(hist, digits),
        "upper_count": tx.count_class(hist, rf"[{tx.UPPER}&&[^{tx.DIGIT}]]"),
        "space_count": tx.count_class(hist, f"[{tx.WS}]"),
        "punct_count": tx.count_class(hist, rf"[{others}&&[^{tx.UPPER}]]"),
        "exclamation_count": tx.count_signs(hist, "!"),
        "question_count": tx.count_signs(hist, "?"),
        "newline_count": tx.count_signs(hist, "\n"),
        "currency_symbol_count": tx.count_signs(hist, "€", "$"),
        "word_count": F.col("wc"),
        "unique_word_count": F.size(F.array_distinct(low)),
        "token_chars": tx.sum_lengths(toks),
        "url_count": F.size(found),
        "unique_url_count": F.size(F.array_distinct(F.transform(found, lambda u: F.lower(u)))),
        "unique_domain_count": F.size(F.array_distinct(F.filter(F.transform(found, mt.domain), lambda d: d != ""))),
        "email_count": F.size(mt.emails(t)),
        "amount_pattern_count": mt.amounts(t),
        "promo_code_pattern_count": mt.promo_codes(t),
        "promo_symbol_count": tx.count_signs(hist, *lx.PROMO_SYMBOLS),
        "uppercase_token_count": mt.upper_tokens(toks),
        "short_line_count": mt.short_lines(t),
        "short_token_count": mt.short_tokens(toks),
        "digit_run_count": mt.digit_runs(t),
        "business_signature_hits": mt.signatures(t),
        "suspicious_tld_count": mt.suspicious(found),
        "shortener_url_count": mt.shorteners(found),
        "cta_plus_url_score": guard((cta > 0) & linked, mt.chunks_with(t, has_link, has_cta)),
        "brand_plus_link_score": guard(linked, mt.chunks_with(t, has_link, lambda c: mt.any_term(mt.padded(c), lx.BRAND))),
        "urgency_cta_url_combo": guard((cta > 0) & linked, mt.chunks_with(t, has_link, has_cta, lambda c: mt.any_term(mt.padded(c), lx.URGENCY))),
        "money_cta_combo": guard(cta > 0, mt.chunks_with(t, has_cta, lambda c: mt.any_term(mt.padded(c), lx.MONEY) | (mt.amounts(c) > 0))),
        **{f"{k}_hits": mt.category_hits(hits, lx.CATEGORIES, k) for k in lx.CATEGORIES},
    }


def derived(c) -> dict[str, Column]:
    """The numeric columns from the base counts; ``c`` gives a count by name as double."""
    wc = c("word_count")
    url, cta, spam, action = c("url_count"), c("cta_hits"), c("spam_hits"), c("action_hits")
    strength = c("ham_formal_hits") + c("ham_admin_doc_hits") + c("ham_technical_business_hits") + c("business_signature_hits")
    account_security, delivery_link = (c("account_hits") > 0) & (c("security_hits") > 0), (c("delivery_hits") > 0) & (url > 0)
    digit_ratio, punct_ratio = tx.per(c("digit_count"), c("char_count")), tx.per(c("punct_count"), c("char_count"))
    length = tx.per(c("token_chars"), wc)
    intent = 1.5 * c("cta_plus_url_score") + 2.0 * c("urgency_cta_url_combo") + 1.5 * c("money_cta_combo") + 1.5 * c("suspicious_tld_count") + c("shortener_url_count") + flag(account_security) + flag(delivery_link)
    noise = flag(c("lang_score") < 0.35) + flag(punct_ratio > 0.18) + flag(digit_ratio > 0.20) + flag(tx.per(c("short_token_count"), wc) > 0.35) + flag((length < 3.0) | (length > 12.0))
    same = ["char_count", "word_count", "unique_word_count", "digit_count", "exclamation_count", "question_count", "newline_count", "currency_symbol_count", "amount_pattern_count", "promo_code_pattern_count", "promo_symbol_count", "uppercase_token_count", "short_line_count", "short_token_count", "ham_business_hits", "ham_formal_hits", "ham_admin_doc_hits", "ham_technical_business_hits", "business_signature_hits", "digit_run_count", "suspicious_tld_count", "shortener_url_count", "cta_plus_url_score", "brand_plus_link_score", "urgency_cta_url_combo", "money_cta_combo", "lang_score", "lang_is_ita"]
    out = {k: c(k) for k in same}
    out |= {f"{k}_keyword_hits": c(f"{k}_hits") for k in ("spam", "urgency", "money", "cta", "account", "security", "delivery", "brand", "unsubscribe", "promo")}
    out |= {f"{k}_keyword_density": tx.per(c(f"{k}_hits"), wc) for k in ("spam", "cta", "money", "urgency")}
    out |= {f"{k}_clip": F.least(c(k), F.lit(float(m))) for k, m in (("promo_symbol_count", 3), ("exclamation_count", 5), ("digit_run_count", 3), ("uppercase_token_count", 5))}
    return out | {
        "unique_word_ratio": tx.per(c("unique_word_count"), wc),
        "avg_word_length": length,
        "digit_ratio": digit_ratio,
        "uppercase_ratio": tx.per(c("upper_count"), c("char_count")),
        "punctuation_ratio": punct_ratio,
        "whitespace_ratio": tx.per(c("space_count"), c("char_count")),
        "url_count_text": url,
        "unique_url_count_text": c("unique_url_count"),
        "unique_domain_count_text": c("unique_domain_count"),
        "email_count_text": c("email_count"),
        "url_density": tx.per(url, wc),
        "email_density": tx.per(c("email_count"), wc),
        "action_phrase_count": action,
        "safe_security_ham_hits": c("safe_security_hits"),
        "has_link_and_cta": flag((url > 0) & (action > 0)),
        "has_urgency_and_cta": flag((c("urgency_hits") > 0) & (action > 0)),
        "has_brand_and_link": flag((c("brand_hits") > 0) & (url > 0)),
        "has_money_and_cta": flag((c("money_hits") > 0) & (action > 0)),
        "has_account_and_security": flag(account_security),
        "has_delivery_and_link": flag(delivery_link),
        "has_ham_and_no_url": flag((c("ham_business_hits") > 0) & (url == 0)),
        "has_formal_and_no_cta": flag((c("ham_formal_hits") > 0) & (cta == 0)),
        "has_admin_doc_and_no_url": flag((c("ham_admin_doc_hits") > 0) & (url == 0)),
        "has_technical_business_and_no_cta": flag((c("ham_technical_business_hits") > 0) & (cta == 0)),
        "has_signature_and_no_cta": flag((c("business_signature_hits") > 0) & (cta == 0)),
        "symbol_pressure_score": c("promo_symbol_count") + c("uppercase_token_count") + c("digit_run_count"),
        "ham_to_spam_keyword_ratio": (c("ham_business_hits") + 1.0) / (spam + 1.0),
        "ham_to_cta_ratio": (c("ham_business_hits") + 1.0) / (cta + 1.0),
        "ham_strength_to_spam_ratio": (strength + 1.0) / (spam + 1.0),
        "safe_security_to_spam_ratio": (c("safe_security_hits") + 1.0) / (spam + 1.0),
        "ham_strength_score": strength,
        "ham_business_density": tx.per(c("ham_business_hits"), wc),
        "spam_intent_score": intent,
        "noise_score": noise,
        "noise_without_spam_intent": flag((noise >= 2.0) & (intent == 0.0)),
    }


def spam_features(docs: DataFrame, text: str = "text", doc_id: Column | None = None, labels: list[Column] | None = None, language: Column | None = None, score: Column | None = None, out: str = "spam", names: list[str] | None = None) -> DataFrame:
    """All columns of ``docs`` plus the struct ``out`` of the 84 columns (or the named ones), in their fixed order; a null text counts as empty."""
    none = F.lit(None)
    ready = prepared(docs, text, doc_id if doc_id is not None else F.lit(""), labels or [], language if language is not None else none, score if score is not None else none)
    parts = language_parts(tx.stripped(F.col("t")), F.col("low"), F.col("lid"), F.col("hist"))
    counted = ready.select("_row", F.coalesce("id", F.lit("")).alias("id"), "label", parts.alias("lp"), flag(F.coalesce(F.lower("language"), F.lit("")).isin("ita", "it", "italian")).alias("lang_is_ita"), *[v.alias(k) for k, v in counts().items()])
    counted = counted.withColumn("lang_score", language_score(F.col("lp")))
    made = derived(lambda k: F.col(k).cast("double"))
    made |= {"doc_id": F.col("id"), "target_label": F.col("label"), "spam_target_label": F.col("label")}
    row = counted.select("_row", F.struct(*[made[k].alias(k) for k in names or COLUMNS]).alias("_made"))
    return row.select(*[F.col("_row")[c].alias(c) for c in docs.columns], F.col("_made").alias(out))
