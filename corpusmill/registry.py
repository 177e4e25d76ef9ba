"""Queries over the standard tables and their DuckDB SQL. Every query reads its whole tables."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import lexicon as lx
from .functions import matching as mt
from .operators import decisions as dc
from .operators import metrics as mx
from .operators import quality_features as qf
from .operators import spam_features as sf
from .operators import splits as sp
from .operators.language import PROFILES, language_of
from .session import spread
from .tables import cut

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark, sf_dir: str, names: list[str], table: str = "documents", key: str = "doc_id", text: str = "text") -> DataFrame:
    docs = spread(read(spark, sf_dir, table)).select(key, text)
    return qf.quality_features(docs, names, text).select(key, "quality.*")


# --- text quality -----------------------------------------------------------------------------------------------
_N = lambda pattern, t="text": f"len(regexp_extract_all({t}, '{pattern}'))"
_WORDS = "list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda w: w <> '')"


@query(f"""SELECT doc_id, CAST(length(text) AS INT) AS length, {_N(r"\s")} / length(text) AS white_space_ratio, {_N(r"[^\p{L}\p{N}]")} / length(text) AS non_alpha_digit_ratio,
  {_N(r"\p{Nd}")} / length(text) AS digit_ratio, {_N(r"\p{Lu}")} / length(text) AS uppercase_ratio, {_N(r"\.\.\.|…")} / length(text) AS elipsis_ratio,
  {_N(r"[.,;:!?()\[\]\x22\x27]")} / length(text) AS punctuation_ratio FROM documents""")
def q_base_stats(spark, sf_dir):
    return quality(spark, sf_dir, qf.BASE)


_LITERALS = {"comma_ratio": ",", "period_ratio": ".", "question_mark_ratio": "?", "exclamation_ratio": "!", "colon_ratio": ":", "semicolon_ratio": ";"}
_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in lx.STOPWORDS) + "]"


@query(f"""WITH d AS (SELECT doc_id, text, CAST(length(text) AS DOUBLE) AS n, {_WORDS} AS ws, greatest(1, {_N("[.?!]")}) AS sc FROM documents)
SELECT doc_id, CAST(len(ws) AS INT) AS word_count, CAST(sc AS INT) AS sentence_count, CAST(len(list_distinct(list_transform(ws, lambda w: lower(w)))) AS INT) AS vocabulary_size,
  {_N(r"\p{Ll}")} / n AS lowercase_ratio, {_N("[aeiouàèéìòù]", "lower(text)")} / n AS vowel_ratio,
  len(list_filter(regexp_extract_all(lower(text), '\\p{{L}}'), lambda c: NOT contains('aeiouàèéìòù', c))) / n AS consonant_ratio,
  CASE WHEN len(ws) > 0 THEN list_sum(list_transform(ws, lambda w: length(w))) / len(ws) ELSE 0 END AS avg_word_length, len(ws) / sc AS avg_sentence_length,
  {_N("[\\x22\\x27«»]")} / n AS quote_ratio, {_N("[()]")} / n AS parenthesis_ratio,
  {", ".join(f"(length(text) - length(replace(text, '{s}', ''))) / n AS {k}" for k, s in _LITERALS.items())},
  CASE WHEN len(ws) > 0 THEN len(list_filter(ws, lambda w: list_contains({_STOP}, lower(w)))) / len(ws) ELSE 0 END AS stopword_ratio FROM d""")
def q_linguistic_stats(spark, sf_dir):
    return quality(spark, sf_dir, qf.LINGUISTIC)


@query(f"""SELECT doc_id, CASE WHEN len({_WORDS}) > 0 THEN len(list_filter({_WORDS}, lambda w: list_contains({_STOP}, lower(w)))) / len({_WORDS}) ELSE 0 END AS stopword_ratio FROM documents""")
def q_stopword_ratio(spark, sf_dir):
    return quality(spark, sf_dir, ["stopword_ratio"])


@query(f"""WITH d AS (SELECT page_id, html AS text, CAST(length(html) AS DOUBLE) AS n, string_split(html, chr(10)) AS raw, {_WORDS.replace("text", "html")} AS ws,
    list_filter(string_split(html, chr(10) || chr(10)), lambda p: regexp_matches(p, '\\S')) AS ps FROM pages),
  e AS (SELECT *, CASE WHEN raw[-1] = '' THEN raw[:-2] ELSE raw END AS ls FROM d)
SELECT page_id, CAST(len(ls) AS INT) AS line_count, CAST(len(ps) AS INT) AS paragraph_count, n / len(ls) AS avg_line_length, n / len(ps) AS avg_paragraph_length,
  len(list_filter(ls, lambda x: NOT regexp_matches(x, '\\S'))) / len(ls) AS empty_line_ratio, CAST({_N("(?m)^\\s*[-*•]\\s")} AS INT) AS bullet_point_count, {_N("(?m)^\\s*[-*•]\\s")} / n AS bullet_point_ratio,
  CAST({_N("https?://[^\\s)>\\]\\x22\\x27}]*")} AS INT) AS url_count, {_N("https?://[^\\s)>\\]\\x22\\x27}]*")} / len(ws) AS url_density,
  CAST({_N("\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Z|a-z]{2,}\\b")} AS INT) AS email_count, {_N("\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Z|a-z]{2,}\\b")} / len(ws) AS email_density,
  CAST({_N("<[^>]+>")} AS INT) AS html_tag_count, {_N("<[^>]+>")} / n AS html_tag_ratio, {_N("[@#$%^&*+=]")} / n AS special_char_ratio FROM e""")
def q_structural_stats(spark, sf_dir):
    return quality(spark, sf_dir, qf.STRUCTURAL, "pages", "page_id", "html")


_ANOMALY = [k for k in qf.ANOMALY if k not in ("repeated_char_count", "repeated_char_ratio", "repeated_sequence_count", "text_entropy")]
_SHARE = lambda test: f"CASE WHEN len(ws) > 0 THEN len(list_filter(ws, lambda w: {test})) / len(ws) ELSE 0 END"
_UP, _LOW = r"regexp_matches(w, '\p{Lu}')", r"regexp_matches(w, '\p{Ll}')"


@query(f"""WITH d AS (SELECT doc_id, row_number() OVER () AS k, text, {_WORDS} AS ws FROM documents),
  c AS (SELECT k, w, count(*) AS m FROM (SELECT k, unnest(list_transform(ws, lambda w: lower(w))) AS w FROM d) GROUP BY k, w),
  a AS (SELECT k, max(m) AS top, count(*) FILTER (WHERE m > 1) AS rep, count(*) AS dist FROM c GROUP BY k)
SELECT doc_id, CAST(coalesce(top, 0) AS INT) AS most_common_word_freq, CAST(coalesce(rep, 0) AS INT) AS repeated_word_count, coalesce(rep / len(ws), 0) AS repeated_word_ratio,
  CAST(coalesce(dist, 0) AS INT) AS unique_word_count, coalesce(dist / len(ws), 0) AS unique_word_ratio, {_SHARE(f"{_UP} AND NOT {_LOW} AND length(w) > 1")} AS all_caps_word_ratio,
  {_SHARE(f"{_LOW} AND NOT {_UP}")} AS all_lowercase_word_ratio, {_SHARE(f"{_LOW} AND {_UP}")} AS mixed_case_word_ratio,
  CAST({_N(" {2,}")} AS INT) AS consecutive_spaces_count, CAST({_N("[.!?,;:]{2,}")} AS INT) AS consecutive_punctuation_count FROM d LEFT JOIN a USING (k)""")
def q_anomaly_words(spark, sf_dir):
    return quality(spark, sf_dir, _ANOMALY)


@query("""WITH c AS (SELECT doc_id, ch, count(*) AS m FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents) GROUP BY doc_id, ch),
  t AS (SELECT doc_id, m / sum(m) OVER (PARTITION BY doc_id) AS p FROM c)
SELECT doc_id, round(-sum(p * log2(p)), 9) AS text_entropy FROM t GROUP BY doc_id""")
def q_char_entropy(spark, sf_dir):
    return quality(spark, sf_dir, ["text_entropy"]).select("doc_id", F.round("text_entropy", 9).alias("text_entropy"))


_WORD_D = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"
#: All 52 statistics of ``documents``: view ``qf`` (k numbers the rows). Runs are islands of equal neighbours.
_QF = rf"""q0 AS (SELECT doc_id, row_number() OVER () AS k, text, CAST(length(text) AS DOUBLE) AS n, {_WORDS} AS ws, greatest(1, {_N("[.?!]")}) AS sc, string_split(text, chr(10)) AS raw,
    list_filter(string_split(text, chr(10) || chr(10)), lambda p: regexp_matches(p, '\S')) AS ps FROM documents),
  q1 AS (SELECT *, CASE WHEN raw[-1] = '' THEN raw[:-2] ELSE raw END AS ls FROM q0),
  qw AS (SELECT k, max(m) AS top, count(*) FILTER (WHERE m > 1) AS rep, count(*) AS dist FROM (SELECT k, w, count(*) AS m FROM (SELECT k, unnest(list_transform(ws, lambda w: lower(w))) AS w FROM q0) GROUP BY k, w) GROUP BY k),
  qc AS (SELECT k, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS i FROM q0),
  qe AS (SELECT k, round(-sum(p * log2(p)), 9) AS h FROM (SELECT k, m / sum(m) OVER (PARTITION BY k) AS p FROM (SELECT k, ch, count(*) AS m FROM qc GROUP BY k, ch)) GROUP BY k),
  qr AS (SELECT k, count(*) AS runs FROM (SELECT k, ch, g, count(*) AS m FROM (SELECT k, ch, i - row_number() OVER (PARTITION BY k, ch ORDER BY i) AS g FROM qc) GROUP BY k, ch, g) WHERE m >= 3 AND ch <> chr(10) GROUP BY k),
  qu AS (SELECT k, unnest(us) AS u, generate_subscripts(us, 1) AS i FROM (SELECT k, regexp_extract_all(lower(text), '{_WORD_D}+\s*|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]+') AS us FROM q0)),
  qs AS (SELECT k, count(*) AS seqs FROM (SELECT k, u, g, count(*) AS m FROM (SELECT k, u, i - row_number() OVER (PARTITION BY k, u ORDER BY i) AS g FROM qu WHERE regexp_matches(u, '^{_WORD_D}+\s+$')) GROUP BY k, u, g) WHERE m >= 2 GROUP BY k),
  qf AS (SELECT q1.k, doc_id, CAST(n AS INT) AS length, {_N(r"\s")} / n AS white_space_ratio, {_N(r"[^\p{L}\p{N}]")} / n AS non_alpha_digit_ratio, {_N(r"\p{Nd}")} / n AS digit_ratio, {_N(r"\p{Lu}")} / n AS uppercase_ratio,
    {_N(r"\.\.\.|…")} / n AS elipsis_ratio, {_N(r"[.,;:!?()\[\]\x22\x27]")} / n AS punctuation_ratio, CAST(len(ws) AS INT) AS word_count, CAST(sc AS INT) AS sentence_count, CAST(coalesce(dist, 0) AS INT) AS vocabulary_size,
    {_N(r"\p{Ll}")} / n AS lowercase_ratio, {_N("[aeiouàèéìòù]", "lower(text)")} / n AS vowel_ratio, ({_N(r"\p{L}")} - {_N("[aeiouàèéìòùAEIOUÀÈÉÌÒÙ]")}) / n AS consonant_ratio,
    coalesce(list_sum(list_transform(ws, lambda w: length(w))) / nullif(len(ws), 0), 0) AS avg_word_length, len(ws) / sc AS avg_sentence_length, {_N("[\\x22\\x27«»]")} / n AS quote_ratio, {_N("[()]")} / n AS parenthesis_ratio,
    {", ".join(f"(n - length(replace(text, '{x}', ''))) / n AS {k}" for k, x in _LITERALS.items())},
    coalesce(len(list_filter(ws, lambda w: list_contains({_STOP}, lower(w)))) / nullif(len(ws), 0), 0) AS stopword_ratio,
    CAST(len(ls) AS INT) AS line_count, CAST(len(ps) AS INT) AS paragraph_count, coalesce(n / nullif(len(ls), 0), 0) AS avg_line_length, coalesce(n / nullif(len(ps), 0), 0) AS avg_paragraph_length,
    coalesce(len(list_filter(ls, lambda x: NOT regexp_matches(x, '\S'))) / nullif(len(ls), 0), 0) AS empty_line_ratio, CAST({_N(r"(?m)^\s*[-*•]\s")} AS INT) AS bullet_point_count, {_N(r"(?m)^\s*[-*•]\s")} / n AS bullet_point_ratio,
    CAST({_N(r"https?://[^\s)>\]\x22\x27}]*")} AS INT) AS url_count, coalesce({_N(r"https?://[^\s)>\]\x22\x27}]*")} / nullif(len(ws), 0), 0) AS url_density,
    CAST({_N(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b")} AS INT) AS email_count, coalesce({_N(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b")} / nullif(len(ws), 0), 0) AS email_density,
    CAST({_N("<[^>]+>")} AS INT) AS html_tag_count, {_N("<[^>]+>")} / n AS html_tag_ratio, {_N("[@#$%^&*+=]")} / n AS special_char_ratio,
    CAST(coalesce(top, 0) AS INT) AS most_common_word_freq, CAST(coalesce(rep, 0) AS INT) AS repeated_word_count, coalesce(rep / nullif(len(ws), 0), 0) AS repeated_word_ratio,
    CAST(coalesce(runs, 0) AS INT) AS repeated_char_count, coalesce(runs, 0) / n AS repeated_char_ratio, CAST(coalesce(seqs, 0) AS INT) AS repeated_sequence_count, h AS text_entropy,
    CAST(coalesce(dist, 0) AS INT) AS unique_word_count, coalesce(dist / nullif(len(ws), 0), 0) AS unique_word_ratio, {_SHARE(f"{_UP} AND NOT {_LOW} AND length(w) > 1")} AS all_caps_word_ratio,
    {_SHARE(f"{_LOW} AND NOT {_UP}")} AS all_lowercase_word_ratio, {_SHARE(f"{_LOW} AND {_UP}")} AS mixed_case_word_ratio, CAST({_N(" {2,}")} AS INT) AS consecutive_spaces_count, CAST({_N("[.!?,;:]{2,}")} AS INT) AS consecutive_punctuation_count
    FROM q1 LEFT JOIN qw USING (k) LEFT JOIN qe USING (k) LEFT JOIN qr USING (k) LEFT JOIN qs USING (k))"""


def quality_rows(spark, sf_dir: str) -> DataFrame:
    """doc_id and all 52 statistics, the entropy to 9 digits."""
    return quality(spark, sf_dir, qf.FEATURES).withColumn("text_entropy", F.round("text_entropy", 9))


@query(f"WITH {_QF} SELECT doc_id, repeated_char_count, repeated_char_ratio, repeated_sequence_count FROM qf")
def q_repeated_runs(spark, sf_dir):
    return quality(spark, sf_dir, ["repeated_char_count", "repeated_char_ratio", "repeated_sequence_count"])


@query(f"WITH {_QF} SELECT * EXCLUDE (k) FROM qf")
def q_quality_features(spark, sf_dir):
    return quality_rows(spark, sf_dir)


# --- spam ---------------------------------------------------------------------------------------------------------
def spam(spark, sf_dir: str, names: list[str], table: str = "documents", key: str = "doc_id", text: str = "text") -> DataFrame:
    docs = spread(read(spark, sf_dir, table))
    language = F.col("lang") if "lang" in docs.columns else F.lit(None)
    return sf.spam_features(docs.select(key, text, *(["lang"] if "lang" in docs.columns else [])), text, F.col(key), [], language, names=names).select(key, *[F.col("spam")[k].alias(k) for k in names])


_CHARS = ["char_count", "digit_count", "digit_ratio", "uppercase_ratio", "punctuation_ratio", "whitespace_ratio", "exclamation_count", "question_count", "newline_count", "currency_symbol_count"]


@query(f"""SELECT doc_id, CAST(length(text) AS DOUBLE) AS char_count, CAST({_N(r"\p{Nd}")} AS DOUBLE) AS digit_count, {_N(r"\p{Nd}")} / length(text) AS digit_ratio, {_N(r"\p{Lu}")} / length(text) AS uppercase_ratio,
  {_N(r"[^\p{L}\p{N}\s]")} / length(text) AS punctuation_ratio, {_N(r"\s")} / length(text) AS whitespace_ratio, CAST({_N("!")} AS DOUBLE) AS exclamation_count, CAST({_N(r"\?")} AS DOUBLE) AS question_count,
  CAST({_N(r"\n")} AS DOUBLE) AS newline_count, CAST({_N("[€$]")} AS DOUBLE) AS currency_symbol_count FROM documents""")
def q_spam_char_stats(spark, sf_dir):
    return spam(spark, sf_dir, _CHARS)


_TOKENS = r"regexp_extract_all({t}, '[\p{{L}}\p{{N}}_](?:[\p{{L}}\p{{N}}_\x27-]*[\p{{L}}\p{{N}}_])?')"


@query(f"""WITH d AS (SELECT doc_id, {_TOKENS.format(t="text")} AS k FROM documents)
SELECT doc_id, CAST(len(k) AS DOUBLE) AS word_count, CAST(len(list_distinct(list_transform(k, lambda w: lower(w)))) AS DOUBLE) AS unique_word_count,
  coalesce(len(list_distinct(list_transform(k, lambda w: lower(w)))) / nullif(len(k), 0), 0) AS unique_word_ratio, coalesce(list_sum(list_transform(k, lambda w: length(w))) / nullif(len(k), 0), 0) AS avg_word_length FROM d""")
def q_tokens(spark, sf_dir):
    return spam(spark, sf_dir, ["word_count", "unique_word_count", "unique_word_ratio", "avg_word_length"])


_PAD = "concat(' ', trim(regexp_replace(strip_accents(lower({t})), '[^0-9a-zA-ZÀ-ÖØ-öø-ÿ]+', ' ', 'g')), ' ')"


def _hits(terms: list[str], p: str = "p") -> str:
    listed = sorted(Counter(mt.normal_term(t) for t in terms).items())
    return "CAST(" + " + ".join(f"{n} * ((length({p}) - length(replace({p}, ' {t} ', ''))) // {len(t) + 2})" for t, n in listed) + " AS DOUBLE)"


_KEYWORDS = {"spam": lx.SPAM, "urgency": lx.URGENCY, "money": lx.MONEY, "cta": lx.CTA, "account": lx.ACCOUNT, "security": lx.SECURITY, "delivery": lx.DELIVERY, "brand": lx.BRAND, "unsubscribe": lx.UNSUBSCRIBE, "promo": lx.PROMO_CODE}
_HITS = ", ".join(f"{_hits(v)} AS {k}_keyword_hits" for k, v in _KEYWORDS.items())
_HAM = {"ham_business_hits": lx.BUSINESS, "ham_formal_hits": lx.FORMAL, "ham_admin_doc_hits": lx.ADMIN, "ham_technical_business_hits": lx.TECHNICAL, "safe_security_ham_hits": lx.SAFE_SECURITY, "action_phrase_count": lx.ACTION}
_PADDED = f"WITH d AS (SELECT doc_id, text, lang, {_PAD.format(t='text')} AS p, CAST(len({_TOKENS.format(t='text')}) AS DOUBLE) AS wc FROM documents)"


@query(f"{_PADDED} SELECT doc_id, {_HITS} FROM d")
def q_keyword_hits(spark, sf_dir):
    return spam(spark, sf_dir, [f"{k}_keyword_hits" for k in _KEYWORDS])


@query(f"{_PADDED} SELECT doc_id, " + ", ".join(f"coalesce({_hits(v)} / nullif(wc, 0), 0) AS {k}_density" for k, v in [("spam_keyword", lx.SPAM), ("cta_keyword", lx.CTA), ("money_keyword", lx.MONEY), ("urgency_keyword", lx.URGENCY), ("ham_business", lx.BUSINESS)]) + " FROM d")
def q_keyword_density(spark, sf_dir):
    return spam(spark, sf_dir, [f"{k}_density" for k in ("spam_keyword", "cta_keyword", "money_keyword", "urgency_keyword", "ham_business")])


@query(f"{_PADDED} SELECT doc_id, " + ", ".join(f"{_hits(v)} AS {k}" for k, v in _HAM.items()) + " FROM d")
def q_ham_signals(spark, sf_dir):
    return spam(spark, sf_dir, list(_HAM))


_FLAGS = ["has_urgency_and_cta", "has_money_and_cta", "has_account_and_security", "has_formal_and_no_cta", "has_technical_business_and_no_cta", "ham_to_spam_keyword_ratio", "ham_to_cta_ratio", "safe_security_to_spam_ratio"]


@query(f"""{_PADDED}, h AS (SELECT doc_id, {_HITS}, {", ".join(f"{_hits(v)} AS {k}" for k, v in _HAM.items())} FROM d)
SELECT doc_id, CASE WHEN urgency_keyword_hits > 0 AND action_phrase_count > 0 THEN 1e0 ELSE 0e0 END AS has_urgency_and_cta, CASE WHEN money_keyword_hits > 0 AND action_phrase_count > 0 THEN 1e0 ELSE 0e0 END AS has_money_and_cta,
  CASE WHEN account_keyword_hits > 0 AND security_keyword_hits > 0 THEN 1e0 ELSE 0e0 END AS has_account_and_security, CASE WHEN ham_formal_hits > 0 AND cta_keyword_hits = 0 THEN 1e0 ELSE 0e0 END AS has_formal_and_no_cta,
  CASE WHEN ham_technical_business_hits > 0 AND cta_keyword_hits = 0 THEN 1e0 ELSE 0e0 END AS has_technical_business_and_no_cta, (ham_business_hits + 1) / (spam_keyword_hits + 1) AS ham_to_spam_keyword_ratio,
  (ham_business_hits + 1) / (cta_keyword_hits + 1) AS ham_to_cta_ratio, (safe_security_ham_hits + 1) / (spam_keyword_hits + 1) AS safe_security_to_spam_ratio FROM h""")
def q_flags(spark, sf_dir):
    return spam(spark, sf_dir, _FLAGS)


_EMAIL_D, _CH = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", r"[^\s<>()\[\]{}\x22\x27]"
_URL_D = rf"(?i)\bhttps?:/{{1,2}}{_CH}+|\bwww\.{_CH}+|\b(?:[a-z0-9](?:[a-z0-9-]{{0,61}}[a-z0-9])?\.)+[a-z]{{2,}}(?:/{_CH}*)?"
_EDGE_D = r"^[.,;:!?()\[\]{}<>\x22\x27]+|[.,;:!?()\[\]{}<>\x22\x27]+$"
_URL_FEATURES = ["url_count_text", "unique_url_count_text", "unique_domain_count_text", "email_count_text", "suspicious_tld_count", "shortener_url_count"]


@query(f"""WITH u AS (SELECT page_id, {_N(_EMAIL_D, "html")} AS emails, list_transform(regexp_extract_all(regexp_replace(html, '{_EMAIL_D}', ' ', 'g'), '{_URL_D}'), lambda x: regexp_replace(x, '{_EDGE_D}', '', 'g')) AS us FROM pages),
  v AS (SELECT *, list_filter(list_transform(us, lambda x: string_split(string_split(regexp_replace(regexp_replace(lower(x), '^https?://', ''), '^www\\.', ''), '/')[1], ':')[1]), lambda x: x <> '') AS ds FROM u)
SELECT page_id, CAST(len(us) AS DOUBLE) AS url_count_text, CAST(len(list_distinct(list_transform(us, lambda x: lower(x)))) AS DOUBLE) AS unique_url_count_text, CAST(len(list_distinct(ds)) AS DOUBLE) AS unique_domain_count_text,
  CAST(emails AS DOUBLE) AS email_count_text, CAST(len(list_filter(ds, lambda x: regexp_matches(x, '(?:{"|".join(t.replace(".", "[.]") for t in lx.SUSPICIOUS_TLDS)})$'))) AS DOUBLE) AS suspicious_tld_count,
  CAST(len(list_filter(us, lambda x: regexp_matches(lower(x), '{"|".join(t.replace(".", "[.]") for t in lx.SHORTENERS)}'))) AS DOUBLE) AS shortener_url_count FROM v""")
def q_url_features(spark, sf_dir):
    return spam(spark, sf_dir, _URL_FEATURES, "pages", "page_id", "html")


_ANY = lambda terms, x: "(" + " OR ".join(f"contains({x}, ' {t} ')" for t in sorted({mt.normal_term(t) for t in terms})) + ")"


@query(f"""WITH c AS (SELECT conv_id, turn, row_number() OVER () AS k, list_filter(regexp_split_to_array(text, '[\\n.!?]+'), lambda x: regexp_matches(x, '\\S')) AS cs FROM conversations),
  p AS (SELECT k, unnest(cs) AS x FROM c), q AS (SELECT k, x, {_PAD.format(t="x")} AS p FROM p),
  m AS (SELECT k, count(*) FILTER (WHERE {_ANY(lx.CTA, "p")} AND ({_ANY(lx.MONEY, "p")} OR regexp_matches(x, '(?i)€\\s?\\d+[\\d.,]*|\\d+[\\d.,]*\\s?€|\\b\\d+[\\d.,]*\\s?(?:euro|eur)\\b'))) AS n FROM q GROUP BY k)
SELECT conv_id, turn, CAST(coalesce(n, 0) AS DOUBLE) AS money_cta_combo FROM c LEFT JOIN m USING (k)""")
def q_cooccurrence(spark, sf_dir):
    docs = spread(read(spark, sf_dir, "conversations")).select("conv_id", "turn", "text")
    return sf.spam_features(docs, names=["money_cta_combo"]).select("conv_id", "turn", "spam.money_cta_combo")


_LP = r"""l AS (SELECT doc_id, wc, length(text) AS n, [lower(x) FOR x IN """ + _TOKENS.format(t="text").replace("{{", "{").replace("}}", "}") + r"""] AS k, text, [trim(x, ' ' || chr(10)) FOR x IN regexp_split_to_array(text, '[.!?\n\r;:]+') IF trim(x, ' ' || chr(10)) <> ''] AS cs FROM (SELECT doc_id, wc, trim(text, ' ' || chr(10)) AS text FROM d)),
  r AS (SELECT doc_id, len(k) AS m, len(regexp_extract_all(text, '\p{L}')) / n AS alpha, len(regexp_extract_all(text, '\p{Nd}')) / n AS digit, len(regexp_extract_all(text, '[^\p{L}\p{N}\s]')) / n AS punct,
    len(regexp_extract_all(lower(text), '[àèéìòù]')) / n AS acc, list_sum([length(x) FOR x IN k]) / len(k) AS w, len([x FOR x IN k IF length(x) >= 4]) / len(k) AS lo, len([x FOR x IN k IF length(x) <= 2]) / len(k) AS sh,
    len([x FOR x IN k IF list_contains(STOPS, x)]) / len(k) AS st, len([x FOR x IN k IF list_contains(COMMONS, x)]) / len(k) AS co, list_sum([length(x) FOR x IN cs]) / len(cs) AS ch FROM l),
  g AS (SELECT *, 0.22e0 * least(1, alpha / 0.75e0) + 0.22e0 * least(1, st / 0.18e0) + 0.12e0 * least(1, co / 0.08e0)
    + 0.10e0 * CASE WHEN w BETWEEN 4 AND 8.5e0 THEN 1 WHEN w >= 3 AND w < 4 THEN w - 3 WHEN w > 8.5e0 AND w <= 11 THEN 1 - (w - 8.5e0) / 2.5e0 ELSE 0 END + 0.08e0 * least(1, lo / 0.45e0)
    + 0.08e0 * CASE WHEN ch BETWEEN 20 AND 180 THEN 1 WHEN ch >= 10 AND ch < 20 THEN (ch - 10) / 10 WHEN ch > 180 AND ch <= 260 THEN 1 - (ch - 180) / 80 ELSE 0 END + 0.04e0 * least(1, acc / 0.01e0)
    - (0.10e0 * least(1, digit / 0.2e0) + 0.08e0 * least(1, punct / 0.22e0) + 0.06e0 * least(1, sh / 0.45e0)) AS s FROM r)"""
_LIST = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
_LP = _LP.replace("STOPS", _LIST(lx.MINI_STOPWORDS)).replace("COMMONS", _LIST(lx.COMMON_WORDS))


@query(f"{_PADDED}, {_LP} SELECT doc_id, CASE WHEN m > 0 THEN round(0.15e0 + 0.75e0 * greatest(0, least(1, s)), 3) ELSE 0 END AS lang_score FROM g")
def q_lang_score(spark, sf_dir):
    docs = spread(read(spark, sf_dir, "documents")).select("doc_id", "text", "lang")
    ready = sf.prepared(docs, "text", F.col("doc_id"), [], F.col("lang"), F.lit(None))
    parts = sf.language_parts(sf.tx.stripped(F.col("t")), F.col("low"), F.col("lid"), F.col("hist"))
    p = ready.select(F.col("_row")["doc_id"].alias("doc_id"), parts.alias("p"))
    return p.select("doc_id", F.round(sf.language_score(F.col("p"), None), 3).alias("lang_score"))


_CAT = {**{f"{k}_keyword_hits": v for k, v in _KEYWORDS.items()}, **_HAM}
_AMOUNT_D, _FLAG = lx.AMOUNT, lambda test: f"CASE WHEN {test} THEN 1e0 ELSE 0e0 END"
_DIV = lambda a, b: f"coalesce({a} / nullif({b}, 0), 0)"
_SAME = ["char_count", "word_count", "unique_word_count", "digit_count", "exclamation_count", "question_count", "newline_count", "currency_symbol_count", "url_count_text", "unique_url_count_text", "unique_domain_count_text", "email_count_text", "amount_pattern_count", "promo_code_pattern_count", "promo_symbol_count", "uppercase_token_count", "short_line_count", "short_token_count", "business_signature_hits", "digit_run_count", "suspicious_tld_count", "shortener_url_count", "cta_plus_url_score", "brand_plus_link_score", "urgency_cta_url_combo", "money_cta_combo"]
#: All 84 columns of ``documents``: view ``sf``.
_SF = rf"""s0 AS (SELECT doc_id, row_number() OVER () AS k, text, lang, CAST(length(text) AS DOUBLE) AS char_count, {_PAD.format(t="text")} AS p, {_TOKENS.format(t="text")} AS ts,
    list_transform(regexp_extract_all(regexp_replace(text, '{_EMAIL_D}', ' ', 'g'), '{_URL_D}'), lambda x: regexp_replace(x, '{_EDGE_D}', '', 'g')) AS us FROM documents),
  s1 AS (SELECT *, CAST(len(ts) AS DOUBLE) AS wc, list_filter(list_transform(us, lambda x: string_split(string_split(regexp_replace(regexp_replace(lower(x), '^https?://', ''), '^www\.', ''), '/')[1], ':')[1]), lambda x: x <> '') AS ds FROM s0),
  sh AS (SELECT k, {", ".join(f"{_hits(v)} AS {c}" for c, v in _CAT.items())} FROM s0),
  sp AS (SELECT k, {_PAD.format(t="x")} AS p, x, len(list_transform(regexp_extract_all(regexp_replace(x, '{_EMAIL_D}', ' ', 'g'), '{_URL_D}'), lambda u: u)) > 0 AS link FROM (SELECT k, unnest(list_filter(regexp_split_to_array(text, '[\n.!?]+'), lambda x: regexp_matches(x, '\S'))) AS x FROM s0)),
  sx AS (SELECT k, count(*) FILTER (WHERE link AND cta) AS cta_url, count(*) FILTER (WHERE link AND brand) AS brand_url, count(*) FILTER (WHERE link AND cta AND urgent) AS urgent_url, count(*) FILTER (WHERE cta AND paid) AS cta_paid
    FROM (SELECT k, link, {_ANY(lx.CTA, "p")} AS cta, {_ANY(lx.BRAND, "p")} AS brand, {_ANY(lx.URGENCY, "p")} AS urgent, {_ANY(lx.MONEY, "p")} OR regexp_matches(x, '(?i){_AMOUNT_D}') AS paid FROM sp) GROUP BY k),
  d AS (SELECT k AS doc_id, text, wc FROM s1), {_LP},
  sl AS (SELECT doc_id AS k, CASE WHEN m > 0 THEN round(0.15e0 + 0.75e0 * greatest(0, least(1, s)), 4) ELSE 0 END AS lang_score FROM g),
  sc AS (SELECT s1.k, doc_id, char_count, wc AS word_count, CAST(len(list_distinct(list_transform(ts, lambda w: lower(w)))) AS DOUBLE) AS unique_word_count, {_DIV("list_sum(list_transform(ts, lambda w: length(w)))", "wc")} AS avg_word_length,
    CAST({_N(r"\p{Nd}")} AS DOUBLE) AS digit_count, CAST({_N(r"\p{Lu}")} AS DOUBLE) AS uppers, CAST({_N(r"[^\p{L}\p{N}\s]")} AS DOUBLE) AS puncts, CAST({_N(r"\s")} AS DOUBLE) AS spaces, CAST({_N("!")} AS DOUBLE) AS exclamation_count, CAST({_N(r"\?")} AS DOUBLE) AS question_count,
    CAST({_N(r"\n")} AS DOUBLE) AS newline_count, CAST({_N("[€$]")} AS DOUBLE) AS currency_symbol_count, CAST(len(us) AS DOUBLE) AS url_count_text, CAST(len(list_distinct(list_transform(us, lambda x: lower(x)))) AS DOUBLE) AS unique_url_count_text,
    CAST(len(list_distinct(ds)) AS DOUBLE) AS unique_domain_count_text, CAST({_N(_EMAIL_D)} AS DOUBLE) AS email_count_text, CAST({_N("(?i)" + _AMOUNT_D)} AS DOUBLE) AS amount_pattern_count, CAST({_N("(?i)" + lx.PROMO_CODE_PATTERN)} AS DOUBLE) AS promo_code_pattern_count,
    CAST({_N(f"[{lx.PROMO_SYMBOLS}]")} AS DOUBLE) AS promo_symbol_count, CAST(len(list_filter(ts, lambda w: len(regexp_extract_all(w, '\p{{L}}')) >= 2 AND upper(w) = w AND lower(w) <> w)) AS DOUBLE) AS uppercase_token_count,
    CAST(len(list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, '^\s+|\s+$', '', 'g')) BETWEEN 1 AND 40)) AS DOUBLE) AS short_line_count, CAST(len(list_filter(ts, lambda w: regexp_matches(w, '^[\p{{L}}\p{{N}}]{{2}}$'))) AS DOUBLE) AS short_token_count,
    CAST({_N("(?i)" + lx.SIGNATURE.replace(chr(39), r"\x27"))} AS DOUBLE) AS business_signature_hits, CAST({_N(r"\b\d{4,}\b")} AS DOUBLE) AS digit_run_count,
    CAST(len(list_filter(ds, lambda x: regexp_matches(x, '(?:{"|".join(t.replace(".", "[.]") for t in lx.SUSPICIOUS_TLDS)})$'))) AS DOUBLE) AS suspicious_tld_count, CAST(len(list_filter(us, lambda x: regexp_matches(lower(x), '{"|".join(t.replace(".", "[.]") for t in lx.SHORTENERS)}'))) AS DOUBLE) AS shortener_url_count,
    CASE WHEN cta_keyword_hits > 0 AND len(us) > 0 THEN CAST(coalesce(cta_url, 0) AS DOUBLE) ELSE 0e0 END AS cta_plus_url_score, CASE WHEN len(us) > 0 THEN CAST(coalesce(brand_url, 0) AS DOUBLE) ELSE 0e0 END AS brand_plus_link_score,
    CASE WHEN cta_keyword_hits > 0 AND len(us) > 0 THEN CAST(coalesce(urgent_url, 0) AS DOUBLE) ELSE 0e0 END AS urgency_cta_url_combo, CASE WHEN cta_keyword_hits > 0 THEN CAST(coalesce(cta_paid, 0) AS DOUBLE) ELSE 0e0 END AS money_cta_combo,
    {", ".join(_CAT)}, CAST(lang_score AS DOUBLE) AS lang_score, {_FLAG("lower(lang) IN ('ita', 'it', 'italian')")} AS lang_is_ita
    FROM s1 JOIN sh USING (k) LEFT JOIN sx USING (k) LEFT JOIN sl USING (k)),
  se AS (SELECT *, {_DIV("digit_count", "char_count")} AS digit_ratio, {_DIV("uppers", "char_count")} AS uppercase_ratio, {_DIV("puncts", "char_count")} AS punctuation_ratio, {_DIV("spaces", "char_count")} AS whitespace_ratio,
    ham_formal_hits + ham_admin_doc_hits + ham_technical_business_hits + business_signature_hits AS ham_strength_score, {_FLAG("account_keyword_hits > 0 AND security_keyword_hits > 0")} AS has_account_and_security, {_FLAG("delivery_keyword_hits > 0 AND url_count_text > 0")} AS has_delivery_and_link FROM sc),
  si AS (SELECT *, 1.5e0 * cta_plus_url_score + 2e0 * urgency_cta_url_combo + 1.5e0 * money_cta_combo + 1.5e0 * suspicious_tld_count + shortener_url_count + has_account_and_security + has_delivery_and_link AS spam_intent_score,
    {_FLAG("lang_score < 0.35e0")} + {_FLAG("punctuation_ratio > 0.18e0")} + {_FLAG("digit_ratio > 0.2e0")} + {_FLAG(_DIV("short_token_count", "word_count") + " > 0.35e0")} + {_FLAG("avg_word_length < 3e0 OR avg_word_length > 12e0")} AS noise_score FROM se),
  sf AS (SELECT k, doc_id, '' AS target_label, '' AS spam_target_label, {", ".join(_SAME)}, {_DIV("unique_word_count", "word_count")} AS unique_word_ratio, avg_word_length, digit_ratio, uppercase_ratio, punctuation_ratio, whitespace_ratio,
    {_DIV("url_count_text", "word_count")} AS url_density, {_DIV("email_count_text", "word_count")} AS email_density, {", ".join(_CAT)}, lang_score, lang_is_ita, {_FLAG("url_count_text > 0 AND action_phrase_count > 0")} AS has_link_and_cta, {_FLAG("urgency_keyword_hits > 0 AND action_phrase_count > 0")} AS has_urgency_and_cta,
    {_FLAG("brand_keyword_hits > 0 AND url_count_text > 0")} AS has_brand_and_link, {_FLAG("money_keyword_hits > 0 AND action_phrase_count > 0")} AS has_money_and_cta, has_account_and_security, has_delivery_and_link, {_FLAG("ham_business_hits > 0 AND url_count_text = 0")} AS has_ham_and_no_url,
    {_FLAG("ham_formal_hits > 0 AND cta_keyword_hits = 0")} AS has_formal_and_no_cta, {_FLAG("ham_admin_doc_hits > 0 AND url_count_text = 0")} AS has_admin_doc_and_no_url, {_FLAG("ham_technical_business_hits > 0 AND cta_keyword_hits = 0")} AS has_technical_business_and_no_cta,
    {_FLAG("business_signature_hits > 0 AND cta_keyword_hits = 0")} AS has_signature_and_no_cta, promo_symbol_count + uppercase_token_count + digit_run_count AS symbol_pressure_score, (ham_business_hits + 1) / (spam_keyword_hits + 1) AS ham_to_spam_keyword_ratio,
    (ham_business_hits + 1) / (cta_keyword_hits + 1) AS ham_to_cta_ratio, (ham_strength_score + 1) / (spam_keyword_hits + 1) AS ham_strength_to_spam_ratio, ham_strength_score, noise_score, spam_intent_score, {_FLAG("noise_score >= 2 AND spam_intent_score = 0")} AS noise_without_spam_intent,
    least(promo_symbol_count, 3e0) AS promo_symbol_count_clip, least(exclamation_count, 5e0) AS exclamation_count_clip, least(digit_run_count, 3e0) AS digit_run_count_clip, least(uppercase_token_count, 5e0) AS uppercase_token_count_clip, (safe_security_ham_hits + 1) / (spam_keyword_hits + 1) AS safe_security_to_spam_ratio,
    {", ".join(f"{_DIV(f'{k}_keyword_hits', 'word_count')} AS {k}_keyword_density" for k in ("spam", "cta", "money", "urgency"))}, {_DIV("ham_business_hits", "word_count")} AS ham_business_density FROM si)"""
_NOISE = ["noise_score", "spam_intent_score", "noise_without_spam_intent", "symbol_pressure_score", "promo_symbol_count_clip", "exclamation_count_clip", "digit_run_count_clip"]


@query(f"WITH {_SF} SELECT doc_id, {', '.join(_NOISE)} FROM sf")
def q_intent_noise(spark, sf_dir):
    return spam(spark, sf_dir, _NOISE)


@query(f"WITH {_SF} SELECT * EXCLUDE (k) FROM sf")
def q_spam_features(spark, sf_dir):
    return spam(spark, sf_dir, [c for c in sf.COLUMNS if c != "doc_id"])


# --- decisions ------------------------------------------------------------------------------------------------------
_FUNCTION_WORDS = {k: "[" + ", ".join(f"'{w}'" for w in v) + "]" for k, v in sorted(PROFILES.items())}
_LANGUAGE = rf"""l0 AS (SELECT doc_id, [lower(x) FOR x IN {_TOKENS.format(t="text").replace("{{", "{").replace("}}", "}")}] AS ts FROM documents),
  l1 AS (SELECT doc_id, {", ".join(f"len([x FOR x IN ts IF list_contains({v}, x)]) AS n_{k}" for k, v in _FUNCTION_WORDS.items())} FROM l0),
  l2 AS (SELECT doc_id, {" + ".join(f"n_{k}" for k in _FUNCTION_WORDS)} AS total, greatest({", ".join(f"n_{k}" for k in _FUNCTION_WORDS)}) AS best, {", ".join(f"n_{k}" for k in _FUNCTION_WORDS)} FROM l1),
  lg AS (SELECT doc_id, CASE WHEN total = 0 THEN NULL {" ".join(f"WHEN n_{k} = best THEN '{k}'" for k in _FUNCTION_WORDS)} END AS language, coalesce(best / nullif(total, 0), 0) AS score FROM l2)"""


@query(f"WITH {_LANGUAGE} SELECT doc_id, language, score, coalesce(language = 'fr' AND score > 0.75e0, false) AS keep FROM lg")
def q_language_filter(spark, sf_dir):
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", language_of(F.col("text")).alias("l"))
    return docs.select("doc_id", "l.language", "l.score", dc.language_keep(F.col("l.language"), F.col("l.score"), "fr").alias("keep"))


@query("""SELECT page_id, length(html) >= 120 AND length(html) - length(replace(html, '|', '')) <= 6
  AND contains(lower(html), 'home')::INT + contains(lower(html), 'contatti')::INT + contains(lower(html), 'cookie policy')::INT + contains(lower(html), 'privacy')::INT + contains(lower(html), 'login')::INT < 3 AS keep FROM pages""")
def q_heuristic_filter(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", dc.heuristic_keep(F.col("html")).alias("keep"))


#: Scores of features where the decision, not the model, is under test.
_SPAM_SCORE, _QUALITY_SCORE = "least(1e0, spam_keyword_density * 20e0)", "least(1e0, stopword_ratio * 2e0 + unique_word_ratio / 4e0)"
_RULES = """suspicious_tld_count > 0 OR (shortener_url_count > 0 AND cta_keyword_hits > 0) OR cta_plus_url_score > 0 OR urgency_cta_url_combo > 0 OR money_cta_combo > 0 OR (account_keyword_hits > 0 AND security_keyword_hits > 0)
  OR (delivery_keyword_hits > 0 AND url_count_text > 0) OR (brand_keyword_hits > 0 AND url_count_text > 0 AND cta_keyword_hits > 0) OR (spam_keyword_hits >= 4 AND (cta_keyword_hits > 0 OR urgency_keyword_hits > 0 OR money_keyword_hits > 0))
  OR (s >= 0.9e0 AND ham_business_hits = 0 AND ham_strength_score = 0)"""


def decided(spark, sf_dir: str, made) -> DataFrame:
    """doc_id and ``made`` of the spam struct and its score."""
    docs = spread(read(spark, sf_dir, "documents")).select("doc_id", "text", "lang")
    rows = sf.spam_features(docs, doc_id=F.col("doc_id"), language=F.col("lang"))
    return rows.select("doc_id", "spam", F.least(F.lit(1.0), F.col("spam.spam_keyword_density") * 20).alias("s")).select("doc_id", made(F.col("spam"), F.col("s")).alias("d"))


@query(f"WITH {_SF}, e AS (SELECT *, {_SPAM_SCORE} AS s FROM sf) SELECT doc_id, {_RULES} AS strong_evidence FROM e")
def q_strong_evidence(spark, sf_dir):
    return decided(spark, sf_dir, dc.strong_evidence).select("doc_id", F.col("d").alias("strong_evidence"))


@query(f"""WITH {_SF}, e AS (SELECT *, {_SPAM_SCORE} AS s FROM sf), f AS (SELECT doc_id, s, {_RULES} AS strong FROM e)
SELECT doc_id, NOT (s >= 0.75e0 AND strong) AS keep, CASE WHEN s >= 0.75e0 AND strong THEN 'spam_detected' END AS reason, CASE WHEN s >= 0.75e0 THEN 'spam' ELSE 'ham' END AS pred_label, CAST(round(CAST(CAST(s AS VARCHAR) AS DECIMAL(20, 18)), 6) AS DOUBLE) AS pred_score, strong AS strong_evidence,
  CASE WHEN s >= 0.75e0 AND NOT strong THEN 'high_score_but_weak_spam_evidence' END AS uncertain_reason FROM f""")
def q_spam_decision(spark, sf_dir):
    return decided(spark, sf_dir, dc.spam_decision).select("doc_id", "d.*")


@query(f"""WITH {_QF}, e AS (SELECT doc_id, {_QUALITY_SCORE} AS s FROM qf)
SELECT doc_id, s >= 0.65e0 AS keep, CASE WHEN s >= 0.65e0 THEN NULL ELSE 'quality_bad' END AS reason, CASE WHEN s >= 0.65e0 THEN 'good' ELSE 'bad' END AS label, CAST(round(CAST(CAST(s AS VARCHAR) AS DECIMAL(20, 18)), 4) AS DOUBLE) AS score FROM e""")
def q_quality_decision(spark, sf_dir):
    made = qf.quality_features(spread(read(spark, sf_dir, "documents")).select("doc_id", "text")).select("doc_id", "quality")
    score = F.least(F.lit(1.0), F.col("quality.stopword_ratio") * 2 + F.col("quality.unique_word_ratio") / 4)
    return made.select("doc_id", dc.quality_decision(score, dc.complete(F.col("quality"), qf.FEATURES)).alias("d")).select("doc_id", "d.*")


@query("""SELECT text, label_rilevata, scartato_da, file FROM (
  SELECT text, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS label_rilevata, CASE WHEN n_chars < 600 THEN '1_language' WHEN n_chars < 1500 THEN '2_spam' ELSE '3_quality' END AS scartato_da,
    CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS file FROM documents JOIN labels USING (doc_id))""")
def q_reject_audit(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    stage = F.when(F.col("n_chars") < 600, "1_language").when(F.col("n_chars") < 1500, "2_spam").otherwise("3_quality")
    rows = rows.withColumn("stage", stage).withColumn("label", F.when(F.col("quality") == 1, " Good ").when(F.col("quality") == 0, "bad"))
    return dc.reject_audit(rows, "text", "label", "stage")


@query("""SELECT CASE WHEN n_chars < 600 THEN '1_language' WHEN n_chars < 1500 THEN '2_spam' ELSE '3_quality' END AS stage, lang AS reason, count(*) AS n FROM documents GROUP BY ROLLUP (stage, reason)""")
def q_funnel(spark, sf_dir):
    stage = F.when(F.col("n_chars") < 600, "1_language").when(F.col("n_chars") < 1500, "2_spam").otherwise("3_quality")
    docs = read(spark, sf_dir, "documents").select(stage.alias("stage"), F.col("lang").alias("reason"))
    return docs.rollup("stage", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, text, 'documents' AS part FROM documents UNION ALL SELECT item_id AS doc_id, text, 'benchmark' AS part FROM benchmark""")
def q_union_parts(spark, sf_dir):
    from .sources.io import union_parts

    a = read(spark, sf_dir, "documents").select("doc_id", "text", F.lit("documents").alias("part"))
    return union_parts([a, read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text", F.lit("benchmark").alias("part"))])


# --- metrics ----------------------------------------------------------------------------------------------------------
#: Truth: labels.quality. Score: the share of distinct words.
_SCORED = f"""WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
  s AS (SELECT w.doc_id, l.quality AS y, coalesce(len(list_distinct(list_transform(ws, lambda x: lower(x)))) / nullif(len(ws), 0), 0) AS score FROM w JOIN labels l USING (doc_id))"""
_CONF = "count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp, count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp"
_R = lambda a, b: f"coalesce(({a}) / nullif(CAST({b} AS DOUBLE), 0), 0)"
_RATES = {"accuracy": _R("tp + tn", "tn + fp + fn + tp"), "precision_1": _R("tp", "tp + fp"), "recall_1": _R("tp", "tp + fn"), "precision_0": _R("tn", "tn + fn"), "recall_0": _R("tn", "tn + fp"), "loss_rate": _R("fp", "tn + fp"), "contamination_rate": _R("fn", "tn + fn"), "miss_rate": _R("fn", "fn + tp"), "predicted_positive_rate": _R("tp + fp", "tn + fp + fn + tp")}
_MORE = {"balanced_accuracy": "(recall_0 + recall_1) / 2", "f1_1": _R("2 * precision_1 * recall_1", "(precision_1 + recall_1)"), "f1_0": _R("2 * precision_0 * recall_0", "(precision_0 + recall_0)"), "preservation_rate": "recall_0", "detection_rate": "recall_1"}
_ALL_RATES = f"SELECT *, {', '.join(f'{v} AS {k}' for k, v in _MORE.items())} FROM (SELECT *, {', '.join(f'{v} AS {k}' for k, v in _RATES.items())} FROM c)"


def scored(spark, sf_dir: str) -> DataFrame:
    """doc_id, y, score of the labelled documents."""
    made = quality(spark, sf_dir, ["unique_word_ratio"])
    return made.join(read(spark, sf_dir, "labels"), "doc_id").select("doc_id", F.col("quality").alias("y"), F.col("unique_word_ratio").alias("score"))


def predicted(spark, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).withColumn("p", (F.col("score") >= 0.65).cast("int"))


@query(f"{_SCORED}, p AS (SELECT *, (score >= 0.65e0)::INT AS p FROM s) SELECT {_CONF} FROM p")
def q_confusion(spark, sf_dir):
    return mx.confusion(predicted(spark, sf_dir), "y", "p")


@query(f"{_SCORED}, p AS (SELECT *, (score >= 0.65e0)::INT AS p FROM s), c AS (SELECT {_CONF} FROM p) {_ALL_RATES}")
def q_operating_metrics(spark, sf_dir):
    return mx.operating_metrics(predicted(spark, sf_dir), "y", "p")


@query(f"""{_SCORED}, p AS (SELECT *, (score >= 0.65e0)::INT AS p FROM s), c AS (SELECT {_CONF} FROM p), m AS ({_ALL_RATES})
SELECT '0' AS class, precision_0 AS precision, recall_0 AS recall, f1_0 AS f1, tn + fp AS support FROM m UNION ALL SELECT '1', precision_1, recall_1, f1_1, fn + tp FROM m
UNION ALL SELECT 'macro', (precision_0 + precision_1) / 2, (recall_0 + recall_1) / 2, (f1_0 + f1_1) / 2, tn + fp + fn + tp FROM m
UNION ALL SELECT 'weighted', {", ".join(_R(f"{k}_0 * (tn + fp) + {k}_1 * (fn + tp)", "(tn + fp + fn + tp)") for k in ("precision", "recall", "f1"))}, tn + fp + fn + tp FROM m""")
def q_class_report(spark, sf_dir):
    return mx.class_report(predicted(spark, sf_dir), "y", "p")


_CUM = """, b AS (SELECT score, sum((y = 1)::INT) AS pos, sum((y = 0)::INT) AS neg FROM s GROUP BY score),
  u AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM b)"""


@query(f"{_SCORED}{_CUM} SELECT round(sum(neg * (tp - pos / 2e0)) / max(CAST(np AS DOUBLE) * nn), 9) AS roc_auc FROM u")
def q_roc_auc(spark, sf_dir):
    return mx.roc_auc(scored(spark, sf_dir), "y", "score").select(F.round("roc_auc", 9).alias("roc_auc"))


@query(f"{_SCORED}{_CUM} SELECT round(sum(CAST(pos AS DOUBLE) / np * tp / (tp + fp)), 9) AS average_precision FROM u")
def q_pr_auc(spark, sf_dir):
    return mx.average_precision(scored(spark, sf_dir), "y", "score").select(F.round("average_precision", 9).alias("average_precision"))


@query(f"{_SCORED}{_CUM} SELECT score AS threshold, CAST(fp AS DOUBLE) / nn AS fpr, CAST(tp AS DOUBLE) / np AS tpr FROM u")
def q_roc_curve(spark, sf_dir):
    return mx.roc_curve(scored(spark, sf_dir), "y", "score")


@query(f"{_SCORED}{_CUM} SELECT score AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / np AS recall FROM u")
def q_pr_curve(spark, sf_dir):
    return mx.pr_curve(scored(spark, sf_dir), "y", "score")


_SWEEP = {"precision_spam": "precision_1", "recall_spam": "recall_1", "f1_spam": "f1_1", "precision_ham": "precision_0", "recall_ham": "recall_0", "f1_ham": "f1_0", "true_negative": "tn", "false_positive": "fp", "false_negative": "fn", "true_positive": "tp", "true_ham": "tn + fp", "true_spam": "tp + fn", "predicted_ham": "tn + fn", "predicted_spam": "fp + tp", "ham_correct": "tn", "ham_lost_as_spam": "fp", "ham_preservation_rate": "recall_0", "ham_loss_rate": "loss_rate", "spam_in_predicted_ham": "fn", "spam_contamination_in_predicted_ham": "contamination_rate", "spam_detected": "tp", "spam_missed_as_ham": "fn", "spam_detection_rate": "recall_1", "spam_miss_rate": "miss_rate", "fp_rate_on_ham": "loss_rate", "fn_rate_on_spam": "miss_rate"}
_STEPS = [0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90]


@query(f"{_SCORED}, t AS (SELECT CAST(unnest({_STEPS}) AS DOUBLE) AS threshold), c AS (SELECT threshold, {_CONF} FROM (SELECT threshold, y, (score >= threshold)::INT AS p FROM t, s) GROUP BY threshold), m AS ({_ALL_RATES}) SELECT threshold, accuracy, balanced_accuracy, {', '.join(f'{v} AS {k}' for k, v in _SWEEP.items())} FROM m")
def q_threshold_sweep(spark, sf_dir):
    return mx.threshold_sweep(scored(spark, sf_dir), "y", "score", _STEPS)


_ALL = f"WITH {_QF}, f AS (SELECT qf.*, CAST(l.quality AS DOUBLE) AS y FROM qf JOIN labels l USING (doc_id)), u AS (SELECT k, feature, CAST(value AS DOUBLE) AS value, y FROM (SELECT k, y, unnest([{', '.join(repr(c) for c in qf.FEATURES)}]) AS feature, unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in qf.FEATURES)}]) AS value FROM f))"
_NUMBER = "list_position([" + ", ".join(repr(c) for c in qf.FEATURES) + "], {f})"
_FLAT = "v AS (SELECT feature, avg(value) AS mean, stddev_pop(value) AS std, stddev_pop(value) <= 1e-12 * greatest(1, abs(avg(value))) AS flat FROM u GROUP BY feature)"


def labelled(spark, sf_dir: str) -> DataFrame:
    """All 52 statistics and y of the labelled documents."""
    return quality_rows(spark, sf_dir).join(read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y")), "doc_id")


@query(f"""{_ALL}, {_FLAT}, z AS (SELECT k, feature, CASE WHEN flat THEN NULL ELSE (value - mean) / std END AS z FROM u JOIN v USING (feature))
SELECT a.feature AS a, b.feature AS b, round(avg(a.z * b.z), 5) AS r FROM z a JOIN z b ON a.k = b.k AND {_NUMBER.format(f="a.feature")} < {_NUMBER.format(f="b.feature")} GROUP BY 1, 2""")
def q_corr_pairs(spark, sf_dir):
    return mx.correlations(cut(labelled(spark, sf_dir)), qf.FEATURES).select("a", "b", F.round("r", 5).alias("r"))


@query(f"{_ALL}, {_FLAT} SELECT feature, CASE WHEN any_value(flat) THEN NULL ELSE round(corr(value, y), 6) END AS r FROM u JOIN v USING (feature) GROUP BY feature")
def q_label_correlations(spark, sf_dir):
    return mx.label_correlations(labelled(spark, sf_dir), qf.FEATURES, "y").select("feature", F.round("r", 6).alias("r"))


@query(f"{_ALL}, {_FLAT} SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM v")
def q_scaler_fit(spark, sf_dir):
    return mx.scaler_fit(labelled(spark, sf_dir), qf.FEATURES).select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(f"""{_ALL}, c AS (SELECT feature, value, count(*) AS n FROM u GROUP BY feature, value)
SELECT feature, count(*) AS n_distinct, max(n) / CAST(sum(n) AS DOUBLE) AS top_share, count(*) <= 1 AS constant, max(n) / CAST(sum(n) AS DOUBLE) >= 0.995e0 AS near_constant FROM c GROUP BY feature""")
def q_near_constant(spark, sf_dir):
    return mx.near_constant(labelled(spark, sf_dir), qf.FEATURES)


_PLACED = "p AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(concat(CAST(doc_id AS VARCHAR), '42')), doc_id) AS i, count(*) OVER (PARTITION BY quality) AS n FROM labels)"


@query(f"WITH {_PLACED} SELECT doc_id, quality, CASE WHEN i - 1 < floor(n * CAST(0.7e0 AS DOUBLE) + 0.5e0) THEN 'train' WHEN i - 1 < floor(n * (0.7e0 + 0.15e0) + 0.5e0) THEN 'validation' ELSE 'test' END AS split FROM p")
def q_stratified_split(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    return sp.stratified_split(labels, "doc_id", "quality", {"train": 0.7, "validation": 0.15, "test": 0.15})


@query(f"WITH {_PLACED} SELECT doc_id, quality, CAST((i - 1) % 5 AS INT) AS fold FROM p")
def q_kfold(spark, sf_dir):
    return sp.stratified_folds(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "quality")


#: Models of one feature each, scored by the feature itself, over the stratified folds.
_ONE = ["stopword_ratio", "unique_word_ratio", "lowercase_ratio", "all_lowercase_word_ratio"]
_FOLDS = f"""{_ALL}, {_PLACED}, o AS (SELECT feature AS model, CAST((p.i - 1) % 5 AS INT) AS fold, CAST(u.y AS INT) AS y, (value >= 0.5e0)::INT AS p FROM u JOIN f USING (k) JOIN p USING (doc_id) WHERE feature IN ({", ".join(repr(c) for c in _ONE)})),
  c AS (SELECT model, fold, {_CONF} FROM o GROUP BY model, fold), r AS ({_ALL_RATES}), m AS (SELECT model, {", ".join(f"avg({k}) AS {k}_mean, stddev_pop({k}) AS {k}_std" for k in ("accuracy", "f1_1", "f1_0"))} FROM r GROUP BY model)"""


def fold_means(spark, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = sp.stratified_folds(labels, "doc_id", "quality").join(quality(spark, sf_dir, _ONE), "doc_id")
    each = mx.stacked(rows.select("fold", F.col("quality").alias("y"), *_ONE), _ONE, ["fold", "y"])
    p = (F.col("value") >= 0.5).cast("int")
    folds = each.groupBy(F.col("feature").alias("model"), "fold").agg(*mx.counts(F.col("y"), p))
    return mx.fold_summary(folds.withColumns(mx.rates()), "model", ["accuracy", "f1_1", "f1_0"])


@query(f"{_FOLDS} SELECT model, {', '.join(f'round({k}_{w}, 9) AS {k}_{w}' for k in ('accuracy', 'f1_1', 'f1_0') for w in ('mean', 'std'))} FROM m")
def q_fold_summary(spark, sf_dir):
    done = fold_means(spark, sf_dir)
    return done.select("model", *[F.round(c, 9).alias(c) for c in done.columns if c != "model"])


@query(f"{_FOLDS} SELECT model, row_number() OVER (ORDER BY round(f1_1_mean, 9) DESC, round(accuracy_mean, 9) DESC, model) AS rank FROM m")
def q_model_ranking(spark, sf_dir):
    rounded = fold_means(spark, sf_dir).select("model", F.round("f1_1_mean", 9).alias("f1_1_mean"), F.round("accuracy_mean", 9).alias("accuracy_mean"))
    return mx.ranking(rounded, ["f1_1_mean", "accuracy_mean"]).select("model", F.col("rank").cast("long").alias("rank"))


# --- models and whole runs ----------------------------------------------------------------------------------------------
def matrices(spark, sf_dir: str) -> dict[str, DataFrame]:
    """id, y and the model's features of the labelled documents, by task; y is quality, or toxic for spam."""
    from .operators import models as md

    labels = read(spark, sf_dir, "labels")
    made = {"quality": (quality(spark, sf_dir, qf.FEATURES), qf.FEATURES, "quality"), "spam": (spam(spark, sf_dir, sf.MODEL_FEATURES), sf.MODEL_FEATURES, "toxic")}
    return {task: cut(md.matrix(df.join(labels, "doc_id"), "doc_id", {k: F.col(k) for k in names}, F.col(y))) for task, (df, names, y) in made.items()}


def tried(spark, sf_dir: str, task: str, kind: str) -> tuple:
    """A model fitted on four fifths of the labelled documents, and the other fifth."""
    from .operators import models as md

    names = {"quality": qf.FEATURES, "spam": sf.MODEL_FEATURES}[task]
    data = cut(sp.stratified_split(matrices(spark, sf_dir)[task], "id", "y", {"train": 0.8, "test": 0.2}))
    return md.fit(kind, data.filter("split = 'train'"), names, task=task), data.filter("split = 'test'"), names


@query()
def q_quality_model(spark, sf_dir):
    from .operators import models as md

    model, test, _ = tried(spark, sf_dir, "quality", "gbdt")
    return md.scored(model, test).select(F.col("id").alias("doc_id"), "y", "score")


@query()
def q_spam_model(spark, sf_dir):
    from .operators import models as md

    model, test, _ = tried(spark, sf_dir, "spam", "gbdt")
    return md.error_rows(md.scored(model, test), 0.75).select(F.col("id").alias("doc_id"), "true_label", "pred_label", "spam_probability", "threshold", "is_error", "error_type")


@query()
def q_topk_importance(spark, sf_dir):
    from .operators import models as md

    model, test, names = tried(spark, sf_dir, "quality", "random_forest")
    return md.importance_shares(md.permutation_importance(model, test, names, 0.5), 10)


@query()
def q_full_pipeline(spark, sf_dir):
    """All documents, in any language, through features and two models that were fitted on the labelled ones."""
    from .operators import models as md
    from .plans.curation import Config, curate, with_language

    data = matrices(spark, sf_dir)
    scorers = [md.ModelScore(md.fit("logistic_regression", data[task], names, task=task), names) for task, names in (("spam", sf.MODEL_FEATURES), ("quality", qf.FEATURES))]
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text")).join(read(spark, sf_dir, "labels"), "doc_id", "left")
    label = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad")
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text", F.struct(F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("language_score"), label.alias("label")).alias("meta"))
    return curate(with_language(rows), Config(language="", lang_threshold=0.5), *scorers).select("id", "decision.*")
