"""Quality and spam features against plain Python, on edge texts and driver tables."""

import math
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import lexicon as lx
from corpusmill.functions import matching as mt
from corpusmill.operators import quality_features as qf
from corpusmill.operators import spam_features as sf

TEXTS = ["", "clicca clicca", "Clicca qui https://bit.ly/x", "Clicca qui www.sito.it", "test.com", "fine.Inizio", "A1! abc", "€", "conferma identità", "aaa bbb", "ciao ciao", "ciao ciao ciao", "a\n\nb\n", "- uno\n* due\r\ntre\x0bquattro", "x² Ü é 😀😀😀 — «ciao»…", "<p>Ciao a@b.it</p> L'amico  è qui!!! ?!", "a b\x1cc d", "Paga 100 € ora: clicca. Codice sconto: ABC123"]


def words_of(text):
    return text.split()


def python_quality(t):
    """The definitions, one by one, for what tells most about character and word rules."""
    n, ws = len(t), t.split()
    if not n:
        return {}
    low = Counter(w.lower() for w in ws)
    return {
        "white_space_ratio": sum(c.isspace() for c in t) / n,
        "non_alpha_digit_ratio": sum(not c.isalnum() for c in t) / n,
        "digit_ratio": sum(c.isdigit() for c in t) / n,
        "uppercase_ratio": sum(c.isupper() for c in t) / n,
        "lowercase_ratio": sum(c.islower() for c in t) / n,
        "word_count": len(ws),
        "line_count": len(t.splitlines()),
        "most_common_word_freq": max(low.values(), default=0),
        "repeated_word_count": sum(v > 1 for v in low.values()),
        "all_caps_word_ratio": sum(w.isupper() and len(w) > 1 for w in ws) / len(ws) if ws else 0,
        "all_lowercase_word_ratio": sum(w.islower() for w in ws) / len(ws) if ws else 0,
        "repeated_char_count": len(re.findall(r"(.)\1{2,}", t)),
        "repeated_sequence_count": len(re.findall(r"(\b\w+\b\s+)\1+", t, re.I)),
        "text_entropy": -sum(c / n * math.log2(c / n) for c in Counter(t).values()),
        "html_tag_count": len(re.findall("<[^>]+>", t)),
        "paragraph_count": sum(bool(p.strip()) for p in t.split("\n\n")),
    }


@pytest.fixture(scope="module")
def edges(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(99, None)], "id int, text string")
    return {r["id"]: r for r in sf.spam_features(qf.quality_features(df), doc_id=F.col("id")).collect()}


def test_quality_against_python(edges):
    for i, t in enumerate(TEXTS):
        for k, v in python_quality(t).items():
            assert edges[i]["quality"][k] == pytest.approx(v, abs=1e-9), (t, k)


def test_empty_and_null(edges):
    for i in (0, 99):
        assert all(v == 0 for v in edges[i]["quality"].asDict().values())
        s = edges[i]["spam"]
        assert (s["money_keyword_hits"], s["spam_keyword_hits"], s["noise_score"], s["noise_without_spam_intent"], s["ham_to_spam_keyword_ratio"], s["lang_score"]) == (3, 3, 2, 1, 0.25, 0)


def test_spam_edges(edges):
    s = [edges[i]["spam"] for i in range(len(TEXTS))]
    assert s[1]["cta_keyword_hits"] == 1
    assert (s[2]["cta_keyword_hits"], s[2]["action_phrase_count"], s[2]["url_count_text"], s[2]["shortener_url_count"], s[2]["cta_plus_url_score"], s[2]["has_link_and_cta"]) == (2, 2, 1, 1, 1, 1)
    assert (s[3]["url_count_text"], s[3]["cta_plus_url_score"]) == (1, 0)
    assert (s[4]["url_count_text"], s[4]["shortener_url_count"]) == (1, 1)
    assert s[5]["url_count_text"] == 1
    assert (s[7]["money_keyword_hits"], s[7]["currency_symbol_count"], s[7]["promo_symbol_count"]) == (3, 1, 1)
    assert (s[8]["account_keyword_hits"], s[8]["security_keyword_hits"], s[8]["cta_keyword_hits"], s[8]["spam_keyword_hits"]) == (1, 1, 1, 3)
    assert edges[6]["quality"]["all_caps_word_ratio"] == 0.5
    assert (s[17]["amount_pattern_count"], s[17]["promo_code_pattern_count"], s[17]["money_cta_combo"]) == (1, 1, 1)


def test_row_layout():
    assert len(sf.COLUMNS) == 84 and len(sf.MODEL_FEATURES) == 55 and len(qf.FEATURES) == 52 and len(qf.MODEL_FEATURES) == 53
    assert "shortener_url_count" in sf.MODEL_FEATURES


def test_lexicon_sizes():
    sizes = {"DELIVERY_BRANDS": 13, "BANK": 14, "IDENTITY": 13, "PRESSURE": 12, "FORMAL": 16, "ADMIN": 16, "TECHNICAL": 20, "ACTION": 12, "MINI_STOPWORDS": 77, "COMMON_WORDS": 29, "URGENCY": 13, "MONEY": 22, "CTA": 31, "ACCOUNT": 16, "SECURITY": 19, "SAFE_SECURITY": 23, "DELIVERY": 22, "BRAND": 21, "UNSUBSCRIBE": 6, "PROMO_CODE": 6, "STOPWORDS": 178}
    assert {k: len(set(getattr(lx, k))) for k in sizes} == sizes


def test_term_table_equals_flat_counts(spark):
    df = spark.createDataFrame([("clicca qui clicca qui, ora urgente: conto corrente e carta d'identità",), ("",), ("niente",)], "t string").withColumn("p", mt.padded(F.col("t")))
    table = mt.term_table(F.col("p"), lx.CATEGORIES)
    for k, terms in lx.CATEGORIES.items():
        for r in df.select(mt.category_hits(table, lx.CATEGORIES, k).alias("a"), mt.term_hits(F.col("p"), terms).alias("b")).collect():
            assert r["a"] == r["b"], k


def test_normal_form(spark):
    texts = ["Ｃｌｉｃｃａ ｑｕｉ", "ﬁne offerta", "½ Ⅳ №5 ŉ", "città—È però", "𝐂𝐥𝐢𝐜𝐜𝐚", "straße ø"]
    plain = lambda t: re.sub(r"[^0-9a-zA-ZÀ-ÖØ-öø-ÿ]+", " ", "".join(x for x in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(x))).strip()
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(mt.normalised(F.col("t"))).collect()]
    assert got == [plain(t) for t in texts]


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "ciao", "x", "y")], "id int, text string, t string, n string")
    row = sf.spam_features(qf.quality_features(df, ["length"])).first()
    assert (row["t"], row["n"], row["quality"]["length"]) == ("x", "y", 4)
