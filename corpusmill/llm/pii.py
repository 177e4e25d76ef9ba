"""Personal data by regular expressions, checksum validators and context words (DataFrame functions only).

Expressions propose spans; Luhn, octet and mod-97 checks confirm them; words near a span raise or lower its score (0 to
100), whatever its kind. Base kinds (email, ip, card, phone) are kept whenever their check holds, with any score. The
added kinds are ``iban`` (mod-97) and ``ssn`` (three digit groups, no checksum, so context decides), kept from
``THRESHOLD`` on. Nearby is what stands within ``REACH`` code points before or after a span and outside the other
matches of its pattern. Offsets are code points, ends exclusive.

Patterns are possessive and anchored at run starts (``\\G`` or a look-behind), which finds the same leftmost
matches as the plain form without its recursion and its quadratic scans on very long runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, table

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){3,7}(?:\x20[A-Z0-9]{1,3})?)",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
#: What a text must hold for the pattern to be worth a scan.
HINTS = {"email": "instr(t, '@') > 0", "ip": "digits and instr(t, '.') > 0", "card": "digits", "phone": "instr(t, '+') > 0", "iban": "digits and t rlike '[A-Z]{2}[0-9]{2}'", "ssn": "digits and instr(t, '-') > 0"}
#: Words that raise or lower a score, the reach in code points before and after a span, and the scores.
CONTEXT = {
    "email": ("mail", "contact", "kontakt", "correo", "write to"),
    "ip": ("server", "host", "address", "login", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "mobile", "telefon", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "taxpayer", "insured"),
}
AGAINST = ("isbn", "order", "invoice", "version")
REACH = 40
SCORE = {"email": 90, "ip": 60, "card": 80, "phone": 60, "iban": 90, "ssn": 30}
STEP = 30
THRESHOLD = 50
BLOCK = 256


def _spans(kind: str) -> str:
    """SQL for array<struct<m, a, near>> of all matches: what stands between matches gives their places and context.

    Lengths are summed by blocks and context is cut from the stretches between matches, so a text with very many
    matches costs little more than in proportion.
    """
    p = PATTERNS[kind].replace("\\", "\\\\")
    return f"""
      case when {HINTS[kind]} then
        transform(array(struct(regexp_extract_all(t, '{p}', 0) as ms, split(t, '{p}', -1) as gs)),
          r -> transform(array(struct(r.ms as ms, r.gs as gs, zip_with(r.ms, slice(r.gs, 1, size(r.ms)), (m, g) -> length(m) + length(g)) as ls)),
            s -> transform(array(struct(s.ms as ms, s.gs as gs, s.ls as ls,
                  transform(sequence(0, size(s.ls) div {BLOCK}), b -> aggregate(slice(s.ls, b * {BLOCK} + 1, {BLOCK}), 0, (x, y) -> x + y)) as bs)),
              u -> transform(array(struct(u.ms as ms, u.gs as gs, u.ls as ls,
                    transform(u.bs, (v, i) -> aggregate(slice(u.bs, 1, i), 0, (x, y) -> x + y)) as os)),
                w -> transform(w.ms, (m, i) -> struct(m as m,
                    w.os[i div {BLOCK}] + aggregate(slice(w.ls, (i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK}), 0, (x, y) -> x + y) + length(w.gs[i]) as a,
                    lower(concat(substring(w.gs[i], -{REACH}, {REACH}), ' ', substring(w.gs[i + 1], 1, {REACH}))) as near))))))[0][0][0][0]
      else cast(array() as array<struct<m: string, a: int, near: string>>) end"""


LUHN = """(aggregate(sequence(1, length({d})), 0, (q, i) -> q + case when (length({d}) - i) % 2 = 0 then int(substring({d}, i, 1))
  else int(substring({d}, i, 1)) * 2 - if(int(substring({d}, i, 1)) > 4, 9, 0) end) % 10 = 0)"""
DIGITS = "regexp_replace(s.m, '[^0-9]', '')"
IBAN = "regexp_replace(s.m, ' ', '')"
MOD97 = f"""(aggregate(transform(sequence(1, length({IBAN})), i -> substring(concat(substring({IBAN}, 5), substring({IBAN}, 1, 4)), i, 1)), 0,
  (r, c) -> case when c between '0' and '9' then (r * 10 + int(c)) % 97 else (r * 100 + ascii(c) - 55) % 97 end) = 1)"""


def _score(kind: str, near: str = "s.near") -> str:
    has = lambda words: "(" + " or ".join(f"contains({near}, '{w}')" for w in words) + ")"
    return f"greatest(0, least(100, {SCORE[kind]} + case when {has(CONTEXT[kind])} then {STEP} else 0 end - case when {has(AGAINST)} then {STEP} else 0 end))"


VALID = {
    "email": "true",
    "ip": "forall(split(s.m, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)",
    "card": f"(length({DIGITS}) between 13 and 19 and {LUHN.format(d=DIGITS)})",
    "phone": f"length({DIGITS}) between 9 and 15",
    "iban": MOD97,
    "ssn": "(not startswith(s.m, '000') and not startswith(s.m, '666') and not startswith(s.m, '9'))",
}


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """All rows of ``docs`` plus the struct ``out``: an array of (m, a, score) per kind: the matched text, its start, its score.

    A null or empty text has no spans, a text of any length is scanned whole, an empty table gives an empty one. Equal
    rows get equal results; spans of one kind never overlap, spans of two kinds may (a card inside a phone number counts
    as both). A column named as ``out`` stays; the new one gets underscores in front.
    """
    out = fresh(docs, out)
    held = [F.col(f"`{c}`") for c in docs.columns]
    keep, t = fresh(docs, "_row"), F.coalesce(F.col(text), F.lit(""))
    work = docs.select(F.struct(*held).alias(keep) if held else F.lit(None).alias(keep), t.alias("t")).withColumn("digits", F.col("t").rlike("[0-9]"))
    work = work.select(keep, "t", *[F.expr(_spans(k)).alias(f"p_{k}") for k in (*BASE, *ADDED)])
    weighed = lambda k: f"transform(filter(p_{k}, s -> {VALID[k]}), s -> struct(s.m as m, s.a as a, {_score(k)} as score))"
    kept = {**{k: weighed(k) for k in BASE}, **{k: f"filter({weighed(k)}, s -> s.score >= {THRESHOLD})" for k in ADDED}}
    found = F.struct(*[F.expr(v).alias(k) for k, v in kept.items()])
    return work.select(keep, found.alias(out)).select(*[F.col(keep)[c].alias(c) for c in docs.columns], out)


def joined(pii: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans by kind as listed, then start."""
    named = lambda k: lambda s: F.concat_ws(":", F.lit(k), s["a"], s["a"] + F.length(s["m"]))
    each = [F.transform(pii[k], named(k)) for k in kinds]
    return F.array_join(F.concat(*each), ",")


def scores(pii: Column, kinds: tuple[str, ...]) -> Column:
    """The scores in the order of ``joined``."""
    return F.array_join(F.concat(*[F.transform(pii[k], lambda s: s["score"].cast("string")) for k in kinds]), ",")


def redacted(text: Column, pii: Column) -> Column:
    """The text with each found span replaced by its kind in angle brackets; of spans that overlap, the one that begins first
    (then the kind as listed) gives the mark and all their characters go."""
    chars = F.split(text, "")
    spans = F.concat(*[F.transform(pii[k], lambda s: F.struct(s["a"].alias("a"), F.lit(i).alias("i"), (s["a"] + F.length(s["m"])).alias("z"))) for i, k in enumerate((*BASE, *ADDED))])  # noqa: B023
    marks = F.array(*[F.lit(f"<{k}>") for k in (*BASE, *ADDED)])
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done: Column, s: Column) -> Column:
        between = F.array_join(F.slice(chars, done["at"] + 1, F.greatest(F.lit(0), s["a"] - done["at"])), "")
        parts = F.when(s["a"] >= done["at"], F.concat(done["parts"], F.array(between, marks[s["i"]]))).otherwise(done["parts"])
        return F.struct(F.greatest(done["at"], s["z"]).alias("at"), parts.alias("parts"))

    ended = lambda d: F.array_join(F.concat(d["parts"], F.array(F.array_join(F.slice(chars, d["at"] + 1, F.size(chars)), ""))), "")
    return F.when(F.size(spans) > 0, F.aggregate(F.array_sort(spans), zero, step, ended)).otherwise(text)


def op10_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    p, every = F.col("pii"), (*BASE, *ADDED)
    counts = [F.size(p[k]).cast("long").alias(f"n_{k}") for k in BASE]
    return find_pii(docs).select("doc_id", *counts, F.sha2(joined(p, BASE), 256).alias("base_sha256"), joined(p, every).alias("spans"), scores(p, every).alias("scores"))


def _duck_spans(kind: str, pattern: str) -> str:
    gaps, found = f"regexp_split_to_array(t, '{pattern}')", f"regexp_extract_all(t, '{pattern}')"
    return f"""
  SELECT doc_id, k, '{kind}' AS kind, unnest({found}) AS m,
         unnest(list_transform({found}, lambda x, i: CAST(list_sum(list_transform({gaps}[:i], lambda g: length(g))) + coalesce(list_sum(list_transform({found}[:i - 1], lambda g: length(g))), 0) AS BIGINT))) AS a,
         unnest(list_transform({found}, lambda x, i: lower(concat(right({gaps}[i], {REACH}), ' ', left({gaps}[i + 1], {REACH}))))) AS near
  FROM d"""


DUCK_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": PATTERNS["phone"],
    "iban": PATTERNS["iban"],
    "ssn": PATTERNS["ssn"],
}
OP10_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS t FROM documents),
p AS ({" UNION ALL ".join(_duck_spans(k, v) for k, v in DUCK_PATTERNS.items())}),
q AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits, replace(m, ' ', '') AS packed, CASE kind {" ".join(f"WHEN '{k}' THEN {_score(k, 'near')}" for k in DUCK_PATTERNS)} END AS score FROM p),
v AS (
  SELECT *, list_position(['email', 'ip', 'card', 'phone', 'iban', 'ssn'], kind) AS o FROM q
  WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(TRY_CAST(ltrim(x, '0') AS INT), 0) > 255)) = 0
    WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''), lambda c, i:
        CASE WHEN i % 2 = 1 THEN CAST(c AS INT) ELSE CAST(c AS INT) * 2 - CASE WHEN CAST(c AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    WHEN 'iban' THEN list_reduce(list_transform(string_split(concat(substr(packed, 5), left(packed, 4)), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN CAST(c AS INT) ELSE ascii(c) - 55 END),
        lambda r, x: CASE WHEN x < 10 THEN (r * 10 + x) % 97 ELSE (r * 100 + x) % 97 END, 0) = 1 AND score >= {THRESHOLD}
    ELSE NOT (starts_with(m, '000') OR starts_with(m, '666') OR starts_with(m, '9')) AND score >= {THRESHOLD} END),
g AS (
  SELECT k, sum((o = 1)::INT) AS e, sum((o = 2)::INT) AS i, sum((o = 3)::INT) AS c, sum((o = 4)::INT) AS f,
         string_agg(concat(kind, ':', a, ':', a + length(m)), ',' ORDER BY o, a) FILTER (WHERE o <= 4) AS base,
         string_agg(concat(kind, ':', a, ':', a + length(m)), ',' ORDER BY o, a) AS spans, string_agg(CAST(score AS VARCHAR), ',' ORDER BY o, a) AS scores
  FROM v GROUP BY k)
SELECT doc_id, CAST(coalesce(e, 0) AS BIGINT) AS n_email, CAST(coalesce(i, 0) AS BIGINT) AS n_ip, CAST(coalesce(c, 0) AS BIGINT) AS n_card,
       CAST(coalesce(f, 0) AS BIGINT) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN g USING (k)
"""
