"""Mixing sources to target weights with hash-threshold histograms (DataFrame functions only).

Every row has a hash of 36 bits. For each source the tokens are summed by hash cell, the cell in which the budget
ends is found, and only that cell is summed again at a finer level; the budget then is one hash threshold per
source, and the mix is a filter on it: nothing is sorted, and a threshold for a smaller budget selects a subset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, fresh, ranked, table, tidy

WORD = r"[^\x20\x09-\x0D]+"
MARKS = 32  # levels that are tried in one round
LEVELS = (3, 6, 9)  # hexadecimal digits of a cell's name at each level: 4096 cells, each of them cut in 4096, twice


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(row_id: Column, text: Column) -> Column:
    """36 bits as hexadecimal digits, from id and text, so that repeated ids do not share a fate."""
    return F.substring(F.md5(F.concat_ws("|", row_id.cast("string"), text)), 1, LEVELS[-1])


def source_targets(sized: DataFrame, weights: tuple[int, ...], cap: int, share: float) -> DataFrame:
    """Columns src, source_size, target (double): one row per source.

    Sources in code point order, null last, get the weights in turn. The level ``v`` with
    ``sum(least(cap * size, v * weight)) = share * total`` lies between two sources in the order in which they reach
    their cap. Each round takes MARKS quantiles of that order that are still in question and sums what each would fill,
    so rounds grow with the logarithm of the number of sources; only these sums go to the driver, never the sources.
    """
    per_source = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    sources = ranked(per_source, [F.col("src").isNull(), F.col("src")], "place")
    wheel = F.array(*[F.lit(int(w)) for w in weights])
    bound, weight, ratio = F.col("source_size") * cap, F.col("weight"), F.col("source_size").cast("double") * cap / F.col("weight")
    sources = cut(sources.withColumn("weight", F.element_at(wheel, (F.col("place") % len(weights) + 1).cast("int"))))
    total = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    budget = int(total * share) if share != 1 else total
    lo, hi = -1.0, float("inf")
    while marks := sources.filter((ratio > lo) & (ratio < hi)).agg(F.percentile_approx(ratio, [i / MARKS for i in range(1, MARKS + 1)]).alias("m")).first()[0]:
        marks = sorted(set(marks))
        filled = sources.agg(*[F.sum(F.least(bound.cast("double"), weight * F.lit(m))).alias(f"f{i}") for i, m in enumerate(marks)]).first()
        lo = max([lo] + [m for m, f in zip(marks, filled, strict=True) if f < budget])
        hi = min([hi] + [m for m, f in zip(marks, filled, strict=True) if f >= budget])
    row = sources.agg(F.sum(F.when(ratio <= lo, bound).otherwise(0)), F.sum(F.when(ratio <= lo, 0).otherwise(weight))).first()
    level = (budget - row[0]) / row[1] if row[1] else lo  # a budget beyond all caps fills them
    want = weight * F.lit(float(level or 0.0))
    return sources.select("src", "source_size", F.when(want > bound, bound.cast("double")).otherwise(want).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds copies (whole passes over the source), cut_at (the cell in which the rest ends) and cut_in (whether it is taken)."""
    size = F.col("source_size").cast("double")
    plan = targets.withColumn("copies", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int"))
    plan = cut(plan.withColumn("rest", F.when(size > 0, F.col("target") - F.col("copies") * size).otherwise(0.0)).withColumn("cut_at", F.lit("")).withColumn("before", F.lit(0.0)))
    for level, digits in enumerate(LEVELS):
        narrowed = sized.join(plan.select(F.col("src").alias("psrc"), "cut_at"), F.col("src").eqNullSafe(F.col("psrc"))) if level else sized
        if level:
            narrowed = narrowed.filter(F.substring("hash", 1, LEVELS[level - 1]) == F.col("cut_at"))
        cells = narrowed.groupBy("src", F.substring("hash", 1, digits).alias("cell")).agg(F.sum("size").alias("tokens"))
        upto = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        cells = cells.withColumn("upto", F.sum("tokens").over(upto).cast("double"))
        joined = plan.join(cells.select(F.col("src").alias("csrc"), "cell", "tokens", "upto"), F.col("src").eqNullSafe(F.col("csrc")), "left")
        beyond = F.when(F.col("before") + F.col("upto") > F.col("rest"), F.struct("cell", "tokens", "upto"))
        found = joined.groupBy("src", "source_size", "target", "copies", "rest", "before").agg(F.min(beyond).alias("edge"))
        start = F.col("before") + F.coalesce(F.col("edge.upto") - F.col("edge.tokens"), F.lit(0.0))
        found = found.select("src", "source_size", "target", "copies", "rest", F.coalesce(F.col("edge.cell"), F.lit("")).alias("cut_at"), start.alias("before"), F.coalesce(F.col("edge.tokens"), F.lit(0)).alias("edge_tokens"))
        plan = cut(found)
    over = F.col("before") + F.col("edge_tokens") - F.col("rest")
    return plan.select("src", "source_size", "target", "copies", "cut_at", ((F.col("edge_tokens") > 0) & (over < F.col("rest") - F.col("before"))).alias("cut_in"))


@tidy
def planned(docs: DataFrame, weights: tuple[int, ...], cap: int, share: float, row_id: str, text: str, source: str) -> DataFrame:
    """The thresholds of every source; the only table that a mix needs."""
    sized = cut(docs.select(F.col(source).alias("src"), token_count(F.col(text)).alias("size"), row_hash(F.col(row_id), F.col(text)).alias("hash")))
    return thresholds(sized, source_targets(sized.select("src", "size"), weights, cap, share))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, share: float = 1.0, row_id: str = "doc_id", text: str = "text", source: str = "source", out: str = "mix") -> DataFrame:
    """All rows of ``docs`` plus the struct ``out``: size, source_size, target, copies (how often the mix takes the row).

    A null or empty text has size 0, a text of any length is counted whole; a null source is a source of its own, last
    in order. An empty table gives an empty one. A column named as ``out`` stays; the new one gets underscores in front.
    Equal rows (same id and text) share a hash and so a fate. A target of 0 (a source without words) takes its rows 0
    times. No source is sampled or sorted; a hot source only fills more of its 4096 cells.
    """
    out = fresh(docs, out)
    plan = planned(docs, weights, cap, share, row_id, text, source)
    a, b, h = fresh(docs, "_plan_source"), fresh(docs, "_plan"), fresh(docs, "_hash")
    packed = plan.select(F.col("src").alias(a), F.struct("source_size", "target", "copies", "cut_at", "cut_in").alias(b))
    joined = docs.join(packed, F.col(source).eqNullSafe(F.col(a)), "left").withColumn(h, row_hash(F.col(row_id), F.col(text)))
    p = F.col(b)
    extra = (F.col(h) < p["cut_at"]) | ((F.col(h) == p["cut_at"]) & p["cut_in"])
    copies = p["copies"] + F.when((p["cut_at"] != "") & extra, 1).otherwise(0)
    return joined.withColumn(out, F.struct(token_count(F.col(text)).alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"), copies.cast("int").alias("copies"))).drop(a, b, h)


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as it is taken."""
    n = fresh(docs, "mix")
    each = fresh(docs, "_copy")
    out = mix(docs, **kw)
    return out.filter(F.col(n)["copies"] > 0).withColumn(each, F.explode(F.sequence(F.lit(1), F.col(n)["copies"]))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    m = F.col("mix")
    return mix(docs).select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"), (m["size"] * m["copies"]).alias("taken"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), text)), 1, 9) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / w AS ratio,
         coalesce(sum(3 * source_size) OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(w) OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
         sum(source_size) OVER () AS total
  FROM s),
v AS (
  SELECT min_by(CAST(total - capped AS DOUBLE) / CAST(open_w AS DOUBLE), ratio) AS level
  FROM o WHERE ratio >= CAST(total - capped AS DOUBLE) / CAST(open_w AS DOUBLE)),
t AS (
  SELECT source, source_size, CASE WHEN w * level > 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE w * level END AS target
  FROM s, v),
b AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS base FROM t),
c AS (
  SELECT source, h, sum(size) AS tokens, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto
  FROM d GROUP BY source, h),
e AS (
  SELECT b.source, min(c.h) AS cut_at, min_by(c.upto, c.h) AS upto, min_by(c.tokens, c.h) AS tokens
  FROM b JOIN c ON b.source IS NOT DISTINCT FROM c.source
  WHERE c.upto > target - base * source_size GROUP BY b.source)
SELECT d.doc_id, d.size, b.source_size, b.target,
       CAST(d.size * (b.base + CASE WHEN d.h < e.cut_at
              OR (d.h = e.cut_at AND e.upto - (b.target - b.base * b.source_size) < (b.target - b.base * b.source_size) - (e.upto - e.tokens)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""
