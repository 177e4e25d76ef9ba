"""Metrics of binary scores: confusion, reports, rank statistics, curves, sweeps, correlations, folds.

Everything that needs an order aggregates by distinct score first and takes running sums over range partitions of these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..tables import cut, ranked


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def counts(y: Column, p: Column) -> list[Column]:
    """tn, fp, fn, tp of integer labels and predictions."""
    cell = lambda a, b, k: F.count(F.when((y == a) & (p == b), 1)).alias(k)
    return [cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(1, 1, "tp")]


def rates() -> dict[str, Column]:
    """Rates from columns tn, fp, fn, tp; 0 where there is nothing to divide by."""
    tn, fp, fn, tp = (F.col(k) for k in ("tn", "fp", "fn", "tp"))
    p1, r1, p0, r0 = ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(tn, tn + fn), ratio(tn, tn + fp)
    f = lambda p, r: ratio(2 * p * r, p + r)
    return {
        "accuracy": ratio(tp + tn, tn + fp + fn + tp),
        "balanced_accuracy": (r0 + r1) / 2,
        "precision_1": p1,
        "recall_1": r1,
        "f1_1": f(p1, r1),
        "precision_0": p0,
        "recall_0": r0,
        "f1_0": f(p0, r0),
        "preservation_rate": r0,
        "loss_rate": ratio(fp, tn + fp),
        "contamination_rate": ratio(fn, tn + fn),
        "detection_rate": r1,
        "miss_rate": ratio(fn, fn + tp),
        "predicted_positive_rate": ratio(tp + fp, tn + fp + fn + tp),
    }


def confusion(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(*counts(F.col(y), F.col(p)))


def operating_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    made = rates()
    return confusion(df, y, p).select("tn", "fp", "fn", "tp", *[v.alias(k) for k, v in made.items()])


def class_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row per class and for the macro and weighted means: class, precision, recall, f1, support."""
    m = operating_metrics(df, y, p).withColumn("s0", F.col("tn") + F.col("fp")).withColumn("s1", F.col("fn") + F.col("tp"))
    mean = lambda k: (F.col(f"{k}_0") + F.col(f"{k}_1")) / 2
    heavy = lambda k: ratio(F.col(f"{k}_0") * F.col("s0") + F.col(f"{k}_1") * F.col("s1"), F.col("s0") + F.col("s1"))
    row = lambda name, f, s: F.struct(F.lit(name).alias("class"), f("precision").alias("precision"), f("recall").alias("recall"), f("f1").alias("f1"), s.cast("long").alias("support"))
    rows = F.array(row("0", lambda k: F.col(f"{k}_0"), F.col("s0")), row("1", lambda k: F.col(f"{k}_1"), F.col("s1")), row("macro", mean, F.col("s0") + F.col("s1")), row("weighted", heavy, F.col("s0") + F.col("s1")))
    return m.select(F.explode(rows).alias("r")).select("r.*")


def by_score(df: DataFrame, y: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("pos"), F.sum(F.when(F.col(y) == 0, 1).otherwise(0)).alias("neg"))


def cumulated(df: DataFrame, y: str, score: str) -> DataFrame:
    """Per distinct score, from the highest: tp and fp when it is the threshold."""
    s = cut(by_score(df, y, score))
    every = s.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")).first()
    before = ranked(s, [F.desc("score")], "_place", {"_tp": "pos", "_fp": "neg"})
    n = lambda k: F.lit(every[k] or 0).cast("long").alias(k)
    return before.select("score", "pos", "neg", (F.col("_tp") + F.col("pos")).alias("tp"), (F.col("_fp") + F.col("neg")).alias("fp"), n("n_pos"), n("n_neg"))


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Probability that a positive outranks a negative; ties count half. Null with a single class."""
    c = cumulated(df, y, score)
    pairs = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / F.lit(2e0)))
    return c.agg(F.try_divide(pairs, F.max(F.col("n_pos").cast("double") * F.col("n_neg"))).alias("roc_auc"))


def average_precision(df: DataFrame, y: str, score: str) -> DataFrame:
    """Sum over distinct scores of the step in recall times precision."""
    c = cumulated(df, y, score)
    step = ratio(F.col("pos"), F.col("n_pos")) * ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    return c.agg(F.sum(step).alias("average_precision"))


def roc_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    return cumulated(df, y, score).select(F.col("score").alias("threshold"), ratio(F.col("fp"), F.col("n_neg")).alias("fpr"), ratio(F.col("tp"), F.col("n_pos")).alias("tpr"))


def pr_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    return cumulated(df, y, score).select(F.col("score").alias("threshold"), ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), F.col("n_pos")).alias("recall"))


def threshold_sweep(df: DataFrame, y: str, score: str, thresholds: list[float], positive: str = "spam", negative: str = "ham") -> DataFrame:
    """One row per threshold: rates, confusion and operating counts by name of the class, in one pass over the rows."""
    hit = lambda t, a, up: F.count(F.when((F.col(y) == a) & ((F.col(score) >= t) if up else (F.col(score) < t)), 1))
    made = df.agg(*[F.struct(F.lit(t).alias("threshold"), hit(t, 0, False).alias("tn"), hit(t, 0, True).alias("fp"), hit(t, 1, False).alias("fn"), hit(t, 1, True).alias("tp")).alias(f"t{i}") for i, t in enumerate(thresholds)])
    rows = made.select(F.explode(F.array(*[f"t{i}" for i in range(len(thresholds))])).alias("r")).select("r.*")
    return rows.select("threshold", *[v.alias(k) for k, v in sweep_columns(positive, negative).items()])


def sweep_columns(p: str, n: str) -> dict[str, Column]:
    """The columns of a sweep from tn, fp, fn, tp, for classes named ``p`` and ``n``."""
    tn, fp, fn, tp = (F.col(k) for k in ("tn", "fp", "fn", "tp"))
    r = rates()
    out = {"accuracy": r["accuracy"], "balanced_accuracy": r["balanced_accuracy"]}
    out |= {f"{k}_{name}": r[f"{k}_{i}"] for name, i in ((p, 1), (n, 0)) for k in ("precision", "recall", "f1")}
    out |= {"true_negative": tn, "false_positive": fp, "false_negative": fn, "true_positive": tp}
    out |= {f"true_{n}": tn + fp, f"true_{p}": tp + fn, f"predicted_{n}": tn + fn, f"predicted_{p}": fp + tp}
    out |= {f"{n}_correct": tn, f"{n}_lost_as_{p}": fp, f"{n}_preservation_rate": r["preservation_rate"], f"{n}_loss_rate": r["loss_rate"]}
    out |= {f"{p}_in_predicted_{n}": fn, f"{p}_contamination_in_predicted_{n}": r["contamination_rate"]}
    out |= {f"{p}_detected": tp, f"{p}_missed_as_{n}": fn, f"{p}_detection_rate": r["detection_rate"], f"{p}_miss_rate": r["miss_rate"]}
    return out | {f"fp_rate_on_{n}": r["loss_rate"], f"fn_rate_on_{p}": r["miss_rate"]}


def correlations(df: DataFrame, names: list[str], least: float | None = None) -> DataFrame:
    """Pearson correlation of every pair a < b of columns (in the order given); null where a column is constant.

    With ``least`` only the pairs of a larger magnitude. Columns are standardised in one pass and multiplied in
    another; only the matrix goes to the driver.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation

    x = lambda k: F.coalesce(F.col(k).cast("double"), F.lit(0.0))
    facts = df.agg(*[f(x(k)).alias(f"{i}_{j}") for i, k in enumerate(names) for j, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean, std = [facts[f"{i}_m"] or 0.0 for i in range(len(names))], [facts[f"{i}_s"] or 0.0 for i in range(len(names))]
    z = F.array(*[(x(k) - F.lit(m)) / F.lit(s) if s > 1e-12 * max(1.0, abs(m)) else F.lit(0.0) for k, m, s in zip(names, mean, std, strict=True)])
    found = Correlation.corr(df.select(array_to_vector(z).alias("z")), "z").first()[0].toArray() if facts["0_m"] is not None else None
    flat = [s <= 1e-12 * max(1.0, abs(m)) for m, s in zip(mean, std, strict=True)]
    r = lambda i, j: None if found is None or flat[i] or flat[j] else float(found[i, j])
    rows = [(a, b, r(i, j)) for i, a in enumerate(names) for j, b in enumerate(names) if i < j]
    kept = rows if least is None else [x for x in rows if x[2] is not None and abs(x[2]) > least]
    return df.sparkSession.createDataFrame(kept, "a string, b string, r double")


def _corr(x: Column, y: Column) -> Column:
    """Pearson correlation; ``corr`` itself fails on a constant column, whose deviation may come out a little above 0."""
    varies = lambda c: F.stddev_pop(c) > F.greatest(F.lit(1.0), F.abs(F.avg(c))) * 1e-12
    return F.when(varies(x) & varies(y), F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def label_correlations(df: DataFrame, names: list[str], y: str) -> DataFrame:
    """Correlation of each column with the label, largest magnitude first; null for a constant column."""
    made = df.agg(*[F.struct(F.lit(a).alias("feature"), _corr(F.col(a).cast("double"), F.col(y).cast("double")).alias("r")).alias(f"p{i}") for i, a in enumerate(names)])
    return made.select(F.explode(F.array(*[f"p{i}" for i in range(len(names))])).alias("p")).select("p.*").orderBy(F.desc_nulls_last(F.abs("r")), "feature")


def stacked(df: DataFrame, names: list[str], kept: list[str] | None = None) -> DataFrame:
    """(feature, value) rows of the named columns, with the ``kept`` ones."""
    return df.select(*(kept or []), F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), F.col(k).cast("double").alias("value")) for k in names])).alias("x")).select(*(kept or []), "x.*")


def scaler_fit(df: DataFrame, names: list[str]) -> DataFrame:
    """feature, mean, std (population) over the rows of ``df``."""
    made = df.agg(*[F.struct(F.lit(k).alias("feature"), F.avg(F.col(k).cast("double")).alias("mean"), F.stddev_pop(F.col(k).cast("double")).alias("std")).alias(f"s{i}") for i, k in enumerate(names)])
    return made.select(F.explode(F.array(*[f"s{i}" for i in range(len(names))])).alias("s")).select("s.*")


def near_constant(df: DataFrame, names: list[str], share: float = 0.995) -> DataFrame:
    """feature, n_distinct, top_share, constant, near_constant; a null counts as a value."""
    per = stacked(df, names).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"), (F.max("n").cast("double") / F.sum("n")).alias("top_share"))
    return top.select("feature", "n_distinct", "top_share", (F.col("n_distinct") <= 1).alias("constant"), (F.col("top_share") >= share).alias("near_constant"))


def fold_summary(folds: DataFrame, by: str, names: list[str]) -> DataFrame:
    """Mean and population deviation of fold metrics per model; NaN and null folds are left out."""
    clean = lambda k: F.when(~F.isnan(F.col(k).cast("double")), F.col(k).cast("double"))
    return folds.groupBy(by).agg(*[x for k in names for x in (F.avg(clean(k)).alias(f"{k}_mean"), F.stddev_pop(clean(k)).alias(f"{k}_std"))])


def ranking(models: DataFrame, keys: list[str]) -> DataFrame:
    """Models with their rank by several metrics, best first; ties by name."""
    return models.withColumn("rank", F.row_number().over(Window.orderBy(*[F.desc_nulls_last(k) for k in keys], "model")))
