"""Training and evaluation runs of the quality and spam models, with their files and reports."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as mx
from ..operators import models as md
from ..operators import spam_features as sf
from ..operators import splits as sp
from ..sources import io
from ..tables import cut
from .report import html


def drop_constant(df: DataFrame, names: list[str]) -> tuple[list[str], list[str]]:
    """Names that vary, and names of which one value makes up nearly all rows."""
    rows = mx.near_constant(df, names).collect()
    constant = {r["feature"] for r in rows if r["constant"]}
    return [n for n in names if n not in constant], sorted(r["feature"] for r in rows if r["near_constant"])


def guard(names: list[str], forbidden: list[str]) -> None:
    if bad := sorted(set(names) & set(forbidden)):
        raise ValueError(f"columns that must not be learned from: {', '.join(bad)}")


#: Columns that name, label or leak, and so are never learned from, by task.
FORBIDDEN = {"spam": sf.EXCLUDED, "quality": ["doc_id", "id", "label", "y"]}


def train(df: DataFrame, names: list[str], folder: str, threshold: float, kind: str = "gbdt", shares: dict[str, float] | None = None, trees: int | None = None, weighted: bool = True, importance_repeats: int = 0, task: str = "spam") -> dict:
    """Splits rows (id, y, features) by class, fits on train, scores test, writes model, splits, predictions and report.

    The model's file remembers where its test rows are, so an evaluation without rows of its own finds them.
    """
    guard(names, FORBIDDEN[task])
    used, near = drop_constant(df, names)
    data = cut(sp.stratified_split(df, "id", "y", shares or {"train": 0.8, "test": 0.2}))
    train_rows, test_rows = data.filter("split = 'train'"), data.filter("split = 'test'")
    model = md.fit(kind, train_rows, used, trees, weighted, task)
    done = cut(md.scored(model, test_rows))
    report = {"created": datetime.now(timezone.utc).isoformat(), "model": kind, "features": used, "near_constant": near, "threshold": threshold, "rows": {r["split"]: r["count"] for r in data.groupBy("split").count().collect()}, "metrics": md.evaluate(done, threshold)}
    report["label_correlations"] = [r.asDict() for r in mx.label_correlations(train_rows, used, "y").collect()]
    report["high_correlations"] = [r.asDict() for r in mx.correlations(train_rows, used, 0.9).collect()]
    if importance_repeats:
        made = cut(md.triage(md.permutation_importance(model, test_rows, used, threshold, importance_repeats)))
        io.write_importance(made, f"{folder}/importance")
        report["importance"] = [r.asDict() for r in md.importance_shares(made.select("feature", "importance_mean", "importance_std")).collect()]
    io.write_splits(data, f"{folder}/splits")
    test_rows.drop("split").write.mode("overwrite").parquet(f"{folder}/test")
    io.write_predictions(md.error_rows(done, threshold), f"{folder}/errors")
    md.save(model, folder, used, threshold, {"rows": report["rows"], "created": report["created"], "task": task, "test": f"{folder}/test", "importance": report.get("importance")})
    io.write_report(df.sparkSession, report, f"{folder}/report")
    return report


def test_rows_of(spark, about: dict, given: DataFrame | None = None) -> DataFrame:
    """The rows that are given, else the model's own test rows."""
    if given is not None:
        return given
    if not (path := about["training_metadata"].get("test")):
        raise ValueError("no rows are given and the model names no test rows")
    return spark.read.parquet(path)


def points(curve: DataFrame, x: str, y: str, most: int = 200) -> list[tuple[float, float]]:
    """A curve for a picture: its first and last points and evenly spaced ones between, in the order of ``x``."""
    cell = F.floor(F.col(x) * most)
    rows = curve.groupBy(cell.alias("cell")).agg(F.min(F.struct(x, y)).alias("first"), F.max(F.struct(x, y)).alias("last")).collect()  # most + 1 cells
    return sorted({(float(p[x]), float(p[y])) for r in rows for p in (r["first"], r["last"])})


def evaluate(spark, folder: str, df: DataFrame | None = None, threshold: float | None = None, default: float = 0.65, sweep: tuple[float, ...] = (0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90), folds: int = 0, kinds: tuple[str, ...] = md.MODELS, trees: int | None = None) -> dict:
    """Scores rows (id, y, features; by default the model's own test rows) with a saved model and writes the report, as JSON
    and HTML, and the curves. With ``folds`` also the model on parts of the rows, the comparison of models, the lift over
    logistic regression, and the leakage of a new model."""
    model, about = md.load(spark, folder)
    names, task = about["feature_names"], about["training_metadata"].get("task", "spam")
    t = md.threshold_of(threshold, about, default)
    rows = test_rows_of(spark, about, df)
    done = cut(md.scored(model, rows))
    p = done.withColumn("p", (F.col("score") >= t).cast("int"))
    roc, pr = cut(mx.roc_curve(done, "y", "score")), cut(mx.pr_curve(done, "y", "score"))
    report = {"threshold": t, "features": names, "metrics": md.evaluate(done, t), "leakage": md.leakage(done), "classes": [r.asDict() for r in mx.class_report(p, "y", "p").collect()], "sweep": [r.asDict() for r in mx.threshold_sweep(done, "y", "score", list(sweep)).collect()]}
    report |= {"roc": points(roc, "fpr", "tpr"), "pr": points(pr, "recall", "precision"), "importance": about["training_metadata"].get("importance") or []}
    if folds:
        table = md.comparison(md.cross_validate(rows, names, list(kinds), folds, t, trees, task), task)
        report["comparison"] = [r.asDict() for r in table.orderBy("rank").collect()]
        report["winner"] = report["comparison"][0]["model"]
        report["saved_folds"] = md.saved_folds(model, rows, folds, t)
        report["lift"] = md.lift(rows, names, folds, t, trees=trees, task=task)
        report["fresh_leakage"] = md.fresh_leakage(rows, names, folds)
    for name, curve in (("roc_curve", roc), ("pr_curve", pr)):
        curve.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
    io.write_report(spark, report, f"{folder}/evaluation")
    io.write_text(spark, html(report), f"{folder}/evaluation_html")
    return report
