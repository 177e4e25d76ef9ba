"""Training, scoring, comparison and importance of the quality and spam models with Spark ML."""

from __future__ import annotations

import functools
import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..tables import cut
from . import metrics as mx
from . import splits as sp

MODELS = ("gbdt", "random_forest", "extra_trees", "logistic_regression", "dummy")


def learner(kind: str, rows: int, weight: str | None, trees: int | None = None, seed: int = 42, task: str = "spam"):
    """The Spark ML learner nearest to each of the compared models; extra trees are random forests without bootstrap.

    ``task`` is spam (small, sampled and balanced trees) or quality (larger trees, forests of 400).
    """
    common = {"featuresCol": "x", "labelCol": "y"} | ({"weightCol": weight} if weight else {})
    forest = {"minInstancesPerNode": 2, "maxDepth": 10, "featureSubsetStrategy": "sqrt", "seed": seed, "numTrees": trees or (400 if task == "quality" else 300)}
    if kind == "gbdt":
        shape = {"maxDepth": 5, "minInstancesPerNode": 20} if task == "quality" else {"maxDepth": 4, "minInstancesPerNode": 10, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9"}
        return GBTClassifier(maxIter=trees or 300, stepSize=0.05, seed=seed, **shape, **common)
    if kind == "random_forest":
        return RandomForestClassifier(**forest, **common)
    if kind == "extra_trees":
        return RandomForestClassifier(bootstrap=False, **forest, **common)
    if kind == "logistic_regression":
        return LogisticRegression(maxIter=200, regParam=1.0 / max(1, rows), elasticNetParam=0.0, **common)
    raise ValueError(f"unknown model {kind}")


def matrix(df: DataFrame, row_id: str, features: dict[str, Column], label: Column | None) -> DataFrame:
    """id, y, and the features as doubles; what is no number is 0, as is NaN."""
    clean = [F.coalesce(F.nanvl(c.cast("double"), F.lit(0.0)), F.lit(0.0)).alias(k) for k, c in features.items()]
    return df.select(F.col(row_id).alias("id"), (label.cast("int") if label is not None else F.lit(None).cast("int")).alias("y"), *clean)


def balanced(df: DataFrame) -> DataFrame:
    """Adds w: half of all weight to each class."""
    n = df.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).first()
    pos, neg = n["p"] or 0, n["n"] - (n["p"] or 0)
    return df.withColumn("w", F.when(F.col("y") == 1, n["n"] / (2.0 * max(1, pos))).otherwise(n["n"] / (2.0 * max(1, neg))))


def fit(kind: str, train: DataFrame, names: list[str], trees: int | None = None, weighted: bool = True, task: str = "spam") -> PipelineModel:
    """Scales by mean and deviation of the training rows, then fits. One class alone cannot be learned."""
    if train.select("y").distinct().limit(2).count() < 2:
        raise ValueError("the training rows hold one class only")
    data = balanced(train) if weighted else train
    stages = [VectorAssembler(inputCols=names, outputCol="raw"), StandardScaler(inputCol="raw", outputCol="x", withMean=True)]
    return Pipeline(stages=[*stages, learner(kind, train.count(), "w" if weighted else None, trees, task=task)]).fit(data)


def scored(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    done = model.transform(df)
    return done.withColumn(out, vector_to_array(F.col("probability"))[1]).drop("raw", "x", "rawPrediction", "probability", "prediction", "w")


def dummy(train: DataFrame, df: DataFrame, out: str = "score") -> DataFrame:
    """The class prior for every row."""
    return df.withColumn(out, F.lit(float(train.agg(F.avg("y")).first()[0] or 0.0)))


def score_by(kind: str, train: DataFrame, test: DataFrame, names: list[str], trees: int | None = None, task: str = "spam") -> DataFrame:
    return dummy(train, test) if kind == "dummy" else scored(fit(kind, train, names, trees, task=task), test)


class ModelScore:
    """A fitted or saved model as a step of a run: adds the score of the features in a struct."""

    def __init__(self, model: PipelineModel, names: list[str], threshold: float | None = None):
        self.model, self.names, self.threshold = model, names, threshold

    @classmethod
    def saved(cls, spark: SparkSession, path: str) -> ModelScore:
        model, about = load(spark, path)
        return cls(model, about["feature_names"], about["threshold"])

    def apply(self, df: DataFrame, features: str, out: str) -> DataFrame:
        """What is no number, and every feature of a null struct, counts as 0."""
        x = F.array(*[F.coalesce(F.nanvl(F.col(features)[k].cast("double"), F.lit(0.0)), F.lit(0.0)) for k in self.names])
        done = PipelineModel(self.model.stages[1:]).transform(df.withColumn("raw", array_to_vector(x)))
        return done.withColumn(out, vector_to_array(F.col("probability"))[1]).drop("raw", "x", "rawPrediction", "probability", "prediction")


def evaluate(df: DataFrame, threshold: float) -> dict[str, float]:
    """All metrics of rows (y, score) as one small dict."""
    data = df.withColumn("p", (F.col("score") >= threshold).cast("int"))
    out = mx.operating_metrics(data, "y", "p").first().asDict()
    out |= mx.roc_auc(df, "y", "score").first().asDict() | mx.average_precision(df, "y", "score").first().asDict()
    return out


METRICS = ("accuracy", "balanced_accuracy", "precision_1", "recall_1", "f1_1", "roc_auc", "average_precision")


def out_of_fold(df: DataFrame, names: list[str], kind: str, k: int, trees: int | None = None, task: str = "spam") -> DataFrame:
    """Every row scored by a model that was fitted on the other folds: id, y, fold, score."""
    folds = cut(sp.stratified_folds(df, "id", "y", k))
    parts = [score_by(kind, folds.filter(F.col("fold") != f), folds.filter(F.col("fold") == f), names, trees, task).select("id", "y", "fold", "score") for f in range(k)]
    return cut(functools.reduce(DataFrame.unionByName, parts))


def fold_metrics(rows: DataFrame, k: int, threshold: float) -> list[dict]:
    """The metrics of each fold of rows (y, fold, score); a fold of one class has no rank metrics."""
    every = [{"fold": f, **evaluate(rows.filter(F.col("fold") == f), threshold)} for f in range(k)]
    return [{c: None if m[c] is None else (m[c] if c == "fold" else float(m[c])) for c in ("fold", *METRICS)} for m in every]


def cross_validate(df: DataFrame, names: list[str], kinds: list[str], k: int, threshold: float, trees: int | None = None, task: str = "spam") -> DataFrame:
    """One row per model and fold with its metrics, and per model one of fold -1: the metrics of all out-of-fold scores at once."""
    if df.select("y").distinct().limit(2).count() < 2:
        raise ValueError("the rows hold one class only")
    rows = []
    for kind in kinds:
        scores = out_of_fold(df, names, kind, k, trees, task)
        whole = evaluate(scores, threshold)
        rows += [(kind, *m.values()) for m in fold_metrics(scores, k, threshold)] + [(kind, -1, *[None if whole[c] is None else float(whole[c]) for c in METRICS])]
    return df.sparkSession.createDataFrame(rows, "model string, fold int, " + ", ".join(f"{c} double" for c in METRICS))


#: How models are ranked, best first, and which is the one that others are held against.
RANKED = {"quality": ("roc_auc_mean", "f1_1_mean"), "spam": ("average_precision_mean", "f1_1_mean", "roc_auc_mean")}
BASELINE = "gbdt"


def comparison(folds: DataFrame, task: str = "spam") -> DataFrame:
    """Of ``cross_validate``: per model the mean and deviation of each metric over its folds, its out-of-fold metrics (``oof_``),
    the difference of each mean to the baseline's (``delta_``), and its rank. Without the baseline, the best model takes its place."""
    names = list(METRICS)
    summary = mx.fold_summary(folds.filter("fold >= 0"), "model", names)
    whole = folds.filter("fold = -1").select("model", *[F.col(c).alias(f"oof_{c}") for c in names])
    ranks = mx.ranking(summary.join(whole, "model"), list(RANKED[task]))
    first = F.row_number().over(Window.orderBy(F.col("model") != BASELINE, "rank"))
    base = ranks.withColumn("_first", first).filter("_first = 1").select(*[F.col(f"{c}_mean").alias(f"_{c}") for c in names])
    joined = ranks.crossJoin(F.broadcast(base))  # one row
    return joined.select(*ranks.columns, *[F.round(F.col(f"{c}_mean") - F.col(f"_{c}"), 4).alias(f"delta_{c}") for c in names])


def saved_folds(model: PipelineModel, df: DataFrame, k: int, threshold: float) -> dict:
    """A model as it is, on each of ``k`` parts of the rows and on all: how steady its metrics are."""
    rows = cut(scored(model, sp.stratified_folds(df, "id", "y", k)).select("id", "y", "fold", "score"))
    whole = evaluate(rows, threshold)
    return {"folds": fold_metrics(rows, k, threshold), "all": {c: whole[c] for c in METRICS}}


def lift(df: DataFrame, names: list[str], k: int, threshold: float, kind: str = BASELINE, trees: int | None = None, task: str = "spam") -> dict:
    """Rank metrics of out-of-fold scores of a model and of logistic regression, and the difference."""
    own, plain = (evaluate(out_of_fold(df, names, m, k, trees, task), threshold) for m in (kind, "logistic_regression"))
    keys = ("roc_auc", "average_precision")
    return {kind: {c: own[c] for c in keys}, "logistic_regression": {c: plain[c] for c in keys}, "lift": {c: own[c] - plain[c] for c in keys}}


def permutation_importance(model: PipelineModel, df: DataFrame, names: list[str], threshold: float, repeats: int = 5, metric: str = "f1_1") -> DataFrame:
    """feature, importance_mean, importance_std: the loss of the metric when a feature's values are dealt anew.

    A repeat deals whole rows anew once; every row then becomes one row per feature, with that feature's dealt value in
    place of its own, and all are scored and counted in one pass. ``metric`` is one of the rates.
    """
    vector = F.array(*[F.col(c).cast("double") for c in names])
    rest = PipelineModel(model.stages[1:])
    rate = mx.rates()[metric]
    p = (vector_to_array(F.col("probability"))[1] >= threshold).cast("int")
    rows = cut(df.select("id", "y", vector.alias("v")))
    base = rest.transform(rows.select("y", array_to_vector("v").alias("raw"))).agg(*mx.counts(F.col("y"), p)).select(rate.alias("m")).first()["m"]
    losses = None
    for r in range(repeats):
        dealt = sp.dealt(rows, "id", F.col("v"), 1000 + 2 * r, "_other")
        each = dealt.select("y", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("k"), "v", "_other")
        swapped = F.transform("v", lambda x, i: F.when(i == F.col("k"), F.col("_other")[i]).otherwise(x))
        counted = rest.transform(each.select("y", "k", array_to_vector(swapped).alias("raw"))).groupBy("k").agg(*mx.counts(F.col("y"), p))
        own = counted.select("k", (F.lit(base) - rate).alias("loss"))
        losses = own if losses is None else losses.unionByName(own)
    name = F.element_at(F.lit(list(names)), F.col("k") + 1)
    return losses.groupBy(name.alias("feature")).agg(F.avg("loss").alias("importance_mean"), F.stddev_pop("loss").alias("importance_std")).orderBy(F.desc("importance_mean"), "feature")


def triage(importance: DataFrame, least: float = 0.001) -> DataFrame:
    """Adds strong, to_review and negative; a feature can be in two groups."""
    m, s = F.col("importance_mean"), F.col("importance_std")
    return importance.withColumns({"strong": (m > least) & (s <= F.abs(m)), "to_review": (F.abs(m) <= least) | (s > F.abs(m)), "negative": m < 0})


def importance_shares(importance: DataFrame, top: int = 10) -> DataFrame:
    """The top features with their share of the total importance in percent (a total of 0 counts as 1)."""
    total = importance.agg(F.sum("importance_mean")).first()[0] or 1.0
    return importance.withColumn("share", F.col("importance_mean") / F.lit(total) * 100).orderBy(F.desc("importance_mean"), "feature").limit(top)


def error_rows(df: DataFrame, threshold: float, positive: str = "spam", negative: str = "ham") -> DataFrame:
    """Adds true_label, pred_label, spam_probability, threshold, is_error, error_type."""
    name = lambda c: F.when(c, positive).otherwise(negative)
    pred = F.col("score") >= threshold
    out = df.withColumn("true_label", name(F.col("y") == 1)).withColumn("pred_label", name(pred)).withColumn("spam_probability", F.round("score", 6)).withColumn("threshold", F.lit(threshold))
    wrong = F.col("true_label") != F.col("pred_label")
    return out.withColumn("is_error", wrong).withColumn("error_type", F.when(~wrong, "").when(pred, "false_positive").otherwise("false_negative"))


def save(model: PipelineModel, path: str, names: list[str], threshold: float, metadata: dict | None = None) -> None:
    """The model and, beside it, a one-line JSON file of what scoring needs to know."""
    if not names or not model.stages:
        raise ValueError("a model needs features and a fit")
    spark = SparkSession.getActiveSession()
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps({"feature_names": names, "threshold": threshold, "training_metadata": metadata or {}}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(spark, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/about").first()[0])


def threshold_of(given: float | None, about: dict | None, default: float) -> float:
    """The explicit threshold, else the model's, else the default."""
    return given if given is not None else (about or {}).get("threshold", default)


def fresh_leakage(df: DataFrame, names: list[str], k: int = 5, warn: float = 0.55, seed: int = 7) -> dict[str, float | bool]:
    """ROC-AUC of out-of-fold scores of a new logistic regression that learns dealt labels."""
    dealt = sp.shuffled(df, "id", "y", seed, "_y").drop("y").withColumnRenamed("_y", "y")
    auc = mx.roc_auc(out_of_fold(dealt, names, "logistic_regression", k), "y", "score").first()[0]
    return {"roc_auc": auc, "suspicious": auc is not None and auc >= warn}


def leakage(df: DataFrame, warn: float = 0.55, seed: int = 7) -> dict[str, float | bool]:
    """ROC-AUC of the scores against dealt labels: far from 0.5, something leaks."""
    dealt = sp.shuffled(df.select("id", "y", "score"), "id", "y", seed, "y2")
    auc = mx.roc_auc(dealt, "y2", "score").first()[0]
    return {"roc_auc": auc, "suspicious": auc is not None and auc >= warn}
