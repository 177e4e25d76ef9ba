"""Readers and writers: JSONL documents, feature tables, routed outputs, audits, reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decisions as dc
from ..operators import quality_features as qf

DOCUMENT = "id string, text string, metadata map<string,string>"
#: Where each stage's rejects go.
FOLDERS = {"language": "1_language", "spam": "2_spam", "quality": "3_quality"}


def read_documents(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    """JSONL documents as id, text, metadata; top-level fields that are neither join the metadata. Texts that are empty or missing are left out."""
    raw = spark.read.option("pathGlobFilter", pattern).text(folder)
    fields = F.from_json("value", "map<string,string>")
    rows = raw.select(fields.alias("f"), F.from_json("value", DOCUMENT).alias("d"))
    rest = F.map_filter("f", lambda k, v: ~k.isin("id", "text", "metadata"))
    meta = F.map_concat(F.map_filter(rest, lambda k, v: ~F.coalesce(F.map_contains_key("d.metadata", k), F.lit(False))), F.coalesce("d.metadata", F.create_map().cast("map<string,string>")))
    return rows.select(F.col("d.id").alias("id"), F.col("d.text").alias("text"), meta.alias("metadata")).filter("text <> ''")


def read_features(spark: SparkSession, path: str, names: list[str], label: str, allowed: tuple[str, ...] = ("good", "bad")) -> DataFrame:
    """A feature CSV with y; missing columns, or labels that are not exactly allowed, are errors."""
    df = spark.read.option("header", True).csv(path)
    if missing := [c for c in [*names, label] if c not in df.columns]:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    if bad := df.filter(~F.coalesce(F.col(label).isin(*allowed), F.lit(False))).limit(1).collect():
        raise ValueError(f"unknown label: {bad[0][label]!r}")
    return df.withColumn("y", (F.col(label) == allowed[0]).cast("int")).withColumns({k: F.col(k).cast("double") for k in names})


def read_spam_features(spark: SparkSession, path: str, names: list[str], strict: bool = False) -> tuple[DataFrame, list[str]]:
    """A spam feature CSV with y (spam is 1) and the names that it has; what is no number is 0, rows with other labels are dropped."""
    df = spark.read.option("header", True).csv(path)
    label = next((c for c in ("spam_target_label", "target_label") if c in df.columns), None)
    if label is None:
        raise ValueError("no label column")
    found = [c for c in names if c in df.columns]
    if not found or (strict and len(found) < len(names)):
        raise ValueError(f"features missing: {', '.join(sorted(set(names) - set(found)))}")
    rows = dc.valid_labels(df, label).withColumn("y", (F.col(label) == "spam").cast("int"))
    return rows.withColumns({k: F.coalesce(F.expr(f"try_cast(`{k}` as double)"), F.lit(0.0)) for k in found}), found


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """All rows of tables with the same columns in the same order; another header is an error."""
    if not parts:
        raise ValueError("nothing to unite")
    out = parts[0]
    for p in parts[1:]:
        if p.columns != out.columns:
            raise ValueError(f"headers differ: {out.columns} and {p.columns}")
        out = out.unionAll(p)
    return out


def write_routed(decided: DataFrame, folder: str) -> None:
    """Kept documents to ``clean``, rejected ones to their stage's folder, as JSONL; one pass over the cached rows."""
    flat = decided.select("id", "text", "meta", "decision")
    flat.filter("decision.stage = 'clean'").write.mode("overwrite").json(f"{folder}/clean")
    for stage, name in FOLDERS.items():
        flat.filter(F.col("decision.stage") == stage).write.mode("overwrite").json(f"{folder}/rejected/{name}")


def write_features(decided: DataFrame, folder: str) -> None:
    """The two feature tables as CSV with header: spam for what passed language, quality for what passed spam."""
    stage = F.col("decision.stage")
    decided.filter(stage != "language").select("spam.*").write.mode("overwrite").option("header", True).csv(f"{folder}/spam_features")
    passed = decided.filter(stage.isin("quality", "clean"))
    label = F.lower(F.coalesce("meta.label", F.lit("unknown")))
    passed.select(F.col("id").alias("doc_id"), label.alias("label"), F.col("meta.language_score").alias("language_score"), *[F.col("quality")[k].alias(k) for k in qf.FEATURES]).write.mode("overwrite").option("header", True).csv(f"{folder}/quality_features")


def write_audit(decided: DataFrame, folder: str) -> None:
    """Rejects by gold label."""
    rejects = decided.filter("decision.stage <> 'clean'").select("text", F.col("meta.label").alias("label"), F.col("decision.stage").alias("stage"))
    dc.reject_audit(rejects, "text", "label", "stage").write.mode("overwrite").partitionBy("file").json(f"{folder}/audit")


def write_predictions(rows: DataFrame, folder: str) -> None:
    """All predictions, the misclassified ones, and false positives and negatives, as CSV."""
    tables = {"predictions": rows, "misclassified": rows.filter("is_error"), "false_positives": rows.filter("error_type = 'false_positive'"), "false_negatives": rows.filter("error_type = 'false_negative'")}
    for name, t in tables.items():
        t.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def write_importance(triaged: DataFrame, folder: str) -> None:
    """All features with their groups, and each group, as CSV."""
    plain = triaged.select("feature", "importance_mean", "importance_std")
    tables = {"all": triaged, **{k: plain.filter(triaged[k]) for k in ("strong", "to_review", "negative")}}
    for name, t in tables.items():
        t.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_splits(rows: DataFrame, folder: str, column: str = "split") -> None:
    rows.write.mode("overwrite").option("header", True).csv(f"{folder}/all")
    rows.write.mode("overwrite").partitionBy(column).option("header", True).csv(f"{folder}/by_split")


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """A small dict as one JSON file."""
    write_text(spark, json.dumps(report, indent=2, default=str), path)
