"""The curation run: language, spam and quality decisions in one tagged table, then its outputs."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import decisions as dc
from ..operators import quality_features as qf
from ..operators import spam_features as sf
from ..operators.language import language_of
from ..operators.models import ModelScore


@dataclass
class Config:
    """Settings; the command line wins over the environment, that over the configuration file, that over the default."""

    input: str = "data"
    pattern: str = "*.jsonl"
    output: str = "output"
    language: str = "it"
    lang_threshold: float = dc.LANGUAGE_THRESHOLD
    threshold_spam: float = dc.SPAM_THRESHOLD
    threshold_quality: float = dc.QUALITY_THRESHOLD
    spam_model: str = ""  # folders of saved models
    quality_model: str = ""

    @classmethod
    def load(cls, argv: list[str] | None = None, env: dict[str, str] | None = None) -> Config:
        parser = argparse.ArgumentParser(prog="corpusmill")
        parser.add_argument("--config")
        for f in fields(cls):
            parser.add_argument("--" + f.name.replace("_", "-"), dest=f.name)
        given = vars(parser.parse_args(argv or []))
        values: dict[str, str] = {}
        if path := given.pop("config"):
            with open(path, encoding="utf-8") as lines:
                for line in lines:
                    name, eq, value = line.partition("=")
                    if eq and not line.lstrip().startswith("#"):
                        values[name.strip().lower()] = value.strip()
        for f in fields(cls):
            if (v := (env if env is not None else os.environ).get(f.name.upper())) is not None:
                values[f.name] = v
        values |= {k: v for k, v in given.items() if v is not None}
        return cls(**{f.name: type(f.default)(values[f.name]) for f in fields(cls) if f.name in values})


#: A score from the feature struct: a function of that column, or a step that adds the score to the table.
Scorer = Callable[[Column], Column] | ModelScore


def with_language(docs: DataFrame, scorer: Callable[[Column], Column] = language_of) -> DataFrame:
    """``docs`` (text, meta), with meta.language and meta.language_score from the scorer where a document has no score of its own."""
    m, found = F.col("meta"), F.col("_found")
    known = m["language_score"].isNotNull()
    rows = docs.withColumn("_found", F.when(~known, scorer(F.col("text"))))
    meta = m.withField("language", F.when(known, m["language"]).otherwise(F.coalesce(found["language"], m["language"]))).withField("language_score", F.coalesce(m["language_score"], found["score"]))
    return rows.withColumn("meta", meta).drop("_found")


def _scored(rows: DataFrame, scorer: Scorer, features: str, out: str) -> DataFrame:
    return scorer.apply(rows, features, out) if isinstance(scorer, ModelScore) else rows.withColumn(out, scorer(F.col(features)))


def curate(docs: DataFrame, config: Config, spam_score: Scorer, quality_score: Scorer) -> DataFrame:
    """``docs`` (id, text, meta) plus spam, quality and decision.

    A stage works on an empty text where a stage before rejected the row, so it costs nothing there, and its features
    are null for that row; one linear plan, nothing is computed twice. An empty ``config.language`` lets any language
    pass whose score is above the threshold. decision: stage (language, spam, quality, clean), keep, reason and the spam
    and quality details.
    """
    m, cols = F.col("meta"), docs.columns
    wanted = F.lit(config.language) if config.language else m["language"]
    rows = docs.withColumn("_lang", dc.language_keep(m["language"], m["language_score"], wanted, config.lang_threshold))
    rows = rows.withColumn("_text", F.when(F.col("_lang"), F.col("text")))
    rows = sf.spam_features(rows, "_text", F.col("id"), language=m["language"], score=m["language_score"], out="_spam")
    rows = rows.withColumn("spam", F.when(F.col("_lang"), F.col("_spam"))).drop("_spam")
    rows = _scored(rows, spam_score, "spam", "_spam_score")
    rows = rows.withColumn("_sd", F.when(F.col("_lang"), dc.spam_decision(F.col("spam"), F.col("_spam_score"), config.threshold_spam)))
    rows = rows.withColumn("_kept", F.coalesce(F.col("_sd.keep"), F.lit(False))).withColumn("_text", F.when(F.col("_kept"), F.col("text")))
    rows = qf.quality_features(rows, qf.FEATURES, "_text", "_quality")
    full = F.struct(m["language_score"].cast("double").alias("language_score"), *[F.col("_quality")[k].alias(k) for k in qf.FEATURES])
    rows = rows.withColumn("_full", F.when(F.col("_kept"), full)).withColumn("quality", F.when(F.col("_kept"), F.col("_quality"))).drop("_quality")
    rows = _scored(rows, quality_score, "_full", "_quality_score")
    rows = rows.withColumn("_qd", F.when(F.col("_kept"), dc.quality_decision(F.col("_quality_score"), dc.complete(F.col("_full"), qf.MODEL_FEATURES), config.threshold_quality)))
    stage = F.when(~F.col("_lang"), "language").when(~F.col("_kept"), "spam").when(F.col("_qd.keep"), "clean").otherwise("quality")
    reason = F.when(~F.col("_lang"), "language").otherwise(F.coalesce("_qd.reason", "_sd.reason"))
    details = {"spam_pred_label": "_sd.pred_label", "spam_pred_score": "_sd.pred_score", "spam_strong_evidence": "_sd.strong_evidence", "spam_uncertain_reason": "_sd.uncertain_reason", "quality_label": "_qd.label", "quality_score": "_qd.score"}
    decision = F.struct(stage.alias("stage"), (stage == "clean").alias("keep"), reason.alias("reason"), *[F.col(v).alias(k) for k, v in details.items()])
    return rows.select(*cols, "spam", "quality", decision.alias("decision"))


def run(docs: DataFrame, config: Config, spam_score, quality_score) -> DataFrame:
    """Decides, writes all outputs, and returns the counts per stage and reason."""
    from ..sources import io

    decided = curate(docs, config, spam_score, quality_score).persist()
    io.write_routed(decided, config.output)
    io.write_features(decided, config.output)
    io.write_audit(decided, config.output)
    counts = decided.groupBy("decision.stage", "decision.reason").count()
    counts.write.mode("overwrite").json(f"{config.output}/funnel")
    decided.unpersist()
    return decided.sparkSession.read.json(f"{config.output}/funnel")
