"""``python -m corpusmill``: one curation run over JSONL documents, with saved models where their folders are given."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators.models import ModelScore
from .plans.curation import Config, run, with_language
from .session import get_spark
from .sources import io


def scorers(spark, config: Config) -> tuple:
    """Spam and quality scores: saved models, or, without them, lexical evidence and prose statistics."""
    spam = ModelScore.saved(spark, config.spam_model) if config.spam_model else lambda s: F.least(F.lit(1.0), s["spam_keyword_density"] * 5)
    quality = ModelScore.saved(spark, config.quality_model) if config.quality_model else lambda q: F.least(F.lit(1.0), q["stopword_ratio"] * 2 + q["unique_word_ratio"] / 4)
    return spam, quality


def main(argv: list[str]) -> DataFrame:
    config = Config.load(argv)
    spark = get_spark(os.environ.get("SPARK_MASTER", "local[*]"))
    m = F.col("metadata")
    meta = F.struct(m["language"].alias("language"), m["language_score"].cast("double").alias("language_score"), m["label"].alias("label"))
    docs = io.read_documents(spark, config.input, config.pattern).select("id", "text", meta.alias("meta"))
    done = run(with_language(docs), config, *scorers(spark, config))
    done.show(truncate=False)
    return done


if __name__ == "__main__":
    main(sys.argv[1:])
