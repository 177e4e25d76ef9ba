"""A corpus run in five stages over ``documents``; each stage's outcome is written and read again by the next.

Language ID drops texts without a language or with an uncertain one, near-dedup keeps one document of each group,
decontamination drops documents with a benchmark passage (a window of any item), mixing takes each source to its weight
(documents may repeat), and the last stage writes the token shards and reads their digest back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontaminate, langid, mixing, neardup, tokens
from corpusmill.llm.common import remove, scratch, table, tidying

LEAST_SCORE = 0.5  # posterior of the predicted language


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs, langid.default_vocabulary())
    found = langid.predict(docs, model)
    lang, score = found.columns[-2:]
    return found.filter((F.col(lang) != langid.UND) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), least_items=1)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.read_tokens(spark, tokens.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
    ("token ids", write_token_ids),
]

#: Language ID, hashing and tokenizers are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        with tidying():
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
