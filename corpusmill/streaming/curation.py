"""The curation steps over a stream: everything up to the decision is per row, so each micro-batch runs the batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.curation import Config, curate, with_language
from ..sources import io

DOCUMENT = "id string, text string, meta struct<language: string, language_score: double, label: string>"


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    """JSONL documents that arrive in a folder."""
    return spark.readStream.schema(DOCUMENT).json(folder)


def start(docs: DataFrame, config: Config, spam_score, quality_score, checkpoint: str) -> StreamingQuery:
    """Decides each micro-batch once and writes documents, feature tables and audit to a folder of its own, so a repeated batch
    overwrites itself. Scores are columns or saved models, as in a batch run."""

    def each(batch: DataFrame, number: int) -> None:
        decided = curate(with_language(batch), config, spam_score, quality_score).persist()
        for write in (io.write_routed, io.write_features, io.write_audit):
            write(decided, f"{config.output}/batch={number}")
        decided.unpersist()

    return docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
