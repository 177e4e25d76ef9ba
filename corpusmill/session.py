"""Session construction for local runs, tests and the bench."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, memory: str = "8g", app: str = "corpusmill") -> SparkSession:
    """A session with the settings that the tests and the bench share; a cluster brings its own."""
    os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than there are cores, dealt over all cores; other scans as they are.

    For plain scans only: any other plan would have to run to tell its partitions.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
