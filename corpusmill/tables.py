"""Tables between steps: the shared folder, lineage cuts that tidy up after themselves, and global ranks."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LOCAL_DEFAULT = "/tmp/checkpoints/corpusmill"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which every executor sees; where it is unset, a local one if executors are local too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that every executor sees")
    return (folder or LOCAL_DEFAULT).rstrip("/")


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder; below the local default it is removed when this process ends."""
    path = f"{shared_dir(spark)}/{kind}/{uuid.uuid4().hex}"
    if path.startswith(LOCAL_DEFAULT):
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


_made: list[list[DataFrame]] = []  # tables that were cut within each open ``tidying``


def cut(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again: lineage ends here and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, "tables")
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    if _made:
        _made[-1].append(out)
    return out


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop(*tables: DataFrame) -> None:
    """Deletes what ``cut`` wrote."""
    for df in tables:
        remove(df.sparkSession, df.stored_at)


@contextlib.contextmanager
def tidying() -> Iterator[list[DataFrame]]:
    """Deletes, at the end, all tables that are cut within and still in the list."""
    _made.append(held := [])
    try:
        yield held
    finally:
        _made.pop()
        drop(*held)


def tidy(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function whose result is cut and whose other tables are deleted."""

    @functools.wraps(make)
    def run(*args, **kw) -> DataFrame:
        with tidying() as held:
            out = cut(make(*args, **kw))
            held.pop()  # cut last
        if _made:
            _made[-1].append(out)
        return out

    return run


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ranked(df: DataFrame, order: list[Column], rank: str, sums: dict[str, str] | None = None) -> DataFrame:
    """``df`` with its 0-based position in ``order`` and, for each ``{new: column}`` of ``sums``, the exact sum over the rows before.

    Rows are range-partitioned; only one row of totals per partition meets in one task. ``order`` must be total for
    the outcome not to depend on the partition bounds.
    """
    sums = sums or {}
    pid = fresh(df, "_pid")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.repartitionByRange(n, *order).withColumn(pid, F.spark_partition_id()))
    within = Window.partitionBy(pid).orderBy(*order)
    totals = placed.groupBy(pid).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"_s{i}") for i, c in enumerate(sums.values())])
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(pid, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), *[F.coalesce(F.sum(f"_s{i}").over(before), F.lit(0)).alias(f"_o{i}") for i in range(len(sums))])
    out = placed.join(offsets, pid)
    prior = within.rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn(rank, F.row_number().over(within) - 1 + F.col("_n0"))
    for i, (new, c) in enumerate(sums.items()):
        out = out.withColumn(new, F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0))).over(prior), F.lit(0)) + F.col(f"_o{i}"))
    return out.drop(pid, "_n0", *[f"_o{i}" for i in range(len(sums))])
