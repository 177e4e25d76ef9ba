"""Stratified splits by hash order: the same rows whatever the partitions, in Spark and in SQL.

Places come from range-partitioned ranks, so no class and no table meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import cut, fresh, ranked

SEED = 42


def order_key(row_id: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.col(row_id).cast("string"), F.lit(str(seed))))


def placed(df: DataFrame, row_id: str, label: str, seed: int = SEED) -> DataFrame:
    """Adds the row's place in its class (from 1) and the class size."""
    rows = cut(ranked(df, [F.col(label), order_key(row_id, seed), F.col(row_id)], "_rank"))
    own = fresh(df, "_label")
    classes = rows.groupBy(F.col(label).alias(own)).agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_size"))
    joined = rows.join(classes, F.col(label).eqNullSafe(F.col(own)))
    return joined.withColumn("_place", F.col("_rank") - F.col("_first") + 1).drop(own, "_rank", "_first")


def stratified_split(df: DataFrame, row_id: str, label: str, shares: dict[str, float], seed: int = SEED, out: str = "split") -> DataFrame:
    """Adds ``out``: each class is cut at the same shares, in hash order."""
    at, upto = F.col("_place") - 1, 0.0
    name: Column | None = None
    for part, share in shares.items():
        upto += share
        test = at < F.floor(F.col("_size") * F.lit(upto) + 0.5)
        name = F.when(test, part) if name is None else name.when(test, part)
    last = list(shares)[-1]
    return placed(df, row_id, label, seed).withColumn(out, name.otherwise(last)).drop("_place", "_size")


def stratified_folds(df: DataFrame, row_id: str, label: str, k: int = 5, seed: int = SEED, out: str = "fold") -> DataFrame:
    if k < 2:
        raise ValueError("at least two folds are needed")
    return placed(df, row_id, label, seed).withColumn(out, ((F.col("_place") - 1) % k).cast("int")).drop("_place", "_size")


def dealt(df: DataFrame, row_id: str, values: Column, seed: int, out: str) -> DataFrame:
    """Adds ``out``: the values of other rows, dealt in the order of another hash."""
    source = ranked(df.select(F.col(row_id), values.alias(out)), [order_key(row_id, seed), F.col(row_id)], "_k").select("_k", out)
    target = ranked(df, [order_key(row_id, seed + 1), F.col(row_id)], "_k")
    return cut(target.join(source, "_k").drop("_k"))


def shuffled(df: DataFrame, row_id: str, column: str, seed: int, out: str) -> DataFrame:
    """Adds ``out``: the values of ``column`` dealt to other rows."""
    return dealt(df, row_id, F.col(column), seed, out)
