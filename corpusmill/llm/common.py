"""Shared pieces: files from tasks, salted joins, what workers remember, and Arrow helpers; tables between steps are the package's own."""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread
from ..tables import cut, drop, fresh, ranked, remove, scratch, tidy, tidying

__all__ = ["cut", "drop", "fresh", "ranked", "remove", "scratch", "tidy", "tidying"]  # for the operators, with what follows

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def workers_can_import(spark: SparkSession) -> None:
    """Python workers get the folder that holds this package on their path."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *[p for p in paths if p]])
    # what workers free goes back to the system
    env |= {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "1048576"}


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI (a plain path is a local one) and the path there, for code in tasks."""
    uri = f"file://{folder}" if folder.startswith("/") else re.sub("^file:/(?=[^/])", "file:///", folder)
    return fs.FileSystem.from_uri(uri)


def put_file(folder: str, name: str, content: bytes) -> None:
    """Writes a file under a name of this attempt and renames it, so no reader meets half a file.

    A repeated attempt replaces the file by one with the same content.
    """
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    own = f"{path}/{name}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(own, compression=None) as out:
        out.write(content)
    system.move(own, f"{path}/{name}")


def get_file(folder: str, name: str) -> bytes:
    system, path = file_system(folder)
    with system.open_input_stream(f"{path}/{name}", compression=None) as held:
        return held.read()


HOT, SALTS = 512, 32


def hot_keys(counted: DataFrame, key: str, n: str) -> list:
    """The keys of a table of counts that hold more than 1 / HOT of all; fewer than HOT."""
    every = counted.agg(F.sum(n)).first()[0] or 0
    return [r[0] for r in counted.filter(F.col(n) > every / HOT).select(key).collect()]


def salted_join(many: DataFrame, few: DataFrame, on: list[str], by: Column, hot: list) -> DataFrame:
    """A join whose hot keys (values of the first column of ``on``) are dealt over SALTS tasks by ``by``; their rows in ``few``
    (few a key) are repeated."""
    salt, is_hot = fresh(many, "_salt"), F.col(on[0]).isin(hot) if hot else F.lit(False)
    left = many.withColumn(salt, F.when(is_hot, F.pmod(by, F.lit(SALTS))).otherwise(0).cast("int"))
    right = few.withColumn(salt, F.explode(F.when(is_hot, F.lit(list(range(SALTS)))).otherwise(F.lit([0]))))
    return left.join(right, [*on, salt]).drop(salt)


_caches: dict[str, Callable[[], None]] = {}


def own_cache(name: str, clear: Callable[[], None]) -> None:
    """Says that ``name`` now fills its cache in this worker; what other operators remember here is let go."""
    for other in [k for k in _caches if k != name]:
        _caches.pop(other)()
    _caches[name] = clear


@contextlib.contextmanager
def reused_memory() -> Iterator[None]:
    """Within, the allocator keeps freed arrays of some MB for the next ones instead of fetching fresh pages each time; then all goes back."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 128 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library: only slower
        yield
        return
    try:
        yield
    finally:
        libc.mallopt(-3, 128 << 10)
        libc.mallopt(-1, 1 << 20)
        libc.malloc_trim(0)


def texts_of(column: pa.Array) -> list[str]:
    """Strings of a column; null is the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Re-cuts batches so that none holds much more than ``most_bytes`` of column ``text``; a longer single row stays whole."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if batch.column(text).nbytes <= most_bytes:
            yield batch
            continue
        step = max(1, int(batch.num_rows * most_bytes / max(1, batch.column(text).nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
