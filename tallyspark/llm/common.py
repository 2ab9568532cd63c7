"""Helpers shared by the operators: reading tables, stored intermediate
results, and vectorised hashing of words and word n-grams."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyspark.session import shared_dir, ship_package

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_resident: dict = {}


def _drop_resident() -> None:
    """Also gives what was freed back to the system, where the C library can."""
    _resident.clear()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def resident(key: tuple, build: Callable):
    """A large table that a Python worker keeps from task to task. It keeps one:
    workers outlive an operator, and its tables go when the next one's come."""
    if key not in _resident:
        _drop_resident()
        made = build()  # which may need another for a while
        _drop_resident()
        _resident[key] = made
    return _resident[key]


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` on executors that have this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def map_pandas(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInPandas`` on executors that have this package."""
    ship_package(df.sparkSession)
    return df.mapInPandas(fn, schema)


@contextmanager
def _shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a finished write are dead weight: the written table
    replaces them. Spark removes them at the end of the command."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


_open_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes inside are deleted at the end, also on
    failure: for callers that have stored their result elsewhere by then."""
    paths: list[str] = []
    _open_scratch.append(paths)
    try:
        yield
    finally:
        _open_scratch.remove(paths)
        delete(spark, paths)


def delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    lineage, and survives the loss of any executor. A ``path`` that the caller
    names is the caller's to delete."""
    spark = df.sparkSession
    if path is None:
        path = shared_dir(spark, purpose)
        if _open_scratch:
            _open_scratch[-1].append(path)
    with _shuffle_files_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null is the empty text."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


def record_batch(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    """One batch from the column pieces of many documents."""
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(pieces)) for pieces in zip(*parts, strict=True)], names)


# Words are separated by the six ASCII white-space characters.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BYTE_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length() if n > 1 else 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over all 64 (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(values: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash modulo 2^64 of values[start:end] for each pair, from
    differences of one running sum."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power(base, n), out=total[1:])
    back = _power(pow(base, -1, 1 << 64), n + 1)
    return mix((total[end] - total[start]) * back[start])


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    inside = ~_SPACE[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    return edge[0::2], edge[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a UTF-8 text."""
    start, end = word_bounds(text)
    letters = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    return _spans(letters, _BYTE_BASE, start, end)


def span_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run words[start:end] of word hashes."""
    return _spans(words, _WORD_BASE, start, end)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words."""
    start = np.arange(max(len(words) - size + 1, 0))
    return span_hashes(words, start, start + size)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
