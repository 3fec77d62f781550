"""Helpers of this subpackage: texts as byte arrays, word and shingle hashes, scratch tables.

Everything here works on slices of whole documents of a few megabytes, so the
memory of a task follows the slice (or its one longest document), not the table.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from assayline.sources.scratch import scratch_dir

SLICE_BYTES = 1 << 20
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder (``spark.checkpoint.dir``).

    Where it is unset, a folder below the warehouse directory is used; on a cluster
    whose warehouse is a machine-local folder that is an error.
    """
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _sent(application: str) -> None:
    package = Path(__file__).resolve().parent.parent
    # the driver serves this file as long as the session lives
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    SparkSession.getActiveSession().sparkContext.addPyFile(str(archive))


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package sent to the executors first (once a session)."""
    _sent(df.sparkSession.sparkContext.applicationId)
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once as parquet in the shared folder and read back: cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shares(df: DataFrame, size_mb: float = 32, least: int = 64) -> int:
    """How many parts the input's file size asks for; grows with the data, no upper limit."""
    try:
        total = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # a plan without statistics
        total = 0
    if total > 1 << 60:  # Spark's mark for "unknown"
        total = 0
    return max(least, -(-total // int(size_mb * (1 << 20))))


def byte_rows(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated UTF-8 bytes and n+1 offsets; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` bytes of text (or one row)."""
    lengths = np.diff(byte_rows(batch.column(column))[1])
    start = total = 0
    for row, size in enumerate(lengths.tolist()):
        if row > start and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


#: A random-looking 64-bit value per byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of an odd base modulo 2**64 (or of its inverse)."""
    base = _INVERSE if inverse else _BASE
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << n.bit_length())
        out = np.full(size, base, np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        _POWERS[base] = have
    return have[:n]


@dataclass
class Words:
    """Words of a slice of documents: byte places, document and 64-bit hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # n+1: the first word of each document


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of bytes with ``is_word``; hashes are of the bytes as given."""
    inside = is_word[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[1:], before[0] = inside[:-1], False
        after[:-1], after[-1] = inside[1:], False
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    if len(start):
        # bytes between words count nothing, so one sum runs up to the next word
        values = BYTE_VALUES[data] * powers(len(data))
        values[~inside] = 0
        hashes = mix(np.add.reduceat(values, start) * powers(len(data), inverse=True)[start])
    else:
        hashes = np.zeros(0, np.uint64)
    first = np.searchsorted(doc, np.arange(len(offsets)), "left")
    return Words(start, end, doc, hashes, first)


def windows_of(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all windows of n words within one document."""
    m = len(words.hash)
    if m < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.zeros(m - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(_BASE) + words.hash[i : m - n + 1 + i]
    at = np.flatnonzero(words.doc[: m - n + 1] == words.doc[n - 1 :])
    return at, mix(out[at])


#: Words end at ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
