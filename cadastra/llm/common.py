"""Helpers shared by the training-data operators: shared scratch tables, Arrow slices, word and shingle hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words: space and the characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. One is made only where the session names none (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back, so that what follows doesn't depend on its lineage."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text) -> F.Column:
    """Array of words of a text column, JVM side. Null gives an empty array."""
    return F.regexp_extract_all(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD), F.lit(0))


# ---------------------------------------------------------------------------------------------------
# Vectorised hashing of whole Arrow batches.
# ---------------------------------------------------------------------------------------------------

_RADIX = 0x9E3779B97F4A7C15
_RADIX_INVERSE = pow(_RADIX, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.random.default_rng(733).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=6)
def _powers(n: int, inverse: bool) -> np.ndarray:
    out = np.full(n, _RADIX_INVERSE if inverse else _RADIX, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers of the hash's radix modulo 2**64, for n rounded up so that few tables are kept."""
    return _powers(1 << max(16, int(n - 1).bit_length()), inverse)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash in place."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = (2 << 20) - 64) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Split a batch into runs of rows of about max_bytes of text at most (one row at least).

    Gives each run, its texts' UTF-8 bytes joined without separator, and the offsets of the texts in them.
    A null text has no bytes."""
    col = batch.column(column)
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    offs = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and col.buffers()[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < len(col):
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1)
        end = min(end, len(col))
        yield batch.slice(at, end - at), data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def windowed(batch: pa.RecordBatch, column: str, length: int, max_bytes: int = (2 << 20) - 64) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """As slices, but a text of more than max_bytes comes in stretches, each with the first length - 1 bytes of the next, so that
    every run of `length` bytes begins in just one. Gives the rows of the batch, where the stretch begins in its text (0 for
    whole texts), bytes and offsets."""
    at = 0
    for part, data, offs in slices(batch, column, max_bytes):
        rows = np.arange(at, at + part.num_rows)
        at += part.num_rows
        if len(data) <= max_bytes or len(rows) > 1:
            yield rows, 0, data, offs
            continue
        for base in range(0, len(data), max_bytes):
            piece = data[base : base + max_bytes + length - 1]
            yield rows, base, piece, np.array([0, len(piece)])


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash: len(data) + 1 values."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE[data] * powers(len(data))[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end), equal for equal bytes wherever they stand."""
    h = (prefix[end] - prefix[start]) * powers(len(prefix), True)[start]
    return mix(h ^ (end - start).astype(np.uint64))


class Words:
    """Words of a run of texts: start and end byte of each, and first[d]:first[d + 1], the words of text d."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        inside = ~SPACE[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = offs[:-1][offs[:-1] < len(data)]
        begins[cuts] = inside[cuts]
        cuts = offs[1:] - 1
        cuts = cuts[cuts >= 0]
        ends[cuts] = inside[cuts]
        self.data, self.offs = data, offs
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offs)

    def hashes(self) -> np.ndarray:
        return span_hash(prefix_hash(self.data), self.start, self.end)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes; windows over the end of a text are for the caller to leave out."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j : j + n] * _STEP[j % 64] + _STEP[(j + 7) % 64]
    return mix(out)


def long_window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """As window_hashes, by a running hash, for long windows."""
    n = max(0, len(h) - k + 1)
    prefix = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(len(h))[: len(h)], out=prefix[1:])
    return mix((prefix[k : k + n] - prefix[:n]) * powers(n + 1, True)[:n])


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
