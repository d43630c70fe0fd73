"""Shared helpers: the folder all machines see, and vectorised word splitting."""

from __future__ import annotations

import atexit
import ctypes
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: ASCII white space: space and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}
_LOCAL: list[str] = []
#: Bytes of text worked on at once; a longer text is a chunk of its own.
CHUNK = 1 << 21
#: Rows that go back to Spark at once: those with texts of their own are large.
ROWS = 512


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir. Only a local session may go without that setting; it gets a temporary folder that goes with it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="folioscope-"))
            atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
        root = _LOCAL[0]
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts lineage in a way that survives lost executors. See discard."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what `stored` wrote for tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Drops tables that are quickly made again and gives freed memory back to the system: workers are reused, and what one stage took would stay with all later ones."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def tidy(run):
    """run (of batches), with memory released before and after a task."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        release()
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def byte_texts(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(rows: Iterable, size=lambda r: len(r), limit: int = CHUNK) -> Iterator[list]:
    out, n = [], 0
    for r in rows:
        if out and n + size(r) > limit:
            yield out
            out, n = [], 0
        out.append(r)
        n += size(r) + 1
    if out:
        yield out


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        n = max(n, CHUNK + (1 << 16))
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.cumprod(x, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


class Words:
    """The words of some texts: byte ranges in one buffer, and the text of each.

    A word is a maximal run of bytes that `space` does not mark. Words never span texts.
    """

    def __init__(self, texts: list[bytes], space: np.ndarray = SPACE, lower: bool = False):
        raw = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
        self.buf = LOWER[raw] if lower else raw
        gap = space[raw]
        turns = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        self.start, self.end = turns[0::2], turns[1::2]
        self.first = np.searchsorted(self.start, np.cumsum([1, *(len(t) + 1 for t in texts)]))
        self.counts = np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = _powers(len(self.buf))
        total = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * up[: len(self.buf)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words joined by one space, and where each begins and ends there."""
        length = self.end - self.start
        end = np.cumsum(length + 1)
        keep = np.zeros(len(self.buf) + 1, np.int8)
        keep[self.start] = 1
        keep[self.end + 1] -= 1
        buf = self.buf.copy()
        buf[self.end] = 32
        return buf[np.cumsum(keep[:-1], dtype=np.int8) > 0].tobytes(), end - 1 - length, end - 1


_SEEDS = [pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) | 1 for k in range(64)]


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words, whatever texts they are in."""
    m = max(0, len(words) - n + 1)
    out = np.full(m, n, np.uint64)
    for k in range(n):
        out += words[k : k + m] * np.uint64(_SEEDS[k])
    return mix(out)
