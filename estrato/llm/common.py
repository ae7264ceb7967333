"""Shared helpers: tables in the shared folder, vectorised words and rolling hashes.

Words are hashed in whole blocks with numpy: a word's value is a polynomial in its bytes, summed
for all words of a block at once and mixed with the length. Two independent 64-bit values per word
are available where equality of hashes stands for equality of text.
"""

from __future__ import annotations

import importlib.util
import shutil
import tempfile
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.session import new_folder

SPACE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
"""Word separators of `[^\\x20\\x09-\\x0D]+`."""


def _importable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("estrato") is not None] * batch.num_rows)], ["ok"])


_importable.__module__ = "__main__"  # travels by value: it runs where the package may be missing


_SEEN: set[str] = set()


ROWS_PER_BATCH = 2000
"""Rows of an Arrow batch. Spark's default of 10,000 takes no account of how long texts are."""


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch size where it is Spark's default: a batch of texts is held on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(ROWS_PER_BATCH))


def ensure_importable(spark: SparkSession) -> None:
    """Sends this package to the executors if their Python doesn't find it; asked once per application.

    Every operator's entry calls it, so it also sees to batches of a size fit for texts.
    """
    small_batches(spark)
    if spark.sparkContext.applicationId in _SEEN:
        return
    if not all(r[0] for r in spark.range(1).mapInArrow(_importable, "ok boolean").collect()):
        package = Path(__file__).resolve().parent.parent
        # as --py-files would: Spark's own file server hands the archive to every executor
        spark.sparkContext.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/estrato", "zip", package.parent, package.name))
    _SEEN.add(spark.sparkContext.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, what: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes the files of a table made by `stored` that is not read again."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(rows, bytes of text): one aggregate over one column, used to size partitions."""
    row = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).head()
    return row[0], row[1]


def crc_fold(column: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo `folds`; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def encoded(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each value; NULL gives no bytes."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(texts: Sequence[bytes | str], most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of at most `most` bytes together (a longer text stands alone)."""
    start, held = 0, 0
    for i, x in enumerate(texts):
        if held and held + len(x) > most:
            yield start, i
            start, held = i, 0
        held += len(x) + 1
    if start < len(texts):
        yield start, len(texts)


def sliced(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, list[bytes]]]:
    """(start, end, UTF-8 bytes) of consecutive texts of about `most` bytes together, made one slice at a time.

    A batch from Spark has a fixed number of rows, however long they are; only a slice of it is ever
    turned into Python objects. What Arrow freed goes back to the system at the end.
    """
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total, start = np.cumsum(sizes + 1), 0
    while start < len(sizes):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + most, "right")))
        yield start, end, encoded(column.slice(start, end - start))
        start = end
    pa.default_memory_pool().release_unused()


def separator_table(separators: Iterable[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(separators)] = True
    return out


SPACE_TABLE = separator_table(SPACE)
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in BASES)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(1 << max(18, (int(n) - 1).bit_length()), base, np.uint64)
        steps[0] = 1
        have = _POWERS[int(base)] = np.multiply.accumulate(steps)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Words:
    """Words of several texts: byte spans in `data`, text number of each word, first word of each text."""

    def __init__(self, texts: Sequence[bytes], separators: np.ndarray = SPACE_TABLE, joint: bytes = b"\n"):
        self.data = joint.join(texts)
        self.bytes = np.frombuffer(self.data, np.uint8)
        gap = separators[self.bytes] if len(self.bytes) else np.zeros(0, bool)
        edge = np.diff(np.concatenate(([1], gap.view(np.int8), [1])))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        sizes = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
        self.offset = np.concatenate(([0], np.cumsum(sizes)))
        self.first = np.searchsorted(self.start, self.offset)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self._gap = gap

    def __len__(self) -> int:
        return len(self.start)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]]

    def hashes(self, which: int = 0, block: int = 1 << 18) -> np.ndarray:
        """One 64-bit value per word, from its bytes alone."""
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(self.start):
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + block, "right")))
            lo, hi = self.start[i], self.end[j - 1]
            values = self.bytes[lo:hi].astype(np.uint64) + np.uint64(1)
            values *= powers(BASES[which], hi - lo)
            values[self._gap[lo:hi]] = 0
            at = self.start[i:j] - lo
            sums = np.add.reduceat(values, at) * powers(INVERSES[which], hi - lo)[at]
            out[i:j] = mixed(sums + (self.end[i:j] - self.start[i:j]).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
            i = j
        return out


def window_hashes(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """One value per run of `length` consecutive values; the last length-1 places have no window."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = int(BASES[which])
    total, done, width, run = np.zeros(n, np.uint64), 0, 1, words
    left = length
    while left:
        if left & 1:  # `run` holds the sums over `width` values
            total += run[done : done + n] * np.uint64(pow(base, done, 1 << 64))
            done += width
        left >>= 1
        if left:
            run = run[:-width] + run[width:] * np.uint64(pow(base, width, 1 << 64))
            width *= 2
    return mixed(total)


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n places lie in a window of `length` that begins at one of `starts`."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, n), -1)
    return np.cumsum(step[:n]) > 0


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) if not isinstance(c, pa.Array) else c for c, t in zip(columns, schema)], schema=schema)
