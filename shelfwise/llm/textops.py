"""Text helpers of this subpackage: word hashes in numpy over Arrow buffers, and row sampling.

Words are hashed to 64 bits by a polynomial over their bytes with a fixed odd base, mixed with
their length. Equal words always meet; two different ones do so with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Numpy needs some 50 bytes for each byte of a slice. Where a slice's rows are combined, larger ones
# leave less to shuffle.
SLICE_BYTES = 1 << 21
# Text that Spark hands to Python at once: a slice, with room for the last row and for other columns. Its usual
# 10,000 rows are some 35 MB, which the executor and its Python workers hold several times over.
BATCH_BYTES = SLICE_BYTES - (1 << 16)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers: list[np.ndarray] = []


def small_batches(spark: SparkSession) -> None:
    """A slice of text at a time, for the session, since rows are worked out when they are written."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[:] = tables
    return _powers[0], _powers[1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return at - at[0], np.zeros(0, np.uint8)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0] : at[-1]]


def slices(
    batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``size`` bytes of text, at least one row each."""
    at, _ = text_buffers(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(at, at[begin] + size, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and per row the place of its first word.

    Words are runs of anything but 0x20 and 0x09-0x0D; no word spans two rows.
    """
    at, data = text_buffers(column)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    white = _WHITE[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    begins = ~white
    begins[1:] &= white[:-1] | edge[1:n]
    ends = ~white
    ends[:-1] &= white[1:] | edge[1:n]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    power, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    raw = (total[last + 1] - total[first]) * inverse[first]
    words = mix(raw + (last + 1 - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return words, np.searchsorted(first, at)


def chain(*columns: np.ndarray) -> np.ndarray:
    """One hash of a sequence of hashes; the order counts."""
    h = np.full(1, len(columns), np.uint64)
    for column in columns:
        h = mix((h + np.uint64(0x2545F4914F6CDD1D)) * np.uint64(_BASE) ^ column)
    return h


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def unit_hash(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the row's values only."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))
