"""Small numpy helpers shared by the operators: text batches as bytes, word hashes, grouped streams.

Everything here works on one Arrow batch inside a Spark task; nothing is kept
between batches but the powers of the hash base.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 20
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Let the session send at most `BATCH_ROWS` rows to Python at once.

    Both sides hold a batch of texts several times over, beside the heap; Spark's
    own limit of 10,000 rows is meant for numbers. Smaller limits are left alone.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BYTE_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `n` powers of the hash base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        for k, step in enumerate((_BASE, _INVERSE)):
            table = np.full(size, step, np.uint64)
            table[0] = 1
            _POWERS[k] = np.multiply.accumulate(table)
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each begins; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """`batch` in runs of rows of about `size` bytes of `column`; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64) + 1)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
        yield batch.slice(at, stop - at)
        at = stop
    pa.default_memory_pool().release_unused()


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (runs without ASCII white space), and the first word of each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~SPACES[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    begins[inner] = solid[inner]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    last = inner[inner > 0] - 1
    closes[last] = solid[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_hash(data: np.ndarray, codes: np.ndarray = _BYTE_CODES) -> np.ndarray:
    """Sums from which `span_hash` takes the polynomial hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * powers(len(data))[0], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    inverse = powers(len(sums))[1]
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, and the first word of each text."""
    starts, ends, first = word_spans(data, offsets)
    return span_hash(prefix_hash(data), starts, ends), first


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    jumps = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return jumps + np.arange(total)


def grouped(
    batches: Iterator[pa.RecordBatch], key: str, work: Callable[[pa.Table], pa.RecordBatch | None], rows: int = 20_000
) -> Iterator[pa.RecordBatch]:
    """Call `work` on tables of whole groups, from batches that are sorted by `key`.

    Several groups come at once, about `rows` rows, so that small groups cost
    little; a group is never divided.
    """
    held: list[pa.RecordBatch] = []
    n, enough = 0, rows
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last group may go on
        yield from _worked(table.slice(0, cut), keys[:cut], work, rows)
        held = table.slice(cut).to_batches()
        n = table.num_rows - cut
        enough = n + rows
    if n:
        table = pa.Table.from_batches(held)
        yield from _worked(table, table.column(key).to_numpy(), work, rows)
    pa.default_memory_pool().release_unused()


def _worked(table: pa.Table, keys: np.ndarray, work, rows: int) -> Iterator[pa.RecordBatch]:
    """Results of `work` on runs of whole groups, each of `rows` rows or one group more."""
    ends = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys))
    at = 0
    while at < len(keys):
        stop = int(ends[min(np.searchsorted(ends, at + rows), len(ends) - 1)])
        out = work(table.slice(at, stop - at).combine_chunks())
        if out is not None:
            yield out
        at = stop
