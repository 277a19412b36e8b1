"""Shared pieces of the text operators: word spans and hashes over Arrow buffers,
grouped streams, and written intermediate tables.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``; in UTF-8 that equals the
same rule on code points. All hashing is vectorised over whole Arrow chunks and depends
only on the words, never on where a document is stored.
"""

from __future__ import annotations

import ctypes
import gc
import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

# Bytes of text handled by one vectorised step inside a task.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Everything but ASCII letters and bytes of other code points.
NOT_LETTER = np.ones(256, dtype=bool)
NOT_LETTER[np.r_[65:91, 97:123, 128:256]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns the text operators read; every other column is pruned."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def materialise(df: DataFrame, tag: str, partitions: list[str] | None = None) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    This cuts lineage: a lost executor rereads the table. The folder name is new for
    every call, so no run sees another run's rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{tag}-{uuid.uuid4().hex}")
    df.write.partitionBy(*(partitions or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (invertible), so that nearby sums spread over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1024)
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        have = _powers[name] = np.multiply.accumulate(out)
    return have[:n]


def text_chunks(batch: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``text`` holds about ``limit`` bytes; a longer text is a slice of its own."""
    text = batch.column("text")
    lengths = np.asarray(pc.fill_null(pc.binary_length(text), 0), dtype=np.int64)
    total, start = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(lengths) > start:
        yield batch.slice(start)


def text_buffer(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the offsets of its values; null counts as empty."""
    text = pa.concat_arrays([pc.fill_null(text, "").cast(pa.large_binary())])
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of all words in order; words of value i are first[i]:first[i+1]. ``space`` marks the bytes between words."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~space[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cut = np.unique(offsets[1:-1])
    cut = cut[(cut > 0) & (cut < len(data))]
    begins[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, space: np.ndarray = _SPACE) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial in an odd base, moved to the word's start, mixed with its length.

    A very long text is hashed by runs of words, so that what is held beside it stays small.
    """
    if not len(start):
        return np.empty(0, np.uint64)
    if len(data) > 2 * CHUNK_BYTES and len(start) > 1:
        out = np.empty(len(start), np.uint64)
        a = 0
        while a < len(start):
            b = max(a + 1, int(np.searchsorted(start, start[a] + CHUNK_BYTES)))
            lo, hi = int(start[a]), int(end[b - 1])
            out[a:b] = _hashes(data[lo:hi], start[a:b] - lo, end[a:b] - lo, space)
            a = b
        return out
    return _hashes(data, start, end, space)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, space: np.ndarray) -> np.ndarray:
    value = np.where(space[data], 0, data.astype(np.uint64) + np.uint64(1)).astype(np.uint64)
    value *= _power_table("up", _BASE, len(data))
    # Words of neighbouring texts may touch without a space; cut at every start, spaces count as 0.
    total = np.add.reduceat(value, start)
    total *= _power_table("down", pow(_BASE, -1, 1 << 64), len(data))[start]
    return mix(total + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, at its first word (runs may cross texts; see ``window_starts``)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= np.uint64(0xD1342543DE82EF95)
        out += words[k:k + n]
    return mix(out + np.uint64(size))


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(value index, word index) of each run of ``size`` words inside one value."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    owner = np.repeat(np.arange(len(count)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[:-1], count)
    return owner, at


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64, copy=False).view(np.int64)


def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that have rows."""
    return (b for b in batches if b.num_rows)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``keys``, from batches already sorted by them, one table a group."""
    held: list[pa.Table] = []
    for batch in table(batches):
        t = pa.Table.from_batches([batch])
        if held:
            t = pa.concat_tables([*held, t])
            held = []
        change = np.zeros(t.num_rows, dtype=bool)
        for k in keys:
            v = t.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield t.slice(a, b - a)
        held = [t.slice(cuts[-1])]
    if held:
        yield held[0]


def release() -> None:
    """Give freed memory back to the system: Spark keeps a Python worker for later tasks, with all it ever held."""
    for name in [k for k, v in _powers.items() if len(v) > CHUNK_BYTES + 1024]:  # grown for one long text
        del _powers[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def freeing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, whose worker gives its freed memory back at the end of a task, so that a later stage finds it."""
    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()
    return freed


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table], object]) -> object:
    """``fit`` on a bounded sample, run in one task; only what it returns comes to the driver.

    The sample's rows reach ``fit`` as one table, in no stated order.
    """
    schema = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[f.dataType.simpleString()]) for f in sample.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(table(batches))
        model = fit(pa.Table.from_batches(held) if held else schema.empty_table())
        held.clear()
        release()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    rows = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else fit(schema.empty_table())
