"""Packed lists: many words or numbers as one compressed value, so that shuffles carry few rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

from ledgerline.llm import common as C

_NO_BYTES = np.zeros(256, dtype=bool)


def pack(numbers: np.ndarray) -> bytes:
    """Numbers by byte planes, entropy-coded."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel()


def binary(offsets: np.ndarray, data: np.ndarray | bytes) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def raw_of(a: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of an array."""
    o = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None else np.empty(0, np.uint8)
    return o - o[0], data[o[0]:o[-1]]


def pack_list(a: pa.LargeBinaryArray) -> bytes:
    """Byte strings as one compressed value: their sizes by byte planes, then their bytes."""
    o, data = raw_of(a)
    sizes = np.diff(o).astype(np.int32)
    return zstandard.ZstdCompressor(level=1).compress(np.int32(len(sizes)).tobytes() + sizes.view(np.uint8).reshape(-1, 4).T.tobytes() + data.tobytes())


def unpack_list(value: bytes) -> pa.LargeBinaryArray:
    raw = zstandard.ZstdDecompressor().decompress(value)
    n = int(np.frombuffer(raw, np.int32, 1)[0])
    sizes = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, 4).reshape(4, n).T).view(np.int32).ravel()
    return binary(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), np.frombuffer(raw, np.uint8, offset=4 + 4 * n))


def buckets_of(words: pa.LargeBinaryArray, buckets: int) -> np.ndarray:
    """A bucket for each word, by its bytes alone."""
    o, data = raw_of(words)
    out = np.empty(len(words), np.int64)
    a = 0
    while a < len(words):
        b = max(a + 1, int(np.searchsorted(o, o[a] + C.CHUNK_BYTES)))
        b = min(b, len(words))
        start, end = o[a:b] - o[a], o[a + 1:b + 1] - o[a]
        out[a:b] = (C.word_hashes(data[o[a]:o[b]], start, end, _NO_BYTES) % np.uint64(buckets)).astype(np.int64)
        a = b
    return out


def pack_ids(ids: list[bytes]) -> bytes:
    """Ids of many words: the number of ids of each word, then all ids, by byte planes."""
    counts = np.array([len(x) // 4 for x in ids], np.int32)
    return pack(np.concatenate([np.array([len(counts)], np.int32), counts, np.frombuffer(b"".join(ids), np.int32)]))


def unpack_ids(value: bytes) -> tuple[np.ndarray, np.ndarray]:
    a = unpack(value)
    return a[1:1 + a[0]], a[1 + a[0]:]
