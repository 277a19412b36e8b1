"""Runs of words with a period, found by internal pattern matching.

Per slice of texts, whose words are numbered so that only equal words of one text are equal:

1. Classes of equal stretches of 8, 16, 32, ... words, by doubling (``Factors``). Only
   places whose stretch occurs again go on, so plain prose ends after the first class.
   The order of these places by class is the suffix array; a class is an interval of it.
2. Dyadic blocks: a run of period q, L <= q < 2L (from 1 on for the first L), is at least 3q
   and 24 words long, so it holds a block of L words that starts at a multiple of L, and the
   block's copy q words on. For each block the suffix array's interval is asked for the
   occurrences that start in the neighbouring window, by range successor in a wavelet matrix
   over the suffix array (``Wavelet``).
3. A window is no longer than the block, so its occurrences are a progression. One or two
   give their distances as candidate periods. From three on, the step d is the block's own
   period; both the block and the occurrences lie in stretches of period d, and a run that
   maps one stretch to the other maps its start to the start or its end to the end: two
   candidates.
4. A candidate is extended to both sides by the classes; equal stretches keep their smallest
   period.

Texts never leave their task: there is no shuffle, and a hot source changes nothing. Words are
compared by 64-bit hashes inside a text. A text longer than a slice is a slice of its own; its
memory is some 100 bytes a word, and more only for the words in repeated stretches.

Defined cases: null or empty text has n=0 and no run; a null doc_id takes no planted period;
repeated rows each give their row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import common as C

LEAST = 24         # words of a run, at least
PERIODS = 3        # periods of a run, at least
BASE = 8           # words of the smallest block; 3 * BASE <= LEAST lets it find every smaller period
SLICE_BYTES = 1 << 20


class Factors:
    """Classes of equal stretches of BASE * 2**k words, for the places whose stretch occurs again.

    ``rank[k][i]`` is the class of the stretch at i (the first place of its interval in the
    suffix array), -1 where the stretch is the only one of its kind or passes the end.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = words
        self.rank: list[np.ndarray] = []
        self.size: list[np.ndarray] = []
        self.order = np.empty(0, np.int64)
        cls, at = _classes(words), np.arange(n)
        length = 1
        while length < BASE and len(at):  # pairs, fours, eights: only repeated halves can make a repeated whole
            at = at[cls[at] >= 0]
            at = at[at + length < n]
            at = at[cls[at + length] >= 0]
            key = cls[at] * np.int64(n + 1) + cls[at + length]
            cls = np.full(n, -1, np.int64)
            cls[at] = _classes(key)
            length *= 2
        at = np.flatnonzero(cls >= 0)
        at = at[np.argsort(cls[at], kind="stable")]
        self.order = at
        m = len(at)
        key = cls[at]
        while m:
            new = np.ones(m, bool)
            new[1:] = key[1:] != key[:-1]
            first = np.flatnonzero(new)
            sizes = np.diff(np.append(first, m))
            group = np.cumsum(new) - 1
            rank = np.full(n, -1, np.int32)
            size = sizes[group]
            repeated = size > 1
            if not repeated.any():
                break
            rank[at[repeated]] = first[group][repeated]
            self.rank.append(rank)
            self.size.append(np.where(repeated, size, 0))
            # The next class: by the class of the half that follows; a half without a twin is a class of its own.
            after = at + length
            half = np.where(after < n, rank[np.minimum(after, n - 1)], -1).astype(np.int64)
            key = first[group] * np.int64(n + m + 2) + np.where(half >= 0, half, m + at)
            sort = np.argsort(key, kind="stable")
            at, key = at[sort], key[sort]
            length *= 2
        self.order = at

    def same(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words from i and from j on that are equal."""
        out = np.zeros(len(i), np.int64)
        n = len(self.words)
        for k in range(len(self.rank) - 1, -1, -1):
            a, b = np.minimum(i + out, n - 1), np.minimum(j + out, n - 1)
            r = self.rank[k][a]
            out += np.where((i + out < n) & (j + out < n) & (r >= 0) & (r == self.rank[k][b]), BASE << k, 0)
        return self._by_word(i, j, out, 1)

    def same_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words before i and before j that are equal."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            a, b = i - out - (BASE << k), j - out - (BASE << k)
            r = self.rank[k][np.maximum(a, 0)]
            out += np.where((a >= 0) & (b >= 0) & (r >= 0) & (r == self.rank[k][np.maximum(b, 0)]), BASE << k, 0)
        return self._by_word(i, j, out, -1)

    def _by_word(self, i: np.ndarray, j: np.ndarray, out: np.ndarray, step: int) -> np.ndarray:
        n, live = len(self.words), np.ones(len(i), bool)
        for _ in range(BASE):
            a, b = (i + out, j + out) if step > 0 else (i - out - 1, j - out - 1)
            live = live & (a >= 0) & (b >= 0) & (a < n) & (b < n)
            live = live & (self.words[np.clip(a, 0, n - 1)] == self.words[np.clip(b, 0, n - 1)])
            out = out + live
        return out


def _classes(key: np.ndarray) -> np.ndarray:
    """A number for each key that occurs more than once, in key order; -1 for the others."""
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    return np.where(count[inverse] > 1, inverse, -1).astype(np.int64)


class Wavelet:
    """A wavelet matrix over an array: values by bits, from the highest on, with counts of zeros."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros: list[np.ndarray] = []
        now = values.astype(np.int64)
        for b in range(self.bits - 1, -1, -1):
            one = (now >> b) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one, dtype=np.int32)]))
            now = np.concatenate([now[~one], now[one]])

    def below(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values of [left, right) are under the limit."""
        out = np.zeros(len(left), np.int64)
        all_of = limit >= 1 << self.bits
        out[all_of] = (right - left)[all_of]
        limit = np.where(all_of, 0, np.maximum(limit, 0))
        for zero, b in zip(self.zeros, range(self.bits - 1, -1, -1), strict=True):
            l0, r0 = zero[left], zero[right]
            one = (limit >> b) & 1 == 1
            out += np.where(one, r0 - l0, 0)
            left, right = np.where(one, zero[-1] + left - l0, l0), np.where(one, zero[-1] + right - r0, r0)
        return out

    def smallest(self, left: np.ndarray, right: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth smallest value (from 0) of [left, right)."""
        out = np.zeros(len(left), np.int64)
        for zero, b in zip(self.zeros, range(self.bits - 1, -1, -1), strict=True):
            l0, r0 = zero[left], zero[right]
            one = nth >= r0 - l0
            nth = np.where(one, nth - (r0 - l0), nth)
            out += np.where(one, 1 << b, 0)
            left, right = np.where(one, zero[-1] + left - l0, l0), np.where(one, zero[-1] + right - r0, r0)
        return out


def _candidates(f: Factors) -> tuple[np.ndarray, np.ndarray]:
    """(block, period) of every run, among others."""
    tree = Wavelet(f.order)
    place = np.empty(len(f.words), np.int64)
    place[f.order] = np.arange(len(f.order))
    blocks, periods = [], []
    for k, rank in enumerate(f.rank):
        length = BASE << k
        at = np.arange(0, len(rank), length)
        at = at[rank[at] >= 0]
        left = rank[at].astype(np.int64)
        right = left + f.size[k][left]
        for lo, hi in ([(1, length)] if k == 0 else []) + [(length, 2 * length)]:
            before = tree.below(left, right, at + lo)
            m = tree.below(left, right, at + hi) - before
            b, l, r, before, m = (x[m > 0] for x in (at, left, right, before, m))
            if not len(b):
                continue
            first = tree.smallest(l, r, before)
            two = m >= 2
            second = first.copy()
            second[two] = tree.smallest(l[two], r[two], before[two] + 1)
            few = m <= 2
            blocks += [b[few], b[two & few]]
            periods += [(first - b)[few], (second - b)[two & few]]
            many = ~few
            if many.any():
                b, first, d = b[many], first[many], (second - first)[many]
                s0, e0 = _stretch(f, b, d)
                s1, e1 = _stretch(f, first, d)
                # A stretch that holds both: its own period is the only one that can be the smallest.
                blocks += [b, b]
                periods += [np.where(s0 == s1, d, s1 - s0), np.where(s0 == s1, d, e1 - e0)]
    if not blocks:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(blocks), np.concatenate(periods)


def _stretch(f: Factors, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the longest stretch around each place that keeps the period."""
    return at - f.same_before(at, at + period), at + period + f.same(at, at + period)


def find_runs(words: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs, by start, then period. ``words``: numbers; equal ones are equal words of one text."""
    f = Factors(words)
    at, period = _candidates(f)
    at, period = at[period > 0], period[period > 0]
    if not len(at):
        return np.empty((0, 3), np.int64)
    start, end = _stretch(f, at, period)
    length = end - start
    good = (length >= LEAST) & (length >= PERIODS * period) & (start <= at) & (at < end)
    start, length, period = start[good], length[good], period[good]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    out = np.stack([start[new], length[new], period[new]], 1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of all words, a bounded stretch of bytes at a time (a longer word is a stretch of its own)."""
    out = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + SLICE_BYTES)))
        lo, hi = start[a], end[b - 1]
        out[a:b] = C.word_hashes(data[lo:hi], start[a:b] - lo, end[a:b] - lo)
        a = b
    return out


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) of the copy that the contract plants into a text, if any."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _source(doc_ids: list, first: np.ndarray, plant: bool) -> np.ndarray:
    """For each word of the slice, the word that stands there once periods are planted."""
    at = np.arange(first[-1])
    for d, doc_id in enumerate(doc_ids if plant else []):
        p = planted(doc_id, int(first[d + 1] - first[d]))
        if p is not None:
            a = first[d] + p[0]
            at[a:first[d + 1]] = a + np.arange(first[d + 1] - a) % p[1]
    return at


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> list[bytes]:
    """For each text, its words joined by one space."""
    size = end - start + 1
    edge = np.concatenate([[0], np.cumsum(size)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        parts = []
        while a < b:  # a bounded stretch at a time
            c = min(b, max(a + 1, int(np.searchsorted(edge, edge[a] + SLICE_BYTES))))
            raw = data[np.minimum(np.arange(edge[c] - edge[a]) + np.repeat(start[a:c] - (edge[a:c] - edge[a]), size[a:c]), len(data) - 1)]
            raw[edge[a + 1:c + 1] - edge[a] - 1] = 0x20
            parts.append(raw.tobytes())
            a = c
        out.append(b"".join(parts)[:-1])
    return out


_OUT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
                  ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("n_words", pa.int64()), ("n_dropped", pa.int64())])
OUT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long"


def _slice_runs(chunk: pa.RecordBatch, plant: bool):
    """(doc_ids, data, start, end, first, runs by text, kept): runs and kept words of the texts of one slice."""
    doc_ids = chunk.column("doc_id").to_pylist()
    data, offsets = C.text_buffer(chunk.column("text"))
    start, end, first = C.word_spans(data, offsets)
    at = _source(doc_ids, first, plant)
    owner = np.repeat(np.arange(len(doc_ids), dtype=np.uint64), np.diff(first))
    words = C.mix(_word_hashes(data, start, end)[at] ^ C.mix(owner * np.uint64(0x9E3779B97F4A7C15)))
    runs = find_runs(words)
    kept = np.ones(len(at), bool)
    if len(runs):
        depth = np.zeros(len(at) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        kept = np.cumsum(depth)[:-1] == 0
    by_text = np.searchsorted(runs[:, 0], first)
    runs[:, 0] -= first[np.searchsorted(first, runs[:, 0], side="right") - 1]
    return doc_ids, data, start[at], end[at], first, [runs[a:b] for a, b in zip(by_text[:-1], by_text[1:], strict=True)], kept


def _digests(plant: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in C.table(batches):
            for chunk in C.text_chunks(batch, SLICE_BYTES):
                doc_ids, data, start, end, first, runs, kept = _slice_runs(chunk, plant)
                rest = np.concatenate([[0], np.cumsum(kept)])[first]
                texts = _joined(data, start[kept], end[kept], rest)
                rows = []
                for doc_id, n, left, found, text in zip(doc_ids, np.diff(first).tolist(), np.diff(rest).tolist(), runs, texts, strict=True):
                    top, sha = (None,) * 4, nothing
                    if len(found):
                        listed = found.tolist()
                        s, size, p = max(listed, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
                        top = (s, size, p, 1000 * size // p)
                        sha = hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in listed).encode()).hexdigest()
                    rows.append((doc_id, len(found), *top, sha, hashlib.sha256(text).hexdigest(), n, n - left))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _OUT.types, strict=True)], schema=_OUT)
    return run


def run_digests(docs: DataFrame, plant: bool = True) -> DataFrame:
    """One row per row of ``docs``: its number of runs, the strongest one, and digests of all runs and of the text without repeats."""
    return C.id_and_text(docs).mapInArrow(_digests(plant), OUT)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in C.table(batches):
        for chunk in C.text_chunks(batch, SLICE_BYTES):
            doc_ids, _, _, _, _, runs, _ = _slice_runs(chunk, False)
            ids = [i for i, found in zip(doc_ids, runs, strict=True) for _ in range(len(found))]
            rows = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(rows[:, k]) for k in range(3)]], names=["doc_id", "start", "length", "period"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, period): every run of every text as it stands."""
    return C.id_and_text(docs).mapInArrow(_listed, "doc_id long, start long, length long, period long")


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in C.table(batches):
        for chunk in C.text_chunks(batch, SLICE_BYTES):
            _, data, start, end, first, _, kept = _slice_runs(chunk, False)
            rest = np.concatenate([[0], np.cumsum(kept)])[first]
            texts = [t.decode() for t in _joined(data, start[kept], end[kept], rest)]
            null = chunk.column("text").is_null().to_pylist()
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array([None if x else t for t, x in zip(texts, null, strict=True)], pa.string())], names=["doc_id", "text"])


def collapsed(docs: DataFrame) -> DataFrame:
    """(doc_id, text): words joined by one space, without the words of a run behind its first period; a null text stays null."""
    return C.id_and_text(docs).mapInArrow(_collapse, "doc_id long, text string")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(C.documents(spark, sf_dir))
