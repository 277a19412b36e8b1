"""Substring dedup by recompression: remove word windows that an earlier document already has.

A window is 13 consecutive words of one document. A word goes when it lies in a window
whose word sequence also starts in a document with a smaller doc_id.

Recompression: symbols start as words. The first of two rounds names maximal runs of one
symbol; each round names pairs: every symbol falls on the left or the right side by a bit of its name, and each
neighbouring (left, right) pair becomes one symbol. Names are 64-bit hashes of what they
stand for, so all tasks give the same content the same name without a shared dictionary.
With each symbol goes the span of words that decide it; inside equal windows, symbols
whose deciding span lies in the window are equal in every document.
Symbols only say where windows meet; matches are decided by hashes of the windows.

1. Map: each window takes the highest-level symbol decided inside it, of several the one
   with the largest name (a function of the window's words alone, so equal windows
   always choose alike). Neighbouring windows with the same symbol share one row: the
   symbol's key, the document, the first window, and the 64-bit hash of each window. Rows
   travel packed, one value for each bucket of keys.
   A pass before it finds the keys under which a large share of all windows meet (mergeable
   summaries of bounded size, over all texts): their windows meet by their own hash instead,
   so no frequent word or footer brings its windows to one task.
2. Rows meet by key, sorted by document; windows equal in key and hash are the same
   words. Where the first document that has one is smaller, the window's words are marked.
   The stream keeps only the distinct windows of the current key, in sorted runs that merge
   as they grow, so its time is that of a sort.
3. Marked spans go back to their documents by doc_id, each with a check of its windows: a row
   takes the spans whose windows stand at the same words of its own text.

Defined cases: null text has no words; documents under 13 words keep all; rows with equal
doc_id do not remove each other, and each loses what its own text repeats; a null doc_id is neither
removed from nor compared; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C

WINDOW = 13
ROUNDS = 2
TAG_BYTES = 8
PACKED_ROWS = 128      # anchor rows of one packed row, about
HELD_ROWS = 1 << 20    # anchor rows that a task holds before it packs them
UNPACK = 64            # packed rows unpacked together
SEGMENT = 1 << 16      # windows whose symbols are held at a time; a long text is no more than its segments
_FAR = 1 << 40  # a deciding span that reaches past the text's end


class Level:
    """Symbols of one level in text order: name, words [lo, hi), deciding words [dlo, dhi), owner text."""

    def __init__(self, name, lo, hi, dlo, dhi, owner):
        self.name, self.lo, self.hi, self.dlo, self.dhi, self.owner = name, lo, hi, dlo, dhi, owner

    def same_text(self) -> np.ndarray:
        """Whether symbol i and i+1 belong to one text."""
        return self.owner[1:] == self.owner[:-1]


def words_level(words: np.ndarray, owner: np.ndarray) -> Level:
    at = np.arange(len(words), dtype=np.int64)
    return Level(words, at, at + 1, at, at + 1, owner)


def _neighbours(s: Level) -> tuple[np.ndarray, np.ndarray]:
    """Start of the left and end of the right neighbour's deciding span; far away at a text's ends."""
    left = np.full(len(s.name), -_FAR)
    right = np.full(len(s.name), _FAR)
    same = s.same_text()
    left[1:] = np.where(same, s.dlo[:-1], -_FAR)
    right[:-1] = np.where(same, s.dhi[1:], _FAR)
    return left, right


def name_runs(s: Level) -> Level:
    """Each maximal run of one symbol becomes one symbol, named by the symbol and the run's length."""
    if not len(s.name):
        return s
    new = np.ones(len(s.name), dtype=bool)
    new[1:] = (s.name[1:] != s.name[:-1]) | ~s.same_text()
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(s.name)))
    last = begin + length - 1
    left, right = _neighbours(s)
    name = np.where(length > 1, C.mix(s.name[begin] * np.uint64(0x9FB21C651E98DF25) + length.astype(np.uint64)), s.name[begin])
    return Level(name, s.lo[begin], s.hi[last], np.minimum(np.minimum.reduceat(s.dlo, begin), left[begin]),
                 np.maximum(np.maximum.reduceat(s.dhi, begin), right[last]), s.owner[begin])


def name_pairs(s: Level, level: int) -> Level:
    """Each neighbouring pair of a left and a right symbol becomes one symbol; the side is a bit of the name."""
    if len(s.name) < 2:
        return s
    is_right = (C.mix(s.name + np.uint64(level)) & np.uint64(1)).astype(bool)
    pair = np.zeros(len(s.name), dtype=bool)
    pair[:-1] = ~is_right[:-1] & is_right[1:] & s.same_text()
    second = np.zeros(len(s.name), dtype=bool)
    second[1:] = pair[:-1]
    left, right = _neighbours(s)
    # A left symbol stays alone because of what follows it, a right symbol because of what stands before it.
    dlo = np.where(is_right, np.minimum(s.dlo, left), s.dlo)
    dhi = np.where(is_right, s.dhi, np.maximum(s.dhi, right))
    keep = np.flatnonzero(~second)
    p = pair[keep]
    mate = np.minimum(keep + 1, len(s.name) - 1)
    name = np.where(p, C.mix(s.name[keep] * np.uint64(0xA24BAED4963EE407) + s.name[mate]), s.name[keep])
    return Level(name, s.lo[keep], np.where(p, s.hi[mate], s.hi[keep]),
                 np.where(p, np.minimum(s.dlo[keep], s.dlo[mate]), dlo[keep]),
                 np.where(p, np.maximum(s.dhi[keep], s.dhi[mate]), dhi[keep]), s.owner[keep])


def recompress(words: np.ndarray, owner: np.ndarray, rounds: int = ROUNDS) -> list[Level]:
    """The symbols of every level, words first; ``owner`` is the text of each word."""
    levels = [words_level(words, owner)]
    for r in range(rounds):
        s = levels[-1]
        levels.append(name_pairs(name_runs(s) if r == 0 else s, r))
    return levels


def choose_symbols(levels: list[Level], at: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each window start ``at``: the level, name and deciding span of its symbol."""
    open_ = np.zeros(n_words + 1, dtype=bool)
    open_[at] = True
    level = np.zeros(n_words + 1, np.int64)
    index = np.zeros(n_words + 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        s = levels[k]
        usable = np.flatnonzero(s.dhi - s.dlo <= WINDOW)
        if k < len(levels) - 1 and len(usable):  # only near windows that still lack a symbol
            waiting = np.concatenate([[0], np.cumsum(open_)])
            a = np.maximum(s.dhi[usable] - WINDOW, 0)
            b = np.minimum(s.dlo[usable], n_words)
            usable = usable[waiting[b + 1] > waiting[np.minimum(a, b + 1)]]
        if not len(usable):
            continue
        a, b = np.maximum(s.dhi[usable] - WINDOW, 0), s.dlo[usable]
        count = b - a + 1
        where = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(a, count)
        who = np.repeat(usable, count)
        ok = open_[where]
        where, who = where[ok], who[ok]
        rank = C.mix(s.name[who] ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
        best = np.zeros(n_words + 1, np.uint64)
        np.maximum.at(best, where, rank)
        won = best[where] == rank
        where, who = where[won], who[won]
        index[where[::-1]] = who[::-1]  # of equal names the leftmost
        level[where] = k
        open_[where] = False
    lv, ix = level[at], index[at]
    name, dlo, dhi = np.empty(len(at), np.uint64), np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    for k, s in enumerate(levels):
        m = np.flatnonzero(lv == k)
        name[m], dlo[m], dhi[m] = s.name[ix[m]], s.dlo[ix[m]], s.dhi[ix[m]]
    return lv, name, dlo, dhi


def _span_hash(words: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the words [lo, hi), wherever they stand."""
    up = C._power_table("up", C._BASE, len(words) + 1)
    down = C._power_table("down", pow(C._BASE, -1, 1 << 64), len(words) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[:-1])])
    return C.mix((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def anchor_segments(chunk: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows (key, doc_id, start, tags) of a chunk's windows, SEGMENT windows at a time.

    A window's symbol depends on its own words alone, so it is the same wherever segments are cut.
    """
    data, offsets = C.text_buffer(chunk.column("text"))
    start, end, first = C.word_spans(data, offsets)
    words = C.word_hashes(data, start, end)
    del data, start, end
    owner, at = C.window_starts(first, WINDOW)
    ids = np.asarray(chunk.column("doc_id").fill_null(0), dtype=np.int64)
    if len(at):
        valid = np.asarray(chunk.column("doc_id").is_valid())
        if not valid.all():
            owner, at = owner[valid[owner]], at[valid[owner]]
    for k in range(0, len(at), SEGMENT):
        own, begin = owner[k:k + SEGMENT], at[k:k + SEGMENT]
        lo, hi = int(begin[0]), int(begin[-1]) + WINDOW
        texts = np.searchsorted(first, np.arange(lo, hi), side="right") - 1
        yield _anchors(words[lo:hi], texts, own, begin - lo, begin - first[own], ids)


def anchor_rows(chunk: pa.RecordBatch) -> pa.RecordBatch:
    """All of a chunk's rows."""
    parts = list(anchor_segments(chunk))
    return pa.concat_batches(parts) if parts else pa.RecordBatch.from_pylist([], schema=_ANCHORS)


def _anchors(words: np.ndarray, texts: np.ndarray, owner: np.ndarray, at: np.ndarray, place: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """Rows of the windows at the words ``at``; ``owner`` and ``place``: each window's text and its first word there."""
    lv, name, dlo, dhi = choose_symbols(recompress(words, texts), at, len(words))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (dlo[1:] != dlo[:-1]) | (dhi[1:] != dhi[:-1]) | (name[1:] != name[:-1]) | (lv[1:] != lv[:-1])
    begin = np.flatnonzero(new)
    key = C.mix(_span_hash(words, dlo[begin], dhi[begin]) + name[begin] * np.uint64(3) + lv[begin].astype(np.uint64))
    # Neighbouring windows under one key need one row, also where the symbol moves on: a long run of one word.
    new = np.ones(len(begin), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[begin[1:]] != owner[begin[:-1]])
    begin, key = begin[new], key[new]
    tags = C.window_hashes(words, WINDOW)[at]
    raw = tags.tobytes()
    cuts = np.append(begin, len(at)) * TAG_BYTES
    binary = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(raw)])
    return pa.RecordBatch.from_arrays([pa.array(C.signed(key)), pa.array(ids[owner[begin]]), pa.array(place[begin].astype(np.int32)), binary], schema=_ANCHORS)


_ANCHORS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()), ("tags", pa.binary())])
_SPANS = pa.schema([("doc_id", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("check", pa.int64())])


def _window_checks(tags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What a window adds to the check of a span: a function of its words and its place."""
    return C.mix(tags + at.astype(np.uint64) * np.uint64(0x9E6C63D0876A9A47))


class Rows:
    """Anchor rows as arrays; row i has ``count[i]`` windows in a row, their hashes one after another in ``tag``."""

    def __init__(self, key: np.ndarray, doc: np.ndarray, start: np.ndarray, count: np.ndarray, tag: np.ndarray):
        self.key, self.doc, self.start, self.count, self.tag = key, doc, start, count, tag

    @staticmethod
    def of(batch: pa.RecordBatch) -> Rows:
        tags = batch.column("tags")
        cuts = np.frombuffer(tags.buffers()[1], np.int32)[tags.offset:tags.offset + len(tags) + 1].astype(np.int64)
        tag = np.frombuffer(tags.buffers()[2], np.uint8)[cuts[0]:cuts[-1]].view(np.uint64)
        key, doc, start = (batch.column(c).to_numpy() for c in ("key", "doc_id", "start"))
        return Rows(key, doc, start, np.diff(cuts) // TAG_BYTES, tag)

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        return Rows(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("key", "doc", "start", "count", "tag")))

    def batch(self) -> pa.RecordBatch:
        cuts = np.append(0, np.cumsum(self.count)) * TAG_BYTES
        tags = pa.Array.from_buffers(pa.binary(), len(self.key), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(self.tag))])
        return pa.RecordBatch.from_arrays([pa.array(self.key), pa.array(self.doc), pa.array(self.start), tags], schema=_ANCHORS)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, place in the row) of each window."""
        row = np.repeat(np.arange(len(self.key)), self.count)
        return row, np.arange(len(row)) - np.repeat(np.cumsum(self.count) - self.count, self.count)

    def take(self, order: np.ndarray) -> Rows:
        first, count = (np.cumsum(self.count) - self.count)[order], self.count[order]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        return Rows(self.key[order], self.doc[order], self.start[order], count, self.tag[at])

    def split(self, hot: np.ndarray) -> Rows:
        """Each window of a row under one of the ``hot`` keys (sorted) becomes a row under a key of its own words."""
        if not len(hot) or not len(self.key):
            return self
        at = np.minimum(np.searchsorted(hot, self.key), len(hot) - 1)
        is_hot = hot[at] == self.key
        parts = np.where(is_hot, self.count, 1)
        row = np.repeat(np.arange(len(self.key)), parts)
        place = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        first = (np.cumsum(self.count) - self.count)[row] + place
        own = C.signed(C.mix(self.tag[first] ^ np.uint64(0x2545F4914F6CDD1D)))
        return Rows(np.where(is_hot[row], own, self.key[row]), self.doc[row], (self.start[row] + place).astype(np.int32),
                    np.where(is_hot[row], 1, self.count[row]), self.tag)


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
    for batch in C.table(batches):
        for chunk in C.text_chunks(batch):
            yield from (Rows.of(rows) for rows in anchor_segments(chunk))


def _frequent(size: int):
    """A summary of a task's keys with their numbers of windows, each too low by a ``size``-th of all at most; the row without a key has the total."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, total = np.empty(0, np.int64), np.empty(0, np.int64), 0
        for rows in _chunk_rows(batches):
            total += len(rows.tag)
            keys, at = np.unique(np.concatenate([keys, rows.key]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, rows.count]), minlength=len(keys)).astype(np.int64)
            if len(keys) > size:
                counts = counts - np.partition(counts, len(counts) - size - 1)[len(counts) - size - 1]
                keys, counts = keys[counts > 0], counts[counts > 0]
        yield pa.RecordBatch.from_arrays([pa.array([None, *keys.tolist()], pa.int64()), pa.array([total, *counts.tolist()], pa.int64())], names=["key", "n"])
    return run


def hot_keys(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted keys with a ``size``-th of all windows or more; all with twice that share are found, at most ``size`` come back."""
    parts = C.id_and_text(docs).mapInArrow(C.freeing(_frequent(size)), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    parts = C.materialise(parts, "window-keys")
    n = parts.where("key IS NULL").agg(F.sum("n")).first()[0] or 0
    return np.sort(np.array([r["key"] for r in parts.where(F.col("key").isNotNull() & (F.col("n") * size >= n)).collect()], np.int64))


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _packed(buckets: int, hot: np.ndarray):
    """One row per bucket of keys for many anchor rows: keys and hashes as they are, documents, starts and counts compressed."""
    def rows(parts: list[Rows]) -> Iterator[pa.RecordBatch]:
        r = Rows.joined(parts)
        bucket = (C.mix(r.key.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        r, bucket = r.take(order), bucket[order]
        a = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        b = np.append(a[1:], len(bucket))
        window = np.append(0, np.cumsum(r.count))
        press = zstandard.ZstdCompressor(level=1).compress
        places = [press(_planes(np.concatenate([np.diff(r.doc[i:j], prepend=0), r.start[i:j], r.count[i:j]]))) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        cut = lambda values, edges: [values[i:j].tobytes() for i, j in zip(edges[0].tolist(), edges[1].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[a].astype(np.int32)), pa.array(cut(r.key, (a, b)), pa.binary()), pa.array(places, pa.binary()),
                                          pa.array(cut(r.tag, (window[a], window[b])), pa.binary())], names=["bucket", "keys", "places", "tags"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for part in _chunk_rows(batches):
            parts.append(part.split(hot))
            n += len(parts[-1].key)
            if n >= min(PACKED_ROWS * buckets, HELD_ROWS):
                yield from rows(parts)
                parts, n = [], 0
        if parts:
            yield from rows(parts)
    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor().decompress
    for batch in C.table(batches):
        for a in range(0, batch.num_rows, UNPACK):
            parts = []
            for keys, places, tags in zip(*(batch.column(c).slice(a, UNPACK).to_pylist() for c in ("keys", "places", "tags")), strict=True):
                key = np.frombuffer(keys, np.int64)
                doc, start, count = np.frombuffer(press(places), np.uint8).reshape(8, -1).T.copy().view(np.int64).reshape(3, len(key))
                parts.append(Rows(key, np.cumsum(doc), start.astype(np.int32), count, np.frombuffer(tags, np.uint64)))
            yield Rows.joined(parts).batch()


class Seen:
    """The distinct windows of one key and the smallest document of each, in sorted runs that at least double in size."""

    def __init__(self, key: int | None):
        self.key, self.runs = key, []

    def documents(self, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether seen, document) of each window."""
        seen, doc = np.zeros(len(tag), dtype=bool), np.zeros(len(tag), np.int64)
        for tags, docs in self.runs:
            at = np.minimum(np.searchsorted(tags, tag), len(tags) - 1)
            hit = tags[at] == tag
            seen |= hit
            doc[hit] = docs[at[hit]]
        return seen, doc

    def add(self, tag: np.ndarray, doc: np.ndarray) -> None:
        """Windows not seen before, in ascending order."""
        if len(tag):
            self.runs.append((tag, doc))
        while len(self.runs) > 1 and len(self.runs[-2][0]) < 2 * len(self.runs[-1][0]):
            tags, docs = (np.concatenate(c) for c in zip(self.runs[-2], self.runs[-1], strict=True))
            order = np.argsort(tags, kind="stable")
            self.runs[-2:] = [(tags[order], docs[order])]


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of words in windows that a smaller document has, from rows sorted by (key, doc_id)."""
    seen = Seen(None)
    for batch in C.table(batches):
        rows = Rows.of(batch)
        key, doc, tag = rows.key, rows.doc, rows.tag
        row, place = rows.windows()
        at = rows.start[row] + place
        group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        g, w_doc = group[row], doc[row]
        order = np.lexsort((np.arange(len(tag)), tag, g))  # equal windows in the order of documents
        new = np.ones(len(order), dtype=bool)
        new[1:] = (g[order[1:]] != g[order[:-1]]) | (tag[order[1:]] != tag[order[:-1]])
        first = order[new]  # of each distinct window, by (group, tag)
        least = w_doc[first].copy()
        old = np.zeros(len(first), dtype=bool)
        if seen.key == key[0]:
            carried = int(np.searchsorted(g[first], 1))
            old[:carried], earlier = seen.documents(tag[first[:carried]])
            least[:carried] = np.where(old[:carried], earlier, least[:carried])
        else:
            seen = Seen(key[0])
        if key[-1] != seen.key:
            seen = Seen(key[-1])
        last = (g[first] == group[-1]) & ~old
        seen.add(tag[first[last]], least[last])
        later = np.zeros(len(order), dtype=bool)
        later[order] = w_doc[order] > least[np.cumsum(new) - 1]
        hit = np.flatnonzero(later)
        if len(hit):
            r, p = row[hit], at[hit]
            cut = np.ones(len(hit), dtype=bool)
            cut[1:] = (r[1:] != r[:-1]) | (p[1:] != p[:-1] + 1)
            a = np.flatnonzero(cut)
            b = np.append(a[1:], len(hit)) - 1
            check = np.add.reduceat(_window_checks(tag[hit], p), a)
            yield pa.RecordBatch.from_arrays([pa.array(doc[r[a]]), pa.array(p[a].astype(np.int32)),
                                              pa.array((p[b] + WINDOW).astype(np.int32)), pa.array(C.signed(check))], schema=_SPANS)


def repeated_spans(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(doc_id, spans): for each doc_id with repeated windows, the word spans [a, b) to remove and their checks, unordered and overlapping.

    ``buckets`` should grow with the data; four for each of the session's shuffle partitions by default.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = C.id_and_text(docs).mapInArrow(C.freeing(_packed(buckets, hot_keys(docs, buckets))), "bucket int, keys binary, places binary, tags binary")
    rows = rows.repartition("bucket").mapInArrow(C.freeing(_unpacked), "key long, doc_id long, start int, tags binary").sortWithinPartitions("key", "doc_id")
    spans = rows.mapInArrow(C.freeing(_repeats), "doc_id long, a int, b int, check long")
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b", "check")).alias("spans"))


def _removed(text: str, spans: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(start of each word, whether it goes): spans of another text under the same doc_id do not count."""
    data, offsets = C.text_buffer(pa.array([text]))
    start, end, _ = C.word_spans(data, offsets)
    n = len(start)
    tags = C.window_hashes(C.word_hashes(data, start, end), WINDOW)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_window_checks(tags, np.arange(len(tags))), dtype=np.uint64)])
    a, b, check = (np.array([s[k] for s in spans], np.int64) for k in ("a", "b", "check"))
    inside = b <= n
    a, b, check = a[inside], b[inside], check[inside]
    own = C.signed(total[b - WINDOW + 1] - total[a]) == check
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, a[own], 1)
    np.add.at(depth, b[own], -1)
    return start, np.cumsum(depth)[:n] > 0


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (chunk for whole in C.table(batches) for chunk in C.text_chunks(whole)):
        n_words, n_removed, sha = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            words = (text.as_py() or "").encode().split()
            kept = words
            if spans.is_valid:
                _, gone = _removed(text.as_py() or "", spans.as_py())
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                          pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row."""
    spans = repeated_spans(docs)
    return (C.id_and_text(docs).join(spans, "doc_id", "left").select("doc_id", "text", "spans")
            .mapInArrow(C.freeing(_digests), "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def _cut_texts(spans_name: str, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (chunk for whole in C.table(batches) for chunk in C.text_chunks(whole)):
            texts = []
            for text, spans in zip(batch.column("text"), batch.column(spans_name), strict=True):
                text = text.as_py()
                if text is not None and spans.is_valid:
                    start, gone = _removed(text, spans.as_py())
                    raw = text.encode()
                    edge = np.append(start, len(raw))
                    # A word goes with the space behind it, so lines between kept words stay.
                    text = (raw[:edge[0]] + b"".join(raw[edge[i]:edge[i + 1]] for i in np.flatnonzero(~gone))).decode()
                    text = None if len(gone) and gone.all() else text
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if k == "text" else batch.column(k) for k in kept]
            lost = [t is None and batch.column("text")[i].is_valid for i, t in enumerate(texts)]
            yield pa.RecordBatch.from_arrays(columns, names=kept).filter(pa.array([not x for x in lost], pa.bool_()))
    return run


def without_repeats(docs: DataFrame) -> DataFrame:
    """Pipeline stage: ``docs`` with repeated windows cut out of ``text`` (and ``n_chars`` counted anew); rows left without a word go.
    Columns of any name come back as they were."""
    own = lambda name: next(n for n in (name + "_" * k for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    id_name, spans_name = own("__id"), own("__spans")
    spans = repeated_spans(docs).select(F.col("doc_id").alias(id_name), F.col("spans").alias(spans_name))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    cut = docs.withColumn(id_name, F.col("doc_id").cast("long")).join(spans, id_name, "left")
    cut = cut.select(*docs.columns, spans_name).mapInArrow(C.freeing(_cut_texts(spans_name, docs.columns)), schema)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(C.documents(spark, sf_dir))
