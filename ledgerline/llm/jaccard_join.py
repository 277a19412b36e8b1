"""N-gram Jaccard join over a count-vector R-tree: near-duplicate documents by five-word shingles.

Words are runs of non-space bytes after lower-casing A-Z. A document's set holds its
distinct five-word shingles (64-bit hashes); with one to four words it is the whole
sequence as one shingle. Two documents link when ``100 * |A & B| >= 80 * |A | B|``.

Steps, each a Spark job over written tables:

1. One pass over the texts gives each document's set size and its class (a distinct set).
   Exact copies meet in the class.
2. A linked set shares at least 0.8 of its shingles with one other set. A pass over one text of
   each class sends shingles, shortened and packed, to buckets that tell which of them two
   classes have; classes with fewer such shingles are closed. The others' documents are set in
   a bitmap, and the next steps read only those. Wherever something is not sure (shortened
   hashes, the bitmap, repeated ids), a class stays open.
3. A pass over the open texts gives the point of each class: its tokens hashed into groups, and
   the counts of the groups. The pass also counts shingles in a table of fixed size.
4. A further pass emits, once per class and task, the shingles that a partner must share
   with it: the ``n - ceil(0.8 n) + 1`` first ones, rarest counters first. Classes that share
   such a shingle, sorted by size, are candidates: with few classes each pair whose sizes fit
   (FEW bounds them), with more the chain of neighbours whose sizes fit, which connects
   whatever can be linked.
5. Pairs are bounded by their points: the sum of coordinate minima is the largest overlap
   they can have. What is left is joined into candidate components, outside of which there
   are no links.
6. Components larger than a block are first compared with one pivot class each. What links
   to the pivot is settled among itself; only the rest is searched against all blocks.
7. In each block the points are packed into an R-tree (sorted by size, then by the widest
   coordinate). A node's corner of largest counts bounds the overlap by the sum of coordinate
   minima; pairs that survive and are not yet connected are verified on the sets.
8. Components over the verified links.

Only links between classes that a block already connects are left out, which no component loses.

Defined cases: null or word-less text has an empty set and its own doc_id as component;
equal rows share a class; an empty table gives an empty result; a null doc_id keeps its row,
with the smallest non-null doc_id of its component.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm.graph import connected_components

WORDS = 5            # words of a shingle
NUM, DEN = 4, 9      # 100 * inter >= 80 * union  <=>  9 * inter >= 4 * (a + b)
CELLS = 1 << 22      # counters of the shingle order: 16 MB as 32-bit numbers, at any input size
CELL_ROW = 1 << 16   # counters of one row on their way
FEW = 8              # classes of a shingle that are paired; more are chained
BLOCK = 512          # classes of one block
LEAF = 16            # points of one R-tree leaf
LIST = 1 << 21       # shingles that are sent to the buckets at a time, and shingles of a bucket
MOST_BITS = 1 << 27  # of a bitmap of documents: 16 MB; with more documents it lets more through
BIT_ROW = 1 << 19    # bits of one row on their way


def shingle_sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash): the distinct shingles of each text of a chunk, sorted by (owner, hash)."""
    data, offsets = C.text_buffer(batch.column("text"))
    data = C.lower_ascii(data)
    start, end, first = C.word_spans(data, offsets)
    words = C.word_hashes(data, start, end)
    owner, at = C.window_starts(first, WORDS)
    h = C.window_hashes(words, WORDS)[at] if len(at) else np.empty(0, np.uint64)
    count = np.diff(first)
    for size in range(1, WORDS):
        few = np.flatnonzero(count == size)
        if len(few):
            owner = np.concatenate([owner, few])
            h = np.concatenate([h, C.window_hashes(words, size)[first[few]]])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    return owner[keep], h[keep]


def _classes(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = [xxhash.xxh64_intdigest(h[a:b].tobytes(), seed=int(b - a)) if b > a else 0
           for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return C.signed(np.array(out, dtype=np.uint64))


def _sets_with_bounds(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    owner, h = shingle_sets(chunk)
    bounds = np.searchsorted(owner, np.arange(chunk.num_rows + 1))
    return owner, h, bounds, _classes(h, bounds)


def groups_of(n: int) -> int:
    """Coordinates of a set of ``n`` tokens: about one for each dozen, so that points of unrelated sets lie apart. Powers of four times 64 fold into each other."""
    groups = 64
    while n >= 12.5 * groups and groups < 1 << 16:
        groups *= 4
    return groups


def point(s: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((s >> np.uint64(40)).astype(np.int64) % groups, minlength=groups)


def write_point(s: np.ndarray) -> bytes:
    counts = point(s, groups_of(len(s)))
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def read_point(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if len(data) == groups_of(n) else np.uint32).astype(np.int64)


def may_link(a: np.ndarray, n: int, b: np.ndarray, m: int) -> bool:
    """Whether the points leave room for a link of sets with ``n`` and ``m`` tokens."""
    groups = min(len(a), len(b))
    bound = np.minimum(a.reshape(-1, groups).sum(axis=0), b.reshape(-1, groups).sum(axis=0)).sum()
    return DEN * bound >= NUM * (n + m)


_SUMMARY = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64())])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in C.table(batches):
        for chunk in C.text_chunks(batch):
            _, _, bounds, cls = _sets_with_bounds(chunk)
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(cls)], schema=_SUMMARY)


def _slots(ids: np.ndarray, size: int) -> np.ndarray:
    return (C.mix(ids.astype(np.int64).view(np.uint64) + np.uint64(1)) & np.uint64(size - 1)).astype(np.int64)


def _bit_pieces(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.table(batches):
            slots = np.unique(_slots(batch.column("doc_id").to_numpy(), size))
            yield pa.RecordBatch.from_arrays([pa.array(slots // BIT_ROW), pa.array(slots % BIT_ROW)], names=["piece", "slot"])
    return run


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces: dict[int, np.ndarray] = {}  # MOST_BITS at most
    for batch in C.table(batches):
        piece, slot = batch.column("piece").to_numpy(), batch.column("slot").to_numpy()
        for k in np.unique(piece).tolist():
            if k not in pieces:
                pieces[k] = np.zeros(BIT_ROW // 8, np.uint8)
            mine = slot[piece == k]
            np.bitwise_or.at(pieces[k], mine >> 3, (1 << (mine & 7)).astype(np.uint8))
    for k, bits in pieces.items():
        yield pa.RecordBatch.from_pylist([{"piece": k, "bits": zlib.compress(bits.tobytes(), 1)}], schema=pa.schema([("piece", pa.int64()), ("bits", pa.binary())]))


def id_bits(ids: DataFrame, most: int) -> np.ndarray:
    """A bitmap of the hashed ``doc_id`` of up to ``most`` rows; it may hold others too. A null has no bit, see ``_held``."""
    size = min(MOST_BITS, max(BIT_ROW, 1 << (16 * most).bit_length()))
    pieces = ids.where("doc_id IS NOT NULL").select("doc_id").mapInArrow(C.freeing(_bit_pieces(size)), "piece long, slot long")
    bits = np.zeros(size // 8, np.uint8)
    for r in pieces.repartition("piece").mapInArrow(C.freeing(_set_bits), "piece long, bits binary").collect():
        bits[r["piece"] * BIT_ROW // 8:(r["piece"] + 1) * BIT_ROW // 8] = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return bits


def _held(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows whose doc_id is in the bitmap, or null."""
    for batch in C.table(batches):
        ids = batch.column("doc_id")
        slots = _slots(ids.fill_null(0).to_numpy(), 8 * len(bits))
        keep = ((bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1).astype(bool) | ids.is_null().to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(keep))


def _open_rows(opened) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _held(batches, opened.value)
    return run


def _planes(numbers: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, entropy-coded."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes())


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


# A row of a list and a bucket: numbers of the sets and differences of the sorted keys, ``total`` of them. A list's own row (bucket of its name): sizes
# and counts of its sets, their ids, and the total over all buckets. The same columns take the counts back: numbers of sets, counts.
_LISTS = pa.schema([("bucket", pa.int32()), ("list", pa.int64()), ("own", pa.bool_()), ("total", pa.int64()), ("at", pa.binary()), ("data", pa.binary())])
_LISTS_SQL = "bucket int, list long, own boolean, total long, at binary, data binary"


def _packed_list(sets: list[np.ndarray], ids: list[int | None], cls: list[int], key_bits: int, buckets: int) -> pa.RecordBatch:
    """Keys of a list of sets, by buckets. Keys of two sets of the list are counted here and sent once, under the number after the last set's."""
    n = np.array([len(s) for s in sets], np.int64)
    key = (np.concatenate(sets) >> np.uint64(64 - key_bits)).astype(np.int64)
    order = np.argsort(key)
    key, owner = key[order], np.repeat(np.arange(len(sets), dtype=np.int32), n)[order]
    same = key[1:] == key[:-1]
    shared, first = np.append(same, False), np.ones(len(key), dtype=bool)
    shared[1:] |= same
    first[1:] = ~same
    counts = np.bincount(owner[shared], minlength=len(sets))
    owner[shared] = len(sets)
    key, owner = key[first], owner[first]
    ids = [0 if i is None else i for i in ids]  # rows without an id are always held
    name = xxhash.xxh64_intdigest(np.array([cls, ids], np.int64).tobytes())
    name -= (name >> 63) << 64
    rows = [{"bucket": name % buckets, "list": name, "own": True, "total": len(key), "at": _planes(np.concatenate([n, counts])), "data": _planes(np.array(ids, np.int64))}]
    cut = np.searchsorted(key, -(-(np.arange(buckets + 1) << key_bits) // buckets)).tolist()
    for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        if b > a:
            rows.append({"bucket": k, "list": name, "own": False, "total": b - a, "at": _planes(owner[a:b]), "data": _planes(np.diff(key[a:b], prepend=0))})
    return pa.RecordBatch.from_pylist(rows, schema=_LISTS)


def _shingle_lists(shared, key_bits: int, buckets: int) -> Callable:
    """Shingles of one text of each class, cut to ``key_bits``, about LIST at a time, packed by buckets of keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, ids, classes, held = [], [], [], 0
        for batch in _held(batches, shared.value):
            for chunk in C.text_chunks(batch):
                _, h, bounds, cls = _sets_with_bounds(chunk)
                for a, b, i, c in zip(bounds[:-1].tolist(), bounds[1:].tolist(), chunk.column("doc_id").to_pylist(), cls.tolist(), strict=True):
                    if b > a:
                        sets.append(h[a:b])
                        ids.append(i)
                        classes.append(c)
                        held += b - a
                if held >= LIST:
                    yield _packed_list(sets, ids, classes, key_bits, buckets)
                    sets, ids, classes, held = [], [], [], 0
        if held:
            yield _packed_list(sets, ids, classes, key_bits, buckets)
    return run


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each list and bucket, how many keys of each set other sets have too."""
    for group in C.sorted_groups(batches, ["bucket"]):
        yield from group.filter(group.column("own")).to_batches()
        rows = group.filter(pc.invert(group.column("own"))).to_pylist()
        if not rows:
            continue
        key = np.concatenate([np.cumsum(_numbers(r["data"])) for r in rows])
        order = np.argsort(key)
        key = key[order]
        same = key[1:] == key[:-1]
        shared = np.zeros(len(key), dtype=bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        del key, order, same
        begin = 0
        for r in rows:
            mine = np.bincount(_numbers(r["at"])[shared[begin:begin + r["total"]]])
            begin += r["total"]
            r["at"], r["data"] = _planes(np.flatnonzero(mine)), _planes(mine[mine > 0])
        yield pa.RecordBatch.from_pylist(rows, schema=_LISTS)


def _open_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each list whose sets share at least 0.8 of their keys; all of a list whose rows do not make up its total (a task that ran twice, in another order)."""
    for group in C.sorted_groups(batches, ["list"]):
        rows = group.to_pylist()
        own = [r for r in rows if r["own"]]
        if not own:
            continue
        n, counts = _numbers(own[0]["at"]).reshape(2, -1)
        counts = np.append(counts, 0)
        for r in rows:
            if not r["own"]:
                counts[_numbers(r["at"])] += _numbers(r["data"])
        keep = 10 * counts[:-1] >= 8 * n
        if sum(r["total"] for r in own) != sum(r["total"] for r in rows if not r["own"]):
            keep[:] = True
        yield pa.RecordBatch.from_arrays([pa.array(_numbers(own[0]["data"])[keep])], names=["doc_id"])


def open_documents(docs: DataFrame, classes: DataFrame) -> np.ndarray:
    """A bitmap (see ``id_bits``) with a document of each class that can link: others have at least 0.8 of its shingles. ``classes``: rep, n."""
    spark = docs.sparkSession
    number, shingles = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    key_bits = min(48, max(16, math.ceil(math.log2(shingles + 1)) + 5))  # cut keys of different shingles seldom meet; if so, a class may stay open
    buckets = min(2048, shingles // LIST + 1)
    reps = spark.sparkContext.broadcast(id_bits(classes.select(F.col("rep").alias("doc_id")), number))
    lists = docs.mapInArrow(C.freeing(_shingle_lists(reps, key_bits, buckets)), _LISTS_SQL).repartition("bucket").sortWithinPartitions("bucket")
    lists = lists.mapInArrow(C.freeing(_shared_counts), _LISTS_SQL).repartition("list").sortWithinPartitions("list")
    return id_bits(C.materialise(lists.mapInArrow(C.freeing(_open_ids), "doc_id long"), "open"), number)


_POINTS = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])


def _points(shared) -> Callable:
    """Of the open texts: kind 0, the point of a class (``id``), once a task; kind 1, counters of shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = np.zeros(CELLS, dtype=np.uint32), set()
        for batch in _held(batches, shared.value):
            for chunk in C.text_chunks(batch):
                _, h, bounds, cls = _sets_with_bounds(chunk)
                np.add.at(cells, (h & np.uint64(CELLS - 1)).astype(np.int64), np.uint32(1))
                rows = []
                for a, b, c in zip(bounds[:-1].tolist(), bounds[1:].tolist(), cls.tolist(), strict=True):
                    if b > a and c not in seen:
                        seen.add(c)
                        rows.append({"kind": 0, "id": c, "n": b - a, "data": write_point(h[a:b])})
                yield pa.RecordBatch.from_pylist(rows, schema=_POINTS)
        for k in range(0, CELLS, CELL_ROW):
            row = cells[k:k + CELL_ROW]
            if row.any():
                yield pa.RecordBatch.from_pylist([{"kind": 1, "id": k // CELL_ROW, "n": 0, "data": zlib.compress(row.tobytes(), 1)}], schema=_POINTS)
    return run


def _add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}  # CELLS counters at most
    for batch in C.table(batches):
        for k, data in zip(batch.column("id").to_pylist(), batch.column("data").to_pylist(), strict=True):
            row = np.frombuffer(zlib.decompress(data), np.uint32).astype(np.uint64)
            total[k] = total[k] + row if k in total else row
    for k, row in total.items():
        row = np.minimum(row, np.uint64(0xFFFFFFFF)).astype(np.uint32)
        yield pa.RecordBatch.from_pylist([{"id": k, "data": zlib.compress(row.tobytes(), 1)}], schema=pa.schema([("id", pa.int64()), ("data", pa.binary())]))


def shingle_counters(seen: DataFrame) -> np.ndarray:
    """All documents' counters, added up by rows of CELL_ROW in the tasks; CELLS numbers reach the driver."""
    rows = seen.where("kind = 1").select("id", "data").repartition("id").mapInArrow(C.freeing(_add_cells), "id long, data binary").collect()
    cells = np.zeros(CELLS, dtype=np.uint32)
    for r in rows:
        part = cells[r["id"] * CELL_ROW:(r["id"] + 1) * CELL_ROW]
        part += np.frombuffer(zlib.decompress(r["data"]), np.uint32)
    return cells


def _prefixes(opened, shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = shared.value, set()
        for batch in _held(batches, opened.value):
            for chunk in C.text_chunks(batch):
                owner, h, bounds, cls = _sets_with_bounds(chunk)
                n = np.diff(bounds)
                fresh = np.zeros(chunk.num_rows, dtype=bool)
                for i, c in enumerate(cls.tolist()):
                    if n[i] and c not in seen:
                        seen.add(c)
                        fresh[i] = True
                keep = fresh[owner]
                owner, h = owner[keep], h[keep]
                rarity = cells[(h & np.uint64(CELLS - 1)).astype(np.int64)]
                order = np.lexsort((h, rarity, owner))
                owner, h = owner[order], h[order]
                begin = np.searchsorted(owner, np.arange(chunk.num_rows))
                length = n - (8 * n + 9) // 10 + 1
                keep = np.arange(len(owner)) - begin[owner] < length[owner]
                yield pa.RecordBatch.from_arrays([pa.array(C.signed(h[keep])), pa.array(n[owner[keep]].astype(np.int32)), pa.array(cls[owner[keep]])],
                                                 names=["key", "n", "cls"])
    return run


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sure", pa.bool_())])


def _bucket_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of rows sorted by (key, n, cls). Of a shingle that runs on past a batch, FEW rows and their number are held."""
    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)]
    held_key, before = None, 0  # rows of the held key that are no longer held
    for batch in _with_end(batches):
        if batch is None:
            key, n, cls = held
            done = len(key)
        else:
            key, n, cls = (np.concatenate([h, batch.column(c).to_numpy().astype(np.int64)]) for h, c in zip(held, ("key", "n", "cls"), strict=True))
            done = int(np.searchsorted(key, key[-1]))  # the last key may go on
        if not len(key):
            continue
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])  # a class once a shingle
        spill = len(key) - done > FEW
        if spill:
            done = len(key)
        keep = np.flatnonzero(new[:done])
        k, m, c = key[keep], n[keep], cls[keep]
        first = np.ones(len(k), dtype=bool)
        first[1:] = k[1:] != k[:-1]
        begin = np.flatnonzero(first)
        size = np.diff(np.append(begin, len(k)))
        if len(begin) and before and held_key == k[0]:
            size[0] += before
        if spill:
            size[-1] = max(size[-1], FEW + 1)
        size = np.repeat(size, np.diff(np.append(begin, len(k))))
        out = []
        for d in range(1, FEW):
            same = (k[d:] == k[:-d]) & (5 * m[:-d] >= 4 * m[d:]) & ((size[d:] <= FEW) | (d == 1))
            at = np.flatnonzero(same)
            if not len(at):
                continue
            out.append((c[at], c[at + d], size[at] > FEW))
        if out:
            a, b, sure = (np.concatenate(x) for x in zip(*out, strict=True))
            low, high = np.minimum(a, b), np.maximum(a, b)
            order = np.lexsort((~sure, high, low))
            low, high, sure = low[order], high[order], sure[order]
            one = np.ones(len(low), dtype=bool)
            one[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(low[one]), pa.array(high[one]), pa.array(sure[one])], schema=_PAIRS)
        if spill:  # go on with the last row, so that the chain does
            before = FEW if not (before and held_key == key[-1]) else before
            held_key, held = key[-1], [key[-1:], n[-1:], cls[-1:]]
        else:
            if not (before and held_key == key[-1]):
                before = 0
            held_key, held = key[-1], [key[done:], n[done:], cls[done:]]


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from C.table(batches)
    yield None


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in C.table(batches):
        keep = [sure or (x is not None and y is not None and may_link(read_point(x, n), n, read_point(y, m), m))
                for sure, n, x, m, y in zip(*[batch.column(c).to_pylist() for c in ("sure", "n", "x", "m", "y")], strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _class_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, text): a text of each class of a task."""
    seen: set[int] = set()
    for batch in C.table(batches):
        for chunk in C.text_chunks(batch):
            _, _, bounds, cls = _sets_with_bounds(chunk)
            fresh = [n > 0 and not (c in seen or seen.add(c)) for n, c in zip(np.diff(bounds).tolist(), cls.tolist(), strict=True)]
            out = pa.RecordBatch.from_arrays([pa.array(cls), chunk.column("text")], names=["cls", "text"])
            yield out.filter(pa.array(fresh, pa.bool_()))


def _candidate_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # repeated rows of a document meet in one task
    for batch in C.table(batches):
        for chunk in C.text_chunks(batch):
            _, h, bounds, cls = _sets_with_bounds(chunk)
            want = chunk.column("cls").to_pylist()
            fresh = [c == w and not (c in seen or seen.add(c)) for c, w in zip(cls.tolist(), want, strict=True)]
            sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(C.signed(h)))
            out = pa.RecordBatch.from_arrays([chunk.column("cls"), chunk.column("comp"), chunk.column("blocks"), sets],
                                             names=["cls", "comp", "blocks", "shingles"])
            yield out.filter(pa.array(fresh, pa.bool_()))


class CountVectorTree:
    """Group counts of sets as points, in leaves of LEAF points under one level of nodes; each keeps its corner of largest counts."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.groups = min(4096, groups_of(int(np.median(self.size))))
        points = np.stack([self.vector(s) for s in sets]).astype(np.int32)
        slab = np.argsort(np.argsort(self.size, kind="stable"), kind="stable") // (4 * LEAF)
        wide = points[:, int(np.argmax(points.var(axis=0)))]
        self.order = np.lexsort((wide, slab))
        self.points = points[self.order]
        cut = np.arange(0, len(sets), LEAF)
        sizes = self.size[self.order]
        self.corner = np.maximum.reduceat(self.points, cut)
        self.small, self.large = np.minimum.reduceat(sizes, cut), np.maximum.reduceat(sizes, cut)
        top = np.arange(0, len(cut), LEAF)
        self.top_corner = np.maximum.reduceat(self.corner, top)
        self.top_small, self.top_large = np.minimum.reduceat(self.small, top), np.maximum.reduceat(self.large, top)

    def vector(self, s: np.ndarray) -> np.ndarray:
        return point(s, self.groups)

    @staticmethod
    def _open(point, n, corner, small, large) -> np.ndarray:
        bound = np.minimum(corner, point).sum(axis=1)
        return (DEN * bound >= NUM * (n + small)) & (5 * large >= 4 * n) & (4 * small <= 5 * n)

    def search(self, point: np.ndarray, n: int) -> np.ndarray:
        """Numbers of the sets whose counts leave room for a link with a set of ``n`` tokens at ``point``."""
        top = np.flatnonzero(self._open(point, n, self.top_corner, self.top_small, self.top_large))
        leaves = (top[:, None] * LEAF + np.arange(LEAF)).ravel()
        leaves = leaves[leaves < len(self.corner)]
        leaves = leaves[self._open(point, n, self.corner[leaves], self.small[leaves], self.large[leaves])]
        at = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
        at = at[at < len(self.points)]
        sizes = self.size[self.order[at]]
        return self.order[at[self._open(point, n, self.points[at], sizes, sizes)]]


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def block_links(all_ids: list[int], all_sets: list[np.ndarray], ids: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Verified links between the queries (ids, sets) and all classes of a block, less those that earlier ones already connect."""
    tree = CountVectorTree(all_sets)
    root = {c: c for c in [*all_ids, *ids]}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    links = []
    for c, s in zip(ids, sets, strict=True):
        for k in tree.search(tree.vector(s), len(s)).tolist():
            other = all_ids[k]
            x, y = find(c), find(other)
            if x != y and DEN * _overlap(s, all_sets[k]) >= NUM * (len(s) + len(all_sets[k])):
                root[x] = y
                links.append((c, other))
    return links


def _search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[tuple[int, int]] = []
    for group in C.sorted_groups(batches, ["comp", "i", "j"]):
        group = group.combine_chunks()
        ids = group.column("cls").to_pylist()
        lists = group.column("shingles").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets = [np.sort(values[a:b].view(np.uint64)) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        asks = group.column("asks").to_pylist()
        inside = [k for k, q in enumerate(asks) if not q]
        if len(inside) == 0:
            continue
        queries = [k for k, q in enumerate(asks) if q] or inside
        found += block_links([ids[k] for k in inside], [sets[k] for k in inside], [ids[k] for k in queries], [sets[k] for k in queries])
        if len(found) > 50_000:
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], schema=_LINKS)
            found = []
    yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], schema=_LINKS)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def verified_links(sets: DataFrame) -> DataFrame:
    """(a, b): verified links between classes, enough to connect what is connected. ``sets``: cls, comp, blocks, shingles."""
    small, big = sets.where("blocks = 1"), sets.where("blocks > 1")
    # Components beyond a block: compare all with one pivot each, salted so that a hot component's pivot is at hand in many tasks.
    pivot = big.groupBy("comp", "blocks").agg(F.min("cls").alias("cls")).join(big.select("cls", "shingles"), "cls")
    pivot = pivot.select("comp", F.col("cls").alias("p"), F.col("shingles").alias("ps"),
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("salt"))
    inter = F.size(F.array_intersect("shingles", "ps"))
    star = (big.withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).join(pivot, ["comp", "salt"])
            .select("cls", "comp", "blocks", "p", (DEN * inter >= NUM * (F.size("shingles") + F.size("ps"))).alias("linked")))
    star = C.materialise(star, "star")
    rest = star.where("NOT linked").groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("asking"))
    left = big.join(star.select("cls", "linked").distinct(), "cls").join(rest, "comp")
    block = F.pmod(F.xxhash64(F.lit(1), "cls"), F.col("blocks")).cast("int")
    ask = F.pmod(F.xxhash64(F.lit(2), "cls"), F.col("asking")).cast("int")
    rows = (small.select("comp", F.lit(0).alias("i"), F.lit(0).alias("j"), "cls", F.lit(False).alias("asks"), "shingles")
            .union(left.select("comp", F.explode(F.sequence(F.lit(0), F.col("asking") - 1)).alias("i"), block.alias("j"),
                               "cls", F.lit(False).alias("asks"), "shingles"))
            .union(left.where("NOT linked").select("comp", ask.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"),
                                                   "cls", F.lit(True).alias("asks"), "shingles")))
    rows = rows.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "cls")
    return rows.mapInArrow(C.freeing(_search_blocks), "a long, b long").union(star.where("linked AND cls != p").select("cls", "p"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (columns doc_id, text; others are ignored)."""
    docs = C.id_and_text(docs)
    spark: SparkSession = docs.sparkSession
    rows = C.materialise(docs.mapInArrow(C.freeing(_summaries), "doc_id long, n long, cls long"), "summaries")
    classes = rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    opened = spark.sparkContext.broadcast(open_documents(docs, classes))
    seen = C.materialise(docs.mapInArrow(C.freeing(_points(opened)), "kind int, id long, n long, data binary"), "points")
    keys = docs.mapInArrow(C.freeing(_prefixes(opened, spark.sparkContext.broadcast(shingle_counters(seen)))), "key long, n int, cls long")
    pairs = keys.repartition("key").sortWithinPartitions("key", "n", "cls").mapInArrow(C.freeing(_bucket_pairs), "a long, b long, sure boolean")
    pairs = pairs.groupBy("a", "b").agg(F.max("sure").alias("sure"))
    points = seen.where("kind = 0").groupBy(F.col("id").alias("cls")).agg(F.max("n").alias("n"), F.max("data").alias("data"))
    pairs = (pairs.join(points.select(F.col("cls").alias("a"), "n", F.col("data").alias("x")), "a")
             .join(points.select(F.col("cls").alias("b"), F.col("n").alias("m"), F.col("data").alias("y")), "b"))
    comps = connected_components(pairs.mapInArrow(C.freeing(_bounded), "a long, b long"), "a", "b").withColumnRenamed("component", "comp")

    reps = classes.select("cls", "rep")
    cand = comps.withColumnRenamed("node", "cls").join(reps, "cls")
    sizes = cand.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cand = cand.join(sizes, "comp").select(F.col("rep").alias("doc_id"), "cls", "comp", "blocks")
    found = docs.mapInArrow(C.freeing(_open_rows(opened)), docs.schema)
    texts = found.join(cand, "doc_id").select("cls", "comp", "blocks", "text")
    # A class that only rows without a doc_id have is fetched by the class itself.
    nameless = docs.where("doc_id IS NULL").mapInArrow(C.freeing(_class_texts), "cls long, text string").dropDuplicates(["cls"])
    texts = texts.union(nameless.join(cand.where("doc_id IS NULL"), "cls").select("cls", "comp", "blocks", "text"))
    sets = C.materialise(texts.mapInArrow(C.freeing(_candidate_sets), "cls long, comp long, blocks int, shingles array<long>"), "sets")

    linked = connected_components(verified_links(sets), "a", "b").withColumnRenamed("node", "cls")
    least_doc = linked.join(reps, "cls").groupBy("component").agg(F.min("rep").alias("least"))
    named = reps.join(linked.join(least_doc, "component").select("cls", "least"), "cls", "left")
    named = named.select("cls", F.coalesce("least", "rep").alias("component_id"))
    full = rows.where("n > 0").join(named, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.union(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Pipeline stage: rows whose doc_id is the smallest of their component, all columns kept; repeated rows of that doc_id once."""
    found = near_duplicates(docs)
    # A row that no join can find (null doc_id) stays; it has no id to be grouped under.
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias("_keep")).distinct()
    out = docs.join(keep, docs["doc_id"].cast("long") == keep["_keep"], "left_semi").dropDuplicates(["doc_id"])
    return out.union(docs.where("doc_id IS NULL")).select(*docs.columns)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.documents(spark, sf_dir))
