"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

1. Map: texts are cut into pre-tokens with their positions. A block is a bounded stretch of
   a task's texts; within it every distinct pre-token gets a local number, and a text is the
   list of its pre-tokens' numbers, in order. Only the block's distinct pre-tokens go on.
2. These are shuffled by a hash bucket of the pre-token, so that each distinct one of the
   corpus is encoded once, wherever it occurs; a block sends one packed row per bucket, and a
   frequent pre-token stands at most once in a block's rows.
3. The ids return to their blocks, where the texts are put together again by position and
   decoded through the token-byte table.

Texts never travel, only their numbers, entropy-coded. Both passes over the texts cut the
same blocks; a block is named by a digest of its words, and a missing or different
dictionary stops the job instead of giving wrong ids.

Defined cases: null or empty text has no tokens (both digests are those of the empty
string); repeated rows each give their row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm.packed import binary, buckets_of, pack, pack_ids, pack_list, raw_of, unpack, unpack_ids, unpack_list

BLOCK_BYTES = 32 << 20   # text of a block (a longer text is a block of its own)
BLOCK_WORDS = 400_000    # distinct pre-tokens of a block, one text more at most
CACHE_WORDS = 1_000_000  # encoded pre-tokens that a bucket remembers
SLICE_NUMBERS = 500_000  # pre-tokens of texts in one row

_compiled: dict[str, regex.Pattern] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken vocabulary file; tens of thousands of entries at any corpus size."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _find(pattern: str):
    if pattern not in _compiled:
        _compiled[pattern] = regex.compile(pattern)
    return _compiled[pattern].findall


class Block:
    """Local numbers of the pre-tokens of a stretch of texts."""

    def __init__(self, pattern: str):
        self.find = _find(pattern)
        self.number: dict[str, int] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.bytes = 0
        self.digest = xxhash.xxh64()

    def full(self) -> bool:
        return self.bytes >= BLOCK_BYTES or len(self.number) >= BLOCK_WORDS

    def _cut(self, piece: str) -> tuple[int, ...]:
        number = self.number
        found = self.pieces[piece] = tuple(number.setdefault(w, len(number)) for w in self.find(piece))
        return found

    def stretches(self, text: str) -> list[str]:
        """Pieces that the pattern cuts alike alone and in the text.

        Before a single space between two other characters every match ends, as no
        match goes on over a space. Texts with white space beside a space stay whole.
        """
        pieces = text.split(" ")
        if len(pieces) == 1:
            return pieces
        if any(not p or p[0].isspace() or p[-1].isspace() for p in pieces):
            return [text]
        return [pieces[0], *[" " + p for p in pieces[1:]]]

    def _enter(self, doc_id: int | None, text: str) -> None:
        self.bytes += len(text)
        self.digest.update(f"{doc_id},{len(text)};".encode())

    def read(self, doc_id: int | None, text: str) -> None:
        self._enter(doc_id, text)
        known = self.pieces
        for piece in self.stretches(text):
            if piece not in known:
                self._cut(piece)

    def numbers(self, doc_id: int | None, text: str) -> np.ndarray:
        self._enter(doc_id, text)
        known, cut = self.pieces, self._cut
        out: list[int] = []
        extend = out.extend
        for piece in self.stretches(text):
            extend(known.get(piece) or cut(piece))
        return np.array(out, dtype=np.int32)

    def dealt(self, buckets: int) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
        """(words by bucket, first word of each bucket, place of each number in that order)."""
        words = pa.array(list(self.number), pa.string()).cast(pa.large_binary())
        bucket = buckets_of(words, buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        return words.take(pa.array(order)), np.searchsorted(bucket[order], np.arange(buckets + 1)), place

    def name(self) -> int:
        """A digest of the block's documents and words; blocks with one name have equal dictionaries."""
        h = self.digest.copy()
        h.update("\0".join(self.number).encode())
        return h.intdigest() - (1 << 63)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    for batch in C.table(batches):
        for chunk in C.text_chunks(batch):
            for doc_id, text in zip(chunk.column("doc_id").to_pylist(), chunk.column("text").to_pylist(), strict=True):
                yield doc_id, text or ""


_WORDS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
_ROWS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("words", pa.int32()),
                   ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("data", pa.binary())])
ROWS = "block long, kind int, part int, words int, doc_ids array<long>, sizes array<int>, data binary"


def _dictionary(pattern: str, buckets: int):
    def rows(block: Block) -> Iterator[pa.RecordBatch]:
        words, edge, _ = block.dealt(buckets)
        used = np.flatnonzero(np.diff(edge)).tolist()
        if used:
            data = [pack_list(words.slice(edge[k], edge[k + 1] - edge[k])) for k in used]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([block.name()] * len(used), pa.int64()), pa.array(data, pa.binary())], schema=_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(pattern)
        for doc_id, text in _texts(batches):
            block.read(doc_id, text)
            if block.full():
                yield from rows(block)
                block = Block(pattern)
        yield from rows(block)
    return run


def _numbered(pattern: str, buckets: int):
    def rows(block: Block, ids: list, numbers: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, _, place = block.dealt(buckets)
        name, a = block.name(), 0
        while a < len(ids):
            b, n = a, 0
            while b < len(ids) and (b == a or n + len(numbers[b]) <= SLICE_NUMBERS):
                n += len(numbers[b])
                b += 1
            yield pa.RecordBatch.from_pylist([{"block": name, "kind": 1, "part": 0, "words": len(place), "doc_ids": ids[a:b],
                                               "sizes": [len(x) for x in numbers[a:b]], "data": pack(place[np.concatenate(numbers[a:b])])}], schema=_ROWS)
            a = b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, numbers = Block(pattern), [], []
        for doc_id, text in _texts(batches):
            ids.append(doc_id)
            numbers.append(block.numbers(doc_id, text))
            if block.full():
                yield from rows(block, ids, numbers)
                block, ids, numbers = Block(pattern), [], []
        if ids:
            yield from rows(block, ids, numbers)
    return run


def _encode_words(ranks, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        enc = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        done: dict[bytes, bytes] = {}
        bucket = None
        for batch in C.table(batches):
            for k, block, data in zip(*[batch.column(c).to_pylist() for c in ("bucket", "block", "data")], strict=True):
                if k != bucket or len(done) >= CACHE_WORDS:
                    bucket, done = k, {}
                words = unpack_list(data).to_pylist()
                for w in words:
                    if w not in done:
                        done[w] = np.array(enc.encode_ordinary(w.decode()), dtype=np.int32).tobytes()
                ids = [done[w] for w in words]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([0], pa.int32()), pa.array([k], pa.int32()), pa.array([len(ids)], pa.int32()),
                                                  pa.nulls(1, _ROWS.field("doc_ids").type), pa.nulls(1, _ROWS.field("sizes").type), pa.array([pack_ids(ids)], pa.binary())], schema=_ROWS)
    return run


class Tables:
    """By id: its bytes, and its decimal text behind a comma."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        plain = [b""] * size
        for b, i in ranks.items():
            plain[i] = b
        self.plain = pa.array(plain, pa.large_binary())
        self.decimal = pa.array([f",{i}".encode() for i in range(size)], pa.large_binary())


class Dictionary:
    """A block's pre-tokens by number: how many ids, their text and their bytes."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], tables: Tables):
        self.counts = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int32)
        flat = np.ascontiguousarray(np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int32))
        at = np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)])
        joined = [raw_of(t.take(pa.array(flat))) for t in (tables.decimal, tables.plain)]
        self.decimal, self.plain = (binary(o[at], data) for o, data in joined)

    def __len__(self) -> int:
        return len(self.counts)

    def texts(self, row: dict) -> pa.RecordBatch:
        numbers = unpack(row["data"])
        at = np.concatenate([[0], np.cumsum(row["sizes"], dtype=np.int64)])
        places = pa.array(numbers)
        (od, decimal), (ob, plain) = raw_of(self.decimal.take(places)), raw_of(self.plain.take(places))
        total = np.concatenate([[0], np.cumsum(self.counts[numbers], dtype=np.int64)])
        edges = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
        return pa.RecordBatch.from_arrays([
            pa.array(row["doc_ids"], pa.int64()), pa.array(total[at[1:]] - total[at[:-1]]),
            pa.array([hashlib.sha256(decimal[od[a] + 1:od[b]]).hexdigest() for a, b in edges], pa.string()),
            pa.array([hashlib.sha256(plain[ob[a]:ob[b]]).hexdigest() for a, b in edges], pa.string())], schema=_DIGESTS)


def _assemble(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(ranks.value)
        block, last, parts, words = None, -1, [], None
        for batch in C.table(batches):
            for row in batch.to_pylist():
                if row["block"] != block:
                    block, last, parts, words = row["block"], -1, [], None
                if row["kind"] == 0:
                    if row["part"] != last:  # else from another block of this name, with equal pre-tokens
                        parts.append(unpack_ids(row["data"]))
                        last = row["part"]
                    continue
                if words is None:
                    words, parts = Dictionary(parts, tables), []
                if len(words) != row["words"]:
                    raise ValueError("a block and its dictionary differ; the input changed between the passes")
                yield words.texts(row)
    return run


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encoded_blocks(docs: DataFrame, ranks: dict[bytes, int], pattern: str, buckets: int | None = None) -> DataFrame:
    """Rows of ``ROWS``, by block: ids of its pre-tokens by bucket (kind 0), then its texts as numbers (kind 1).

    ``buckets`` should grow with the data; the session's number of shuffle partitions by default.
    """
    docs = C.id_and_text(docs)
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(ranks)
    words = docs.select("doc_id", "text").mapInArrow(_dictionary(pattern, buckets), "bucket int, block long, data binary")
    words = words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_encode_words(shared, pattern), ROWS)
    texts = docs.mapInArrow(_numbered(pattern, buckets), ROWS)
    return words.union(texts).repartition("block").sortWithinPartitions("block", "kind", "part")


def encode_and_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    return encoded_blocks(docs, ranks, pattern).mapInArrow(_assemble(shared), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return encode_and_decode(C.documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
