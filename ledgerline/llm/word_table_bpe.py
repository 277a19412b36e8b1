"""BPE encoding and decoding through a table of distinct words.

1. Split: texts are cut before white space into words whose concatenation is the text. A
   block is a bounded stretch of a task's texts; its distinct words are dealt to buckets by
   a hash of the word, and each (block, bucket) sends its words as one packed row.
2. Encode: rows meet by bucket, so that all places of a word meet; each distinct word of the
   bucket is encoded once, and the ids go back to the blocks, packed alike.
3. Join: a block's texts are lists of word numbers, and its ids lists stand in the order of
   these numbers, so ids join their words by position. Decoding joins the distinct words'
   ids with the table of id pieces, then places the bytes by the same numbers.

Splitting is exact: no match of the byte-level pattern goes from a character that is not
white space over to white space, and what the pattern looks ahead to, the end of a white
space run, is inside the word. Places next to a character that some engine may take for
white space are not cut. ``check_vocabulary`` refuses tokenizers of another kind.

Memory: a block's words, a bucket's words (a table beyond ``CACHE_WORDS`` starts anew, which
encodes words again), and a slice of texts. Both passes over the texts cut the same blocks;
a block's name is a digest of its content, and a missing part of a dictionary stops the job.

Defined cases: null or empty text has no tokens (both digests are those of the empty
string); repeated rows each give their row; an empty table gives an empty result; the
added token's literal in a text is one token, as the tokenizers library has it.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import common as C
from ledgerline.llm.packed import binary, buckets_of, pack, pack_ids, pack_list, raw_of, unpack, unpack_ids, unpack_list

BLOCK_BYTES = 32 << 20   # text of a block; a longer text is a block of its own
SLICE_BYTES = 2 << 20    # text of a row of numbers
CACHE_WORDS = 2_000_000  # encoded words that a bucket remembers

_CUT = np.zeros(256, dtype=bool)
_CUT[[0x20, 0x09, 0x0A, 0x0D]] = True
_DOUBTFUL = np.zeros(256, dtype=bool)
_DOUBTFUL[np.r_[0x09:0x0E, 0x1C:0x21]] = True
_tokenizers: dict[int, object] = {}


def read_vocabulary(path: str) -> str:
    """A tokenizers file, checked; its size depends on the vocabulary only."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    check_vocabulary(json.loads(text))
    return text


def check_vocabulary(v: dict) -> None:
    pre = v.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not any(c.isspace() for c in t["content"]) for t in v["added_tokens"])
    if v.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or not plain or v["decoder"]["type"] != "ByteLevel":
        raise ValueError("the vocabulary is not a plain byte-level BPE, whose words can be cut before white space")


def _tokenizer(vocabulary: str):
    key = hash(vocabulary)
    if key not in _tokenizers:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(vocabulary)
        t.no_truncation()
        t.no_padding()
        _tokenizers[key] = t
    return _tokenizers[key]


def pieces(vocabulary: str) -> pa.LargeBinaryArray:
    """The bytes of each id, at the id's place (empty where the vocabulary has no such id)."""
    v = json.loads(vocabulary)
    # The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    token = v["model"]["vocab"] | {t["content"]: t["id"] for t in v["added_tokens"]}
    out = [b""] * (max(token.values(), default=-1) + 1)
    for s, i in token.items():
        out[i] = bytes(byte[c] for c in s) if all(c in byte for c in s) else s.encode()
    return pa.array(out, pa.large_binary())


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of all words in the buffer: each text's start, and white space behind a character that is surely none."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    at = np.flatnonzero(_CUT[data])
    at = at[at > 0]
    last = data[at - 1]
    ok = ~_DOUBTFUL[last]
    wide = np.flatnonzero(ok & (last >= 0x80))
    if len(wide):
        two, three = data[at[wide] - 2], data[np.maximum(at[wide] - 3, 0)]
        ok[wide] = ~((two == 0xC2) | (three == 0xE1) | ((three == 0xE2) & (two <= 0x81)) | ((three == 0xE3) & (two == 0x80)))
    begins = offsets[:-1][np.diff(offsets) > 0]
    return np.union1d(at[ok], begins)


class Block:
    """A stretch of texts: its distinct words by bucket, and the texts as numbers of words in that order."""

    def __init__(self, batches: list[pa.RecordBatch], buckets: int):
        rows = pa.Table.from_batches(batches).combine_chunks()
        text = rows.column("text")
        text = text.chunk(0) if text.num_chunks else pa.array([], pa.string())
        self.doc_ids = rows.column("doc_id").combine_chunks()
        data, self.offsets = C.text_buffer(text)
        start = cuts(data, self.offsets)
        named = binary(np.append(start, len(data)), data).dictionary_encode()
        self.first = np.searchsorted(start, self.offsets)
        bucket = buckets_of(named.dictionary, buckets)
        order = np.argsort(bucket, kind="stable")
        self.edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
        self.words = named.dictionary.take(pa.array(order))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.numbers = place[named.indices.to_numpy()] if len(named) else np.empty(0, np.int32)
        h = xxhash.xxh64(data.tobytes() if not data.flags.c_contiguous else data)
        h.update(self.offsets.tobytes())
        h.update(",".join(map(str, self.doc_ids.to_pylist())).encode())
        self.name = h.intdigest() - (1 << 63)


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int, block_bytes: int) -> Iterator[Block]:
    held, size = [], 0
    for batch in C.table(batches):
        for chunk in C.text_chunks(batch):
            n = chunk.column("text").nbytes
            if held and size + n > block_bytes:
                yield Block(held, buckets)
                held, size = [], 0
            held.append(chunk)
            size += n
    if held:
        yield Block(held, buckets)


_ROWS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("words", pa.int32()),
                   ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("data", pa.binary())])
ROWS = "block long, kind int, part int, words int, doc_ids array<long>, sizes array<int>, data binary"
_WORDS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _word_rows(buckets: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, buckets, block_bytes):
            used = np.flatnonzero(np.diff(block.edge)).tolist()
            if used:
                data = [pack_list(block.words.slice(block.edge[k], block.edge[k + 1] - block.edge[k])) for k in used]
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([block.name] * len(used), pa.int64()), pa.array(data, pa.binary())], schema=_WORDS)
    return run


def _number_rows(buckets: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, buckets, block_bytes):
            n, a = len(block.doc_ids), 0
            while a < n:
                b = min(n, max(a + 1, int(np.searchsorted(block.offsets, block.offsets[a] + SLICE_BYTES))))
                numbers = block.numbers[block.first[a]:block.first[b]]
                yield pa.RecordBatch.from_pylist([{"block": block.name, "kind": 1, "part": 0, "words": len(block.words), "doc_ids": block.doc_ids.slice(a, b - a).to_pylist(),
                                                   "sizes": np.diff(block.first[a:b + 1]).tolist(), "data": pack(np.ascontiguousarray(numbers, np.int32))}], schema=_ROWS)
                a = b
    return run


def _encode_rows(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary.value)
        known: dict[bytes, bytes] = {}
        bucket = None
        for batch in C.table(batches):
            for k, block, data in zip(*[batch.column(c).to_pylist() for c in ("bucket", "block", "data")], strict=True):
                if k != bucket or len(known) > CACHE_WORDS:
                    bucket, known = k, {}
                words = unpack_list(data).to_pylist()
                new = [w for w in words if w not in known]
                for a in range(0, len(new), 10_000):
                    part = new[a:a + 10_000]
                    for w, e in zip(part, tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False), strict=True):
                        known[w] = np.array(e.ids, np.uint32).tobytes()
                ids = [known[w] for w in words]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([0], pa.int32()), pa.array([k], pa.int32()), pa.array([len(ids)], pa.int32()),
                                                  pa.nulls(1, _ROWS.field("doc_ids").type), pa.nulls(1, _ROWS.field("sizes").type), pa.array([pack_ids(ids)], pa.binary())], schema=_ROWS)
    return run


class Dictionary:
    """Ids and decoded bytes of a block's words, each at the word's number."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], table: pa.LargeBinaryArray):
        counts = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int32)
        flat = np.ascontiguousarray(np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int32))
        at = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.ids = binary(at * 4, flat)
        joined = table.take(pa.array(flat))  # ids join the table of pieces
        o, data = raw_of(joined)
        self.bytes = binary(o[at], data)

    def __len__(self) -> int:
        return len(self.ids)


def _result(doc_ids: list, sizes: list, numbers: np.ndarray, words: Dictionary) -> pa.RecordBatch:
    at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    places = pa.array(numbers)
    (oi, ids), (ob, data) = raw_of(words.ids.take(places)), raw_of(words.bytes.take(places))
    n, said, decoded = [], [], []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        n.append(int(oi[b] - oi[a]) // 4)
        said.append(hashlib.sha256(ids[oi[a]:oi[b]]).hexdigest())
        decoded.append(hashlib.sha256(data[ob[a]:ob[b]].tobytes().decode("utf-8", "replace").encode()).hexdigest())
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(n, pa.int64()), pa.array(said, pa.string()), pa.array(decoded, pa.string())], schema=_RESULT)


def _join_rows(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(vocabulary.value)
        block, last, parts, words = None, -1, [], None
        for batch in C.table(batches):
            for row in batch.to_pylist():
                if row["block"] != block:
                    block, last, parts, words = row["block"], -1, [], None
                if row["kind"] == 0:
                    if row["part"] != last:  # else from another block of this name, with equal words
                        parts.append(unpack_ids(row["data"]))
                        last = row["part"]
                    continue
                if words is None:
                    words, parts = Dictionary(parts, table), []
                if len(words) != row["words"]:
                    raise ValueError("a block and its dictionary differ; the input changed between the passes")
                yield _result(row["doc_ids"], row["sizes"], unpack(row["data"]), words)
    return run


def encoded_blocks(docs: DataFrame, vocabulary: str, buckets: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``ROWS``, by block: ids of its words by bucket (kind 0), then its texts as numbers of words (kind 1).

    ``buckets`` should grow with the data; the session's number of shuffle partitions by default.
    """
    docs = C.id_and_text(docs)
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(vocabulary)
    words = docs.mapInArrow(_word_rows(buckets, block_bytes), "bucket int, block long, data binary")
    ids = words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_encode_rows(shared), ROWS)
    texts = docs.mapInArrow(_number_rows(buckets, block_bytes), ROWS)
    return ids.union(texts).repartition("block").sortWithinPartitions("block", "kind", "part")


def encode_and_decode(docs: DataFrame, vocabulary: str, buckets: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return encoded_blocks(docs, vocabulary, buckets, block_bytes).mapInArrow(_join_rows(shared), RESULT)


def op12_word_table_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    return encode_and_decode(C.documents(spark, sf_dir), read_vocabulary(vocabulary or public_tokenizers.path("byte_bpe_50k.json")))
