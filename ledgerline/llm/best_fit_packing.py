"""Best-fit packing: bounded-space online best-fit of token sequences.

Texts become ids in the tasks that read them; words are encoded once and
remembered (``WordEncoder``). Only a document longer than a sequence is cut. What is packed are the pieces'
lengths: a bin keeps its free space, bins are found by a bitset over free space (the lowest
set bit at or above a length is the tightest bin), and when more than OPEN bins are open,
the fullest closes. Pieces are dealt out to packers by a hash of doc_id; the number of
packers follows the number of pieces, so each fills hundreds of sequences and the few bins
open at its end do not count. A packer reads its pieces in a fixed order: a lost task gives
the same sequences again.

Defined cases: null or empty text is one piece holding the end id alone; repeated rows are
documents of their own; null doc_ids go to one packer like any other value.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C

SEQUENCE = 2048
OPEN = 256               # bins open at a time
PIECES_A_PACKER = 60_000
END = 0


class Room(NamedTuple):
    """What a worker may hold: words and pre-tokens that it remembers, bytes of text whose distinct words are looked up together,
    and whether it keeps them for its next task."""
    words: int
    tokens: int
    chunk: int
    kept: bool = True


ROOMY = Room(600_000, 800_000, 12 << 20)
LEAN = Room(50_000, 80_000, 2 << 20, False)  # a worker at 250 MB at most over 32 MB of text, for half as much CPU time again; beside other stages' workers

_loaded: dict[tuple[str, Room], WordEncoder] = {}


class WordEncoder:
    """Ids of texts by a tokenizers vocabulary, remembering words.

    Neither normaliser nor pre-tokenizer of the vocabulary looks past a space or a line end,
    so texts are cut there. A word of ASCII and Latin-1 letters is cut on by the vocabulary's
    own pattern, and each pre-token is encoded once; any other word is encoded as it is, and so
    is a word that holds an added token's content, which the tokenizer takes out before the pattern.
    Pre-tokens go to the tokenizer many at a time, between marks that none of them holds.
    """

    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    MARK = "\x01"

    def __init__(self, vocabulary: str, room: Room = ROOMY):
        from tokenizers import Tokenizer

        self.room = room
        self.tokenizer = Tokenizer.from_str(vocabulary)
        rules = json.loads(vocabulary)
        split = rules["pre_tokenizer"]["pretokenizers"][0]
        added = [t["content"] for t in rules.get("added_tokens") or []]
        if any(" " in t or "\n" in t for t in added):
            raise ValueError("an added token of the vocabulary holds a space or a line end")
        # Without regard to case, as an added token may be sought in the normalised text.
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE)
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        self.mark = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        if len(self.mark) != 1:
            raise ValueError("the vocabulary has no single id for the mark")
        self.words: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}

    def _encode(self, parts: list[str]) -> None:
        for k in range(0, len(parts), 1000):
            some = parts[k:k + 1000]
            joined = f" {self.MARK} ".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            cut = (np.flatnonzero(ids == self.mark[0]) * 4).tolist()
            if len(cut) != len(some) - 1:
                raise ValueError("a pre-token holds the mark")
            raw = ids.tobytes()
            self.tokens.update(zip(some, [raw[a:b] for a, b in zip([0, *[c + 4 for c in cut]], [*cut, len(raw)], strict=True)], strict=True))

    def _learn(self, new: list[str]) -> None:
        if len(self.tokens) > self.room.tokens:
            self.tokens.clear()
        plain = {w: self.find(w.lower()) for w in new if self.PLAIN.fullmatch(w) and not self.added.search(w)}
        self._encode(list({t for parts in plain.values() for t in parts if t not in self.tokens}))
        tokens = self.tokens
        self.words.update({w: b"".join([tokens[t] for t in parts]) for w, parts in plain.items()})
        other = [w for w in new if w not in plain]
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self.words[w] = np.array(e.ids, dtype="<u4").tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of all texts in order; those of text i are ids[first[i]:first[i + 1]]."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        names, at = words.dictionary.to_pylist(), words.indices.to_numpy()
        if len(self.words) > self.room.words:
            self.words.clear()
        known = self.words
        self._learn([w for w in names if w not in known])
        coded = [known[w] for w in names]
        flat = np.frombuffer(b"".join(coded), dtype="<u4")
        size = np.array([len(c) for c in coded], dtype=np.int64) // 4
        place = np.cumsum(size) - size
        length = size[at]
        total = np.concatenate([[0], np.cumsum(length)])
        ids = flat[np.repeat(place[at] - total[:-1], length) + np.arange(total[-1])]
        ends = split.offsets.to_numpy()
        return ids, total[ends - ends[0]]


def _encoder(vocabulary: str, room: Room) -> WordEncoder:
    """The encoder of this worker."""
    if (vocabulary, room) not in _loaded:
        _loaded[vocabulary, room] = WordEncoder(vocabulary, room)
    return _loaded[vocabulary, room]


_PIECES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PLACED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _pieces(shared, room: Room):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END], dtype="<u4").tobytes()
        encoder = _encoder(shared.value, room)
        for batch in C.table(batches):
            for chunk in C.text_chunks(batch, room.chunk):
                out = []
                ids, first = encoder.encode(chunk.column("text"))
                raw = memoryview(ids).cast("B")
                for doc_id, a, b in zip(chunk.column("doc_id").to_pylist(), (first[:-1] * 4).tolist(), (first[1:] * 4).tolist(), strict=True):
                    whole = zlib.crc32(end, zlib.crc32(raw[a:b]))  # tells apart rows of one doc_id
                    for piece, k in enumerate(range(0, b - a + 4, 4 * SEQUENCE)):
                        stop = min(k + 4 * SEQUENCE, b - a + 4)
                        check = zlib.crc32(raw[a + k:min(a + stop, b)])
                        out.append((doc_id, whole, piece, k // 4, (stop - k) // 4, zlib.crc32(end, check) if stop == b - a + 4 else check))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECES.types, strict=True)], schema=_PIECES)
        del encoder
        if not room.kept:
            _loaded.pop((shared.value, room), None)
    return run


class BestFit:
    """Bounded-space best fit; ``put`` gives (bin, offset)."""

    def __init__(self, size: int = SEQUENCE, open_bins: int = OPEN):
        self.size, self.limit = size, open_bins
        self.bits = 0                                        # bit f is set while a bin with f free places is open
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        bin_ = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return bin_

    def put(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            bin_, free = self.made, self.size
            self.made += 1
        left = free - length
        if left:
            self.bins[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return bin_, self.size - free


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer, bins = None, None
    for batch in C.table(batches):
        places = []
        for at, length in zip(batch.column("packer").to_pylist(), batch.column("length").to_pylist(), strict=True):
            if at != packer:
                packer, bins = at, BestFit()
            bin_, offset = bins.put(length)
            places.append(((at << 40) | bin_, offset))
        seq, offset = zip(*places, strict=True)
        yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in _PLACED.names[:5]], pa.array(seq, pa.int64()), pa.array(offset, pa.int64())], schema=_PLACED)


def pack_documents(docs: DataFrame, vocabulary: str, room: Room = ROOMY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row. ``vocabulary``: the tokenizer's JSON."""
    docs = C.id_and_text(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    pieces = C.materialise(docs.mapInArrow(_pieces(shared, room) if room.kept else C.freeing(_pieces(shared, room)), "doc_id long, row long, piece int, start long, length long, ids_crc32 long"), "pieces")
    packers = max(1, round(pieces.count() / PIECES_A_PACKER))
    rows = pieces.withColumn("packer", F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(packers)))
    rows = rows.repartition(packers, "packer").sortWithinPartitions("packer", F.xxhash64("piece", "doc_id", "row"), "doc_id", "row", "piece")
    return rows.mapInArrow(_pack, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def read_vocabulary(path: str | None = None) -> str:
    import public_tokenizers

    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(C.documents(spark, sf_dir), read_vocabulary())
