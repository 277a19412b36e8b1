"""Encoding through the word table against the tokenizers library, and the rule by which texts are cut into words."""

import hashlib
import json

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import word_table_bpe as W

ODD = ["", None, " ", "\n\n", "a", " a", "a ", "  a  b   c", "a\tb\n\nc\r\nd \n e", "it's we'll  'S don't", "x  y", "x  y", "  z", "a \nb　 c", "!\x1c\x1d a\x1f b\x0b c\x0c\x85 d",
       "<|endoftext|>", "a <|endoftext|> b<|endoftext|>\n\n<|endoftext|>", "<|endof text|>", "12 345  6,7", "\U0001f600 \U0001f468‍\U0001f469 你好。 x", "é ß’s",
       "w" * 40_000, " ".join(f"w{k}" for k in range(30_000)), "same text here", "same text here", "trailing \n", "᠎ a  b"]


def _library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def _plain(t, text):
    ids = t.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("block,buckets", [(32 << 20, None), (1 << 12, 5)])
def test_equals_the_library(spark, block, buckets):
    """Odd texts, repeated rows and null ids, in one block and in many; other columns may clash with the operator's own."""
    path, t = _library()
    rows = [(k, x, "b", 1, b"d") for k, x in enumerate(ODD)] + [(None, "no id", "b", 1, b"d"), (3, ODD[3], "b", 1, b"d"), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, bucket int, data binary").repartition(3)
    got = W.encode_and_decode(docs, W.read_vocabulary(path), buckets, block)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = sorted([(str(r[0]), *_plain(t, r[1])) for r in rows])
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == want


def test_equal_blocks_share_a_name(spark):
    """The same rows in several partitions: their blocks have one name and equal dictionaries."""
    path, t = _library()
    one = spark.createDataFrame([(1, "one two two"), (2, "three")], "doc_id long, text string").coalesce(1)
    got = W.encode_and_decode(one.unionAll(one).unionAll(one), W.read_vocabulary(path)).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in got) == sorted([(1, _plain(t, "one two two")[1]), (2, _plain(t, "three")[1])] * 3)


def test_empty_table(spark):
    path, _ = _library()
    assert W.encode_and_decode(spark.createDataFrame([], "doc_id long, text string"), W.read_vocabulary(path)).count() == 0


def test_other_vocabularies_are_refused():
    path, _ = _library()
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        with pytest.raises(ValueError, match="byte-level"):
            W.check_vocabulary(json.load(open(path, encoding="utf-8")) | change)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab'1 \n\t\r\x0b\x1c  　\u0085é.!s<|", max_size=25), min_size=1, max_size=3))
def test_words_encode_alone_as_in_the_text(texts):
    _, t = _library_cached()
    data, offsets = W.C.text_buffer(pa.array(texts))
    start = W.cuts(data, offsets).tolist()
    raw, edge = data.tobytes(), [*start, len(data)]
    words = {a: raw[a:b].decode() for a, b in zip(edge, edge[1:], strict=False)}
    for k, text in enumerate(texts):
        ids = [i for a, w in words.items() if offsets[k] <= a < offsets[k + 1] for i in t.encode(w, add_special_tokens=False).ids]
        assert ids == t.encode(text, add_special_tokens=False).ids


_held = []


def _library_cached():
    if not _held:
        _held.append(_library())
    return _held[0]
