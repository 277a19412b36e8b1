"""Runs against a plain search over all periods, on random, nested and planted texts."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import periodic_runs as P

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    """All (start, length, smallest period), by trying every period on every stretch that cannot grow."""
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            k = i
            while k + q < len(w) and w[k] == w[k + q]:
                k += 1
            if k > i:
                length = k + q - i
                if length >= max(24, 3 * q):
                    found.setdefault((i, length), q)
            i = k + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc_id, text):
    w = SPACE.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = sorted(plain_runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    return (len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def _texts():
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(["th", "é", "ing", "ß", "a"], rng.integers(1, 3)))
    out = [" ".join(word() for _ in range(int(n))) for n in rng.integers(0, 400, 90)]
    out += ["", None, " \n\t ", "one", "go " * 23, "go " * 24, "go " * 900, "a b " * 12 + "a", "a b\n" * 11 + "a"]
    unit = [word() + str(k) for k in range(70)]
    out += [" ".join((unit * 4)[:m]) for m in (139, 209, 210, 211, 280)]
    out += [" ".join(["x"] * 40 + ["y"] + ["x"] * 40 + ["y"] + ["x"] * 40 + ["y"] + ["x"] * 39)]
    out += [" ".join((["a", "b"] * 15 + ["c"]) * 4 + ["a"] * 30), "\x1f \x85 " * 20, " ".join(rng.choice(["a", "b"], 300).tolist())]
    out += [" ".join(word() for _ in range(20_000))[:120_000]]
    return out


def test_runs_equal_a_plain_search(spark):
    rows = [(k, t, "s", 1) for k, t in enumerate(_texts())] + [(None, "z " * 30, "s", 1), (3, _texts()[3], "s", 1), (10**12, "go " * 50, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, n_runs int").repartition(3)
    got = P.run_digests(docs).collect()
    assert sum(P.planted(r[0], len(SPACE.findall(r[1] or ""))) is not None for r in rows) > 3
    assert sorted((str(r.doc_id), *[str(x) for x in tuple(r)[1:8]]) for r in got) == sorted((str(i), *[str(x) for x in plain_row(i, t)]) for i, t, _, _ in rows)


def test_listed_and_collapsed(spark):
    docs = spark.createDataFrame([(1, "a b " * 12 + "end"), (2, None), (3, "plain words only")], "doc_id long, text string")
    assert [tuple(r) for r in P.periodic_runs(docs).collect()] == [(1, 0, 24, 2)]
    assert {r.doc_id: r.text for r in P.collapsed(docs).collect()} == {1: "a b end", 2: None, 3: "plain words only"}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert (P.run_digests(empty).count(), P.periodic_runs(empty).count(), P.collapsed(empty).count()) == (0, 0, 0)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 12)), min_size=1, max_size=4), st.integers(0, 20))
def test_nested_repeats(parts, shift):
    """Concatenated powers over three words, where runs touch, overlap and nest, at any place against the blocks."""
    w = list(range(100, 100 + shift)) + [x for unit, k in parts for x in unit * k]
    assert P.find_runs(np.array(w, np.uint64)).tolist() == [list(r) for r in sorted(plain_runs(w), key=lambda r: (r[0], r[2]))]


@pytest.mark.parametrize("q,n", [(1, 60_000), (7, 50_000), (16_384, 49_200), (16_385, 60_001), (1000, 200_000)])
def test_long_texts(q, n):
    """Periods up to a third of a long text."""
    unit = np.arange(q, dtype=np.uint64) + np.uint64(5)
    w = np.concatenate([[np.uint64(1)], np.resize(unit, n), [np.uint64(2)]])
    assert P.find_runs(w).tolist() == [[1, n, q]]


def test_wavelet():
    rng = np.random.default_rng(5)
    v = rng.permutation(300)
    t = P.Wavelet(v)
    left = rng.integers(0, 300, 500)
    right = left + rng.integers(1, 301, 500) % (301 - left)
    limit = rng.integers(-3, 700, 500)
    assert t.below(left, right, limit).tolist() == [int((v[a:b] < x).sum()) for a, b, x in zip(left, right, limit, strict=True)]
    some = right > left
    nth = (rng.integers(0, 1000, 500) % np.maximum(right - left, 1))[some]
    assert t.smallest(left[some], right[some], nth).tolist() == [int(np.sort(v[a:b])[k]) for a, b, k in zip(left[some], right[some], nth, strict=True)]
