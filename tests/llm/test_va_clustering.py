"""Clustering against plain rounds over all distances, with ties, copies and vectors that do not count."""

import hashlib

import numpy as np
import pytest

from ledgerline.llm import va_clustering as V

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, cells string, v int"


def plain(rows, k=8, rounds=10, size=64):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == size and all(x is not None and np.isfinite(x) for x in e):
            x = np.floor(1024 * np.array(e, np.float32).astype(np.float64)).astype(np.int64)
            kept.append((hashlib.sha256(f"3:{'null' if i is None else i}".encode()).hexdigest(), x.tolist(), i))
    if not kept:
        return []
    c = np.array([v for _, v, _ in sorted(kept, key=lambda r: (r[0], r[1]))[:k]])
    x = np.array([v for _, v, _ in kept])
    near = lambda: ((x[:, None] - c[None]) ** 2).sum(2)
    for _ in range(rounds):
        a = near().argmin(1)
        c = np.array([x[a == j].sum(0) // (a == j).sum() if (a == j).any() else c[j] for j in range(len(c))])
    d = near()
    a = d.argmin(1)
    d = d.min(1)
    return sorted((str(i), int(a[n]), int(d[n]), int(d[a == a[n]].sum()), int(d.sum()), hashlib.sha256(",".join(map(str, c[a[n]])).encode()).hexdigest())
                  for n, (_, _, i) in enumerate(kept))


def _rows(kind):
    rng = np.random.default_rng(7)
    if kind == "few":
        return [(1, [0.5] * 64), (2, [-0.25] * 64), (2, [-0.25] * 64)]
    if kind == "none":
        return [(1, None), (2, []), (3, [float("nan")] * 64)]
    spread = {"noise": 0.0, "groups": 1.0, "ties": 0.0}[kind]
    centres = rng.normal(size=(5, 64)) * spread
    x = centres[rng.integers(0, 5, 700)] + rng.normal(size=(700, 64)) * 0.12
    if kind == "ties":
        x = rng.integers(-1, 2, (700, 64)) / 1024
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(9000, rows[0][1])] * 300 + [(i, rows[3][1]) for i in range(9100, 9150)]  # copies, of an id too
    rows += [(9500, None), (9501, [0.1] * 63), (9502, [0.1] * 65), (9503, [0.1] * 63 + [None]), (9504, [float("nan")] + [0.1] * 63), (9505, [float("inf")] + [0.1] * 63), (9506, [])]
    rows += [(None, [0.3] * 64), (None, [-0.3] * 64), (9600, [100.0] * 64)]
    return rows


@pytest.mark.parametrize("kind,bits", [("noise", 8), ("groups", 8), ("groups", 3), ("ties", 4), ("few", 8), ("none", 8)])
def test_equals_plain_rounds(spark, kind, bits):
    rows = _rows(kind)
    table = spark.createDataFrame([(i, e, 1, 2, "c", 3) for i, e in rows], SCHEMA).repartition(3)
    c = V.fit(table, bits=bits)
    got = sorted((str(r[0]), *tuple(r)[1:]) for r in V.assign(c, spark).collect())
    assert got == plain(rows)
    if kind == "groups" and bits == 8:
        assert max(c.fetched, default=0) < len(rows) / 3  # cells alone decide for most


def test_only_open_classes_are_read(spark):
    """Well separated groups: margin classes without an open vector stay unread."""
    rng = np.random.default_rng(2)
    x = np.repeat(np.eye(8, 64) * 4, 100, axis=0) + rng.normal(size=(800, 64)) * 0.01
    near = np.eye(8, 64)[:4].sum(0) * 1.0  # a few vectors about as near to four groups
    rows = [(i, v.tolist(), 0, 0, "", 0) for i, v in enumerate([*x, *(near + rng.normal(size=(5, 64)) * 0.3)])]
    seen = []
    c = V.fit(spark.createDataFrame(rows, SCHEMA), watch=lambda turn, classes: seen.append(classes))
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in V.assign(c, spark).collect()) == plain([(r[0], r[1]) for r in rows])
    assert seen and all(len(s) < V.CLASSES for s in seen)


def test_cells_never_contradict():
    rng = np.random.default_rng(4)
    x = rng.integers(-50, 50, (500, 6))
    edges = np.sort(rng.integers(-40, 40, (6, 7)), axis=1)
    cells = V.Cells(edges, x.min(0), x.max(0))
    centroids = rng.integers(-50, 50, (5, 6))
    centroids[4] = centroids[1]  # a tie: the smaller number
    told = cells.nearest(V._cell_numbers(x, edges), centroids)
    exact = V._squares(x, centroids).argmin(1)
    assert ((told == exact) | (told < 0)).all() and (told >= 0).any()


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="larger than"):
        V.fit(spark.createDataFrame([(1, [1e9] * 64, 1, 1, "", 1)], SCHEMA))


def test_empty_table(spark):
    out = V.assign(V.fit(spark.createDataFrame([], SCHEMA)), spark)
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
