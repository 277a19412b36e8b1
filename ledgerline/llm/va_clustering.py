"""Centroid clustering over a VA-file: vectors as few-bit cells, full vectors only where distance intervals overlap.

1. Every kept vector becomes integers. Cell edges of each dimension are quantiles of a bounded
   sample (about ``SAMPLE`` rows, by hash); they decide speed only. One table is written with the
   cells (``BITS`` a dimension), the full vector beside them, and partitions by margin class:
   how much nearer the first centroid is than the second. Both parts are columns of their own,
   so a scan of the cells reads no full vector.
2. The first round assigns all vectors exactly and sums them by cluster.
3. A later round needs only the vectors that move. A scan of the cells looks up, for each
   vector, an interval of the distance to every old and new centroid in tables by cell
   (``Cells.nearest``); where the intervals of two centroids overlap, the interval of the
   difference of both distances, which is narrower, may still decide. Vectors decided both
   times and equally need nothing more. The others are fetched, class by class: classes
   without such a vector are pruned from the scan. Sums change by what moved.
4. The last assignment reads all vectors, as it reports distances.

Arithmetic is on 64-bit integers, so sums, floors and ties are exact. The driver holds centroids,
sums and counts by class. Rounds write nothing and shuffle only per-task sums.

Defined cases: vectors of another size, or with a null, NaN or infinite component, are left
out, as are null vectors; a component beyond ``LARGEST`` in size raises an error, as distances
would pass 64 bits; a null vec_id hashes as the text ``3:null`` and stays null in the result;
repeated vec_ids each give their row (starts tie by their components); fewer vectors than
centroids give as many centroids as vectors; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C

SIZE = 64              # components of a vector
SCALE = 1024           # a component becomes floor(SCALE * x)
CENTROIDS = 8
ROUNDS = 10
BITS = 8               # of a cell; at 6 bits four times as many vectors are fetched
SAMPLE = 4096          # vectors whose quantiles are the cells' edges
CLASSES = 32           # margin classes
LARGEST = 1 << 24      # size of an integer component: 64 squared differences stay within 63 bits


def kept_vectors(table: DataFrame, size: int = SIZE) -> DataFrame:
    """(vec_id, v, h): integer vectors and the hash that orders the starts."""
    e = F.col("embedding")
    sound = F.coalesce((F.size(e) == size) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))), F.lit(False))
    scaled = F.transform(e, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    fits = F.forall(e, lambda x: F.abs(x.cast("double")) <= F.lit(LARGEST / SCALE))
    v = F.when(fits, scaled).otherwise(F.raise_error(F.lit(f"a vector component is larger than {LARGEST // SCALE}")).cast("array<bigint>"))
    h = F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).where(sound).select("vec_id", v.alias("v"), h.alias("h"))


def _squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all vectors to all centroids."""
    out = np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        d = x - c
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Packed 32-bit vectors as rows of 64-bit integers."""
    raw = column.cast(pa.large_binary())
    start = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset]
    return np.frombuffer(raw.buffers()[2], np.int32, len(raw) * size, int(start)).reshape(-1, size).astype(np.int64)


class Cells:
    """Cell bounds by dimension and the distance intervals that follow from them."""

    def __init__(self, edges: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.size = len(edges)
        self.low = np.concatenate([low[:, None], edges], axis=1)
        self.high = np.concatenate([edges - 1, high[:, None]], axis=1)
        self._at = np.arange(self.size) * self.low.shape[1]

    def _sum(self, table: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return table.ravel()[cells + self._at].sum(axis=1)

    def nearest(self, cells: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """The centroid that is nearest wherever in its cell a vector lies (ties: the smaller number); -1 where the cells do not tell."""
        n, k = len(cells), len(centroids)
        cells = cells.astype(np.int64)
        lower, upper = np.empty((n, k), np.int64), np.empty((n, k), np.int64)
        for j, c in enumerate(centroids):
            under, over = self.low - c[:, None], self.high - c[:, None]
            lower[:, j] = self._sum(np.where((under <= 0) & (over >= 0), 0, np.minimum(np.abs(under), np.abs(over))) ** 2, cells)
            upper[:, j] = self._sum(np.maximum(np.abs(under), np.abs(over)) ** 2, cells)
        best = np.argmin(lower + upper, axis=1)
        most = upper[np.arange(n), best]
        open_ = np.zeros((n, k), bool)  # pairs whose distance intervals overlap
        for j in range(k):
            open_[:, j] = (best != j) & ~((most < lower[:, j]) | ((most == lower[:, j]) & (best < j)))
        for b in range(k):
            for j in range(k):
                rows = np.flatnonzero((best == b) & open_[:, j])
                if len(rows):
                    w = 2 * (centroids[j] - centroids[b])
                    most = self._sum(np.maximum(w[:, None] * self.low, w[:, None] * self.high), cells[rows]) + (centroids[b] ** 2).sum() - (centroids[j] ** 2).sum()
                    open_[rows, j] = ~((most < 0) | ((most == 0) & (b < j)))
        return np.where(open_.any(axis=1), -1, best)


def _cell_numbers(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, d], side="right") for d, e in enumerate(edges)], axis=1).astype(np.uint8)


def _margin(squares: np.ndarray) -> np.ndarray:
    """0 where two centroids are about equally near, up to CLASSES - 1 where the nearest is far nearer."""
    if squares.shape[1] < 2:
        return np.full(len(squares), CLASSES - 1, np.int64)
    two = np.sqrt(np.partition(squares, 1, axis=1)[:, :2].astype(float))
    return np.minimum((CLASSES * (two[:, 1] - two[:, 0]) / np.maximum(two[:, 1], 1)).astype(np.int64), CLASSES - 1)


def _packed(edges: np.ndarray, starts: np.ndarray):
    size = len(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.table(batches):
            x = batch.column("v").flatten().to_numpy().reshape(-1, size)
            cells = _cell_numbers(x, edges)
            n = len(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([c.tobytes() for c in cells], pa.binary()), pa.array([r.tobytes() for r in x.astype(np.int32)], pa.binary()),
                 pa.array(_margin(_squares(x, starts)) if n else [], pa.int32())], names=["vec_id", "cells", "vec", "margin"])
    return run


_SUMS = "cluster int, n long, total array<long>, low array<long>, high array<long>"


def _sums(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["cluster", "n", "total", "low", "high"])


def _first_sums(starts: np.ndarray):
    """Per task and cluster: count, sums, and the bounds of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = starts.shape
        n, total, low, high = np.zeros(k, np.int64), np.zeros((k, size), np.int64), None, None
        for batch in C.table(batches):
            x = _matrix(batch.column("vec"), size)
            near = _squares(x, starts).argmin(axis=1)
            n += np.bincount(near, minlength=k)
            for j in range(k):
                total[j] += x[near == j].sum(axis=0)
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            yield _sums([(j, int(n[j]), total[j].tolist(), low.tolist(), high.tolist()) for j in range(k)])
    return run


def _unsettled(cells: Cells, old: np.ndarray, new: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    """Rows whose cells leave open whether they stay in their cluster."""
    c = np.frombuffer(b"".join(batch.column("cells").to_pylist()), np.uint8).reshape(-1, cells.size)
    before, after = cells.nearest(c, old), cells.nearest(c, new)
    return np.flatnonzero((before < 0) | (before != after))


def _open_classes(cells: Cells, old: np.ndarray, new: np.ndarray):
    """Per task and margin class: how many vectors have to be fetched."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(CLASSES, np.int64)
        for batch in C.table(batches):
            margin = batch.column("margin").to_numpy()
            count += np.bincount(margin[_unsettled(cells, old, new, batch)], minlength=CLASSES)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used])], names=["margin", "n"])
    return run


def _moves(cells: Cells, old: np.ndarray, new: np.ndarray):
    """Per task and cluster: what moved in, less what moved out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = new.shape
        n, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in C.table(batches):
            rows = _unsettled(cells, old, new, batch)
            if not len(rows):
                continue
            x = _matrix(batch.column("vec").take(pa.array(rows)), size)
            before, after = _squares(x, old).argmin(axis=1), _squares(x, new).argmin(axis=1)
            moved = before != after
            for j in range(k):
                came, went = moved & (after == j), moved & (before == j)
                n[j] += came.sum() - went.sum()
                total[j] += x[came].sum(axis=0) - x[went].sum(axis=0)
        if total.any() or n.any():
            yield _sums([(j, int(n[j]), total[j].tolist(), None, None) for j in range(k)])
    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.table(batches):
            squares = _squares(_matrix(batch.column("vec"), centroids.shape[1]), centroids)
            near = squares.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(near, pa.int32()), pa.array(squares[np.arange(len(near)), near])], names=["vec_id", "cluster", "distance"])
    return run


def _added(parts: DataFrame, k: int, size: int, bounds: bool = False) -> tuple[np.ndarray, ...]:
    """Counts and sums by cluster over all tasks (and the dimensions' bounds); k rows reach the driver."""
    what = [F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(size)]).alias("total")]
    if bounds:
        what += [F.array(*[f(F.col(c)[i]) for i in range(size)]).alias(c) for c, f in (("low", F.min), ("high", F.max))]
    n, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
    rows = parts.groupBy("cluster").agg(*what).collect()
    for r in rows:
        n[r.cluster], total[r.cluster] = r["n"], r["total"]
    return (n, total, np.array(rows[0].low, np.int64), np.array(rows[0].high, np.int64)) if bounds else (n, total)


def _means(n: np.ndarray, total: np.ndarray, before: np.ndarray) -> np.ndarray:
    return np.where(n[:, None] > 0, total // np.maximum(n, 1)[:, None], before)


def _sample(kept: DataFrame, size: int) -> np.ndarray:
    """About SAMPLE vectors by a hash of their content, twice as many at most."""
    every = max(1, kept.count() // SAMPLE)
    some = kept.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(every)) == 0).limit(2 * SAMPLE).select("v").collect()
    return np.array([r.v for r in some or kept.limit(1).collect()], np.int64).reshape(-1, size)


class Clustering:
    """Centroids after all rounds, the written table, and how many vectors each round fetched."""

    def __init__(self, table: DataFrame | None, centroids: np.ndarray, fetched: list[int]):
        self.table, self.centroids, self.fetched = table, centroids, fetched


def fit(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, bits: int = BITS, size: int = SIZE,
        watch: Callable[[int, list[int]], None] | None = None) -> Clustering:
    """Cluster ``vectors`` (vec_id, embedding). ``watch`` is told the round and the margin classes that it reads."""
    kept = kept_vectors(vectors, size)
    starts = np.array([r.v for r in kept.orderBy("h", "v").limit(k).select("v").collect()], np.int64).reshape(-1, size)
    if not len(starts):
        return Clustering(None, starts, [])
    some = _sample(kept, size)
    cells = 1 << bits
    edges = np.ascontiguousarray(np.sort(some, axis=0)[np.arange(1, cells) * len(some) // cells].T)
    table = kept.select("vec_id", "v").mapInArrow(_packed(edges, starts), "vec_id long, cells binary, vec binary, margin int")
    table = C.materialise(table.hint("rebalance", "margin"), "vectors", ["margin"])
    n, total, low, high = _added(table.select("vec").mapInArrow(_first_sums(starts), _SUMS), len(starts), size, bounds=True)
    bounds = Cells(edges, low, high)
    old, new, fetched = starts, _means(n, total, starts), []
    for turn in range(2, rounds + 1):
        if (old == new).all():
            break
        open_ = table.select("cells", "margin").mapInArrow(_open_classes(bounds, old, new), "margin int, n long").groupBy("margin").agg(F.sum("n").alias("n")).collect()
        fetched.append(sum(r["n"] for r in open_))
        classes = sorted(r.margin for r in open_)
        if watch:
            watch(turn, classes)
        if classes:
            dn, dt = _added(table.where(F.col("margin").isin(classes)).select("cells", "vec").mapInArrow(_moves(bounds, old, new), _SUMS), len(starts), size)
            n, total = n + dn, total + dt
        old, new = new, _means(n, total, new)
    return Clustering(table, new, fetched)


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def assign(c: Clustering, spark: SparkSession) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    if c.table is None:
        return spark.createDataFrame([], RESULT)
    rows = c.table.select("vec_id", "vec").mapInArrow(_assigned(c.centroids), "vec_id long, cluster int, distance long")
    inertia = {r.cluster: r.s for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    by_cluster = spark.createDataFrame(
        [(j, s, sum(inertia.values()), hashlib.sha256(",".join(map(str, c.centroids[j].tolist())).encode()).hexdigest()) for j, s in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(by_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_va_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(fit(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")), spark)
