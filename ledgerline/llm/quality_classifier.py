"""Quality classifier by co-training: text content and page metadata teach each other.

Two logistic classifiers see different sides of a document. The content view has shares of
byte kinds and punctuation, word lengths and repetition; the metadata view has source, lang,
the stated length, and the page's lines. Values are cut into bins at quantiles of the sample.
Rounds: each classifier labels a pool of unlabelled documents and hands its most confident
ones, as many of each label as the labelled rows' proportions ask for, to the other as
training rows; only documents beyond the score from which its labels are right for PRECISION
of the rows kept back, so a view that cannot tell hands nothing over. After the last round each view's scores are calibrated (Platt) on labelled rows
kept back for it, and the views' calibrated log-odds, less the prior's that both hold, score
every document together.

Learning reads a bounded sample: LABELLED labelled and POOL other documents, chosen by a hash
of doc_id, reduced to their features in the tasks. The features of all documents are computed
from whole texts in one pass; the two models are a few thousand numbers.

Defined cases: null text is empty; null source or lang is a value of its own; documents
without labels are only scored; a table without labels, or with one label only, gives 0.5; a
null doc_id is scored and not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C

LABELLED = 8_000
POOL = 8_000
ROUNDS = 5
GROW = 0.05            # share of the pool that each view hands over in a round
BINS = 8
PRECISION = 0.98       # share of right labels, on rows kept back, that a handed-over score must reach
SUPPORT = 20           # rows kept back that must bear it out
CATEGORIES = 1_024     # values of source and of lang that have a weight of their own, the most frequent of the sample
SELDOM = 5             # rows of the sample that a value must have; all others share one weight
THRESHOLD = 0.5
N_TEXT, N_META = 44, 4


def held_out() -> Column:
    """Labelled rows that no view learns from; they show the result's accuracy."""
    return F.coalesce(F.expr("crc32(encode(CAST(doc_id AS string), 'UTF-8')) % 5 = 3"), F.lit(False))


def _views(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Content and metadata numbers of each row of a chunk; the last two metadata columns are hashes of categories."""
    data, offsets = C.text_buffer(chunk.column("text"))
    rows, size = chunk.num_rows, np.diff(offsets)
    owner = np.repeat(np.arange(rows), size)
    kinds = np.bincount(owner * 256 + data, minlength=rows * 256).reshape(rows, 256).astype(float)
    n = np.maximum(size, 1)[:, None]
    upper, lower, digit = kinds[:, 65:91].sum(1), kinds[:, 97:123].sum(1), kinds[:, 48:58].sum(1)
    marks = [kinds[:, [b]] for b in b"!\"#$%&'()*+,-./:;<=>?@[]_|~"]
    start, end, first = C.word_spans(data, offsets)
    count = np.diff(first)
    word_owner = np.repeat(np.arange(rows), count)
    h = C.word_hashes(data, start, end)
    words = np.maximum(count, 1)
    distinct = lambda own, x: np.bincount(_unique_owner(own, x), minlength=rows)
    win_owner, at = C.window_starts(first, 3)
    windows = C.window_hashes(h, 3)[at] if len(at) else np.empty(0, np.uint64)
    n_windows = np.maximum(np.bincount(win_owner, minlength=rows), 1)
    content = np.column_stack([
        *[m / n for m in marks], sum(marks) / n, upper[:, None] / n, lower[:, None] / n, digit[:, None] / n, kinds[:, 128:].sum(1)[:, None] / n,
        kinds[:, [32]] / n, (np.bincount(word_owner, end - start, minlength=rows) / words)[:, None], (distinct(word_owner, h) / words)[:, None],
        (distinct(win_owner, windows) / n_windows)[:, None], (upper / np.maximum(upper + lower, 1))[:, None], np.log1p(count)[:, None]])
    content = np.pad(content, ((0, 0), (0, N_TEXT - content.shape[1])))
    lines = kinds[:, 10] + 1
    stated = np.asarray(chunk.column("n_chars").fill_null(0), dtype=float)
    category = lambda c: np.array([xxhash.xxh64_intdigest("" if v is None else "=" + v) >> 12 for v in chunk.column(c).to_pylist()], dtype=float)
    meta = np.column_stack([np.log1p(np.maximum(stated, 0)), np.log1p(lines), category("source"), category("lang")])
    return content, meta


def _unique_owner(owner: np.ndarray, x: np.ndarray) -> np.ndarray:
    order = np.lexsort((x, owner))
    owner, x = owner[order], x[order]
    new = np.ones(len(x), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (x[1:] != x[:-1])
    return owner[new]


def _frequent_values(x: np.ndarray) -> np.ndarray:
    """Sorted values with SELDOM rows or more, at most CATEGORIES."""
    values, count = np.unique(x, return_counts=True)
    often = np.flatnonzero(count >= SELDOM)
    return values[np.sort(often[np.argsort(-count[often], kind="stable")[:CATEGORIES]])]


def trusted(z: np.ndarray, right: np.ndarray) -> float:
    """The least score from which at least PRECISION of the rows, SUPPORT of them or more, are right; infinite where there is none."""
    order = np.argsort(-z, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(z) + 1)
    whole = np.append(z[order][1:] != z[order][:-1], True) if len(z) else np.empty(0, bool)  # equal scores go together
    good = np.flatnonzero((share >= PRECISION) & whole & (np.arange(1, len(z) + 1) >= SUPPORT))
    return float(z[order][good[-1]]) if len(good) else np.inf


class View:
    """A logistic classifier over binned numbers and categories, with a calibration of its log-odds."""

    def __init__(self, sample: np.ndarray, categories: int):
        numbers = sample.shape[1] - categories
        self.edges = [np.unique(np.quantile(sample[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(numbers)]
        self.values = [_frequent_values(sample[:, numbers + k]) for k in range(categories)]
        self.slope, self.shift = 1.0, 0.0
        self.weights = np.zeros(numbers * BINS + sum(len(v) + 1 for v in self.values) + 1)

    def columns(self, x: np.ndarray) -> np.ndarray:
        numbers = len(self.edges)
        cols = [np.searchsorted(e, x[:, j], side="right") + j * BINS for j, e in enumerate(self.edges)]
        base = numbers * BINS
        for k, known in enumerate(self.values):
            value = x[:, numbers + k]
            at = np.minimum(np.searchsorted(known, value), max(len(known) - 1, 0))
            cols.append(base + np.where(known[at] == value, at, len(known)) if len(known) else np.full(len(x), base))
            base += len(known) + 1
        return np.column_stack(cols)

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 200) -> None:
        cols = self.columns(x)
        w = self.weights = np.zeros_like(self.weights)
        m, v = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, steps + 1):
            err = (1 / (1 + np.exp(-np.clip(w[cols].sum(1) + w[-1], -30, 30))) - y) / len(y)
            grad = np.bincount(cols.ravel(), np.repeat(err, cols.shape[1]), minlength=len(w)) + 1e-4 * w
            grad[-1] = err.sum()
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.columns(x)].sum(1) + self.weights[-1]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        z = self.raw(x)
        a, b = 0.0, 0.0
        for _ in range(30):  # Newton's steps, slightly held back so that separable rows keep a finite slope
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            w = np.maximum(p * (1 - p), 1e-6)
            g = np.array([((p - y) * z).sum() + 0.01 * a, (p - y).sum()])
            h = np.array([[(w * z * z).sum() + 0.01, (w * z).sum()], [(w * z).sum(), w.sum() + 0.01]])
            da, db = np.linalg.solve(h, g)
            a, b = a - float(np.clip(da, -1, 1)), b - float(np.clip(db, -1, 1))
        self.slope, self.shift = max(a, 0.0), b

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


class CoTraining:
    def __init__(self, content: np.ndarray, meta: np.ndarray, y: np.ndarray, back: np.ndarray, rounds: int = ROUNDS):
        """``y`` is 1, 0, or -1 for the pool; ``back`` marks labelled rows kept for calibration."""
        self.views = [View(content, 0), View(meta, 2)]
        x = [content, meta]
        pool = np.flatnonzero(y < 0)
        own = [np.flatnonzero((y >= 0) & ~back)] * 2
        labels = [y.copy(), y.copy()]
        share = y[own[0]].mean()
        for _ in range(rounds):
            for k in (0, 1):
                self.views[k].fit(x[k][own[k]], labels[k][own[k]])
            handed = []
            for k in (0, 1):
                free = pool[~np.isin(pool, own[1 - k])]
                z = self.views[k].raw(x[k][free])
                order, z = free[np.argsort(z, kind="stable")], np.sort(z)
                held = self.views[k].raw(x[k][back])
                n_bad, n_good = int((-z >= trusted(-held, y[back] == 0)).sum()), int((z >= trusted(held, y[back] == 1)).sum())
                take = min(GROW * len(pool), n_bad / (1 - share), n_good / share)  # both labels in proportion
                handed.append((order[:int(take * (1 - share))], order[len(order) - int(take * share):]))
            for k, (bad, good) in enumerate(handed):
                labels[1 - k][bad], labels[1 - k][good] = 0, 1
                own[1 - k] = np.unique(np.concatenate([own[1 - k], bad, good]))
        test = back if back.any() and len(np.unique(y[back])) == 2 else y >= 0
        self.prior = float(np.log(share / (1 - share)))
        for k in (0, 1):
            self.views[k].fit(x[k][own[k]], labels[k][own[k]])
            self.views[k].calibrate(x[k][test], y[test])

    def score(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Content, metadata and combined probabilities."""
        odds = [v.odds(x) for v, x in zip(self.views, (content, meta), strict=True)]
        both = odds[0] + odds[1] - self.prior
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (*odds, both))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in C.table(batches):
        for chunk in C.text_chunks(batch):
            content, meta = _views(chunk)
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("quality"), pa.array(content.tolist(), pa.list_(pa.float64())),
                                              pa.array(meta.tolist(), pa.list_(pa.float64()))], names=["doc_id", "quality", "content", "meta"])


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.table(batches):
            for chunk in C.text_chunks(batch):
                a, b, both = shared.value.score(*_views(chunk))
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("held_out"), pa.array(a), pa.array(b), pa.array(both),
                                                  pa.array(both >= THRESHOLD)], names=["doc_id", "held_out", "text_score", "meta_score", "score", "kept"])
    return run


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *[F.col(c).cast(t).alias(c) if c in docs.columns else F.lit(None).cast(t).alias(c)
                         for c, t in (("source", "string"), ("lang", "string"), ("n_chars", "long"))])


def learn(docs: DataFrame, labels: DataFrame) -> CoTraining | None:
    known = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min(F.col("quality").cast("int")).alias("quality")).where(~held_out()))
    docs = _columns(docs).where("doc_id IS NOT NULL")
    n, total = known.count(), docs.count()
    if not n:
        return None
    part = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    other = F.pmod(F.xxhash64(F.lit("pool"), "doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    chosen = part < min(1.0, LABELLED / n)
    sample = docs.where(chosen | (other < min(1.0, POOL / max(total, 1)))).join(known, "doc_id", "left")
    sample = sample.where(F.col("quality").isNull() | chosen).dropDuplicates(["doc_id"])
    rows = sample.mapInArrow(_features, "doc_id long, quality int, content array<double>, meta array<double>").toPandas().sort_values("doc_id")
    y = rows["quality"].fillna(-1).to_numpy(dtype=np.int64)
    if len(np.unique(y[y >= 0])) < 2:
        return None
    back = (y >= 0) & (np.array([xxhash.xxh32_intdigest(f"back {i}") for i in rows["doc_id"]]) % 5 == 0)
    return CoTraining(np.array(rows["content"].tolist()), np.array(rows["meta"].tolist()), y, back)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, text_score, meta_score, score, kept) for every row of ``docs``."""
    model = learn(docs, labels)
    rows = _columns(docs).withColumn("held_out", held_out())
    if model is None:
        return rows.select("doc_id", "held_out", *[F.lit(0.5).alias(c) for c in ("text_score", "meta_score", "score")], F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_scores(shared), "doc_id long, held_out boolean, text_score double, meta_score double, score double, kept boolean")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
