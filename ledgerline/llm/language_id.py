"""Language ID by a byte convolutional network, trained in numpy and applied to whole texts.

Bytes (A-Z lower-cased) go through filters of several widths, a maximum over each window of
WINDOW bytes, and a softmax. A filter is kept as one table of 256 weights for each of its
positions, which is an embedding and a filter in one. A text is cut into such windows up to
its end and predicted by the mean of their probabilities. For whole texts the tables of two
neighbouring positions are summed beforehand into one of 65,536 pairs of bytes.

Training reads a bounded sample: about SAMPLE labelled documents of each language, chosen by a
hash of doc_id, one piece of PIECE code points from each, from a hashed place. The network has
some ten thousand weights and goes to the tasks as a broadcast.

Defined cases: null or letterless text is ``und`` with score 0; a table without labelled rows
makes all ``und``; rows with null lang are predicted but not learned from; a null doc_id is
not held out and not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C

WIDTHS = (2, 3, 4)
FILTERS = 12          # of each width
WINDOW = 256
PIECE = 256
SAMPLE = 1500
STEPS = 1500
BATCH = 64
UNKNOWN = "und"
KEEP = 0.5            # the pipeline rejects documents with a lower score
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_letter = regex.compile(r"\p{L}")


class ByteConvNet:
    def __init__(self, names: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.names = names
        self.tables = [rng.normal(0, 0.1, (w, FILTERS, 256)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names))).astype(np.float32)
        self.out_bias = np.zeros(len(names), np.float32)

    # -- training ---------------------------------------------------------------------

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 8) -> ByteConvNet:
        """Adam on the cross entropy; gradients reach the tables only at the places of the maxima."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.bias, self.out, self.out_bias]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        balance = [np.flatnonzero(labels == k) for k in range(len(self.names))]
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(b, max(1, BATCH // len(balance))) for b in balance])
            x, y = windows[pick], labels[pick]
            # Short texts too: some windows end early.
            stop = rng.integers(16, x.shape[1] + 1, len(x)) * (rng.random(len(x)) < 0.4)
            x = np.where((stop[:, None] > 0) & (np.arange(x.shape[1]) >= stop[:, None]), 0, x)
            hidden, places = [], []
            for table in self.tables:
                w = len(table)
                n = x.shape[1] - w + 1
                conv = sum(table[k][:, x[:, k:k + n]] for k in range(w))  # filters x rows x places
                places.append(conv.argmax(axis=2))
                hidden.append(np.take_along_axis(conv, places[-1][:, :, None], axis=2)[:, :, 0].T)
            pre = np.concatenate(hidden, axis=1) + self.bias
            act = np.tanh(pre)
            p = _softmax(act @ self.out + self.out_bias)
            g = p.copy()
            g[np.arange(len(y)), y] -= 1
            g /= len(y)
            g_pre = (g @ self.out.T) * (1 - act * act)
            grads = []
            for t, (table, at) in enumerate(zip(self.tables, places, strict=True)):
                part = g_pre[:, t * FILTERS:(t + 1) * FILTERS]
                grad = np.zeros_like(table)
                rows, cols = np.meshgrid(np.arange(len(x)), np.arange(FILTERS), indexing="ij")
                for k in range(len(table)):
                    np.add.at(grad[k], (cols, x[rows, at.T + k]), part)
                grads.append(grad)
            grads += [g_pre.sum(axis=0), act.T @ g + 1e-4 * self.out, g.sum(axis=0)]
            rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
            for q, grad, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                q -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        return self

    # -- prediction -------------------------------------------------------------------

    def pair_tables(self) -> list[list[np.ndarray]]:
        """For each filter its tables of byte pairs (first byte * 256 + second); a last single position is paired with nothing."""
        out = []
        for table in self.tables:
            w = len(table)
            for f in range(FILTERS):
                pairs = []
                for k in range(0, w, 2):
                    second = table[k + 1, f] if k + 1 < w else np.zeros(256, np.float32)
                    pairs.append(np.ascontiguousarray((table[k, f][:, None] + second[None, :]).ravel()))
                out.append(pairs)
        return out

    def predict(self, data: np.ndarray, offsets: np.ndarray, pairs: list[list[np.ndarray]]) -> np.ndarray:
        """Mean class probabilities of each text; rows of zeros for empty ones."""
        size = np.diff(offsets)
        blocks = -(-size // WINDOW)
        first = np.concatenate([[0], np.cumsum(blocks)])
        n = int(first[-1]) * WINDOW
        if not n:
            return np.zeros((len(size), len(self.names)))
        # Each text starts a window; its last one is filled up with zero bytes.
        x = np.zeros(n + 4, dtype=np.intp)
        target = np.arange(len(data)) + np.repeat(first[:-1] * WINDOW - offsets[:-1], size)
        x[target] = _LOWER[data]
        # Filters do not look from a text's padding into the next text: a window ends one filter width early there.
        pair = x[:-1] * 256 + x[1:]
        hidden = np.empty((int(first[-1]), len(pairs)), np.float32)
        step = 1024 * WINDOW
        conv, more = np.empty(step, np.float32), np.empty(step, np.float32)
        for a in range(0, n, step):
            b = min(a + step, n)
            for f, tables in enumerate(pairs):
                c = np.take(tables[0], pair[a:b], out=conv[:b - a], mode="clip")
                for k, t in enumerate(tables[1:], 1):
                    np.take(t, pair[a + 2 * k:b + 2 * k], out=more[:b - a], mode="clip")
                    c += more[:b - a]
                w = WIDTHS[f // FILTERS]
                hidden[a // WINDOW:b // WINDOW, f] = c.reshape(-1, WINDOW)[:, :WINDOW - w + 1].max(axis=1)
        p = _softmax(np.tanh(hidden + self.bias) @ self.out + self.out_bias).astype(np.float64)
        total = np.add.reduceat(np.concatenate([p, np.zeros((1, p.shape[1]))]), np.minimum(first[:-1], len(p)), axis=0)
        total[blocks == 0] = 0
        return total / np.maximum(blocks, 1)[:, None]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out() -> Column:
    return F.coalesce(F.expr("crc32(encode(CAST(doc_id AS string), 'UTF-8')) % 3 = 1"), F.lit(False))


def training_pieces(docs: DataFrame) -> DataFrame | None:
    """(lang, piece): the bounded sample. Counts are over all labelled rows; a language's share is SAMPLE of them."""
    rows = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, SAMPLE / n))])
    part = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    piece = F.expr(f"substring(text, 1 + pmod(xxhash64('place', doc_id), greatest(length(text) - {PIECE}, 1)), {PIECE})")
    return rows.where(part < share[F.col("lang")]).select("lang", piece.alias("piece"))


def learn(docs: DataFrame) -> ByteConvNet | None:
    pieces = training_pieces(docs)
    return None if pieces is None else C.fit_in_task(pieces, _fit)


def _fit(rows: pa.Table) -> ByteConvNet | None:
    pairs = sorted(zip(rows.column("lang").to_pylist(), rows.column("piece").to_pylist(), strict=True))
    pieces = [(lang, p) for lang, p in pairs if _letter.search(p)]
    if not pieces:
        return None
    names = sorted({lang for lang, _ in pieces})
    windows = np.zeros((len(pieces), WINDOW), dtype=np.intp)
    for i, (_, p) in enumerate(pieces):
        raw = np.frombuffer(p.encode()[:WINDOW], np.uint8)
        windows[i, :len(raw)] = _LOWER[raw]
    return ByteConvNet(names).train(windows, np.array([names.index(lang) for lang, _ in pieces]))


_RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        pairs = net.pair_tables()
        for batch in C.table(batches):
            for chunk in C.text_chunks(batch):
                data, offsets = C.text_buffer(chunk.column("text"))
                p = net.predict(data, offsets, pairs)
                best = p.argmax(axis=1)
                names, scores = [], []
                for i, text in enumerate(chunk.column("text").to_pylist()):
                    known = text is not None and _letter.search(text) is not None
                    names.append(net.names[best[i]] if known else UNKNOWN)
                    scores.append(min(1.0, float(p[i, best[i]])) if known else 0.0)
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("held_out"), pa.array(names, pa.string()),
                                                  pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; learned from the rows of ``docs`` that are not held out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    net = learn(docs)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    if net is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(net)), _RESULT)


def in_known_language(docs: DataFrame, least: float = KEEP) -> DataFrame:
    """Pipeline stage: rows of ``docs`` with a language, told with a score of at least ``least``.

    Without any labelled row no language can be told; then rows with a letter stay.
    """
    net = learn(docs)
    if net is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return docs.mapInArrow(C.freeing(_keep(docs.sparkSession.sparkContext.broadcast(net), least)), docs.schema)


def _keep(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        pairs = net.pair_tables()
        for batch in C.table(batches):
            for chunk in C.text_chunks(batch):
                p = net.predict(*C.text_buffer(chunk.column("text")), pairs).max(axis=1)
                known = [t is not None and _letter.search(t) is not None for t in chunk.column("text").to_pylist()]
                yield chunk.filter(pa.array((p >= least) & np.array(known, dtype=bool)))
    return run


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(C.documents(spark, sf_dir))
