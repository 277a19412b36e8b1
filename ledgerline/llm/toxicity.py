"""Toxicity: a counterfactually regularised logistic classifier over word presence.

Learned in one task from a bounded sample of labelled rows (SAMPLE rows, texts up to
SAMPLE_CHARS code points, chosen by a hash of doc_id; rows with remainder 2 are held out).
Words and word beginnings whose presence goes with the label beyond chance become features, identity terms always
do. Each labelled sentence with an identity term is paired with copies that hold a term of
another group instead; a sample of sentences without one gets terms inserted. The training
loss adds the squared change of the score over each pair, so that a mere mention of a group
moves a score neither up nor down.

Scoring reads whole texts: words are hashed by vector operations, looked up among the few
thousand features (a broadcast of bounded size), and the weights of a text's distinct features
are summed.

Defined cases: null or empty text has no features and gets the base score; a table without
labels gives 0 for all; a null doc_id is not held out and not learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C

SAMPLE = 8_000         # labelled rows that are learned from, about
SAMPLE_CHARS = 6_000   # longer texts are scored, not learned from
FEATURES = 2_000       # words and stems with a weight, identity terms aside
STEM = 6               # bytes of a stem
THRESHOLD = 0.3
PAIRS = 4_000          # counterfactual pairs
PENALTY = 16.0         # weight of the squared score changes: at 4, terms in biased labels still carry neutral texts over the threshold
# Terms of social groups, by language; a term is swapped for others of its language.
IDENTITY = {
    "en": ("women men girls boys gay lesbian straight bisexual transgender black white asian latino african european american mexican "
           "indian chinese muslim muslims christian christians jewish jews hindu buddhist atheist catholic immigrant immigrants refugees "
           "disabled deaf blind old young feminist feminists").split(),
    "fr": ("femmes hommes filles gay lesbienne noirs blancs africains arabes asiatiques chinois musulman musulmans chrétien chrétiens juif juifs "
           "bouddhiste athée catholique immigrés réfugiés handicapés sourds aveugles vieux jeunes féministes").split(),
    "de": ("frauen männer mädchen jungen schwul lesbisch schwarze weiße afrikaner asiaten chinesen türken muslim muslime christ christen jude juden "
           "buddhist atheist katholik einwanderer flüchtlinge behinderte gehörlose blinde alte junge feministin").split(),
    "es": ("mujeres hombres chicas chicos gay lesbiana negros blancos africanos asiáticos latinos chinos musulmán musulmanes cristiano cristianos "
           "judío judíos budista ateo católico inmigrantes refugiados discapacitados sordos ciegos viejos jóvenes feministas").split(),
}
TERMS = sorted({w for words in IDENTITY.values() for w in words})


def held_out() -> Column:
    return F.coalesce(F.expr("crc32(encode(CAST(doc_id AS string), 'UTF-8')) % 4 = 2"), F.lit(False))


def hash_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of every word (run of letters, A-Z lower-cased) of the texts, and of the first STEM bytes of longer ones."""
    data, offsets = C.text_buffer(texts)
    data = C.lower_ascii(data)
    start, end, first = C.word_spans(data, offsets, C.NOT_LETTER)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    long = np.flatnonzero(end - start > STEM)
    stem = np.zeros(len(long), np.uint64)
    for k in range(STEM):
        stem = stem * np.uint64(257) + data[start[long] + k].astype(np.uint64) + np.uint64(1)
    return np.concatenate([owner, owner[long]]), np.concatenate([C.word_hashes(data, start, end, C.NOT_LETTER), C.mix(stem)])


class Toxicity:
    """Sorted feature hashes, their weights, and the base score's weight."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float):
        self.hashes, self.weights, self.bias = hashes, weights, bias

    def score(self, texts: pa.Array) -> np.ndarray:
        owner, h = hash_words(texts)
        z = np.full(len(texts), self.bias)
        if len(self.hashes) and len(h):
            at = np.searchsorted(self.hashes, h)
            at[at == len(self.hashes)] = 0
            hit = np.flatnonzero(self.hashes[at] == h)
            pair = np.unique(owner[hit] * len(self.hashes) + at[hit])
            z += np.bincount(pair // len(self.hashes), self.weights[pair % len(self.hashes)], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def counterfactuals(texts: list[str], seed: int = 3) -> list[tuple[str, str]]:
    """(sentence, the same with another group's term): swapped where a term stands, inserted in sentences of a sample of texts."""
    rng = np.random.default_rng(seed)
    term = re.compile(r"\b(" + "|".join(TERMS) + r")\b", re.IGNORECASE)
    others = {w: sorted({o for words in IDENTITY.values() if w in words for o in words} - {w}) for w in TERMS}
    swap = lambda s: term.sub(lambda m: str(rng.choice(others[m[0].lower()])), s)
    sentences = lambda text: [s.strip() for s in re.split(r"[.!?\n]+", text) if s.strip()]
    pairs = []
    for text in texts:
        if len(pairs) >= PAIRS // 2:
            break
        if term.search(text):
            pairs += [(s, swap(s)) for s in sentences(text) if term.search(s) for _ in range(2)]
    plain = [s for k in rng.permutation(len(texts))[:400].tolist() for s in sentences(texts[k]) if not term.search(s)]
    for k in rng.permutation(len(plain))[:max(0, PAIRS - len(pairs))].tolist():
        words = plain[k].split()
        i = int(rng.integers(0, len(words) + 1))
        pairs.append((plain[k], " ".join([*words[:i], str(rng.choice(TERMS)), *words[i:]])))
    return pairs


def _rows(texts: list[str], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the distinct features of each text."""
    rows, cols = [], []
    for a in range(0, len(texts), 2000):
        owner, h = hash_words(pa.array(texts[a:a + 2000], pa.string()))
        at = np.searchsorted(hashes, h)
        at[at == len(hashes)] = 0
        hit = np.flatnonzero(hashes[at] == h)
        pair = np.unique(owner[hit] * len(hashes) + at[hit])
        rows.append(pair // len(hashes) + a)
        cols.append(pair % len(hashes))
    return np.concatenate(rows), np.concatenate(cols)


def train(texts: list[str], labels: np.ndarray, penalty: float = PENALTY) -> Toxicity:
    """Logistic regression with L2 and the counterfactual penalty, by Adam on all rows."""
    found, marked = [], []  # the distinct words of each text, and its label
    for a in range(0, len(texts), 500):
        owner, h = hash_words(pa.array(texts[a:a + 500], pa.string()))
        order = np.lexsort((h, owner))
        owner, h = owner[order], h[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
        found.append(h[new])
        marked.append(labels[owner[new] + a] == 1)
    found, marked = np.concatenate(found), np.concatenate(marked)
    n = [max(1, int((labels == k).sum())) for k in (0, 1)]
    words, count = np.unique(found, return_counts=True)
    words, count = words[count >= 5], count[count >= 5]
    hit, times = np.unique(found[marked], return_counts=True)
    del found, marked
    # How far the two shares lie apart, in standard errors.
    c1 = np.zeros(len(words))
    at = np.searchsorted(hit, words)
    at[at == len(hit)] = 0
    if len(hit):
        c1 = np.where(hit[at] == words, times[at], 0).astype(float)
    c0 = count - c1
    p = (c0 + c1 + 1) / (n[0] + n[1] + 2)
    z = (c1 / n[1] - c0 / n[0]) / np.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1]))
    best = [i for i in np.argsort(-np.abs(z))[:FEATURES].tolist() if abs(z[i]) >= 6]
    identity = C.word_hashes(*_one_per_word(TERMS))
    hashes = np.unique(np.concatenate([words[best], identity]))
    rows, cols = _rows(texts, hashes)
    pairs = counterfactuals(texts)
    a_rows, a_cols = _rows([a for a, _ in pairs], hashes) if pairs else (np.empty(0, int), np.empty(0, int))
    b_rows, b_cols = _rows([b for _, b in pairs], hashes) if pairs else (np.empty(0, int), np.empty(0, int))
    params = np.zeros(len(hashes) + 1)
    params[-1] = np.log(n[1] / n[0])
    m, v = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    total = lambda r, c, size: np.bincount(r, params[c], minlength=size) + params[-1]
    for step in range(1, 401):
        err = (sigmoid(total(rows, cols, len(texts))) - labels) / len(texts)
        grad = np.append(np.bincount(cols, err[rows], minlength=len(hashes)), err.sum())
        grad[:-1] += 1e-4 * params[:-1]
        if pairs:
            sa, sb = sigmoid(total(a_rows, a_cols, len(pairs))), sigmoid(total(b_rows, b_cols, len(pairs)))
            push = 2 * penalty * (sa - sb) / len(pairs)
            ga, gb = push * sa * (1 - sa), -push * sb * (1 - sb)
            grad[:-1] += np.bincount(a_cols, ga[a_rows], minlength=len(hashes)) + np.bincount(b_cols, gb[b_rows], minlength=len(hashes))
            grad[-1] += ga.sum() + gb.sum()
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        params -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Toxicity(hashes, params[:-1], float(params[-1]))


def _one_per_word(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = C.text_buffer(pa.array(words, pa.string()))
    return data, *C.word_spans(data, offsets, C.NOT_LETTER)[:2], C.NOT_LETTER


def learn(docs: DataFrame, labels: DataFrame) -> Toxicity | None:
    known = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out()))
    n = known.count()
    if not n:
        return None
    part = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    chosen = known.where(part < min(1.0, SAMPLE / n))  # ids and labels of the sample: a bounded table
    short = C.id_and_text(docs).where((F.length("text") <= SAMPLE_CHARS) & (part < min(1.0, SAMPLE / n)))
    rows = short.join(chosen, "doc_id").dropDuplicates(["doc_id"]).select(F.col("doc_id").cast("long"), "text", F.col("toxic").cast("int"))
    return C.fit_in_task(rows, _fit)


def _fit(rows: pa.Table) -> Toxicity | None:
    rows = rows.sort_by("doc_id")
    toxic = rows.column("toxic").to_numpy().astype(np.int64)
    return train(rows.column("text").to_pylist(), toxic) if len(np.unique(toxic)) == 2 else None


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.table(batches):
            for chunk in C.text_chunks(batch):
                score = shared.value.score(chunk.column("text"))
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("held_out"), pa.array(score),
                                                  pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    rows = C.id_and_text(docs).withColumn("held_out", held_out())
    model = learn(docs, labels)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, held_out boolean, score double, predicted int")


def _keep(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.table(batches):
            for chunk in C.text_chunks(batch):
                yield chunk.filter(pa.array(shared.value.score(chunk.column("text")) < THRESHOLD))
    return run


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: rows of ``docs`` below the threshold."""
    model = learn(docs, labels)
    return docs if model is None else docs.mapInArrow(C.freeing(_keep(docs.sparkSession.sparkContext.broadcast(model))), docs.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
