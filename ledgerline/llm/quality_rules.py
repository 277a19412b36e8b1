"""Quality rules by weak supervision: rules vote good or bad or abstain, expectation-maximisation weighs them.

All steps are DataFrame functions. Each text becomes a row of counts in one pass, written
once. Every rule turns counts into a vote (1 good, 0 bad, null abstains). Documents with the
same votes are one pattern: at most 3 ** (number of rules) rows at any corpus size. On that
table EM estimates how often each rule votes good or bad on good and on bad documents, and the
share of good ones. The posterior decides: ``kept`` when it is at least KEEP and the
base limits hold.

Repeated words: hashes of three-word windows are sorted inside the row, so a long text costs
n log n and no shuffle.

Defined cases: null or word-less text counts 0 everywhere and fails the base limits; repeated
rows get the same result; an empty table gives an empty result (no EM step runs).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C

SPACE = r"[\x20\x09-\x0D]+"
KEEP = 0.5
STEPS = 12           # EM steps

# Votes as SQL over the counts: (rule, bad when, good when); neither is an abstention. A
# rule that looks for one defect has nothing to say about texts without it.
RULES = [
    ("symbols", "n_symbols > 0.10 * n_words", "FALSE"),
    ("symbol_share", "n_symbols > 0.02 * word_chars", "FALSE"),
    ("lines", "n_lines >= 4 AND n_dup_lines > 0.3 * n_lines", "FALSE"),
    ("windows", "n_repeat_words > 0.3 * n_words", "FALSE"),
    ("capitals", "n_capitals > 0.3 * word_chars", "FALSE"),
    ("word_length", "word_chars < 2.5 * n_words OR word_chars > 14 * n_words", "FALSE"),
    ("length", "n_words < 20", "n_words >= 80"),
    ("prose", "n_lines >= 3 AND n_ended < 0.2 * n_lines", "n_ended >= 0.5 * n_lines AND n_symbols <= 0.01 * n_words"),
]


def counts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_ended, n_capitals) for every row."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), F.array_remove(F.split(text, SPACE), "").alias("words"),
                       F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    windows = F.expr("IF(size(words) < 3, CAST(array() AS array<bigint>), "
                     "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])))")
    only = lambda keep: F.length(F.regexp_replace("text", keep, "")).cast("long")
    docs = docs.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        only(r"[^#*$%&|<>]+").alias("n_symbols"), only(r"[^\p{Lu}]+").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda line: F.right(F.rtrim(line), F.lit(1)).isin(".", "!", "?"))).cast("long").alias("n_ended"),
        windows.alias("h"))
    # Only texts with an equal pair of windows are sorted with their places.
    docs = docs.withColumn("sorted", F.expr("IF(size(array_distinct(h)) = size(h), NULL, array_sort(transform(h, (x, i) -> named_struct('x', x, 'i', i))))"))
    docs = docs.withColumn("places", F.expr("array_sort(filter(transform(sorted, (e, j) -> IF((j > 0 AND sorted[j - 1].x = e.x) "
                                            "OR (j < size(sorted) - 1 AND sorted[j + 1].x = e.x), e.i, NULL)), i -> i IS NOT NULL))"))
    covered = F.expr("aggregate(transform(places, (p, j) -> IF(j = size(places) - 1, 3, least(3, places[j + 1] - p))), 0L, (a, n) -> a + n)")
    return docs.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
                       "n_lines", "n_ended", "n_capitals")


def votes(rows: DataFrame) -> DataFrame:
    return rows.withColumns({f"v_{name}": F.expr(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 END") for name, bad, good in RULES})


# Rates before the first step: how often a rule calls a good, then a bad document good or bad.
START = ((0.50, 0.05), (0.10, 0.50))


def posterior(model: dict) -> Column:
    """Probability that a row of votes is a good document; an abstention counts by how often the rule abstains on either kind."""
    odds = F.lit(math.log(model["good"] / (1 - model["good"])))
    for name, _, _ in RULES:
        (good_good, bad_good), (good_bad, bad_bad) = model[name]
        v = F.col(f"v_{name}")
        odds = odds + F.when(v == 1, F.lit(math.log(good_good / good_bad))).when(v == 0, F.lit(math.log(bad_good / bad_bad))).otherwise(
            F.lit(math.log((1 - good_good - bad_good) / (1 - good_bad - bad_bad))))
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, steps: int = STEPS) -> dict:
    """EM over the pattern table: the share of good documents, and how often each rule votes good or bad on either kind.

    A rule stays at least as likely right as wrong: a bad vote never speaks for a document.
    """
    model = {"good": 0.8} | {name: START for name, _, _ in RULES}
    for _ in range(steps):
        p = patterns.withColumn("p", posterior(model))
        sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("good")]
        for name, _, _ in RULES:
            v, n, q = F.col(f"v_{name}"), F.col("n"), F.col("p")
            for vote, k in ((1, "good"), (0, "bad")):
                sums += [F.sum(F.when(v == vote, n * q)).alias(f"{name}_{k}_good"), F.sum(F.when(v == vote, n * (1 - q))).alias(f"{name}_{k}_bad")]
        got = p.agg(*sums).first()
        if not got["n"]:
            break
        of = {"good": got["good"], "bad": got["n"] - got["good"]}
        new = {"good": min(max(got["good"] / got["n"], 0.02), 0.98)}
        for name, _, _ in RULES:  # half a vote of each kind and half an abstention are added, so that no rate is 0
            rate = lambda k, kind: ((got[f"{name}_{k}_{kind}"] or 0.0) + 0.5) / (of[kind] + 1.5)  # noqa: B023, E731
            gg, bg, gb, bb = rate("good", "good"), rate("bad", "good"), rate("good", "bad"), rate("bad", "bad")
            new[name] = ((max(gg, gb), min(bg, bb)), (min(gg, gb), max(bg, bb)))
        moved = max(abs(new["good"] - model["good"]), *(abs(x - y) for k, _, _ in RULES for u, w in zip(new[k], model[k], strict=True) for x, y in zip(u, w, strict=True)))
        model = new
        if moved < 1e-3:
            break
    return model


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, probability) for every row of ``docs``."""
    rows = votes(C.materialise(counts(C.id_and_text(docs)), "counts"))
    names = [f"v_{name}" for name, _, _ in RULES]
    patterns = C.materialise(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "patterns")
    rows = rows.withColumn("probability", posterior(estimate(patterns)))
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       (~failed & (F.col("probability") >= KEEP)).alias("kept"), "probability")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(C.documents(spark, sf_dir))
