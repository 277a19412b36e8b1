"""License scans: an exact set-similarity join between text blocks and license templates.

A template is a list of words with a containment threshold: short phrases need all their
words in order, license texts need 80 % of their distinct words within a block, a window of
as many words as the template has. All steps are DataFrame functions:

1. Each text becomes its hits: the places of words that occur in some template.
2. Word frequencies over all documents put the template words in one global order, rarest
   first. A template's prefix are its ``m - ceil(t m) + 1`` rarest words: every block that
   meets the threshold holds one of them (length filter: the document must be long enough).
3. Hits on prefix words are joined with the prefix table (template words only, a fixed list)
   and verified in their surroundings: phrases word for word, texts by the largest number
   of distinct template words in a block around the hit, where the rank of the hit's word
   bounds what is still to come (positional filter).

Defined cases: null text has no words; places are counted in words from 0; overlapping places
all count; a document without a match has empty labels, null places and the score 0.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C

# Phrases whose places are counted, with their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further phrases and opening sentences of public licenses, with their labels.
MORE_PHRASES = {
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "apache license version 2 0": "apache-2.0",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
}
TEXTS = {
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
}
THRESHOLD = 0.8
NOT_A_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # runs between words before A-Z become lower case


def templates() -> list[dict]:
    """name, label, words, base, ordered, distinct words, least words of them in a block."""
    out = []
    for group, base, ordered in ((BASE_PHRASES, True, True), (MORE_PHRASES, False, True), (TEXTS, False, False)):
        for text, label in group.items():
            words = text.split(" ")
            distinct = list(dict.fromkeys(words))
            least = len(distinct) if ordered else math.ceil(THRESHOLD * len(distinct))
            out.append({"id": len(out), "label": label, "words": words, "base": base, "ordered": ordered, "distinct": distinct, "least": least})
    return out


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def hit_table(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n_words, hits): places and words of template words, in order."""
    vocabulary = sorted({w for t in templates() for w in t["distinct"]})
    docs = docs.withColumn("words", F.array_remove(F.split(F.coalesce("text", F.lit("")), NOT_A_WORD), ""))
    quoted = ", ".join(f"'{w}'" for w in vocabulary)
    folded = f"translate(w, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"  # lower() would also fold letters beyond A-Z
    hits = F.expr(f"filter(transform(words, (w, i) -> IF(length(w) <= {max(map(len, vocabulary))} AND {folded} IN ({quoted}), "
                  f"named_struct('pos', i, 'word', {folded}), NULL)), h -> h IS NOT NULL)")
    return docs.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))


def prefix_table(spark: SparkSession, hits: DataFrame) -> DataFrame:
    """(word, id, rank): the words of each template's prefix. Word counts are over all documents; the table has template words only."""
    counts = {r["word"]: r["n"] for r in hits.select(F.explode("hits.word").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = []
    for t in templates():
        order = sorted(t["distinct"], key=lambda w: (counts.get(w, 0), w))
        rows += [(w, t["id"], r) for r, w in enumerate(order[:len(order) - t["least"] + 1])]
    return spark.createDataFrame(rows, "word string, id int, rank int")


def matches(hits: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(row, id, start, share): verified places; ``start`` is the first word of the phrase or block."""
    kinds = templates()
    reach = max(len(t["words"]) for t in kinds)
    spark = hits.sparkSession
    table = spark.createDataFrame([(t["id"], t["ordered"], t["words"], t["distinct"], len(t["words"]), len(t["distinct"]), t["least"]) for t in kinds],
                                  "id int, ordered boolean, tokens array<string>, distinct array<string>, span int, m int, least int")
    wanted = [r["word"] for r in prefixes.select("word").distinct().collect()]  # template words only
    found = hits.where(F.arrays_overlap(F.col("hits.word"), _strings(wanted)))
    # One row for each hit on a prefix word, with the hits around it: a bounded number, as they stand on different words.
    at = F.expr(f"transform(hits, (h, k) -> IF(h.word IN ({', '.join(repr(w) for w in wanted)}), named_struct('pos', h.pos, 'word', h.word, "
                f"'near', slice(hits, greatest(k + 1 - {reach}, 1), {2 * reach + 1})), NULL))")
    rows = found.select("row", "n_words", F.explode(F.filter(at, lambda x: x.isNotNull())).alias("hit")).select("row", "n_words", "hit.*")
    rows = rows.join(F.broadcast(prefixes), "word").join(F.broadcast(table), "id").where("n_words >= least AND m - rank >= least")
    starts = F.expr("""filter(transform(sequence(0, span - 1), j -> IF(tokens[j] = word, pos - j, -1)), s -> s >= 0
        AND size(filter(near, h -> h.pos >= s AND h.pos < s + span AND h.word = tokens[h.pos - s])) = span)""")
    phrases = rows.where("ordered").select("row", "id", F.explode(starts).alias("start"), F.lit(1.0).alias("share")).distinct()
    # A best block can begin at a hit: moving it right to one loses no template word.
    blocks = F.expr("""transform(filter(near, h -> h.pos > pos - span AND h.pos <= pos AND array_contains(distinct, h.word)), b -> named_struct(
        'n', size(array_intersect(distinct, transform(filter(near, h -> h.pos >= b.pos AND h.pos < b.pos + span), h -> h.word))), 'start', b.pos))""")
    texts = rows.where("NOT ordered").select("row", "id", "m", "least", F.explode(blocks).alias("b")).where("b.n >= least")
    texts = texts.select("row", "id", F.col("b.start").alias("start"), (F.col("b.n") / F.col("m")).alias("share")).distinct()
    return phrases.union(texts)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs``."""
    # A number of its own tells repeated rows apart; it is fixed once the hits are written.
    docs = C.id_and_text(docs).withColumn("row", F.monotonically_increasing_id())
    hits = C.materialise(hit_table(docs), "hits")
    kinds = templates()
    label = F.create_map(*[F.lit(x) for t in kinds for x in (t["id"], t["label"])])
    base = F.col("id").isin([t["id"] for t in kinds if t["base"]])
    found = (matches(hits, prefix_table(docs.sparkSession, hits)).groupBy("row")
             .agg(F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
                  F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
                  F.array_join(F.array_sort(F.collect_set(F.when(base, label[F.col("id")]))), ",").alias("base_labels"),
                  F.array_join(F.array_sort(F.collect_set(label[F.col("id")])), ",").alias("labels"), F.max("share").alias("score")))
    return hits.select("doc_id", "row", "n_words").join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(C.documents(spark, sf_dir))
