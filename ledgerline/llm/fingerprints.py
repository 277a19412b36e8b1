"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a line; its leaves are runs of up to four words of one sentence. A section
ends after a paragraph whose hash is divisible by four, so an edit moves no other boundary.
Paragraph, section and root hashes are taken over their children, the root with a
cryptographic hash. A fingerprint is written as ``root:section=leaves;section=leaves``:
equal roots mean equal texts, and only differing sections need a look at their leaves.

``edit_report`` follows the contract of the query: each text is also changed in its last
half to the beginning of the next document's. Documents are dealt out by ranges of doc_id
whose bounds are documents; a range's first document goes to the range before it as well.
The text is shuffled once and streamed in order; no range is held in memory.

Defined cases: null text is empty (a root without sections); of rows with equal doc_id the
order is that of their texts; null doc_ids come first; one document is its own next one.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C

RUN = 4              # words of a leaf
SECTION = 4          # mean paragraphs of a section
MAX_RANGES = 4096    # bounds that a plan carries as a literal

_h = xxhash.xxh64_intdigest


def tree(text: str) -> tuple[bytes, list[tuple[int, list[int]]]]:
    """(root, sections); a section is its hash and its leaves' hashes."""
    sections, paragraphs, leaves = [], [], []
    for line in text.split("\n") if text else ():
        own = []
        for sentence in line.split(". "):
            words = sentence.split(" ")
            if len(words) <= RUN:
                own.append(_h(sentence))
            else:
                own += [_h(" ".join(words[k:k + RUN])) for k in range(0, len(words), RUN)]
            own.append(-1)
        p = _h(",".join(map(str, own)))
        leaves += [x for x in own if x >= 0]
        paragraphs.append(p)
        if p % SECTION == 0:
            sections.append((_h(",".join(map(str, paragraphs))), leaves))
            paragraphs, leaves = [], []
    if paragraphs:
        sections.append((_h(",".join(map(str, paragraphs))), leaves))
    root = hashlib.blake2b(b"".join(s.to_bytes(8, "little") for s, _ in sections), digest_size=16).digest()
    return root, sections


def write_fingerprint(root: bytes, sections: list[tuple[int, list[int]]]) -> str:
    return root.hex() + ":" + ";".join(f"{s & 0xFFFFFFFF:08x}=" + "".join([f"{x & 0xFFFFFFFF:08x}" for x in own]) for s, own in sections)


def fingerprint(text: str | None) -> str:
    return write_fingerprint(*tree(text or ""))


def read_fingerprint(value: str) -> tuple[str, list[tuple[str, str]]]:
    root, _, rest = value.partition(":")
    return root, [tuple(s.split("=", 1)) for s in rest.split(";") if s]


def differing_sections(a: str, b: str) -> list[int]:
    """Numbers of the sections of ``a`` that ``b`` does not have: where the texts were edited."""
    have = Counter(s for s, _ in read_fingerprint(b)[1])
    out = []
    for i, (s, _) in enumerate(read_fingerprint(a)[1]):
        have[s] -= 1
        if have[s] < 0:
            out.append(i)
    return out


def likeness(a: str, b: str) -> float:
    """Share of leaves that two fingerprints have in common (Dice, with multiplicity); 1 exactly for equal roots."""
    ra, sa = read_fingerprint(a)
    rb, sb = read_fingerprint(b)
    if ra == rb:
        return 1.0
    left, right = Counter(s for s, _ in sa), Counter(s for s, _ in sb)
    both = left & right
    total = sum(len(x) // 8 for _, x in sa) + sum(len(x) // 8 for _, x in sb)
    shared, rest = 0, []
    for sections in (sa, sb):
        skip, leaves = Counter(both), Counter()
        for s, own in sections:
            if skip[s] > 0:
                skip[s] -= 1
                shared += len(own) // 8
            else:
                leaves.update([own[k:k + 8] for k in range(0, len(own), 8)])
        rest.append(leaves)
    shared += 2 * (rest[0] & rest[1]).total()
    return min(shared / total, 1.0 - 1e-9) if total else 0.0


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_REPORT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (range, extra, doc_id): a range's documents, then the one behind it."""
    held = None  # (range, doc_id, text, fingerprint) whose next document is not read yet
    for batch in C.table(batches):
        out = []
        rows = zip(*[batch.column(k).to_pylist() for k in ("range", "extra", "doc_id", "text")], strict=True)
        for at, extra, doc_id, text in rows:
            text = text or ""
            own = fingerprint(text)
            if held is not None and held[0] == at:
                changed = edited(held[2], text)
                other = fingerprint(changed)
                out.append((held[1], len(held[2]), hashlib.sha256(changed.encode()).hexdigest(), held[3], other,
                            likeness(held[3], other), likeness(held[3], own)))
            held = None if extra else (at, doc_id, text, own)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _REPORT.types, strict=True)], schema=_REPORT)


def edit_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row."""
    docs = C.id_and_text(docs)
    spark = docs.sparkSession
    lowest = -(1 << 63)
    key = F.coalesce("doc_id", F.lit(lowest))
    ranges = min(MAX_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.select(key.alias("k"))
    row = ids.agg(F.min("k").alias("least"), F.expr(f"percentile_approx(k, array({', '.join(str(i / ranges) for i in range(1, ranges))}), 100000)").alias("cut")).first()
    if row["least"] is None:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    least, cuts = row["least"], sorted(set(row["cut"]) - {row["least"]})
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.expr("array()").cast("array<bigint>")
    docs = docs.withColumn("range", F.size(F.filter(bounds, lambda b: b <= key)))
    # A range's first document is also the last one's next in the range before; before the first range stands the last.
    before = F.when(F.col("range") == 0, F.lit(len(cuts))).otherwise(F.col("range") - 1)
    own = F.struct(F.col("range").alias("range"), F.lit(0).alias("extra"))
    also = F.struct(before.alias("range"), F.lit(1).alias("extra"))
    places = F.when(key.isin([least, *cuts]), F.array(own, also)).otherwise(F.array(own))
    rows = docs.select("doc_id", "text", F.explode(places).alias("p")).select("p.range", "p.extra", "doc_id", "text")
    rows = rows.repartition("range").sortWithinPartitions("range", "extra", "doc_id", "text")
    return rows.mapInArrow(_reports, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(C.documents(spark, sf_dir))
