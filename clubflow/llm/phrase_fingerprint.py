"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into phrases: each is the longest phrase known so far and one more character. The hashes of the
set of phrases go through ``HASHES`` fixed permutations; the smallest value of each makes the fingerprint, and the
share of equal places estimates how much of two phrase sets is common, as a compressor would see it.

``compare_edited`` looks at each document and the next one in descending doc_id (after the last: the first). Texts
are dealt out in ranges of doc_id and sorted in each range; the first row of the following range comes along as one
row more, so nothing is gathered.

Null text counts as empty; an empty text has no phrase and the fingerprint of the empty set, likeness 1 to itself.
Rows of one doc_id are ordered by text. A null doc_id comes last. A single document is its own next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clubflow.llm.common import narrow, slices, stored

HASHES = 64
SEED = 11
_FACTORS = np.random.default_rng(SEED).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Phrases:
    """The parse of a text so far; ``fork`` goes on from here with another text."""

    def __init__(self):
        self.known: set[str] = set()
        self.open = ""

    def fork(self) -> Phrases:
        other = Phrases()
        other.known, other.open = set(self.known), self.open
        return other

    def add(self, text: str) -> Phrases:
        known, phrase, put = self.known, self.open, self.known.add
        for c in text:
            phrase += c
            if phrase not in known:
                put(phrase)
                phrase = ""
        self.open = phrase
        return self

    def signature(self) -> np.ndarray:
        """Smallest hash under each permutation (32 bits each)."""
        if not self.known:
            return np.full(HASHES, 0xFFFFFFFF, np.uint32)
        digest = xxhash.xxh64_intdigest
        values = np.array([digest(p.encode("utf-8", "surrogatepass")) for p in self.known], dtype=np.uint64)
        least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(values), 8192):
            part = values[i : i + 8192]
            for k in range(HASHES):
                least[k] = min(least[k], (part * _FACTORS[k]).min())
        return (least >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprint(text: str | None) -> np.ndarray:
    return Phrases().add(text or "").signature()


def edited(text: str, following: str) -> tuple[str, str]:
    """What stays and what comes in place of the last third: as many characters of the next text (or all)."""
    n = len(text) // 3
    return text[: len(text) - n], following[:n]


ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # (doc_id, text, parse of what stays, signature) of the row that waits for the next one
    for batch in slices(batches, 1):
        rows = []
        for doc, text, extra in zip(*(batch.column(i).to_pylist() for i in range(3))):
            text = text or ""
            stays = Phrases().add(text[: len(text) - len(text) // 3])
            mine = stays.fork().add(text[len(text) - len(text) // 3 :]).signature()
            if held is not None:
                rows.append(_row(*held, text, mine))
            held = None if extra else (doc, text, stays, mine)
        if rows:
            yield _batch(rows)
    if held is not None:  # no row came after: the range that follows was empty
        yield _batch([_row(*held, held[1], held[3])])


def _row(doc, text, stays, mine, following, other):
    left, right = edited(text, following)
    changed = stays.add(right).signature()
    return (
        doc, len(text), hashlib.sha256((left + right).encode("utf-8", "surrogatepass")).hexdigest(),
        mine.astype(">u4").tobytes().hex(), changed.astype(">u4").tobytes().hex(),
        likeness(mine, changed), likeness(mine, other),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in ROWS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)


def compare_edited(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    spark = docs.sparkSession
    rows = narrow(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(-F.col("doc_id"), F.lit(2**63 - 1))  # ascending in this is descending in doc_id, null last
    # one bound per range: sizes decide how evenly the work is dealt out, never the result
    known = rows.where("doc_id is not null").select(key.cast("double").alias("k"))
    bounds = known.approxQuantile("k", [i / count for i in range(1, count)], 0.0005)
    bounds = sorted({min(int(b), 2**63 - 1) for b in bounds})
    part = F.lit(0)
    if bounds:
        part = F.expr(f"aggregate(array({','.join(f'{b}L' for b in bounds)}), 0, (n, b) -> n + int(b < k))")
    placed = rows.withColumn("k", key).withColumn("part", part)
    # the first row of each range: one per range
    first = placed.groupBy("part").agg(F.min(F.struct("k", "doc_id")).alias("f")).orderBy("part").collect()
    parts = [r["part"] for r in first]
    before = {p: parts[i - 1] for i, p in enumerate(parts)}  # the first row of p also ends the range before
    heads = [(p, r["f"]["k"]) for p, r in zip(parts, first)]
    if not heads:
        return spark.createDataFrame([], ROWS)
    table = stored(
        spark.createDataFrame([(before[p], k) for p, k in heads], "into int, k long"), "heads"
    )
    extra = (
        placed.join(F.broadcast(table), "k")
        .groupBy("into", "k")
        .agg(F.min(F.struct("text", "doc_id")).alias("r"))
        .select("r.doc_id", "r.text", F.lit(True).alias("extra"), "k", F.col("into").alias("part"))
    )
    dealt = placed.select("doc_id", "text", F.lit(False).alias("extra"), "k", "part").unionAll(extra)
    return (
        dealt.repartitionById(max(parts) + 1, "part")
        .sortWithinPartitions("extra", "k", "text")
        .select("doc_id", "text", "extra")
        .mapInArrow(_compare, ROWS)
    )
