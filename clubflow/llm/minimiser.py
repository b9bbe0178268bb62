"""Dealing out windows of a text by minimiser, and what comes back to the documents.

A window of ``width`` symbols belongs to the bucket of the smallest hash among its ``gram``-symbol pieces; equal
windows meet in one bucket. Consecutive windows with one minimiser travel as one packed string.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clubflow.llm.common import mix, narrow, stored, window_minimum

#: Buckets a partition of the exchange works through one after the other.
BUCKETS_PER_PARTITION = 8
#: Packed bytes a task gathers, and compares among themselves, before it sends them.
HELD_BYTES = 12 << 20
#: Symbols whose hashes a task holds at a time; longer texts are worked on in blocks that overlap.
BLOCK = 1 << 20
_PLACE = 31

_powers: dict[int, np.ndarray] = {}
_FACTOR = 0x9E3779B97F4A7C15


def _power(base: int) -> np.ndarray:
    """Powers of a 64-bit number, for the places in a block and the one after it."""
    if base not in _powers:
        with np.errstate(over="ignore"):
            p = np.full(BLOCK + 1, base, np.uint64)
            p[0] = 1
            _powers[base] = np.cumprod(p)
    return _powers[base]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run values[start:end]: the same for the same values, wherever they stand.

    ``starts`` and ``ends`` rise. Sums are formed block by block and kept for the places asked for only.
    """
    up, down = _power(_FACTOR), _power(pow(_FACTOR, -1, 2**64))
    sums = [np.zeros(len(starts), np.uint64), np.zeros(len(ends), np.uint64)]
    total = np.uint64(0)
    with np.errstate(over="ignore"):
        for at in range(0, max(len(values), 1), BLOCK):
            part = values[at : at + BLOCK]
            own = np.empty(len(part) + 1, np.uint64)
            own[0] = 0
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=own[1:])
            own *= np.uint64(pow(_FACTOR, at, 2**64))
            own += total
            for points, out in zip((starts, ends), sums):
                i, j = np.searchsorted(points, (at, at + len(part) + 1))
                out[i:j] = own[points[i:j] - at]
            total = own[-1]
        inverse = down[starts % BLOCK]
        if len(values) > BLOCK:
            far = np.array([pow(_FACTOR, -at, 2**64) for at in range(0, len(values) + 1, BLOCK)], np.uint64)
            inverse *= far[starts // BLOCK]
        return mix((sums[1] - sums[0]) * inverse)


def super_kmers(values: np.ndarray, offsets: np.ndarray, width: int, gram: int, block: int = BLOCK):
    """(text, first window, last window, minimiser) of each run of windows, window numbers counted over all texts.

    ``values`` holds the symbols of all texts, ``offsets`` where each begins (one more: the end). Blocks overlap by
    ``width - 1`` symbols, so each window lies in one; a run ends where its block does.
    """
    none = np.zeros(0, np.int64)
    found = [(none, none, none, none.astype(np.uint64))]
    for at in range(0, len(values), block):
        end = min(len(values), at + block + width - 1)
        if end - at < width:
            break
        doc, edge = int(np.searchsorted(offsets, at, side="right")) - 1, int(np.searchsorted(offsets, end))
        own = np.clip(offsets[doc : edge + 1], at, end) - at
        text, first, last, least = _block_kmers(values[at:end], own, width, gram)
        found.append((text + doc, first + at, last + at, least))
    return tuple(np.concatenate(c) for c in zip(*found))


def _block_kmers(values: np.ndarray, offsets: np.ndarray, width: int, gram: int):
    at = np.arange(len(values) - gram + 1)
    low = np.uint64((1 << _PLACE) - 1)
    keyed = (run_hashes(values, at, at + gram) & ~low) | (at.astype(np.uint64) & low)
    least = window_minimum(keyed, width - gram + 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    inside = np.flatnonzero(np.arange(len(least)) + width <= offsets[doc + 1])
    value, doc = least[inside], doc[inside]
    first = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])][: len(value)])
    last = np.r_[first[1:], len(inside)][: len(first)] - 1
    return doc[first], inside[first], inside[last], value[first] >> np.uint64(_PLACE)


def numbered(docs: DataFrame, place: str) -> DataFrame:
    """All columns and ``place``, one number a row, ordered as doc_id: the doc_id itself where each is there once.

    Otherwise rows are numbered by (doc_id, text), null ids first, and stored, so the numbers stay.
    """
    twice = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not twice:
        return docs.withColumn(place, F.col("doc_id").cast("long"))
    ordered = docs.orderBy(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return stored(ordered.withColumn(place, F.monotonically_increasing_id()), "placed")


def placed(docs: DataFrame) -> DataFrame:
    """(place, doc_id, text) with one place a row."""
    return numbered(narrow(docs, "doc_id", "text"), "place").select("place", "doc_id", "text")


class Parcels:
    """Packed strings on their way to buckets, and spans already decided."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.squeeze = zstandard.ZstdCompressor(level=3)

    def batch(self, bucket, mark, place, start, text: list[bytes], spans: list[tuple[int, int, int]]) -> pa.RecordBatch:
        """One row a bucket. ``mark`` is any number of 32 bits that goes along with a string."""
        bucket = np.asarray(bucket, np.int64)
        order = np.argsort(bucket, kind="stable")
        mark, place, start = np.asarray(mark, np.uint32), np.asarray(place, np.int64), np.asarray(start, np.int64)
        length = np.array([len(t) for t in text], np.uint32)
        decided = np.array(spans, np.int64).reshape(-1, 3)
        theirs = np.abs(decided[:, 0]) % self.buckets
        edge = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        out_bucket, out = [], []
        by = np.argsort(theirs, kind="stable")
        cut = np.searchsorted(theirs[by], np.arange(self.buckets + 1))
        for b in range(self.buckets):
            own, done = order[edge[b] : edge[b + 1]], decided[by[cut[b] : cut[b + 1]]]
            if len(own) or len(done):
                raw = b"".join(
                    [struct.pack("<II", len(own), len(done)), place[own].tobytes(), start[own].tobytes(), done.tobytes(),
                     mark[own].tobytes(), length[own].tobytes(), *[text[i] for i in own.tolist()]]
                )
                out_bucket.append(b)
                out.append(self.squeeze.compress(raw))
        return pa.RecordBatch.from_arrays([pa.array(out_bucket, pa.int32()), pa.array(out, pa.binary())], names=["bucket", "parcel"])


def opened(parcels: list[bytes]):
    """(marks, places, starts, strings, decided spans) of all parcels."""
    open_ = zstandard.ZstdDecompressor()
    marks, places, starts, strings, spans = [], [], [], [], []
    for parcel in parcels:
        raw = open_.decompress(parcel)
        n, d = struct.unpack_from("<II", raw)
        at = 8
        places.append(np.frombuffer(raw, np.int64, n, at))
        starts.append(np.frombuffer(raw, np.int64, n, at + 8 * n))
        at += 16 * n
        spans.append(np.frombuffer(raw, np.int64, 3 * d, at).reshape(-1, 3))
        at += 24 * d
        marks.append(np.frombuffer(raw, np.uint32, n, at))
        lengths = np.frombuffer(raw, np.uint32, n, at + 4 * n)
        ends = np.cumsum(lengths.astype(np.int64)) + at + 8 * n
        strings += [raw[e - k : e] for e, k in zip(ends.tolist(), lengths.tolist())]
    return (
        np.concatenate(marks) if marks else np.zeros(0, np.uint32),
        np.concatenate(places) if places else np.zeros(0, np.int64),
        np.concatenate(starts) if starts else np.zeros(0, np.int64),
        strings,
        np.concatenate(spans) if spans else np.zeros((0, 3), np.int64),
    )


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """The parcels of one bucket after the other, from rows (bucket, parcel) ordered by bucket."""
    held, now = [], None
    for batch in batches:
        for bucket, parcel in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if bucket != now and held:
                yield held
                held = []
            now = bucket
            held.append(parcel)
    if held:
        yield held


def spans_of(place: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """(place, begin, end) covering the windows given, those that touch as one."""
    if not len(place):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((start, place))
    place, start = place[order], start[order]
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (start[1:] > start[:-1] + width)])
    return np.column_stack((place[new], start[new], np.maximum.reduceat(start, new) + width))


def span_batch(spans: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(spans[:, i].copy(), pa.int64()) for i in range(3)], names=["place", "b", "e"])


def bucket_count(docs: DataFrame, per_partition: int = BUCKETS_PER_PARTITION) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * per_partition


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Placed documents (doc_id, text, spans): the spans decided for each, in any order, possibly overlapping."""
    grouped = spans.groupBy("place").agg(F.collect_list(F.struct("b", "e")).alias("spans"))
    return docs.join(grouped, "place", "left").select("doc_id", "text", "spans")


def covered(length: int, spans) -> np.ndarray:
    """Which of ``length`` symbols lie in a span."""
    gone = np.zeros(length, bool)
    if spans is None or not len(spans):
        return gone
    edges = np.array([(s["b"], s["e"]) for s in spans], np.int64)
    edges = edges[np.argsort(edges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(edges[:, 1])
    new = np.flatnonzero(np.r_[True, edges[1:, 0] > reach[:-1]])
    for b, e in zip(edges[new, 0].tolist(), reach[np.r_[new[1:], len(edges)] - 1].tolist()):
        gone[b:e] = True
    return gone
