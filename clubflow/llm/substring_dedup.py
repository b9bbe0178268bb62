"""Substring deduplication by super-k-mers of words.

Words are runs of anything but ASCII white space. Consecutive windows of ``width`` words that share a minimiser
travel as one packed string to its bucket; there the windows are sorted by their words, and each but the earliest
of equal ones (smaller doc_id, then earlier start) covers words to remove. A packed string seen twice by one task
travels once: the later one is decided on the spot, so what many documents share costs a row per task.

Null text has no word. Texts with fewer words than a window lose nothing. Rows of one doc_id, or without one, are
documents of their own, ordered by text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clubflow.llm.common import mix, ragged, raw_bytes, slices
from clubflow.llm.minimiser import (
    HELD_BYTES,
    Parcels,
    bucket_count,
    by_bucket,
    covered,
    opened,
    placed,
    run_hashes,
    span_batch,
    spans_of,
    super_kmers,
    with_spans,
)

WIDTH = 20
GRAM = 4
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _words(data: np.ndarray, offsets: np.ndarray):
    """(start, end) of each word in the bytes of all texts, and how many words come before each text."""
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.r_[True, space[:-1]] | edge[:-1], np.r_[space[1:], True] | edge[1:]
    start = np.flatnonzero(~space & before)
    end = np.flatnonzero(~space & after) + 1
    return start, end, np.searchsorted(start, offsets)


def _tidy(data: np.ndarray, start: np.ndarray, at: np.ndarray) -> bytes:
    """The words of ``data``, each with one blank behind it; ``at``: where each begins in the result (one more: the end)."""
    out = bytearray()
    for i in range(0, len(start), 1 << 17):
        own, to = start[i : i + (1 << 17)], at[i : i + (1 << 17) + 1]
        piece = np.append(data[own[0] : own[-1] + to[-1] - to[-2] - 1], np.uint8(32))
        piece = piece[ragged(own - own[0], np.diff(to))]
        piece[to[1:] - to[0] - 1] = 32
        out += piece.tobytes()
    return bytes(out)


def _send(buckets: int, width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcels = Parcels(buckets)
        seen: dict[bytes, tuple[int, int, int, int]] = {}  # packed string -> place, start, words, bucket
        spans: list[tuple[int, int, int]] = []
        size = 0

        def parcel() -> pa.RecordBatch:
            rows = list(seen.values())
            place, start, _, bucket = zip(*rows) if rows else ((), (), (), ())
            return parcels.batch(bucket, np.zeros(len(rows)), place, start, list(seen), spans)

        for batch in slices(batches, 1):
            data, offsets = raw_bytes(batch.column(1))
            start, end, first_word = _words(data, offsets)
            if not len(start):
                continue
            # all words, each with one blank behind it
            at = np.r_[0, np.cumsum(end - start + 1)]
            text = _tidy(data, start, at)
            doc, a, b, least = super_kmers(run_hashes(data, start, end), first_word, width, gram)
            where = np.asarray(batch.column(0))[doc] if len(doc) else doc
            bucket = (mix(least) % np.uint64(buckets)).astype(np.int64)
            own = a - first_word[doc]
            for place, i, j, begin, k in zip(where.tolist(), a.tolist(), (b + width).tolist(), own.tolist(), bucket.tolist()):
                packed = text[at[i] : at[j] - 1]
                old = seen.get(packed)
                if old is None:
                    seen[packed] = place, begin, j - i, k
                    size += len(packed)
                elif (place, begin) < old[:2]:
                    spans.append((old[0], old[1], old[1] + j - i))
                    seen[packed] = place, begin, j - i, k
                else:
                    spans.append((place, begin, begin + j - i))
            if size > HELD_BYTES or len(spans) > 1_000_000:
                yield parcel()
                seen, spans, size = {}, [], 0
        if seen or spans:
            yield parcel()

    return run


def later_windows(strings: list[bytes], place: np.ndarray, start: np.ndarray, width: int):
    """(place, start) of each window that is not the earliest of its word sequence, over packed strings of words."""
    none = np.zeros(0, np.int64)
    if not strings:
        return none, none
    data = np.frombuffer(b" ".join(strings), np.uint8)
    ends = np.cumsum([len(s) + 1 for s in strings])
    first, last, word_of = _words(data, np.r_[0, ends[:-1], len(data)])
    counts = np.diff(word_of)
    # a hash of each window tells which strings can hold equal ones; only these are sorted by their words
    h = run_hashes(run_hashes(data, first, last), *_window_edges(word_of, width))
    owner = np.repeat(np.arange(len(strings)), np.maximum(counts - width + 1, 0))
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    hit = np.zeros(len(h), bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    some = np.unique(owner[hit])
    if not len(some):
        return none, none
    chosen = ragged(word_of[some], counts[some])
    lengths = (last - first)[chosen]
    values = data[ragged(first[chosen], lengths)]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(chosen), [None, pa.py_buffer(np.r_[0, np.cumsum(lengths)].astype(np.int64)), pa.py_buffer(values)]
    )
    rank = np.asarray(words.dictionary_encode().indices).astype(np.int64)
    begins = np.r_[0, np.cumsum(counts[some])]
    window, _ = _window_edges(begins, width)
    # ranks of 1, 2, 4, ... words from sorted pairs, then of the whole window: equal ranks are equal words
    ranks, span, have, done = rank, 1, None, 0
    left = width
    while left:
        if left & 1:
            part = ranks[window + done]
            have = part if have is None else _pair_rank(have, part)
            done += span
        left >>= 1
        if left:
            ranks = _pair_rank(ranks, np.r_[ranks[span:], np.full(span, -1)])
            span *= 2
    owner = np.repeat(some, counts[some] - width + 1)
    at = start[owner] + window - np.repeat(begins[:-1], counts[some] - width + 1)
    where = place[owner]
    order = np.lexsort((at, where, have))
    later = order[1:][have[order][1:] == have[order][:-1]]
    return where[later], at[later]


def _window_edges(word_of: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    begin = ragged(word_of[:-1], np.maximum(np.diff(word_of) - width + 1, 0))
    return begin, begin + width


def _pair_rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique((a << 32) | (b & 0xFFFFFFFF), return_inverse=True)[1]


def _decide(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parcels in by_bucket(batches):
            _, place, start, strings, spans = opened(parcels)
            if len(spans):
                yield span_batch(spans)
            found = spans_of(*later_windows(strings, place, start, width), width)
            if len(found):
                yield span_batch(found)

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        rows = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            gone = covered(len(words), spans)
            kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words)
            rows.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(v, k) for v, k in zip(zip(*rows), kinds)]],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
        )


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256, kept): the words left, joined by one blank."""
    rows = placed(docs)
    buckets = bucket_count(docs)
    spans = (
        rows.select("place", "text")
        .mapInArrow(_send(buckets, width, gram), "bucket int, parcel binary")
        .repartition(F.col("bucket"))
        .sortWithinPartitions("bucket")
        .mapInArrow(_decide(width), "place long, b long, e long")
    )
    return with_spans(rows, spans).mapInArrow(
        _finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
