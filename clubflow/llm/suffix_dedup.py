"""Suffix-array deduplication: the sorted suffixes of a document collection, built column by column.

``Collection`` starts from the empty suffixes and inserts, in each round, one more symbol of every text at once.
Where a suffix goes follows from the collection's Burrows-Wheeler transform, and its common prefix with the suffix
before it from the smallest common prefix between two equal symbols. The columns (transform, common prefixes, suffix
numbers, places) live in sequential files that each round reads and writes from front to back once they outgrow
``MEMORY``; before that they are arrays.

A whole corpus is dealt out first, so that equal strings of ``width`` bytes meet: the windows of a document that
share a minimiser form one text of a collection. Texts that come more than once are whole repeats and enter once;
the rest of the texts whose minimiser comes more than once form the collections. Neighbours in the sorted order
with a common prefix of ``width`` bytes or more are repeats, and each byte they cover goes, the first occurrence
too. Matches never cross documents.

Null text counts as empty. Texts shorter than ``width`` lose nothing. Rows of one doc_id, or without one, are
documents of their own.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clubflow.llm.common import mix, ragged, raw_bytes, slices, unused
from clubflow.llm.minimiser import (
    HELD_BYTES,
    Parcels,
    bucket_count,
    by_bucket,
    covered,
    numbered,
    opened,
    placed,
    run_hashes,
    span_batch,
    spans_of,
    super_kmers,
    with_spans,
)

WIDTH = 200
GRAM = 32
#: Symbols of a collection held in memory; larger ones live in files.
MEMORY = 16 << 20
#: Symbols of texts that form one collection when they come from many minimisers.
TOGETHER = 1 << 19
_BLOCK = 1 << 20


class Column:
    """A sequence that grows by insertions, in memory or in a file that is read and written from front to back."""

    def __init__(self, kind, length: int, folder: str | None):
        self.kind, self.folder, self.length = np.dtype(kind), folder, length
        self.held = np.zeros(length, kind)
        if folder:
            self.path = os.path.join(folder, f"{id(self)}")
            self.held.tofile(self.path)
            self.held = None

    def read(self) -> np.ndarray:
        return self.held if self.folder is None else np.fromfile(self.path, self.kind)

    def write(self, values: np.ndarray) -> None:
        if self.folder is None:
            self.held = values
        else:
            values.tofile(self.path)

    def insert(self, at: np.ndarray, values: np.ndarray, hole: np.ndarray) -> None:
        """Put ``values`` at the (rising) places ``at`` of the longer sequence; ``hole`` marks those that stay."""
        if self.folder is None:
            out = np.empty(self.length + len(at), self.kind)
            out[hole] = self.held
            out[at] = values
            self.held = out
        else:
            with open(self.path, "rb") as old, open(self.path + "+", "wb") as new:
                for begin in range(0, self.length + len(at), _BLOCK):
                    stay = hole[begin : begin + _BLOCK]
                    out = np.empty(len(stay), self.kind)
                    out[stay] = np.fromfile(old, self.kind, int(stay.sum()))
                    i, j = np.searchsorted(at, (begin, begin + len(stay)))
                    out[at[i:j] - begin] = values[i:j]
                    out.tofile(new)
            os.replace(self.path + "+", self.path)
        self.length += len(at)


class Collection:
    """Sorted suffixes of several texts: ``transform``, ``common`` (with the suffix before) and ``suffix`` numbers."""

    def __init__(self, texts: list[bytes], folder: str | None = None):
        n = len(texts)
        lengths = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(lengths)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        # 0: the text has no more symbols
        data = raw + np.uint8(1) if raw.max(initial=0) < 255 else raw.astype(np.uint16) + np.uint16(1)
        begins = self.ends - lengths
        # round 0: the empty suffixes, in the order of the texts
        self.transform, self.common = Column(data.dtype, n, folder), Column(np.uint16, n, folder)
        self.suffix = Column(np.uint32 if len(data) < 2**32 else np.int64, n, folder)
        first = np.zeros(n, data.dtype)
        first[lengths > 0] = data[self.ends[lengths > 0] - 1]
        self.transform.write(first)
        self.suffix.write(self.ends.astype(self.suffix.kind))
        # where in the order the rest of each suffix stands; rising among the suffixes with one first symbol
        self.rest = Column(np.int64, n, folder)
        heads = np.zeros(int(data.max(initial=0)) + 2, np.int64)  # suffixes by first symbol, the empty ones aside
        active = np.flatnonzero(lengths > 0)
        at = active
        taken = 0
        while len(active):
            taken += 1
            b, rest = self.transform.read(), self.rest.read()
            symbol = b[at]
            by = np.lexsort((at, symbol))
            at, active, symbol = at[by], active[by], symbol[by]
            edge = np.flatnonzero(np.r_[True, symbol[1:] != symbol[:-1]])
            ends = np.r_[edge[1:], len(at)]
            low = n + np.cumsum(heads) - heads
            near, far = np.full(len(at), -1, np.int64), np.full(len(at), len(b), np.int64)
            goes = np.arange(len(at), dtype=np.int64)
            for i, j in zip(edge.tolist(), ends.tolist()):
                c = int(symbol[i])
                pile = rest[low[c] : low[c] + heads[c]]
                before = np.searchsorted(pile, at[i:j])
                goes[i:j] += low[c] + before
                has = before > 0
                near[i:j][has] = pile[before[has] - 1]
                has = before < len(pile)
                far[i:j][has] = pile[before[has]]
                # suffixes of this round with the same symbol are neighbours too
                near[i + 1 : j] = np.maximum(near[i + 1 : j], at[i : j - 1])
                far[i : j - 1] = np.minimum(far[i : j - 1], at[i + 1 : j])
                heads[c] += j - i
            # common prefix with the suffix before: one more than the least between two equal symbols
            c = np.append(self.common.read(), np.uint16(0))
            own, behind = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            has = near >= 0
            own[has] = 1 + _least(c, near[has] + 1, at[has] + 1)
            # and of the suffix behind with this one
            has = far < len(b)
            behind[has] = 1 + _least(c, at[has] + 1, far[has] + 1)
            hole = np.ones(len(b) + len(at), bool)
            hole[goes] = False
            moved = np.flatnonzero(hole)
            starts = self.ends[active] - taken
            more = starts > begins[active]
            symbols = np.zeros(len(at), data.dtype)
            symbols[more] = data[starts[more] - 1]
            self.transform.insert(goes, symbols, hole)
            self.suffix.insert(goes, starts, hole)
            self.rest.write(np.take(moved, rest, mode="clip"))
            self.rest.insert(goes, moved[at], hole)
            self.common.insert(goes, np.minimum(own, 65535).astype(np.uint16), hole)
            c = self.common.read()
            fix = goes + 1
            ok = fix < len(c)
            c[fix[ok]] = np.minimum(behind[ok], 65535)
            self.common.write(c)
            at, active = goes[more], active[more]


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minimum of values[begin:end] for each pair, none of them empty; values has one number more at its end."""
    if not len(begin):
        return np.zeros(0, np.int64)
    order = np.argsort(begin, kind="stable")
    pairs = np.empty(2 * len(begin), np.int64)
    pairs[0::2], pairs[1::2] = begin[order], end[order]
    out = np.empty(len(begin), np.int64)
    out[order] = np.minimum.reduceat(values, pairs)[0::2]
    return out


def repeated(texts: list[bytes], width: int, memory: int = MEMORY) -> np.ndarray:
    """Where, in all texts one after the other, a string of ``width`` bytes starts that starts elsewhere too."""
    size = sum(map(len, texts))
    if size <= memory:
        return _repeated(Collection(texts), width)
    with tempfile.TemporaryDirectory() as folder:
        return _repeated(Collection(texts, folder), width)


def _repeated(collection: Collection, width: int) -> np.ndarray:
    long = np.append(collection.common.read() >= width, False)
    return np.sort(collection.suffix.read()[long[:-1] | long[1:]].astype(np.int64))


def _send(buckets: int, width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcels = Parcels(buckets)
        seen: dict[bytes, tuple[int, int, int, int, bool]] = {}  # string -> place, start, mark, bucket, repeated
        spans: list[tuple[int, int, int]] = []
        size = 0

        def parcel() -> pa.RecordBatch:
            rows = list(seen.values())
            place, start, mark, bucket, twice = zip(*rows) if rows else ((), (), (), (), ())
            # the lowest bit of the mark: this task has seen the string more than once
            mark = (np.array(mark, np.uint64) & np.uint64(0xFFFFFFFE)) | np.array(twice, np.uint64)
            return parcels.batch(bucket, mark, place, start, list(seen), spans)

        for batch in slices(batches, 1):
            data, offsets = raw_bytes(batch.column(1))
            doc, a, b, least = super_kmers(data, offsets, width, gram)
            if not len(doc):
                continue
            text = data.tobytes()
            where = np.asarray(batch.column(0))[doc]
            spread = mix(least)
            bucket = (spread % np.uint64(buckets)).astype(np.int64)
            own = a - offsets[doc]
            for place, i, j, begin, mark, k in zip(
                where.tolist(), a.tolist(), (b + width).tolist(), own.tolist(), (spread >> np.uint64(32)).tolist(), bucket.tolist()
            ):
                packed = text[i:j]
                old = seen.get(packed)
                if old is None:
                    seen[packed] = place, begin, mark, k, False
                    size += j - i
                else:
                    if not old[4]:
                        spans.append((old[0], old[1], old[1] + j - i))
                        seen[packed] = *old[:4], True
                    spans.append((place, begin, begin + j - i))
            if size > HELD_BYTES or len(spans) > 1_000_000:
                yield parcel()
                seen, spans, size = {}, [], 0
        if seen or spans:
            yield parcel()

    return run


def _decide(width: int, memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[bytes] = []
        origin: list[tuple[int, int, bool]] = []
        symbols = 0
        for parcels in by_bucket(batches):
            marks, place, start, strings, spans = opened(parcels)
            if len(spans):
                yield span_batch(spans)
            number: dict[bytes, int] = {}
            which = np.array([number.setdefault(s, len(number)) for s in strings], np.int64)
            texts = list(number)
            if not texts:
                continue
            times = np.bincount(which, minlength=len(texts))
            np.add.at(times, which, (marks & 1).astype(np.int64))
            length = np.array([len(t) for t in texts], np.int64)
            whole = times[which] > 1
            parts = [np.column_stack((place[whole], start[whole], start[whole] + length[which[whole]]))]
            # a text whose minimiser no other one has holds no window of another, nor one twice: the leftmost
            # smallest hash would have moved along
            mark = np.zeros(len(texts), np.uint32)
            mark[which] = marks >> 1
            _, kind, sizes = np.unique(mark, return_inverse=True, return_counts=True)
            group = np.flatnonzero(sizes[kind] > 1)
            row = np.zeros(len(texts), np.int64)
            row[which] = np.arange(len(which))
            text, begin, end = pieces([texts[i] for i in group.tolist()], width)
            for i, x, y in zip(group[text].tolist(), begin.tolist(), end.tolist()):
                waiting.append(texts[i][x:y])
                # rows of a whole repeat are decided; its text only serves the others
                origin.append((int(place[row[i]]), int(start[row[i]]) + x, bool(times[i] == 1)))
                symbols += y - x
            if symbols > TOGETHER:
                parts.append(_found(waiting, origin, width, memory))
                waiting, origin, symbols = [], [], 0
            out = np.concatenate(parts)
            if len(out):
                yield span_batch(out)
        if waiting:
            yield span_batch(_found(waiting, origin, width, memory))

    return run


def pieces(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end) of the parts that can hold repeats: windows whose hash comes more than once.

    Equal windows have equal hashes, so nothing is lost; what comes together by chance the sorted suffixes tell apart.
    """
    if not texts:
        none = np.zeros(0, np.int64)
        return none, none, none
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths) - lengths
    windows = lengths - width + 1
    at = ragged(begins, windows)
    h = run_hashes(np.frombuffer(b"".join(texts), np.uint8), at, at + width)
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    hit = np.zeros(len(h), bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    owner = np.repeat(np.arange(len(texts)), windows)[hit]
    return tuple(spans_of(owner, at[hit] - begins[owner], width).T)


def _found(texts: list[bytes], origin: list[tuple[int, int, bool]], width: int, memory: int) -> np.ndarray:
    """Spans (place, begin, end) of the repeats in the collection of these texts, of those still to be decided."""
    at = repeated(texts, width, memory)
    begins = np.cumsum([0] + [len(t) for t in texts])
    text = np.searchsorted(begins, at, side="right") - 1
    place, start, undecided = np.array(origin, np.int64).reshape(-1, 3).T
    own = undecided[text] > 0
    text, at = text[own], at[own]
    return spans_of(place[text], start[text] + at - begins[text], width)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        rows = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = (text or "").encode("utf-8", "surrogatepass")
            if spans:
                gone = covered(len(raw), spans)
                runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                rows.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
            else:
                rows.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(v, k) for v, k in zip(zip(*rows), kinds)]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def repeat_spans(rows: DataFrame, width: int = WIDTH, gram: int = GRAM, memory: int = MEMORY) -> DataFrame:
    """(place, b, e): bytes of placed texts that stand elsewhere too, in spans that may overlap."""
    return (
        rows.select("place", "text")
        .mapInArrow(_send(bucket_count(rows), width, gram), "bucket int, parcel binary")
        .repartition(F.col("bucket"))
        .sortWithinPartitions("bucket")
        .mapInArrow(_decide(width, memory), "place long, b long, e long")
    )


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, memory: int = MEMORY) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): the bytes left, one after the other."""
    rows = placed(docs)
    return with_spans(rows, repeat_spans(rows, width, gram, memory)).mapInArrow(
        _finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, own in zip(texts, spans):
        if own is None or text is None:
            out.append(text)
            continue
        raw = text.encode("utf-8", "surrogatepass")
        kept = np.frombuffer(raw, np.uint8)[~covered(len(raw), own)].tobytes()
        out.append(kept.decode("utf-8", "ignore"))  # a character that lost a byte goes whole
    return pd.Series(out, dtype=object)


def without_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """All columns of the documents, ``text`` without its repeats (and ``n_chars``, if there, counted anew)."""
    place, own = unused(docs, "row_place"), unused(docs, "row_spans")
    rows = numbered(docs, place)
    spans = repeat_spans(rows.select(F.col(place).alias("place"), "text"), width, gram)
    grouped = spans.groupBy(F.col("place").alias(place)).agg(F.collect_list(F.struct("b", "e")).alias(own))
    joined = rows.join(grouped, place, "left").withColumn("text", F.pandas_udf(_without, "string")("text", own))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col(own).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
