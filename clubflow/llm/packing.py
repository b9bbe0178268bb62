"""Packing token ids of documents into windows by the sum-of-squares rule.

Each partition of the documents packs its own: a document's full windows go out at once, and what remains goes to
the fill level that makes the sum of squared counts of partly filled windows smallest, read from an array with one
count per level. At the end of a partition the emptiest window is taken apart again and again and the rule places its
pieces in the others; a piece that fits into none is cut to close the fullest. The tokens of the last window form
windows whose lengths are powers of two, so no window needs padding. No token moves between machines, and a task keeps
the open windows only.

Null text counts as empty: a document then has its end mark alone. A repeated doc_id is a document of its own.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clubflow.llm.common import narrow, slices
from clubflow.llm.word_bpe import encoder, vocabulary_path

WINDOW = 4096
END_ID = 2
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long, ids binary"
)

#: doc_id, start, ids, tokens of the document
Piece = tuple[int, int, np.ndarray, int]


class SumOfSquares:
    """Open windows by fill level; ``put`` gives back a window once it is full."""

    def __init__(self, size: int = WINDOW):
        self.size = size
        self.counts = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)

    def level(self, length: int, new: bool = True) -> int:
        """The level (0: a new window) at which adding ``length`` makes the sum of squares least; ties: the fullest.

        Without ``new`` only open windows count; 0 then says that the piece fits into none.
        """
        n, size = self.counts, self.size
        lost = 1 - 2 * n[: size + 1 - length]
        lost[0] = 0 if new else np.iinfo(np.int64).max // 2
        gained = 2 * n[length:] + 1
        gained[-1] = 0  # a full window is open no more
        change = lost + gained
        change[1:][n[1 : size + 1 - length] == 0] = np.iinfo(np.int64).max
        return int(len(change) - 1 - np.argmin(change[::-1]))

    def put(self, piece: Piece, new: bool = True) -> list[Piece] | None:
        """Place a piece; without ``new`` it has to fit into an open window."""
        return self._put(piece, self.level(len(piece[2]), new))

    def _put(self, piece: Piece, at: int) -> list[Piece] | None:
        length = len(piece[2])
        window = self.open[at].pop() if at else []
        self.counts[at] -= at > 0
        window.append(piece)
        if at + length == self.size:
            return window
        self.open[at + length].append(window)
        self.counts[at + length] += 1
        return None

    def close(self) -> Iterator[list[Piece]]:
        """The windows that are still open, closed: each step empties the emptiest one into the others."""
        while self.counts.sum() > 1:
            levels = np.flatnonzero(self.counts)
            least = int(levels[0])
            window = self.open[least].pop()
            self.counts[least] -= 1
            for doc, start, ids, tokens in sorted(window, key=lambda p: -len(p[2])):
                while len(ids):
                    if not self.counts.any():  # all others are full: the rest of the window stays open
                        full = self.put((doc, start, ids, tokens))
                    elif self.level(len(ids), new=False):
                        full = self.put((doc, start, ids, tokens), new=False)
                    else:
                        most = int(np.flatnonzero(self.counts)[-1])
                        full = self._put((doc, start, ids[: self.size - most], tokens), most)
                        start, ids = start + self.size - most, ids[self.size - most :]
                        yield full
                        continue
                    if full:
                        yield full
                    break
        last = [p for windows in self.open.values() for window in windows for p in window]
        yield from _powers(last)


def _powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The tokens of the pieces in windows whose lengths are powers of two, the longest first."""
    left = sum(len(p[2]) for p in pieces)
    window, room = [], 0
    for doc, start, ids, tokens in pieces:
        while len(ids):
            if not room:
                room = 1 << (left.bit_length() - 1)
            take = min(room, len(ids))
            window.append((doc, start, ids[:take], tokens))
            start, ids, room, left = start + take, ids[take:], room - take, left - take
            if not room:
                yield window
                window = []


def windows(docs: Iterator[tuple[int, np.ndarray]], size: int = WINDOW) -> Iterator[list[Piece]]:
    """Windows of pieces for a stream of (doc_id, ids)."""
    packer = SumOfSquares(size)
    for doc, ids in docs:
        n = len(ids)
        whole = n - n % size
        for start in range(0, whole, size):
            yield [(doc, start, ids[start : start + size], n)]
        if n > whole:
            full = packer.put((doc, whole, ids[whole:].copy(), n))
            if full:
                yield full
    yield from packer.close()


def pack(docs: DataFrame, vocabulary: str | None = None, size: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place in it and place in its window (``sequence_id``, ``offset``)."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = encoder(path), np.array([END_ID], "<u4").tobytes()
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40

        def stream():
            for batch in slices(batches, 1):
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    yield doc, np.frombuffer(bpe.encode(text or "") + end, dtype="<u4")

        rows: list[tuple] = []
        for k, window in enumerate(windows(stream(), size)):
            offset, total = 0, sum(len(p[2]) for p in window)
            for doc, start, ids, tokens in window:
                raw = ids.tobytes()
                rows.append((doc, start, len(ids), zlib.crc32(raw), tokens, number + k, offset, total, raw if with_ids else None))
                offset += len(ids)
            if len(rows) >= 2000:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return narrow(docs, "doc_id", "text").mapInArrow(run, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.int64()] * 8 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kind) for v, kind in zip(zip(*rows), kinds)], names=names
    )
