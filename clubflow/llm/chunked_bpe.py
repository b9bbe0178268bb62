"""Byte-pair encoding by content-defined chunks: a chunk seen again is not encoded again.

A rolling hash over the bytes cuts each text where the hash ends in zeros, so passages shared by documents fall
into the same chunks wherever they stand. A worker encodes each distinct chunk once and keeps its ids. A cut may
split a word, so every join is repaired: the end of the left chunk and the start of the right one are encoded
again together, reaching out to the next white space on either side. The vocabulary never joins tokens across
white space, so there the two encodings agree exactly; a chunk without white space is taken into the repair whole.

Null text counts as empty, which has no ids and decodes to the empty text. A repeated doc_id gives a row each time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clubflow.llm.common import mix, narrow, raw_bytes, slices
from clubflow.llm.word_bpe import WordEncoder, encoder, vocabulary_path

#: Bytes of the rolling hash, and zeros it ends in at a cut: chunks have 2**ZEROS bytes on average.
ROLL = 16
ZEROS = 7
#: Chunks a worker remembers before it starts anew.
REMEMBERED = 60_000

_OUTER = re.compile(r"[ \t\n\r]")


def cuts(data: np.ndarray, offsets: np.ndarray, roll: int = ROLL, zeros: int = ZEROS) -> list[np.ndarray]:
    """Where each text of a batch is cut (its start and end included), always between characters."""
    n = len(data)
    if n <= roll:
        return [np.unique(offsets[i : i + 2]) for i in range(len(offsets) - 1)]
    with np.errstate(over="ignore"):
        factor = np.uint64(0x9E3779B97F4A7C15)
        h = np.zeros(n - roll + 1, np.uint64)
        for k in range(roll):
            h *= factor
            h += data[k : n - roll + 1 + k]
    hit = np.flatnonzero(mix(h) & np.uint64((1 << zeros) - 1) == 0) + roll
    hit = hit[hit < n]
    hit = hit[(data[hit] & 0xC0) != 0x80]
    # a hash that reaches back into the text before says nothing about this one
    doc = np.searchsorted(offsets, hit, side="right") - 1
    hit, doc = hit[hit - roll >= offsets[doc]], doc[hit - roll >= offsets[doc]]
    first = np.searchsorted(doc, np.arange(len(offsets)))
    return [
        np.unique(np.concatenate((offsets[i : i + 2], hit[first[i] : first[i + 1]]))) for i in range(len(offsets) - 1)
    ]


class ChunkEncoder:
    """Ids of texts given as chunks."""

    def __init__(self, words: WordEncoder):
        self.words = words
        self.known: dict[str, tuple[str, bytes, str] | None] = {}
        self.encoded = self.reused = 0

    def _chunk(self, chunk: str) -> tuple[str, bytes, str] | None:
        """(open start, ids of what lies between the first and last white space, open end); None without white space."""
        if chunk in self.known:
            self.reused += 1
            return self.known[chunk]
        self.encoded += 1
        first = _OUTER.search(chunk)
        if first is None:
            parts = None
        else:
            last = max(chunk.rfind(c) for c in " \t\n\r")
            parts = chunk[: first.start()], self.words.encode(chunk[first.start() : last]), chunk[last + 1 :]
        if len(chunk) <= 4096:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[chunk] = parts
        return parts

    def encode(self, chunks: list[str]) -> bytes:
        out: list[bytes] = []
        pending = ""
        for chunk in chunks:
            parts = self._chunk(chunk)
            if parts is None:
                pending += chunk
                continue
            head, ids, tail = parts
            # the join: both open ends together, between white space on either side
            out.append(self.words.encode(pending + head))
            out.append(ids)
            pending = tail
        out.append(self.words.encode(pending))
        return b"".join(out)


def encode(docs: DataFrame, vocabulary: str | None = None, roll: int = ROLL, zeros: int = ZEROS) -> DataFrame:
    """Rows (doc_id, n_tokens, ids, decoded, ids_sha256, decoded_sha256, n_chunks) for each whole text."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker = ChunkEncoder(encoder(path))
        for batch in slices(batches, 1):
            data, offsets = raw_bytes(batch.column(1))
            whole = data.tobytes()
            rows = []
            for at in cuts(data, offsets, roll, zeros):
                chunks = [whole[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                ids = chunker.encode(chunks)
                numbers = np.frombuffer(ids, dtype="<u4")
                text = chunker.words.decode(numbers)
                rows.append(
                    (len(numbers), ids, text, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), len(chunks))
                )
            kinds = (pa.int64(), pa.binary(), pa.string(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, k) for v, k in zip(zip(*rows), kinds)]],
                names=["doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256", "n_chunks"],
            )

    return narrow(docs, "doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_tokens long, ids binary, decoded string, ids_sha256 string, decoded_sha256 string, n_chunks long",
    )
