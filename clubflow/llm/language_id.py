"""Language identification by rank order: out-of-place distance between n-gram profiles.

A profile lists the most frequent n-grams (1 to 3 letters of words padded with a blank) by rank. Languages learn
theirs from all training texts, counted by Spark; a document's own profile is compared with each by the sum of
rank differences, an n-gram missing in the language profile counting as the profile's length. The language with
the smallest distance wins; ties go to the alphabetically first.

Null text, and text without a letter, is ``und`` with score 0. Rows without a language teach nothing. With no
training row every text is ``und``. A repeated doc_id gives a row each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clubflow.llm.common import held_out, narrow, slices

#: Length of a language's profile and of a document's.
PROFILE = 1000
RANKS = 400
UNKNOWN = "und"


@lru_cache(maxsize=4096)
def _letter(code: int) -> int:
    c = chr(code)
    return ord(c.lower()[0]) if c.isalpha() else 32


def _letters(text: str) -> np.ndarray:
    """Code points in lower case, anything but letters as a blank, blanks in a row as one, one at each end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(codes):
        return np.full(1, 32, np.int64)
    top = int(codes.max())
    if top < 1024:
        out = _table()[codes]
    else:
        values, where = np.unique(codes, return_inverse=True)
        out = np.array([_letter(v) for v in values.tolist()], np.int64)[where]
    out = np.concatenate(([32], out, [32]))
    blank = out == 32
    return out[~(blank & np.r_[False, blank[:-1]])]


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    return np.array([_letter(c) for c in range(1024)], np.int64)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as numbers (21 bits a letter) and how often each occurs; none without a letter."""
    x = _letters(text or "")
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = (x[:-1] << 21) | x[1:]
    triples = (pairs[:-1] << 21) | x[2:]
    triples = triples[x[1:-1] != 32]  # no gram spans two words
    return np.unique(np.concatenate((x[x != 32], pairs, triples)), return_counts=True)


def _top(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent first; equally frequent ones by their number."""
    return keys[np.lexsort((keys, -counts))[:size]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language and n-gram of this task, each once."""
    totals: dict[str, dict[int, int]] = {}
    for batch in slices(batches, 1):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            mine = totals.setdefault(lang, {})
            keys, counts = grams(text)
            for k, c in zip(keys.tolist(), counts.tolist()):
                mine[k] = mine.get(k, 0) + c
        if sum(map(len, totals.values())) > 500_000:
            yield from _rows(totals)
            totals = {}
    yield from _rows(totals)


def _rows(totals: dict[str, dict[int, int]]) -> Iterator[pa.RecordBatch]:
    for lang, mine in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(mine)), pa.array(list(mine), pa.int64()), pa.array(list(mine.values()), pa.int64())],
            names=["lang", "gram", "n"],
        )


def learn(train: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """{language: n-grams by rank} from rows (text, lang); at most ``size`` numbers a language reach the driver."""
    counted = (
        narrow(train, "lang", "text")
        .where("lang is not null and text is not null")
        .mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for lang, gram, _ in sorted(ranked.select("lang", "gram", "rank").collect(), key=lambda r: (r[0], r[2])):
        profiles.setdefault(lang, []).append(gram)
    return profiles


class Judge:
    """Distances of texts to all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]], ranks: int = RANKS):
        self.names, self.ranks = sorted(profiles), ranks
        self.size = max((len(p) for p in profiles.values()), default=1)
        self.keys = np.unique(np.concatenate([np.array(p, np.int64) for p in profiles.values()] or [np.zeros(0, np.int64)]))
        self.rank = np.full((len(self.names), len(self.keys) + 1), -1, np.int64)
        for row, name in enumerate(self.names):
            self.rank[row, np.searchsorted(self.keys, profiles[name])] = np.arange(len(profiles[name]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        mine = _top(*grams(text), self.ranks)
        if not len(mine) or not self.names:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.keys, mine)
        at[at < len(self.keys)] = np.where(
            self.keys[at[at < len(self.keys)]] == mine[at < len(self.keys)], at[at < len(self.keys)], len(self.keys)
        )
        found = self.rank[:, at]
        place = np.arange(len(mine))
        away = np.where(found < 0, self.size, np.abs(found - place)).sum(axis=1)
        best = int(np.argmin(away))
        # how much nearer than the mean distance, against the largest possible
        rest = np.delete(away, best)
        if not len(rest):
            return self.names[best], 1.0
        odds = np.exp((away[best] - rest) / (0.05 * self.size * len(mine))).sum()
        return self.names[best], float(1 / (1 + odds))


def predict(docs: DataFrame, profiles: dict[str, list[int]], ranks: int = RANKS) -> DataFrame:
    """Rows (doc_id, lang_pred, score) for each whole text; the profiles are a few thousand numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(profiles, ranks)
        for batch in slices(batches, 1):
            said = [judge(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return narrow(docs, "doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, parts: int = 4, part: int = 2, size: int = PROFILE) -> DataFrame:
    """Learn from the rows that are not held out and predict all: (doc_id, held_out, lang_pred, score)."""
    out = held_out("doc_id", parts, part)
    said = predict(docs, learn(docs.where(~out), size))
    return said.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def language_of(profiles: dict[str, list[int]], ranks: int = RANKS):
    """A column function text -> (lang, score)."""

    @F.pandas_udf("lang string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        judge = Judge(profiles, ranks)
        return pd.DataFrame([judge(t) for t in texts], columns=["lang", "score"])

    return language
