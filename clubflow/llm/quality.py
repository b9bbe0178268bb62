"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated by isotonic steps.

Each text gives ``len(FEATURES)`` statistics. Standardised by the labelled rows, they go through ``WIDTH`` random
cosines, whose products approximate a Gaussian kernel. Every partition sums its part of the normal equations; the
sums, ``WIDTH`` by ``WIDTH`` numbers whatever the number of rows, are solved on the driver. Rows of one fold are
scored by the equations of the other one, and pooled steps turn these scores into the share of good rows.

Null text counts as empty; its statistics are zeros and it gets a score as any other. Without labelled rows every
score is 0.5; rows whose label is null teach nothing. A repeated doc_id gives a row each time; a label repeated for
a doc_id counts once (the larger).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clubflow.llm.common import held_out, narrow, slices, stored, unused

WIDTH = 192
GAMMA = 0.05
RIDGE = 1e-3
BINS = 400
#: Statistics are cut at so many standard deviations, so no odd document leaves the kernel's range.
REACH = 6.0

FEATURES = (
    "log_chars", "log_words", "word_length", "long_words", "capitals", "all_capitals", "digits", "marks", "spaces",
    "odd_marks", "marked_words", "kinds_of_words", "top_word", "same_next", "kinds_of_pairs", "kinds_of_lines",
    "log_lines", "line_length", "stops", "short_words", "word_entropy", "bars", "squeeze", "links", "no_letter_words",
)

_MARKS = re.compile(r"[^\w\s]")
_ODD = re.compile(r"[^\w\s.,;:'\"!?()\-’–—¿¡«»]")
_DIGIT, _UPPER, _BLANK = re.compile(r"\d"), re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"\s")
_LINK = re.compile(r"https?://|www\.|@")


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text."""
    text = text or ""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    words = text.split()
    w = len(words) or 1
    counts = Counter(words)
    pairs = set(zip(words, words[1:]))
    lines = text.split("\n")
    letters = max(1, n - len(_BLANK.findall(text)))
    marks = _MARKS.findall(text)
    share = np.array(list(counts.values()) or [1], float) / w
    stops = sum(text.count(m) for m in (". ", ".\n", "? ", "! "))
    return [
        np.log1p(n), np.log1p(len(words)), letters / w, sum(len(x) > 12 for x in words) / w,
        len(_UPPER.findall(text)) / letters, sum(map(str.isupper, words)) / w, len(_DIGIT.findall(text)) / letters,
        len(marks) / letters, 1 - letters / n, len(_ODD.findall(text)) / letters,
        sum(not x[-1].isalnum() for x in words) / w, len(counts) / w ** 0.8, max(counts.values(), default=0) / w,
        sum(a == b for a, b in zip(words, words[1:])) / w, (len(pairs) + 1) / w,
        len(set(lines)) / len(lines), np.log1p(len(lines)), np.log1p(n / len(lines)), stops / w,
        sum(len(x) <= 3 for x in words) / w, float(-(share * np.log(share)).sum()) / np.log(w + 1),
        text.count("|") / w, len(zlib.compress(text.encode("utf-8", "surrogatepass"), 1)) / n,
        len(_LINK.findall(text)) / w, sum(not any(map(str.isalpha, x)) for x in words) / w,
    ]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of each text as an array of doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            x = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return narrow(docs, "doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


class Model:
    """Standardisation, cosines, weights and calibration; a few hundred numbers."""

    def __init__(self, mean, spread, width=WIDTH, gamma=GAMMA, seed=3):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = np.asarray(mean, float), np.asarray(spread, float)
        self.turn = rng.normal(0, np.sqrt(2 * gamma), (len(self.mean), width))
        self.phase = rng.uniform(0, 2 * np.pi, width)
        self.weights: list[np.ndarray] = []
        self.steps = (np.zeros(1), np.full(1, 0.5))

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -REACH, REACH)
        return np.column_stack((np.cos(z @ self.turn + self.phase) * np.sqrt(2 / len(self.phase)), np.ones(len(x))))

    def raw(self, x: np.ndarray, fold: int | None = None) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), 0.5)
        f = self.expand(x)
        return f @ (np.mean(self.weights, axis=0) if fold is None else self.weights[fold])

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.steps), 0.0, 1.0)


def _sums(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = model.turn.shape[1] + 1
        total = np.zeros((2, d, d + 1))
        for batch in batches:
            if batch.num_rows:
                f, y = model.expand(_matrix(batch.column(0))), np.asarray(batch.column(1), float)
                fold = np.asarray(batch.column(2))
                weight = np.asarray(batch.column(3), float)
                for k in (0, 1):
                    g = f[fold == k]
                    total[k] += (g * weight[fold == k, None]).T @ np.column_stack((g, y[fold == k]))
        rows = total.reshape(2 * d, d + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(2 * d)), pa.array(list(rows), pa.list_(pa.float64()))], names=["row", "sums"]
        )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, sums in zip(batch.column(0).to_pylist(), _matrix(batch.column(1)) if batch.num_rows else ()):
            totals[row] = totals[row] + sums if row in totals else sums
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(totals), pa.int64()), pa.array(list(totals.values()), pa.list_(pa.float64()))], names=["row", "sums"]
    )


def isotonic(x: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps through the shares of good rows (pool adjacent violators): middles and heights of the pools."""
    pools: list[list[float]] = []
    for v, g, w in zip(x, good, weight):
        pools.append([v * w, g, w])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fit(rows: DataFrame) -> Model:
    """Learn from all rows (x array<double>, y double, fold 0 or 1)."""
    n = len(FEATURES)
    stats = rows.agg(
        F.avg("y").alias("share"), F.count("*").alias("rows"),
        *[f(F.col("x")[i]).alias(f"{name}{i}") for i in range(n) for name, f in (("m", F.avg), ("s", F.stddev_pop))],
    ).first()
    if not stats["rows"]:
        return Model(np.zeros(n), np.ones(n))
    spread = np.array([stats[f"s{i}"] for i in range(n)])
    model = Model([stats[f"m{i}"] for i in range(n)], np.where(spread > 1e-9, spread, 1.0))
    # both labels weigh the same in the regression; the calibration brings their shares back
    share = min(max(stats["share"], 1e-3), 1 - 1e-3)
    weighted = rows.withColumn("weight", F.when(F.col("y") > 0, 0.5 / share).otherwise(0.5 / (1 - share)))
    sums = weighted.select("x", "y", "fold", "weight").mapInArrow(_sums(model), "row long, sums array<double>")
    sums = sums.repartition("row").mapInArrow(_added, "row long, sums array<double>")
    d = model.turn.shape[1] + 1
    total = np.zeros((2 * d, d + 1))
    for r in sums.collect():  # 2 * (WIDTH + 1) rows
        total[r["row"]] = r["sums"]
    total = total.reshape(2, d, d + 1)
    every = total.sum(axis=0)
    for k in (1, 0):  # the weights of fold k come from the other fold
        part = total[k] if total[k].any() else every
        scale = RIDGE * max(part[-1, -2], 1.0)
        model.weights.append(np.linalg.solve(part[:, :-1] + scale * np.eye(d), part[:, -1]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, fold = _matrix(batch.column(0)), np.asarray(batch.column(2))
                raw = np.where(fold == 0, model.raw(x, 0), model.raw(x, 1))
                cell = np.clip(np.round(raw * BINS), -BINS, 2 * BINS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column(1)], names=["cell", "y"])

    cells = rows.select("x", "y", "fold").mapInArrow(score, "cell long, y double")
    found = cells.groupBy("cell").agg(F.sum("y").alias("good"), F.count("*").alias("n")).orderBy("cell").collect()
    model.steps = isotonic(*(np.array([r[i] for r in found], float) * (1 / BINS if i == 0 else 1) for i in range(3)))
    return model


def predict(rows: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, score) for measured texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], names=["doc_id", "score"]
                )

    return rows.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def labelled(rows: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """Measured rows with their label, without the held-out ones: (x, y, fold)."""
    known = narrow(labels, "doc_id", "quality").where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("y"))
    return (
        rows.where(~held_out("doc_id", parts, part))
        .join(known, "doc_id")
        .select("x", F.col("y").cast("double").alias("y"), (F.abs(F.xxhash64("doc_id")) % 2).cast("int").alias("fold"))
    )


def rate(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted): learn from the labelled rows not held out, score all."""
    rows = stored(measured(docs), "statistics")
    scored = predict(rows, fit(labelled(rows, labels, parts, part)))
    return scored.select(
        "doc_id", held_out("doc_id", parts, part).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """The rows of ``docs``, all columns, whose text the classifier takes as good.

    Each text is measured once and its statistics are stored beside the row, so the labels meet a few numbers a
    document and no text is shuffled.
    """

    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    held = unused(docs, "row_statistics")
    rows = stored(docs.withColumn(held, measure(F.col("text"))), "statistics")
    model = fit(labelled(rows.select("doc_id", F.col(held).alias("x")), labels, parts, part))

    @F.pandas_udf("boolean")
    def good(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist(), float).reshape(len(x), -1)) >= 0.5)

    return rows.where(good(F.col(held))).drop(held)
