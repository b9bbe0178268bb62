"""Hard-negative mining with rotated one-bit codes.

Vectors become whole numbers, are turned by a fixed orthogonal matrix and written as a few one-bit codes, the signs of
the numbers and of what each code before left over; with them their alignment is stored, the multiple of the code
vector that is nearest. Between two coded vectors the popcounts of the codes estimate the product, and by Cauchy and
Schwarz the true product differs by at most ``rest(q) |o| + |q'| rest(o)``, where ``rest`` is the exact length of what the codes leave out and ``q'`` what they
say. So each pair has an interval. A pair whose interval cannot reach the best found so far, or lies outside the band
asked for, is discarded; the others are scored in whole numbers. No true result is lost.

Queries meet rows in tiles of bounded size, a block of queries with a block of rows: first with the rows of their own
label for the positives, then, with the bands of the scores wanted, with all rows. A tile gives the best few of each
query, and a ranking of those makes the result.

A row takes part if it has a vec_id, a label and a vector of finite numbers. Equal rows (id, label, vector) count once;
rows that share an id otherwise are rows of their own. Only vectors of one length are compared. A whole number outside
the range of doubles becomes the largest double, a score outside long the end of its range.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clubflow.llm.common import narrow, stored

SCALE = 256
ANCHORS_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
#: Scores of negatives, in hundredths of the positive's score.
BAND = (30, 90)
#: Sign codes of a row, and of a query.
LEVELS, QUERY_LEVELS = 5, 6
#: Parts of a vector's largest number that the codes may reach to; the best is taken.
REACHES = (1.0, 0.85, 0.7, 0.55)
#: Bytes of the vectors of one side of a tile.
TILE_BYTES = 16 << 20
#: Queries and rows of a tile that are compared at a time.
STEP = (32, 4096)
#: Numbers above have no code: their pairs are all scored.
_WIDE = 1e12
_LONG = (-(2**63), 2**63 - 1)


def mislabelled(vec_id: Column, label: Column) -> Column:
    """Labels with every seventh row's moved on to the next of ten."""
    label = label.cast("long")
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


@lru_cache
def rotation(dim: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(v: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), alignments, lengths of the rest, and lengths of the rows.

    The codes of a row, each half as heavy as the one before, make one code vector; the alignment is the multiple of
    it that is nearest to the turned row, so that the rest stands at right angles to the code vector.
    """
    n, dim = v.shape
    words = max(1, -(-dim // 64))
    wide = np.abs(v).max(axis=1, initial=0) > _WIDE
    turned = np.where(wide[:, None], 0, v) @ rotation(dim).T if dim else v
    length = np.sqrt((turned**2).sum(axis=1))
    codes, align, left = np.zeros((n, levels, words), np.uint64), np.zeros(n), length.copy()
    top = np.abs(turned).max(axis=1, initial=0)
    for reach in REACHES if dim else ():
        rest, weight, made = turned, (top * reach / 2)[:, None], np.zeros_like(turned)
        ups = []
        for k in range(levels):
            up = rest >= 0
            rest = rest - np.where(up, weight, -weight) / 2**k
            made += np.where(up, 2.0**-k, -(2.0**-k))
            ups.append(up)
        along = (turned * made).sum(axis=1) / (made**2).sum(axis=1)
        missing = np.sqrt(((turned - along[:, None] * made) ** 2).sum(axis=1))
        better = missing < left
        align[better], left[better] = along[better], missing[better]
        bits = np.zeros((int(better.sum()), levels, 64 * words), bool)
        for k, up in enumerate(ups):
            bits[:, k, :dim] = up[better]
        codes[better] = np.packbits(bits, axis=2, bitorder="little").view(np.uint64)
    left += 1e-9 * length
    left[wide] = length[wide] = np.inf
    return codes, align, left, length


def intervals(q: tuple, o: tuple, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest products of each query with each row, from their codes."""
    (qc, qa, ql, qn), (oc, oa, ol, on) = q, o
    differ = np.zeros((len(qc), len(oc)), np.float32)
    for i in range(qc.shape[1]):
        for j in range(oc.shape[1]):
            count = np.bitwise_count(qc[:, None, i, 0] ^ oc[None, :, j, 0])
            for w in range(1, oc.shape[2]):
                count = count.astype(np.uint16) + np.bitwise_count(qc[:, None, i, w] ^ oc[None, :, j, w])
            differ += count * np.float32(2.0 ** -(i + j))
    every = dim * (2 - 2.0 ** (1 - qc.shape[1])) * (2 - 2.0 ** (1 - oc.shape[1]))
    value = np.outer(qa, oa).astype(np.float32) * (np.float32(every) - 2 * differ)
    said = qn + ql  # at least the length of what the query's codes say
    bound = np.outer(ql + 1e-30, on + 1e-30) + np.outer(said + 1e-30, ol + 1e-30)
    bound += 1e-5 * np.outer(said + 1e-30, on + ol + 1e-30)
    bound = bound.astype(np.float32)
    return value - bound, value + bound


def score(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact products of rows of whole numbers."""
    top = np.abs(x).max(axis=1, initial=0) * np.abs(y).max(axis=1, initial=0)
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.einsum("ij,ij->i", x, y)
        far = np.flatnonzero(~(top * max(1, x.shape[1]) < 2**53))
    out[far] = 0
    out = out.astype(np.int64)
    for i in far.tolist():
        exact = sum(int(a) * int(b) for a, b in zip(x[i].tolist(), y[i].tolist()))
        out[i] = min(max(exact, _LONG[0]), _LONG[1])
    return out


class Best:
    """The best few rows of each (query, band): higher scores first, ties by smaller id."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.found = [[(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in row] for row in low]
        #: What a row must reach.
        self.least = low.astype(np.float64)

    def expect(self, first: int, lows: np.ndarray, highs: np.ndarray, ask: np.ndarray) -> np.ndarray:
        """Which pairs, of queries from ``first`` on, have to be scored."""
        wanted = np.zeros(lows.shape, bool)
        for a in range(len(lows)):
            low, high = lows[a], highs[a]
            for b in range(self.low.shape[1]):
                lo, hi = self.low[first + a, b], self.high[first + a, b]
                if lo > hi:
                    continue
                least = self.least[first + a, b]
                if len(self.found[first + a][b][0]) < self.k:
                    sure = low[(low >= lo) & (high <= hi) & ask[a]]
                    if len(sure) >= self.k:
                        least = max(least, float(np.partition(sure, len(sure) - self.k)[len(sure) - self.k]))
                wanted[a] |= (high >= np.float32(least)) & (low <= np.float32(hi))
        return wanted & ask

    def add(self, query: int, scores: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        """Put in scored rows; ``ids`` names all rows of the tile."""
        for b, (have, at) in enumerate(self.found[query]):
            fits = (scores >= self.low[query, b]) & (scores <= self.high[query, b])
            if fits.any():
                s, r = np.concatenate((have, scores[fits])), np.concatenate((at, rows[fits]))
                order = np.lexsort((r, ids[r], ~s))[: self.k]
                self.found[query][b] = s[order], r[order]
                if len(order) == self.k:
                    self.least[query, b] = max(self.least[query, b], s[order[-1]])


def _matrix(values: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    flat = np.asarray(values.flatten())
    return flat.reshape(n, len(flat) // n if n else 0)


def _code(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column(2).value_lengths())
            for dim in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == dim)))
                n = part.num_rows
                with np.errstate(over="ignore"):
                    v = np.clip(np.floor(SCALE * _matrix(part.column(2), n)), *np.finfo(float).max * np.array([-1, 1]))
                codes, align, left, length = encode(v, levels)
                flat = pa.array(np.column_stack((align, left, length)).ravel())
                raw = codes.reshape(n, -1).view(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(np.full(n, dim, np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dim), pa.array(v.ravel())),
                        pa.array([r.tobytes() for r in raw], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 3), flat),
                    ],
                    names=["vec_id", "label", "dim", "v", "code", "align"],
                )

    return run


def _tile(levels: int, query_levels: int, k: int, same_label: bool):
    """The best rows of each query of a tile, (node, band, id, score); ``low`` and ``high`` are the query's bands."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = np.asarray(table["asks"].combine_chunks().cast(pa.int8())).astype(bool)
        node, ids, label = (np.asarray(table[c]) for c in ("node", "vec_id", "label"))
        v = _matrix(table["v"], len(node))
        dim = v.shape[1]
        q, o = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(q) or not len(o):
            return _rows([], [], [], [])
        seen = table.filter(pa.array(~asks))
        align = _matrix(seen["align"], len(o))
        codes = np.frombuffer(b"".join(seen["code"].to_pylist()), np.uint64).reshape(len(o), levels, -1)
        stored_rows = codes, *align.T
        asked = encode(v[q], query_levels)
        own = table.filter(pa.array(asks))
        bands = _matrix(own["low"], len(q)).shape[1]
        best = Best(_matrix(own["low"], len(q)).reshape(len(q), bands), _matrix(own["high"], len(q)).reshape(len(q), bands), k)
        x, y, oi = v[q], v[o], ids[o]
        for j in range(0, len(o), STEP[1]):
            rows = [c[j : j + STEP[1]] for c in stored_rows]
            oj = o[j : j + STEP[1]]
            for i in range(0, len(q), STEP[0]):
                qi = q[i : i + STEP[0]]
                low, high = intervals(tuple(c[i : i + STEP[0]] for c in asked), tuple(rows), dim)
                if same_label:
                    ask = (label[qi][:, None] == label[oj][None]) & (node[qi][:, None] != node[oj][None])
                else:
                    ask = label[qi][:, None] != label[oj][None]
                a, b = np.nonzero(best.expect(i, low, high, ask))
                found = np.empty(len(a), np.int64)
                for c in range(0, len(a), 1 << 16):
                    found[c : c + (1 << 16)] = score(x[i + a[c : c + (1 << 16)]], y[j + b[c : c + (1 << 16)]])
                edge = np.searchsorted(a, np.arange(len(qi) + 1))
                for n in np.flatnonzero(np.diff(edge)).tolist():
                    best.add(i + n, found[edge[n] : edge[n + 1]], j + b[edge[n] : edge[n + 1]], oi)
        out: list[list] = [[], [], [], []]
        for n, per_band in enumerate(best.found):
            for band, (scores, at) in enumerate(per_band):
                for column, values in zip(out, ([int(node[q[n]])] * len(at), [band] * len(at), oi[at].tolist(), scores.tolist())):
                    column += values
        return _rows(*out)

    return run


_FOUND = "node long, band int, id long, score long"


def _rows(*columns: list) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["node", "band", "id", "score"])


def _each(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def _met(rows: DataFrame, queries: DataFrame, counts: DataFrame, keys: list[str], tiles) -> DataFrame:
    """The best rows of every query (node, dim, label, v, low, high) among all rows of its keys, in tiles.

    ``counts`` has, for each value of the keys, the parts ``hs`` of the rows and ``qs`` of the queries.
    """
    part = F.pmod(F.xxhash64("node"), F.lit(1 << 30)).cast("int")
    names = ["dim", "node", "vec_id", "label", "v"]
    none = [F.lit(None).cast("binary").alias("code"), F.lit(None).cast("array<double>").alias("align")]
    no_band = [F.lit(None).cast("array<long>").alias(c) for c in ("low", "high")]
    sides = [
        rows.join(counts, keys).select(*names, "code", "align", *no_band, F.lit(False).alias("asks"), _each(F.col("qs")).alias("i"), (part % F.col("hs")).alias("j")),
        queries.join(counts, keys).select(*names, *none, "low", "high", F.lit(True).alias("asks"), (part % F.col("qs")).alias("i"), _each(F.col("hs")).alias("j")),
    ]
    return sides[0].unionAll(sides[1]).groupBy(*keys, "i", "j").applyInArrow(tiles, _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("node", "band").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
    anchors_every: int = ANCHORS_EVERY,
    levels: int = LEVELS,
    tile: int | None = None,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for (vec_id, embedding, label).

    Anchors are the rows with a vec_id divisible by ``anchors_every``; ``tile``: rows of a tile's side.
    """
    spark = vectors.sparkSession
    rows = narrow(vectors, "vec_id", "label", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    nodes = stored(
        rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
        .distinct()
        .mapInArrow(_code(levels), "vec_id long, label long, dim int, v array<double>, code binary, align array<double>")
        .withColumn("node", F.monotonically_increasing_id()),
        "codes",
    )
    is_anchor = F.col("vec_id") % anchors_every == 0
    counts = stored(
        nodes.groupBy("dim", "label").agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("a")).where("a > 0"), "counts"
    )
    side = F.lit(tile) if tile else F.greatest(F.lit(256), F.lit(TILE_BYTES) / (8 * F.col("dim") + 128)).cast("int")
    hs, qs = (F.ceil(F.col(c) / side).cast("int").alias(p) for c, p in (("n", "hs"), ("a", "qs")))

    def bounds(low: Column, high: Column) -> list[Column]:
        return [F.col("dim"), F.col("node"), F.col("vec_id"), F.col("label"), F.col("v"), low.alias("low"), high.alias("high")]

    anchors = nodes.where(is_anchor)
    open_band = bounds(F.array(F.lit(_LONG[0])), F.array(F.lit(_LONG[1])))
    near = _met(
        nodes, anchors.select(*open_band), counts.select("dim", "label", hs, qs), ["dim", "label"],
        _tile(levels, QUERY_LEVELS, positives, True),
    )
    near = stored(_first(near, positives).select("node", F.col("rank").alias("place"), "id", "score"), "positives")
    asked = near.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("p"))  # a few each

    def edge(of: int, up: bool) -> Column:
        # whole numbers between of/100 of the score
        times = F.lit(of).cast("decimal(20,0)")
        share = (lambda s: F.ceil(s.cast("decimal(20,0)") * times / 100)) if up else (lambda s: F.floor(s.cast("decimal(20,0)") * times / 100))
        return F.transform("p", lambda p: share(p["score"]).cast("long"))

    # every part of the rows can run at the same time
    enough = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # all rows of one length meet its anchors, whatever the labels
    totals = nodes.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("a")).where("a > 0")
    parts = totals.select("dim", F.greatest(F.ceil(F.col("n") / side), F.least(F.lit(enough), F.ceil(F.col("n") / 256))).cast("int").alias("hs"), qs)
    wanted = anchors.join(asked, "node").select(*bounds(edge(band[0], True), edge(band[1], False)))
    far = _met(nodes, wanted, parts, ["dim"], _tile(levels, QUERY_LEVELS, negatives, False))
    best = _first(far, negatives).select("node", (F.col("band") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select("node", F.col("vec_id").alias("anchor_id"))
    return (
        best.join(near.select("node", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["node", "place"])
        .join(ids, "node")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )
