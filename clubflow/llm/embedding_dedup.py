"""Embedding near-duplicates by cosine, from tile products of int8 codes with error bounds per vector.

Distinct vectors are dealt to the nearest of some pivot vectors. A vector can only have partners in a cell whose
border is near enough: with cosine at least ``t``, partners lie within ``sqrt(2 - 2 t)``, so it is a guest of every
cell of a lower number whose separating plane is no farther. Cells are cut into tiles of bounded size. In a tile both sides are
quantised to int8; the product of the codes and the two exact quantisation errors bound the true cosine from both
sides. Pairs whose bounds lie on one side of the threshold are settled, the others are computed again in double
precision. A tile gives counts and a spanning forest of its links, never its pairs.

Vectors that are null, zero, hold null or non-finite numbers, or have another length than most, link with nothing
(the last with vectors of their length only). Equal vectors are one node with a number of copies. A repeated vec_id
counts as several vectors of one name; a null vec_id is kept as such and links with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clubflow.llm.common import components, local_components, narrow, stored

THRESHOLD = 0.9
#: Bytes of the vectors of one side of a tile, on average, as doubles.
TILE_BYTES = 16 << 20
#: Pivots: one for so many tile sides, within these limits; they are taken by hash, and only the speed depends on
#: them. A vector is copied into at most as many cells, so few large cells also bound the rows that are shuffled.
PIVOTS = (8, 512)
#: Rows of one side that are multiplied at a time.
BLOCK = 1024


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit rows, their scales, and the exact length of what the codes leave out."""
    top = np.abs(x).max(axis=1) if x.shape[1] else np.ones(len(x))
    scale = np.maximum(top, 1e-30) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1))


def code_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows. Blocks of 1,024 columns stay below 2**24, where single precision counts exactly."""
    out = np.zeros((len(a), len(b)), np.float32 if a.shape[1] <= 1024 else np.float64)
    for i in range(0, a.shape[1], 1024):
        out += a[:, i : i + 1024].astype(np.float32) @ b[:, i : i + 1024].astype(np.float32).T
    return out


def block_links(p: tuple, q: tuple, x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (row of x, row of y) of unit rows with product >= threshold, and how many needed full precision.

    ``p`` and ``q`` are the quantised rows of x and y.
    """
    (cp, sp, ep), (cq, sq, eq) = p, q
    if not len(cp) or not len(cq):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    rough = code_product(cp, cq)
    # |<u,v> - <u',v'>| <= |u - u'| |v| + |u'| |v - v'|, lengths 1 and at most 1 + error; a little for rounding
    least = threshold - (ep + (1 + ep) * float(eq.max()) + 1e-5)
    # the product of codes that a pair needs at the largest scale, or at the smallest one if it is below zero
    floor = least / (sp * np.where(least > 0, sq.max(), sq.min()))
    i, j = np.divmod(np.flatnonzero(rough >= (floor - np.abs(floor) * 1e-6)[:, None].astype(rough.dtype)), len(cq))
    value = rough[i, j].astype(float) * sp[i] * sq[j]
    bound = ep[i] + (1 + ep[i]) * eq[j] + 1e-5
    sure = value - bound >= threshold
    maybe = np.flatnonzero(~sure & (value + bound >= threshold))
    for k in range(0, len(maybe), 1 << 18):
        m = maybe[k : k + (1 << 18)]
        sure[m] = np.einsum("ij,ij->i", x[i[m]], y[j[m]]) >= threshold
    return i[sure], j[sure], len(maybe)


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """The same for rows that are not quantised yet."""
    return block_links(quantise(x), quantise(y), x, y, threshold)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; the largest number goes first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _unit(values: pa.Array) -> np.ndarray:
    return unit(np.asarray(values.flatten(), np.float64).reshape(len(values), -1))


def _deal(pivots: np.ndarray, reach: float):
    """Each vector to its own cell, and as a guest to the cells of lower numbers it may have partners in."""
    gap = np.sqrt(np.maximum(((pivots[:, None] - pivots[None]) ** 2).sum(axis=2), 0)) if len(pivots) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                x = _unit(part.column(1))
                near = x @ pivots.T
                cell = near.argmax(axis=1)
                best = near[np.arange(len(x)), cell]
                # distance to the plane between the two pivots
                guest = best[:, None] - near <= reach * gap[cell] * (1 + 1e-9) + 1e-9
                # a pair of two cells meets once, in the cell of the lower number
                guest &= np.arange(len(pivots)) < cell[:, None]
                row, other = np.nonzero(guest)
                rows = np.concatenate((np.arange(len(x)), row))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows)),
                        part.column(2).take(pa.array(rows)), pa.array(np.concatenate((cell, other)).astype(np.int32)),
                        pa.array(np.arange(len(rows)) >= len(x)),
                    ],
                    names=["node", "v", "n_same", "cell", "guest"],
                )

    return run


def _tile(threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, part, with_part, within = (k.as_py() for k in key)
        alone = within and part == with_part  # a part of a cell with itself: each pair once
        table = table.combine_chunks()
        node, times = np.asarray(table["node"]), np.asarray(table["n_same"])
        home = ~np.asarray(table["probe"].cast(pa.int8())).astype(bool)
        x = _unit(table["v"].combine_chunks())
        codes = quantise(x)
        # rows of like scales together, so that the largest scale of a block says most
        order = np.argsort(codes[1], kind="stable")
        h, p = order[home[order]], order if alone else order[~home[order]]
        count, forest = np.zeros(len(node), np.int64), np.arange(len(node))
        full = 0
        for a in range(0, len(h), BLOCK):
            hh = h[a : a + BLOCK]
            for b in range(a if alone else 0, len(p), BLOCK):
                pp = p[b : b + BLOCK]
                i, j, again = block_links([c[pp] for c in codes], [c[hh] for c in codes], x[pp], x[hh], threshold)
                full += again
                if alone and a == b:
                    i, j = i[i > j], j[i > j]
                if len(i):
                    i, j = pp[i], hh[j]
                    count += np.bincount(i, times[j], len(node)).astype(np.int64)
                    count += np.bincount(j, times[i], len(node)).astype(np.int64)
                    forest = local_components(len(node), forest[i], forest[j])[forest]
        joined = np.flatnonzero((forest != np.arange(len(node))) | (count > 0))
        return pa.table({
            "a": node[joined], "b": node[forest[joined]], "n": count[joined],
            "again": np.where(np.arange(len(joined)) == 0, full, 0).astype(np.int64),
        })

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int | None = None) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for a table (vec_id, embedding); ``tile``: vectors of a tile's side."""
    spark = vectors.sparkSession
    rows = narrow(vectors, "vec_id", "embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))
    good = F.coalesce(
        (F.size("embedding") > 0)
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
        & F.exists("embedding", lambda v: v != 0)
        & F.col("vec_id").isNotNull(),
        F.lit(False),
    )
    # -0.0 and 0.0 are one number
    v = F.transform("embedding", lambda x: x + F.lit(0.0))
    nodes = stored(
        rows.where(good)
        .groupBy(v.alias("v"))
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("n_same"))
        .withColumn("dim", F.size("v")),
        "vectors",
    )
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    parts = [
        _links(nodes.where(F.col("dim") == d), n, threshold, tile or max(256, TILE_BYTES // (8 * d)))
        for d, n in sorted(sizes.items())
    ]
    if not parts:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    links = parts[0]
    for more in parts[1:]:
        links = links.unionAll(more)
    links = stored(links, "tiles")
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    found = components(links.select("a", "b"))
    named = (
        nodes.select("v", "node", "n_same")
        .join(counts, "node", "left")
        .join(found, "node", "left")
        .select(
            "v",
            (F.coalesce("n", F.lit(0)) + F.col("n_same") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    keyed = rows.select("vec_id", F.when(good, v).alias("v"))
    return keyed.join(named, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )


def _links(nodes: DataFrame, n: int, threshold: float, tile: int) -> DataFrame:
    """(a, b, n): for vectors of one length, links to count and a spanning set of pairs."""
    spark = nodes.sparkSession
    want = min(max(n // tile, PIVOTS[0]), PIVOTS[1])
    chosen = nodes.orderBy(F.xxhash64("v"), "node").limit(want).select("v").collect()  # at most 512 vectors
    pivots = unit(np.array([r["v"] for r in chosen], float))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    dealt = stored(
        nodes.select("node", "v", "n_same").mapInArrow(
            _deal(pivots, reach), "node long, v array<double>, n_same long, cell int, guest boolean"
        ),
        "cells",
    )
    # sizes of the cells: two numbers a pivot
    cut = {
        r["cell"]: (max(1, -(-r["homes"] // tile)), -(-r["guests"] // tile))
        for r in dealt.groupBy("cell")
        .agg(F.count_if(~F.col("guest")).alias("homes"), F.count_if("guest").alias("guests"))
        .collect()
    }
    table = spark.createDataFrame([(c, h, g) for c, (h, g) in sorted(cut.items())], "cell int, hs int, gs int")
    sized = dealt.join(F.broadcast(table), "cell")
    at = F.pmod(F.xxhash64("node"), F.lit(1 << 30)).cast("int")
    own = sized.where(~F.col("guest")).withColumn("s", at % F.col("hs"))
    guests = sized.where("guest").withColumn("s", at % F.col("gs"))
    keep = ["node", "v", "n_same", "cell"]
    # a tile is a part of the cell's own vectors (i) with itself, against a later part (j), or against a part of the guests
    home, probe = F.lit(False).alias("probe"), F.lit(True).alias("probe")
    within, across = F.lit(True).alias("self"), F.lit(False).alias("self")

    def each(first, last):
        return F.explode(F.sequence(first, last))

    tiles = [
        own.select(*keep, F.col("s").alias("i"), each(F.col("s"), F.col("hs") - 1).alias("j"), within, home),
        own.where("s > 0").select(*keep, each(F.lit(0), F.col("s") - 1).alias("i"), F.col("s").alias("j"), within, probe),
        own.where("gs > 0").select(*keep, F.col("s").alias("i"), each(F.lit(0), F.col("gs") - 1).alias("j"), across, home),
        guests.select(*keep, each(F.lit(0), F.col("hs") - 1).alias("i"), F.col("s").alias("j"), across, probe),
    ]
    union = tiles[0].unionAll(tiles[1]).unionAll(tiles[2]).unionAll(tiles[3])
    found = union.groupBy("cell", "i", "j", "self").applyInArrow(_tile(threshold), "a long, b long, n long, again long")
    return found.select("a", "b", "n")
