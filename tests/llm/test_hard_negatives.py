"""Hard negatives against a plain version that scores all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clubflow.llm import hard_negatives as hn

KINDS = "vec_id long, label int, embedding array<double>, node long, code string, low double, dim int"


def table(spark, rows):
    return spark.createDataFrame([(i, k, v, 1, "x", 0.5, 2) for i, k, v in rows], KINDS).repartition(3)


def whole(x: float) -> int:
    top = int(np.finfo(float).max)
    return math.floor(x * 256) if abs(x) < 1e300 else max(-top, min(top, int(x) * 256))


def plain(rows, positives=5, negatives=10):
    good = []
    for i, k, v in dict.fromkeys((i, k, None if v is None else tuple(v)) for i, k, v in rows):
        if i is None or k is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, k, [whole(x) for x in v]))

    def product(x, y):
        return max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(x, y))))

    out = []
    for n, (i, k, v) in enumerate(good):
        if i % 100:
            continue
        others = [(-product(v, w), j, kk) for m, (j, kk, w) in enumerate(good) if m != n and len(w) == len(v)]
        for ps, p, _ in sorted(o for o in others if o[2] == k)[:positives]:
            ps = -ps
            band = sorted((s, j) for s, j, kk in others if kk != k and 30 * ps <= -100 * s <= 90 * ps)
            out += [(i, p, r, j, ps, -s) for r, (s, j) in enumerate(band[:negatives], 1)]
    return sorted(out)


def got(spark, rows, **more):
    return sorted(tuple(r) for r in hn.mine(table(spark, rows), **more).collect())


def random_rows(seed, n=400, dim=9, step=25):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    rows = []
    for i in range(n):
        k = int(rng.integers(0, 4))
        v = centres[rng.integers(0, 6)] + 0.4 * rng.standard_normal(dim)
        rows.append((i * step, k, (v / np.linalg.norm(v)).tolist()))
    return rows


@pytest.mark.parametrize("seed,dim,tile", [(1, 9, None), (2, 70, 40), (3, 64, 50), (4, 130, None)])
def test_same_rows_as_all_pairs(spark, seed, dim, tile):
    rows = random_rows(seed, dim=dim)
    want = plain(rows)
    assert want and got(spark, rows, tile=tile) == want


def test_ties_repeats_nulls_and_odd_numbers(spark):
    rng = random.Random(5)
    pool = [[rng.choice([0.0, 0.5, 1.0, -0.5]) for _ in range(3)] for _ in range(4)]
    rows = [(i * 20, i % 3, pool[rng.randrange(4)]) for i in range(120)]  # many equal scores
    rows += rows[:10]  # equal rows count once
    rows += [(100, 1, [0.5, 0.25, 1.0]), (100, 2, [0.5, 0.5, 1.0])]  # one id, several rows
    rows += [(None, 1, [1.0, 1.0, 1.0]), (7, None, [1.0, 1.0, 1.0]), (8, 1, None), (9, 1, [1.0, None, 1.0]), (10, 1, [1.0, math.nan, 1.0]),
             (11, 1, [math.inf, 0.0, 0.0]), (12, 1, []), (200, 1, []), (13, 2, []), (300, 1, [1.0]), (14, 1, [2.0]), (15, 2, [1.0]),
             (400, 1, [0.0, 0.0, 0.0]), (500, 1, [-1.0, -1.0, 0.0]), (-100, 2, [0.5, 1.0, 0.0])]
    want = plain(rows)
    assert want and got(spark, rows, tile=16) == want


def test_very_large_numbers(spark):
    rng = random.Random(6)
    rows = [(i * 50, i % 2, [rng.choice([1e-300, 0.7, 5e6, 1.37e6, 4e6 + 1 / 3]) for _ in range(4)]) for i in range(60)]
    rows += [(i * 50, i % 2, [rng.choice([0.7, 3e7, 1e13, 1e200, 1e307, -1e20]) for _ in range(4)]) for i in range(60, 80)]
    want = plain(rows)
    assert want and got(spark, rows) == want


def test_no_rows_and_int_ids(spark):
    rows = random_rows(7, n=60)
    assert hn.mine(table(spark, rows).limit(0)).collect() == []
    narrow = table(spark, rows).withColumn("vec_id", F.col("vec_id").cast("int")).withColumn("embedding", F.col("embedding").cast("array<float>"))
    want = plain([(i, k, [float(np.float32(x)) for x in v]) for i, k, v in rows])
    assert want and sorted(tuple(r) for r in hn.mine(narrow).collect()) == want


def test_intervals_hold_and_discard():
    rng = np.random.default_rng(8)
    v = np.floor(256 * (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.standard_normal((600, 64))))
    q = v[:50]
    low, high = hn.intervals(hn.encode(q, 6), hn.encode(v, 5), 64)
    true = q @ v.T
    assert (low <= true).all() and (true <= high).all()
    # one pair in ten at most reaches the score that one in a hundred has
    assert (high >= np.quantile(true, 0.99)).mean() < 0.1


def test_mislabelled(spark):
    rows = spark.createDataFrame([(7, 9), (0, 3), (8, 9), (14, None)], "i long, k int")
    assert [r[0] for r in rows.select(hn.mislabelled(F.col("i"), F.col("k"))).collect()] == [0, 4, 9, None]
