"""Interval joins against brute force."""

import datetime as dt
import random

import pytest

from clubflow.operators.intervals import inside_any, max_over_covering
from clubflow.operators.skew import measure

EPOCH = dt.date(1970, 1, 1)


def day(n):
    return EPOCH + dt.timedelta(days=n)


@pytest.mark.parametrize("seed", [1, 2])
def test_max_over_covering(spark, seed):
    rng = random.Random(seed)
    points = [(i, rng.choice("abh"), rng.choice([0, 65535, 19000]) if i % 9 == 0 else rng.randrange(18900, 19200)) for i in range(60)]
    spans = []
    for i in range(40):
        lo = rng.choice([0, 18000, rng.randrange(18900, 19200)])
        hi = lo + rng.choice([-1, 0, 1, 30, 400, 47000])
        spans.append((rng.choice("abh"), lo, min(hi, 65535), i, rng.choice(["x", "y", None])))
    p = spark.createDataFrame([(i, k, day(d)) for i, k, d in points], "id long, k string, d date")
    s = spark.createDataFrame([(k, day(a), day(b), v, w) for k, a, b, v, w in spans], "k string, a date, b date, v long, w string")
    got = {
        r["id"]: (r["v1"], r["w1"])
        for r in max_over_covering(p, s, ["k"], "d", "a", "b", {"v1": "v", "w1": "w"}).collect()
    }
    want = {}
    for i, k, d in points:
        hits = [(v, w) for kk, a, b, v, w in spans if kk == k and a <= d <= b]
        texts = [w for _, w in hits if w is not None]
        want[i] = (max((v for v, _ in hits), default=None), max(texts, default=None))
    assert got == want


def test_days_far_from_the_epoch_do_not_meet(spark):
    rng = random.Random(9)
    points = [(i, "a", rng.randrange(-25_600, 120_600)) for i in range(80)] + [(80, "a", -719_162), (81, "a", 2_932_896)]
    spans = [(lo, lo + rng.choice([0, 1, 700, 9_000]), i) for i, lo in enumerate(rng.randrange(-25_600, 120_000) for _ in range(60))]
    spans += [(-3654, -2000, 60), (65_750, 69_500, 61), (2_932_800, 2_932_896, 62), (-719_162, -719_000, 63)]
    p = spark.createDataFrame([(i, k, day(d)) for i, k, d in points], "id long, k string, d date")
    s = spark.createDataFrame([("a", day(a), day(b), v) for a, b, v in spans], "k string, a date, b date, v long")
    got = {r["id"]: r["w"] for r in max_over_covering(p, s, ["k"], "d", "a", "b", {"w": "v"}).collect()}
    assert got == {i: max((v for a, b, v in spans if a <= d <= b), default=None) for i, _, d in points}


@pytest.mark.parametrize("limit", [None, 4])
def test_inside_any(spark, limit):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    at = lambda m: start + dt.timedelta(minutes=m)
    points = [(i, rng.choice("ab"), rng.randrange(300)) for i in range(50)]
    spans = [(rng.choice("ab"), lo, lo + rng.choice([0, 3, 20])) for lo in (rng.randrange(300) for _ in range(12))]
    p = spark.createDataFrame([(i, k, at(m)) for i, k, m in points], "id long, k string, t timestamp_ntz")
    s = spark.createDataFrame(
        [(k, at(a), at(b)) for k, a, b in spans] + [("a", at(0), None), ("a", None, at(400))],
        "k string, lo timestamp_ntz, hi timestamp_ntz",
    )
    hot = None
    if limit:
        hot = (measure(p, {"points": ["k"]}, limit) | measure(s, {"spans": ["k"]}, limit)).of("points", "spans")
    got = {r["id"] for r in inside_any(p, s, ["k"], "t", "lo", "hi", "id", hot=hot).collect()}
    assert got == {i for i, k, m in points if any(kk == k and a <= m <= b for kk, a, b in spans)}
