"""Ordered operators: split keys give the same rows as a plain window and as brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clubflow.operators.ordered import (
    distinct_ranks,
    first_rows,
    group_values,
    lead_in_frame,
    neighbours,
    row_numbers,
    running,
    sessions,
)
from clubflow.operators.skew import (
    SEGMENT,
    add_sketches,
    measure,
    read_statistics,
    segmented,
    without_hot,
)


def make(spark, seed=1, n=120):
    """One key with a third of all rows, a NULL key, NULL order values and NULL values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "d", None])
        at = None if rng.random() < 0.1 else rng.randrange(40) ** 2
        value = None if rng.random() < 0.3 else rng.randrange(100)
        rows.append((i, key, at, value))
    return spark.createDataFrame(rows, "id long, k string, at long, v long"), rows


def brute(rows):
    """Rows by key in order, NULLs last, ties by id."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r[2] is None, r[2] or 0, r[0]))
    return groups


def result(df, *names):
    return {r["id"]: tuple(r[n] for n in names) for r in df.collect()}


@pytest.fixture(params=[None, 4, 10])
def limit(request):
    return request.param


def hot_of(df, limit):
    return None if limit is None else measure(df, {"k": ["k"]}, limit).of("k")


def test_neighbours(spark, limit):
    df, rows = make(spark)
    out = neighbours(df, ["k"], ["at", "id"], lag={"p": "v"}, lead={"n": "id"}, hot=hot_of(df, limit))
    assert set(out.columns) == {"id", "k", "at", "v", "p", "n"}
    want = {}
    for g in brute(rows).values():
        for i, r in enumerate(g):
            want[r[0]] = (g[i - 1][3] if i else None, g[i + 1][0] if i + 1 < len(g) else None)
    assert result(out, "p", "n") == want


def test_row_numbers(spark, limit):
    df, rows = make(spark, 2)
    out = row_numbers(df, ["k"], ["at", "id"], "rn", hot=hot_of(df, limit))
    want = {r[0]: (i + 1,) for g in brute(rows).values() for i, r in enumerate(g)}
    assert result(out, "rn") == want


def test_running(spark, limit):
    df, rows = make(spark, 3)
    kinds = ("sum", "count", "min", "max", "last", "first")
    out = running(df, ["k"], ["at", "id"], {k: (k, "v") for k in kinds}, hot=hot_of(df, limit))
    want = {}
    for g in brute(rows).values():
        seen = []
        for r in g:
            if r[3] is not None:
                seen.append(r[3])
            full = (sum(seen), len(seen), min(seen), max(seen), seen[-1], seen[0]) if seen else (None, 0, None, None, None, None)
            want[r[0]] = full
    assert result(out, *kinds) == want


def test_group_values_and_first_rows(spark):
    df, rows = make(spark, 4)
    out = group_values(df, ["k"], {"top": ("max", "v"), "n": ("count", "id")})
    groups = brute(rows)
    want = {}
    for g in groups.values():
        values = [r[3] for r in g if r[3] is not None]
        want |= {r[0]: (max(values), len(g)) for r in g}
    assert result(out, "top", "n") == want
    firsts = {r["k"]: r["id"] for r in first_rows(df, ["k"], ["at", "id"]).collect()}
    assert firsts == {k: g[0][0] for k, g in groups.items()}
    lasts = {r["k"]: r["id"] for r in first_rows(df, ["k"], ["at", "id"], last=True).collect()}
    assert lasts == {k: g[-1][0] for k, g in groups.items()}


def test_lead_in_frame_sees_peers_only(spark, limit):
    df, rows = make(spark, 5)
    out = lead_in_frame(df, ["k"], ["at"], {"peer": "id"}, tie=["id"], hot=hot_of(df, limit))
    want = {}
    for g in brute(rows).values():
        for i, r in enumerate(g):
            after = g[i + 1] if i + 1 < len(g) else None
            want[r[0]] = (after[0] if after and after[2] == r[2] else None,)
    assert result(out, "peer") == want
    assert set(out.columns) == {"id", "k", "at", "v", "peer"}


def test_dense_ranks(spark, limit):
    df, rows = make(spark, 6)
    df = df.where("k is not null and at is not null")
    out = distinct_ranks(df, ["k"], "at", "rnk", hot=hot_of(df, limit))
    want = {}
    for k, g in brute([r for r in rows if r[1] is not None and r[2] is not None]).items():
        order = sorted({r[2] for r in g})
        want |= {r[0]: (order.index(r[2]) + 1,) for r in g}
    assert result(out, "rnk") == want


@pytest.mark.parametrize("hot_limit", [None, 2])
def test_session_gap_boundary(spark, hot_limit):
    start = dt.datetime(2024, 1, 1)
    seconds = [0, 10_799, 21_598, 32_398, 32_398, 50_000]  # gaps 10799, 10799, 10800, 0, 17602
    df = spark.createDataFrame(
        [(i, "u", start + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)], "id long, k string, t timestamp_ntz"
    )
    hot = hot_of(df, hot_limit)
    out = sessions(df, ["k"], "t", ["id"], 10_800, hot=hot)
    assert [r["session_number"] for r in out.orderBy("id").collect()] == [1, 1, 1, 2, 2, 3]


def test_large_key_is_spread_over_segments(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("at")
    )
    hot = hot_of(df, 100)
    assert list(hot.rows.values()) == [1000] and [r["k"] for r in df.where(hot.has(["k"])).select("k").distinct().collect()] == ["hot"]
    cut = segmented(df, ["k"], ["at"], hot)
    sizes = [r["count"] for r in cut.groupBy(SEGMENT).count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 100 and sum(sizes) == 1000
    assert without_hot(df, ["k"], hot).count() == 2000
    # segments follow the order
    spans = cut.groupBy(SEGMENT).agg(F.min("at").alias("lo"), F.max("at").alias("hi")).orderBy(SEGMENT).collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("kind", ["outlier", "burst", "nulls"])
def test_segments_are_small_whatever_the_values(spark, kind):
    at = {
        "outlier": "CASE WHEN id = 7 THEN DATE'1970-01-01' ELSE date_add(DATE'2024-01-01', int(id % 9)) END",
        "burst": "CASE WHEN id % 50 = 0 THEN date_add(DATE'2024-01-01', int(id % 7)) ELSE DATE'2024-05-05' END",
        "nulls": "CASE WHEN id % 3 = 0 THEN date_add(DATE'2024-01-01', int(id % 7)) END",
    }[kind]
    df = spark.range(20_000).selectExpr("'one' AS k", f"{at} AS at", "id")
    cut = segmented(df, ["k"], ["at", "id"], hot_of(df, 1000))
    sizes = [r["count"] for r in cut.groupBy(SEGMENT).count().collect()]
    assert max(sizes) <= 1000 and sum(sizes) == 20_000
    out = row_numbers(df, ["k"], ["at", "id"], "rn", hot=hot_of(df, 1000))
    want = df.selectExpr("id", "row_number() OVER (PARTITION BY k ORDER BY at NULLS LAST, id) AS want")
    assert out.join(want, "id").where("rn <> want").count() == 0


def test_no_large_key_means_a_plain_window(spark):
    df, _ = make(spark, 7)
    assert hot_of(df, 1000) is None


def test_statistics_of_loads_add_up(spark, tmp_path):
    """Sketches are kept per load; a key that is large in their sum only is found, whatever its sets and types."""
    path = str(tmp_path / "statistics")
    sets = {"t.user": ["user"], "t.user_day": ["user", "to_date(at)"]}
    for load in range(3):
        rows = spark.range(400).selectExpr(
            "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN 7L ELSE id END AS user",
            f"TIMESTAMP_NTZ'2024-01-0{load + 1} 10:00:00' + INTERVAL 1 MINUTE * id AS at",
        )
        add_sketches(rows, sets, path)
    known = read_statistics(spark, path, 250)
    # NULL is a key like others
    assert sorted(known.of("t.user").rows.values()) == [300, 303] and known.of("t.user_day") is None
    assert len(read_statistics(spark, path, 90).of("t.user_day").rows) == 6
    # a union of two tables has the rows of both
    both = known | measure(rows, {"other.user": ["user"]}, 250)
    assert sorted(both.of("t.user", "other.user").rows.values()) == [400, 404] and both.of("other.user") is None
    assert known.of("never.measured") is None
    large = known.of("t.user")
    assert rows.where(large.has(["user"])).count() == 201 and without_hot(rows, ["user"], large).count() == 199


def test_an_empty_table_has_no_large_keys(spark):
    assert measure(spark.range(0), {"k": ["id"]}, 5).of("k") is None
