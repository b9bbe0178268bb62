"""Row versions by bucket: the newest rows, and no exchange on the way."""

import random

import pytest
from pyspark.sql import functions as F

from clubflow.sources import bucketed


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def newest(rows):
    best = {}
    for r in rows:
        if r[0] not in best or r[1:3] >= best[r[0]][1:3]:
            best[r[0]] = r
    return sorted(best.values(), key=str)


@pytest.fixture
def rows():
    rng = random.Random(3)
    out = [(rng.choice([None, *range(40)]), v // 2, v, f"note {v}" if v % 5 else None) for v in range(400)]
    rng.shuffle(out)
    return out


KINDS = "id long, version long, at long, note string"


def test_latest_of_several_loads_without_an_exchange(spark, rows):
    table = bucketed.create_versions(spark.createDataFrame(rows[:150], KINDS), ["id"], 4)
    bucketed.add_versions(spark.createDataFrame(rows[150:], KINDS).select("note", "at", "version", "id"), table)
    assert bucketed.layout(spark, table) == (["id"], 4)
    found = bucketed.latest_versions(spark, table, ["version", "at"])
    assert sorted(map(tuple, found.collect()), key=str) == newest(rows)
    assert "Exchange" not in plan_of(found)


def test_merging_changes_is_a_join_of_buckets(spark, rows):
    rows = [r for r in rows if r[0] is not None]
    base = bucketed.create_versions(spark.createDataFrame(rows[:200], KINDS), ["id"], 4)
    small = bucketed.compacted(spark, base, ["version", "at"])
    assert spark.table(small).count() == len(newest(rows[:200])) and bucketed.layout(spark, small) == (["id"], 4)
    changes = bucketed.create_versions(spark.createDataFrame([*rows[200:], (99, 1, 1, "new key")], KINDS), ["id"], 4)
    merged = bucketed.merged_versions(spark, small, changes, ["version", "at"])
    assert sorted(map(tuple, merged.collect()), key=str) == newest([*rows, (99, 1, 1, "new key")])
    plan = plan_of(merged)
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and "SortMergeJoin" in plan


def test_compacting_moves_no_row(spark, rows):
    table = bucketed.create_versions(spark.createDataFrame(rows, KINDS), ["id"], 4)
    files = spark.table(bucketed.compacted(spark, table, ["version", "at"])).select(F.input_file_name()).distinct().count()
    assert files <= 4


def test_tables_bucketed_otherwise_are_not_merged(spark, rows):
    one = bucketed.create_versions(spark.createDataFrame(rows, KINDS), ["id"], 4)
    other = bucketed.create_versions(spark.createDataFrame(rows, KINDS), ["id"], 3)
    with pytest.raises(ValueError):
        bucketed.merged_versions(spark, one, other, ["version"])
