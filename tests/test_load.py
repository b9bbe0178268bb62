"""Load modes on small tables: repeated and partial loads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clubflow.sources import load, published
from clubflow.sources.scan import latest


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, day date, note string").withColumn("month", F.trunc("day", "MM"))


def content(spark, path):
    return sorted((r["id"], r["day"].isoformat(), r["note"]) for r in load.read_target(spark, path).collect())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "target")


def test_append_in_slices_equals_one_load(spark, path):
    assert load.watermark(spark, path, "id") == 0
    rows = table(spark, [(i, dt.date(2024, 1, i), "x") for i in range(1, 10)])
    for upto in (3, 3, 7, 9, 9):
        load.append_above(rows.where(F.col("id") <= upto), path, "id")
    assert content(spark, path) == [(i, f"2024-01-0{i}", "x") for i in range(1, 10)]
    assert load.watermark(spark, path, "id") == 9
    assert load.loaded_rows(spark, path, "id", 7).first()["loaded"] == 2


def test_append_computed_passes_the_watermark(spark, path):
    rows = table(spark, [(i, dt.date(2024, 1, i), "x") for i in range(1, 5)])
    seen = []

    def build(above):
        seen.append(above)
        return rows.where(F.col("id") > above)

    load.append_computed(spark, path, "id", build)
    load.append_computed(spark, path, "id", build)
    assert seen == [0, 4] and len(content(spark, path)) == 4


def test_replace_range_keeps_rows_outside(spark, path):
    old = table(spark, [(1, dt.date(2024, 1, 10), "old"), (2, dt.date(2024, 1, 20), "old"), (3, dt.date(2024, 2, 5), "old"), (4, dt.date(2024, 3, 1), "old")])
    load.replace_range(old, path, "day", dt.date(2000, 1, 1), dt.date(2030, 1, 1), "month")
    new = table(spark, [(9, dt.date(2024, 1, 25), "new"), (8, dt.date(2024, 1, 1), "outside the range")])
    for _ in range(2):
        load.replace_range(new, path, "day", dt.date(2024, 1, 15), dt.date(2024, 3, 1), "month")
    assert content(spark, path) == [(1, "2024-01-10", "old"), (4, "2024-03-01", "old"), (9, "2024-01-25", "new")]


def test_replace_range_can_include_its_end(spark, path):
    old = table(spark, [(4, dt.date(2024, 3, 1), "old")])
    load.replace_range(old, path, "day", dt.date(2000, 1, 1), dt.date(2030, 1, 1), "month")
    load.replace_range(old.where("false"), path, "day", dt.date(2024, 2, 1), dt.date(2024, 3, 1), "month", closed=True)
    assert load.read_target(spark, path) is None or content(spark, path) == []


def test_replace_months_reloads_last_month_early_in_a_month(spark, path):
    assert load.months_to_reload(dt.date(2024, 3, 2)) == [dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    assert load.months_to_reload(dt.date(2024, 3, 3)) == [dt.date(2024, 3, 1)]
    assert load.months_to_reload(dt.date(2024, 1, 1)) == [dt.date(2023, 12, 1), dt.date(2024, 1, 1)]
    calls = []

    def build(first, last):
        calls.append((first, last))
        return table(spark, [(1, first, "m"), (2, last, "m")])

    load.replace_months(build, path, dt.date(2024, 3, 2), "month")
    load.replace_months(build, path, dt.date(2024, 3, 2), "month")
    assert calls[:2] == [(dt.date(2024, 2, 1), dt.date(2024, 2, 29)), (dt.date(2024, 3, 1), dt.date(2024, 3, 2))]
    assert len(content(spark, path)) == 4


def test_full_replace_and_create_as(spark, path):
    rows = table(spark, [(i, dt.date(2024, 1, 1), "x") for i in range(20)])
    load.full_replace(rows, path)
    load.full_replace(rows.where("id < 5"), path)
    assert len(content(spark, path)) == 5
    load.create_as(rows, path, ["id"])
    assert len(content(spark, path)) == 20


def test_compact_only_named_partitions(spark, path):
    rows = table(spark, [(1, dt.date(2024, 1, 1), "a"), (1, dt.date(2024, 1, 2), "b"), (1, dt.date(2024, 2, 1), "a"), (1, dt.date(2024, 2, 2), "b")])
    load.overwrite_partitions(rows, path, "month")
    load.compact(spark, path, ["id"], ["day"], "month", [dt.date(2024, 2, 1)])
    assert content(spark, path) == [(1, "2024-01-01", "a"), (1, "2024-01-02", "b"), (1, "2024-02-02", "b")]


def test_latest_takes_whole_rows(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, "c")], "id long, version long, note string")
    assert sorted(tuple(r) for r in latest(df, ["id"], ["version"]).collect()) == [(1, 2, None), (2, 1, "c")]


def test_an_emptied_month_loses_its_rows(spark, path):
    rows = table(spark, [(1, dt.date(2024, 4, 3), "old"), (2, dt.date(2024, 5, 1), "old"), (3, dt.date(2024, 3, 9), "old")])
    load.overwrite_partitions(rows, path, "month")
    load.replace_months(lambda first, last: rows.where("id > 5"), path, dt.date(2024, 5, 2), "month")
    assert content(spark, path) == [(3, "2024-03-09", "old")]


def test_partition_folders_are_named_as_spark_names_them(spark, path):
    import os

    values = ["a b", "x:y", "50%", "p=q", "é", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, part string")
    load.overwrite_partitions(df, path, "part")
    assert {load.partition_folder("part", v) for v in values} == {f for f in os.listdir(path) if f.startswith("part=")}


class Stopped(Exception):
    pass


@pytest.fixture
def stop_before_publishing(monkeypatch):
    """A job that dies after its files are written."""

    def run(work):
        def die(*_):
            raise Stopped

        with monkeypatch.context() as m:
            m.setattr(load, "publish", die)
            with pytest.raises(Stopped):
                work()

    return run


def test_a_load_that_dies_leaves_the_old_table(spark, path, stop_before_publishing):
    rows = table(spark, [(i, dt.date(2024, 1 + i % 4, 1 + i), "old") for i in range(1, 12)])
    load.overwrite_partitions(rows, path, "month")
    before = content(spark, path)
    held = load.read_target(spark, path)
    new = rows.withColumn("note", F.lit("new"))
    jobs = [
        lambda: load.replace_range(new, path, "day", dt.date(2024, 1, 1), dt.date(2024, 3, 1), "month"),
        lambda: load.overwrite_partitions(new, path, "month"),
        lambda: load.replace_months(lambda a, b: new.where(F.col("day").between(F.lit(a), F.lit(b))), path, dt.date(2024, 4, 1), "month"),
        lambda: load.full_replace(new, path),
        lambda: load.compact(spark, path, ["note"], ["id"], "month", [dt.date(2024, 2, 1)]),
        lambda: load.append_above(new, path, "id"),
    ]
    for job in jobs:
        stop_before_publishing(job)
        assert content(spark, path) == before
    jobs[0]()
    assert {n for _, d, n in content(spark, path) if d < "2024-03-01"} == {"new"}
    assert len(content(spark, path)) == len(before)
    # who read the table before still can
    assert sorted((r["id"], r["day"].isoformat(), r["note"]) for r in held.collect()) == before


def test_a_manifest_cut_short_is_not_read_and_its_number_not_used_again(spark, path, tmp_path):
    rows = table(spark, [(1, dt.date(2024, 1, 1), "a")])
    load.append_above(rows, path, "id")
    (tmp_path / "target" / "_manifests" / "0000000002.json").write_text('{"schema": {"fie')
    assert content(spark, path) == [(1, "2024-01-01", "a")]
    load.append_above(rows.withColumn("id", F.col("id") + 1), path, "id")
    assert [i for i, _, _ in content(spark, path)] == [1, 2]
    assert published.current(spark, path).number == 3


def test_two_jobs_from_one_manifest_do_not_both_publish(spark, path):
    rows = table(spark, [(1, dt.date(2024, 1, 1), "a")])
    load.append_above(rows, path, "id")
    base = published.current(spark, path)
    made = published.write_load(rows, path, base)
    load.append_above(rows.withColumn("id", F.col("id") + 1), path, "id")
    with pytest.raises(published.ConcurrentLoad):
        published.publish(spark, path, published.described(base, rows, None).with_replaced({"": [made.name]}))
    assert len(content(spark, path)) == 2


def test_the_watermark_needs_no_scan(spark, path, tmp_path):
    rows = table(spark, [(i, dt.date(2024, 1, 1), "a") for i in range(1, 30)])
    load.append_above(rows.where("id < 20"), path, "id")
    for file in (tmp_path / "target").glob("_load=*/*.parquet"):
        file.write_bytes(b"")  # unreadable: nothing opens it
    assert load.watermark(spark, path, "id") == 19
    assert load.append_above(rows, path, "id") == 19
    assert load.watermark(spark, path, "id") == 29
    # a load that finds nothing keeps it
    assert load.append_above(rows, path, "id") == 29 and load.watermark(spark, path, "id") == 29


def test_vacuum_removes_what_no_kept_manifest_names(spark, path, stop_before_publishing):
    rows = table(spark, [(i, dt.date(2024, 1 + i % 3, 1), "x") for i in range(9)])
    for n in range(4):
        load.overwrite_partitions(rows.withColumn("note", F.lit(f"load {n}")), path, "month")
    stop_before_publishing(lambda: load.overwrite_partitions(rows, path, "month"))
    before = content(spark, path)
    gone = published.vacuum(spark, path)
    assert [g.split("-")[0] for g in gone] == ["0000000001", "0000000002"]
    assert content(spark, path) == before and published.vacuum(spark, path) == []
    load.overwrite_partitions(rows, path, "month")
    # now the load that died is older than the newest manifest
    assert "0000000005" in {g.split("-")[0] for g in published.vacuum(spark, path, keep=1)}
    assert len(content(spark, path)) == 9


def test_an_emptied_partition_is_gone_and_the_last_one_leaves_an_empty_table(spark, path):
    rows = table(spark, [(1, dt.date(2024, 1, 5), "a"), (2, dt.date(2024, 2, 5), "b")])
    load.overwrite_partitions(rows, path, "month")
    load.replace_range(rows.where("false"), path, "day", dt.date(2024, 1, 1), dt.date(2024, 2, 1), "month")
    assert list(published.current(spark, path).loads) == ["month=2024-02-01"]
    load.replace_range(rows.where("id > 9"), path, "day", dt.date(2024, 2, 1), dt.date(2024, 3, 1), "month")
    empty = load.read_target(spark, path)
    assert empty.count() == 0 and empty.columns == ["id", "day", "note", "month"]


def test_partitions_outside_the_range_are_not_written_again(spark, path, tmp_path):
    rows = table(spark, [(i, dt.date(2024, m, 10), "old") for i, m in enumerate(range(1, 7))])
    load.overwrite_partitions(rows, path, "month")
    new = table(spark, [(90, dt.date(2024, 2, 20), "new"), (91, dt.date(2024, 3, 1), "new")])
    load.replace_range(new, path, "day", dt.date(2024, 2, 15), dt.date(2024, 3, 5), "month")
    # no old row lay in the range: both partitions gain a load and keep the one they had
    assert {f: len(x) for f, x in published.current(spark, path).loads.items()} == {f"month=2024-0{m}-01": 1 + (m in (2, 3)) for m in range(1, 7)}
    assert len(content(spark, path)) == 8


def test_null_and_odd_partition_values(spark, path):
    values = ["a b", "x:y", "50%", "p=q", "é", "[x]*?{y}", None]
    df = spark.createDataFrame([(i, v, i) for i, v in enumerate(values)], "id long, part string, at int")
    load.overwrite_partitions(df, path, "part")
    assert {r["part"] for r in load.read_target(spark, path).collect()} == set(values)
    load.replace_range(df.withColumn("id", F.col("id") + 100), path, "at", 2, 99, "part")
    got = {r["id"]: r["part"] for r in load.read_target(spark, path).collect()}
    assert got == {i + 100 * (i >= 2): v for i, v in enumerate(values)}


def test_a_derived_table_is_built_again_only_when_an_input_changed(spark, path, tmp_path):
    plain, target = str(tmp_path / "plain"), str(tmp_path / "published")
    rows = table(spark, [(1, dt.date(2024, 1, 1), "a")])
    rows.write.parquet(plain)
    load.append(rows, target)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(plain).union(load.read_target(spark, target))

    def now(**more):
        inputs = {p: published.version_of(spark, p) for p in (plain, target)} | more
        return load.derived(spark, path, inputs, build).count()

    assert (now(), now(), len(built)) == (2, 2, 1)
    rows.write.mode("append").parquet(plain)
    assert (now(), now(), len(built)) == (3, 3, 2)
    load.append(rows, target)
    assert (now(), len(built)) == (4, 3)
    assert (now(rules="2"), now(rules="2"), len(built)) == (4, 4, 4)


def test_an_input_that_changes_during_the_build_makes_the_next_call_build_again(spark, path, tmp_path):
    plain = str(tmp_path / "plain")
    rows = table(spark, [(1, dt.date(2024, 1, 1), "a")])
    rows.write.parquet(plain)
    inputs = {"plain": published.version_of(spark, plain)}
    load.derived(spark, path, inputs, lambda: spark.read.parquet(plain))
    rows.write.mode("append").parquet(plain)
    again = {"plain": published.version_of(spark, plain)}
    assert again != inputs and load.derived(spark, path, again, lambda: spark.read.parquet(plain)).count() == 2
