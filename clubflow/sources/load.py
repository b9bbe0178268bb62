"""Load modes: how a computed table reaches its target.

Targets are published in one step (see ``published``): new files first, then a small manifest. They are partitioned
by a date or month column where a mode replaces part of the table. Rows are always matched by column name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clubflow.sources import published
from clubflow.sources.published import current, described, publish, write_load
from clubflow.sources.scan import latest


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The target table, or None before its first load."""
    manifest = current(spark, path)
    return None if manifest is None or manifest.schema is None else published.read(spark, path, manifest)


def _replace_all(df: DataFrame, path: str) -> None:
    base = current(df.sparkSession, path)
    made = write_load(df, path, base)
    new = described(base, df, None)
    publish(df.sparkSession, path, new.with_replaced({f: [] for f in new.loads} | {f: [made.name] for f in made.folders}))


def full_replace(df: DataFrame, path: str) -> None:
    """Replace all rows."""
    _replace_all(df, path)


def derived(
    spark: SparkSession, path: str, inputs: Mapping[str, str], build: Callable[[], DataFrame]
) -> DataFrame:
    """A mart that others read: the stored one if it was built from the inputs as they are, else built and stored.

    ``inputs`` gives the version of each table it is built from (``published.version_of``), and of the rules if they
    change. Versions are taken before the build, so an input that changes meanwhile makes the next call build again.
    """
    manifest = current(spark, path)
    if manifest is None or manifest.schema is None or manifest.inputs != dict(inputs):
        rows = build()
        made = write_load(rows, path, manifest)
        new = described(manifest, rows, None)
        new = new.with_replaced({f: [] for f in new.loads} | {f: [made.name] for f in made.folders})
        publish(spark, path, replace(new, inputs=dict(inputs)))
    return read_target(spark, path)


def create_as(df: DataFrame, path: str, sort: Sequence[str]) -> None:
    """Recreate the table with files range-sorted by its sort key.

    Range partitioning gives every file a narrow key range, so a reader that
    filters on the key skips most files by their min/max statistics.
    """
    _replace_all(df.repartitionByRange(*sort).sortWithinPartitions(*sort), path)


def watermark(spark: SparkSession, path: str, column: str) -> int:
    """Highest id in the target, 0 when it is empty.

    Appends keep it in the manifest; only after another kind of load the column is read.
    """
    manifest = current(spark, path)
    if manifest is None or manifest.schema is None:
        return 0
    if column in manifest.marks:
        return manifest.marks[column]
    top = published.read(spark, path, manifest).agg(F.max(column)).first()[0]
    return 0 if top is None else int(top)


def append(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Append all rows."""
    base = current(df.sparkSession, path)
    made = write_load(df, path, base, partition)
    new = described(base, df, partition)
    publish(df.sparkSession, path, new.with_replaced({f: [*new.loads.get(f, []), made.name] for f in made.folders}))


def append_above(df: DataFrame, path: str, column: str) -> int:
    """Append rows whose id is above the target's highest; returns the old watermark.

    The watermark is a literal, so the filter reaches the scan.
    """
    return append_computed(df.sparkSession, path, column, lambda above: df.where(F.col(column) > above))


def append_computed(
    spark: SparkSession, path: str, column: str, build: Callable[[int], DataFrame], partition: str | None = None
) -> int:
    """Append ``build(watermark)``, for marts that take the watermark themselves; the new one is taken while writing."""
    above = watermark(spark, path, column)
    base = current(spark, path)
    rows = build(above)
    made = write_load(rows, path, base, partition, (column,))
    new = described(base, rows, partition)
    marks = {column: max(above, int(made.tops[column] or 0))}
    publish(spark, path, new.with_replaced({f: [*new.loads.get(f, []), made.name] for f in made.folders}, marks))
    return above


def replace_range(
    df: DataFrame, path: str, column: str, lo, hi, partition: str, closed: bool = False, partitions: tuple | None = None
) -> None:
    """Replace target rows with ``lo <= column < hi`` (``<= hi`` if closed) by ``df``, in one step.

    ``partition`` is the target's partition column, a function of ``column``
    that ``df`` carries. Only partitions that hold rows of the range are
    rewritten; rows of theirs outside the range are kept. A partition left
    without rows is gone. ``partitions`` names the first and last partition
    value the range can touch, so that a reload opens no other partition of the
    target.
    """
    spark = df.sparkSession
    value = F.col(column)
    inside = (value >= F.lit(lo)) & ((value <= F.lit(hi)) if closed else (value < F.lit(hi)))
    base = current(spark, path)
    rows, held = df.where(inside), []
    if base is not None and base.schema is not None:
        target = published.read(spark, path, base)
        if partitions is not None:
            target = target.where(F.col(partition).between(F.lit(partitions[0]), F.lit(partitions[1])))
        # partitions of one load: they are written anew, with their rows outside the range
        held = [r[0] for r in target.where(inside).select(partition).distinct().collect()]
        if held:
            named = F.col(partition).isin([v for v in held if v is not None])
            if None in held:
                named = F.col(partition).isNull() | F.coalesce(named, F.lit(False))
            rows = rows.unionByName(target.where(named & ~F.coalesce(inside, F.lit(False))))
    made = write_load(rows, path, base, partition)
    new = described(base, rows, partition)
    touched = {partition_folder(partition, v) for v in held}
    parts = {f: [] for f in touched}
    parts |= {f: [made.name] if f in touched else [*new.loads.get(f, []), made.name] for f in made.folders}
    publish(spark, path, new.with_replaced(parts))


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace exactly the partitions present in ``df``."""
    base = current(df.sparkSession, path)
    made = write_load(df, path, base, partition)
    publish(df.sparkSession, path, described(base, df, partition).with_replaced({f: [made.name] for f in made.folders}))


def partition_folder(partition: str, value) -> str:
    """The folder of a partition value as Spark names it."""
    if value is None or value == "":
        return f"{partition}=__HIVE_DEFAULT_PARTITION__"
    # fixed values: the characters that partition folders escape
    special = set("\"#%'*/:=?\\{[]^") | {chr(i) for i in range(1, 32)} | {"\x7f"}
    return f"{partition}=" + "".join(f"%{ord(c):02X}" if c in special else c for c in str(value))


def months_to_reload(as_of: dt.date, grace_days: int = 2) -> list[dt.date]:
    """Starts of the months to reload: the current one, and the last one early in a month."""
    current = as_of.replace(day=1)
    previous = (current - dt.timedelta(days=1)).replace(day=1)
    return [previous, current] if as_of.day <= grace_days else [current]


def replace_months(
    build: Callable[[dt.date, dt.date], DataFrame], path: str, as_of: dt.date, month: str = "date"
) -> None:
    """Reload whole months: ``build(first_day, last_day)`` for each month due, published together.

    A month that the build leaves empty loses its old rows too.
    """
    parts: dict[str, list[str]] = {}
    for first in months_to_reload(as_of):
        following = (first + dt.timedelta(days=32)).replace(day=1)
        rows = build(first, min(as_of, following - dt.timedelta(days=1)))
        spark = rows.sparkSession
        if not parts:
            base = current(spark, path)
        made = write_load(rows, path, base, month)
        parts |= {partition_folder(month, first): []} | {f: [made.name] for f in made.folders}
    publish(spark, path, described(base, rows, month).with_replaced(parts))


def compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    version: Sequence[str],
    partition: str,
    partitions: Sequence,
) -> None:
    """Collapse row versions inside the named partitions."""
    base = current(spark, path)
    recent = published.read(spark, path, base).where(F.col(partition).isin(list(partitions)))
    rows = latest(recent, [partition, *keys], version)
    made = write_load(rows, path, base, partition)
    # highest keys stay the same
    marks = {c: top for c, top in base.marks.items() if c in keys}
    publish(spark, path, described(base, rows, partition).with_replaced({f: [made.name] for f in made.folders}, marks))


def loaded_rows(spark: SparkSession, path: str, column: str, above) -> DataFrame:
    """Number of rows loaded above a watermark (an id or a date), as one row ``loaded``."""
    kept = read_target(spark, path).where(F.col(column) > F.lit(above))
    return kept.agg(F.count(F.lit(1)).alias("loaded"))
