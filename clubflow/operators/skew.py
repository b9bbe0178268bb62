"""Find keys that are too large for one task and cut them into ordered segments.

A window needs all rows of its partition in one task. Adaptive execution does
not split such partitions, so one key with a third of the table would stall the
job. Large keys are known before a plan is built: a frequent-items sketch of a
table, for all its sets of keys in one pass and without a shuffle, is kept beside
the table, one row per load, and merged when it is read. Plans are given the keys
above the limit as plain numbers, so building a plan starts no job.

Large keys are cut by rank: their rows are range-partitioned by key and the whole
ordering, so the sizes of the parts follow the number of rows, not the span of the
values. The window then runs per (key, segment) and only one summary row per
segment is exchanged between segments.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clubflow.session import rows_per_segment, stored

#: Helper columns start with this prefix and are dropped again.
SEGMENT = "_segment"
#: Keys a sketch follows. Up to three quarters of so many distinct keys are counted exactly; beyond, no key with more
#: than rows / 75,000 is missed and counts are upper bounds.
TRACKED = 100_000
#: A key counts as large in the sum of so many tables at most.
TABLES_ADDED = 4


def key_hash(keys: Sequence[str | Column]) -> Column:
    """What a key is known by. Two keys with one hash are treated alike, which costs time only."""
    return F.xxhash64(*keys)


@dataclass(frozen=True)
class LargeKeys:
    """Keys with more rows than one task should hold: hash -> rows, at most rows of the table / limit of them."""

    rows: Mapping[int, int]
    limit: int

    def has(self, keys: Sequence[str]) -> Column:
        return key_hash(keys).isin(*self.rows)

    def segments(self) -> int:
        """Parts planned: four per limit, as their bounds come from a sample."""
        return sum(-(-4 * n // self.limit) for n in self.rows.values())


@dataclass(frozen=True)
class KeyStatistics:
    """What is known of the keys of some tables, by the name of the set of keys."""

    rows: Mapping[str, Mapping[int, int]] = field(default_factory=dict)
    limit: int = 0

    def of(self, *names: str) -> LargeKeys | None:
        """The large keys of one set, or of the union of several tables' rows; None if there are none."""
        total: Counter[int] = Counter()
        for name in names:
            total.update(self.rows.get(name, {}))
        large = {k: n for k, n in total.items() if n > self.limit}
        return LargeKeys(large, self.limit) if large else None

    def __or__(self, other: KeyStatistics) -> KeyStatistics:
        return KeyStatistics({**self.rows, **other.rows}, max(self.limit, other.limit))


#: Nothing is known, so every key is taken to fit into a task.
NO_STATISTICS = KeyStatistics()


def sketches(df: DataFrame, sets: Mapping[str, Sequence[str | Column]]) -> DataFrame:
    """Rows (name, sketch) of all sets of keys of a table, in one pass; ``sets`` maps names to expressions."""
    hashed = df.select(
        *[key_hash([F.expr(k) if isinstance(k, str) else k for k in keys]).alias(f"k{i}") for i, keys in enumerate(sets.values())]
    )
    one = hashed.agg(*[F.expr(f"approx_top_k_accumulate(k{i}, {TRACKED})").alias(f"s{i}") for i in range(len(sets))])
    named = [F.struct(F.lit(name).alias("name"), F.col(f"s{i}").alias("sketch")) for i, name in enumerate(sets)]
    return one.select(F.explode(F.array(*named)).alias("r")).select("r.name", "r.sketch")


def add_sketches(df: DataFrame, sets: Mapping[str, Sequence[str | Column]], path: str) -> None:
    """Keep the sketches of newly loaded rows beside their table."""
    sketches(df, sets).coalesce(1).write.mode("append").parquet(path)


def statistics(found: DataFrame, limit: int | None = None) -> KeyStatistics:
    """Large keys from rows (name, sketch), those of one name merged."""
    limit = limit or rows_per_segment(found.sparkSession)
    merged = found.groupBy("name").agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"))
    counted = merged.select("name", F.explode(F.expr(f"approx_top_k_estimate(sketch, {TRACKED})")).alias("k"))
    # fewer than TABLES_ADDED * rows / limit keys of a set
    kept = counted.where(F.col("k.count") > limit // TABLES_ADDED).select("name", "k.item", "k.count").collect()
    rows: dict[str, dict[int, int]] = {}
    for name, item, count in kept:
        rows.setdefault(name, {})[item] = count
    return KeyStatistics(rows, limit)


def read_statistics(spark: SparkSession, path: str, limit: int | None = None) -> KeyStatistics:
    """The statistics kept beside a table by ``add_sketches``."""
    return statistics(spark.read.parquet(path), limit)


def measure(df: DataFrame, sets: Mapping[str, Sequence[str | Column]], limit: int | None = None) -> KeyStatistics:
    """Statistics of a table that keeps none."""
    return statistics(sketches(df, sets), limit)


def without_hot(df: DataFrame, keys: Sequence[str], hot: LargeKeys) -> DataFrame:
    """Rows of the ordinary keys."""
    return df.where(~hot.has(keys))


def segmented(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: LargeKeys) -> DataFrame:
    """Rows of the hot keys with ``_segment``, a number that grows along the order inside each key.

    The bounds are quantiles of (keys, whole ordering), so outliers, bursts, ties of the first
    ordering column and NULLs do not make a part larger. The sample behind them decides sizes
    only, never rows. The rows are read several times (rows and summaries), so they are written once.
    """
    laid_out = df.where(hot.has(keys)).repartitionByRange(
        max(hot.segments(), 1), *[F.col(k) for k in keys], *[F.col(c).asc_nulls_last() for c in order]
    )
    return stored(laid_out.withColumn(SEGMENT, F.spark_partition_id().cast("long")), "segments")


def attach(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join one summary row to every row of its (key, segment)."""
    right = summary.select(
        *[
            F.col(c).alias(f"_segment_of_{c}") if c in (*keys, SEGMENT) else F.col(c)
            for c in summary.columns
        ]
    )
    same = F.col(SEGMENT) == F.col(f"_segment_of_{SEGMENT}")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_segment_of_{k}"))
    return rows.join(right, same, "left").drop(*[f"_segment_of_{k}" for k in (*keys, SEGMENT)])
