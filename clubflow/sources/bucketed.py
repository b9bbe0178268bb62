"""Row versions stored by key, so that collapsing them moves no row.

A table of versions is bucketed and sorted by its key. All versions of a key lie in one bucket, whatever load they came
with, so the newest of each key is found bucket by bucket without a shuffle; loads are laid out once, when they arrive.
For ``merged_versions`` keys are not null.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clubflow.session import new_table_path
from clubflow.sources.scan import latest


def create_versions(df: DataFrame, keys: Sequence[str], buckets: int, name: str = "versions") -> str:
    """Store rows as a new table bucketed by ``keys``; returns its name. The number of buckets stays for good."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    _write(df, keys, buckets).option("path", new_table_path(df.sparkSession, table)).saveAsTable(table)
    return table


def add_versions(df: DataFrame, table: str) -> None:
    """Append a load. Only its own rows are shuffled."""
    keys, buckets = layout(df.sparkSession, table)
    _write(df.select(*df.sparkSession.table(table).columns), keys, buckets).mode("append").saveAsTable(table)


def latest_versions(spark: SparkSession, table: str, version: Sequence[str]) -> DataFrame:
    """The row with the highest version of each key."""
    return latest(spark.table(table), layout(spark, table)[0], version)


def merged_versions(spark: SparkSession, base: str, changes: str, version: Sequence[str]) -> DataFrame:
    """The newest rows of a collapsed table and a table of later changes, both bucketed alike.

    A key has one row on each side, so this is one join of buckets. A change that is older than the base row is ignored.
    """
    keys, buckets = layout(spark, base)
    if layout(spark, changes) != (keys, buckets):
        raise ValueError(f"{base} and {changes} are not bucketed alike")
    columns = spark.table(base).columns
    old = spark.table(base).select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.struct(*columns).alias("_old"))
    new = latest_versions(spark, changes, version)
    new = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys], F.struct(*columns).alias("_new"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"_old_{k}") == F.col(f"_new_{k}"))
    newer = F.struct(*[F.col(f"_new.{v}") for v in version]) >= F.struct(*[F.col(f"_old.{v}") for v in version])
    row = F.when(F.col("_old").isNull() | (F.col("_new").isNotNull() & newer), F.col("_new")).otherwise(F.col("_old"))
    return old.join(new, same, "full").select(row.alias("row")).select("row.*")


def compacted(spark: SparkSession, table: str, version: Sequence[str], name: str = "versions") -> str:
    """A new table with the newest row of each key, laid out alike; readers of the old one are not disturbed."""
    keys, buckets = layout(spark, table)
    rows = latest_versions(spark, table, version)
    new = f"{name}_{uuid.uuid4().hex[:12]}"
    # the rows are in their buckets already
    writer = rows.select(*spark.table(table).columns).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    writer.option("path", new_table_path(spark, new)).saveAsTable(new)
    return new


def layout(spark: SparkSession, table: str) -> tuple[list[str], int]:
    """Key columns and number of buckets of a table."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return [c.strip(" `") for c in facts["Bucket Columns"].strip("[]").split(",")], int(facts["Num Buckets"])


def _write(df: DataFrame, keys: Sequence[str], buckets: int):
    # one task a bucket, so a load adds one file to each
    return df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
