"""Reading tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from clubflow.operators.ordered import first_rows


def scan_table(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """A Parquet table, only the named columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def latest(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Collapse row versions: the row with the highest version of each key."""
    return first_rows(df, keys, version, last=True)
