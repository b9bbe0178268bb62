"""An index of receipts by the transaction they belong to.

Counts of receipts per transaction and fiscal status, partitioned by ranges of transaction ids. Ids grow, so an hourly
batch of receipts and an hourly batch of ledger rows touch the newest ranges, and no batch opens the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clubflow.plans.money import receipt_counts
from clubflow.session import stored
from clubflow.sources import load, published

RANGE = "id_range"
#: Transaction ids of one range.
RANGE_IDS = 1_000_000


def _range(transaction_id: Column, width: int) -> Column:
    return F.floor(transaction_id / width).cast("long")


def _ranges(ids: DataFrame) -> list[int]:
    """The distinct ranges of a batch, as many as partitions at most."""
    return [r[0] for r in ids.select(RANGE).distinct().collect()]


def add_receipts(spark: SparkSession, path: str, receipts: DataFrame, width: int = RANGE_IDS) -> None:
    """Count new receipts into the index, in one step; each receipt's number is parsed once, when it arrives.

    Receipts without a transaction id belong to no ledger row and are left out.
    """
    new = receipt_counts(receipts).where(F.col("id_transaction").isNotNull())
    new = stored(new.withColumn(RANGE, _range(F.col("id_transaction"), width)), "receipts")
    base = published.current(spark, path)
    if base is not None and base.schema is not None:
        old = published.read(spark, path, base).where(F.col(RANGE).isin(_ranges(new)))
        new = (
            new.unionByName(old)
            .groupBy(RANGE, "id_transaction", "fiscal_status")
            .agg(F.sum("cnt_receips").alias("cnt_receips"))
        )
    load.overwrite_partitions(new, path, RANGE)


def receipts_of(spark: SparkSession, path: str, ids: DataFrame, width: int = RANGE_IDS) -> DataFrame:
    """Counts for (at least) the transactions of ``ids``, its first column; only their ranges are read."""
    name = ids.columns[0]
    wanted = _ranges(ids.where(F.col(name).isNotNull()).select(_range(F.col(name), width).alias(RANGE)))
    # the ranges are literals, so they choose partitions when the scan is planned
    return load.read_target(spark, path).where(F.col(RANGE).isin(wanted)).drop(RANGE)
