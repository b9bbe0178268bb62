"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of one key that a single task may hold before the key is split.
ROWS_PER_SEGMENT = "clubflow.rowsPerSegment"
DEFAULT_ROWS_PER_SEGMENT = 10_000_000


def build_session(app: str = "clubflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC clock and ANSI types."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings every plan relies on, for sessions built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def rows_per_segment(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_SEGMENT, str(DEFAULT_ROWS_PER_SEGMENT)))


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a scratch one only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", "") or sc.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", sc.master):  # one process: driver and executors see the same disk
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="clubflow-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def new_table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/clubflow/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """Write the rows once to the shared folder, as Parquet, and go on from there.

    Unlike a checkpoint, later steps read only the columns they need and know the table's size.
    """
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


materialize = stored
