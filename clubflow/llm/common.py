"""What several operators share: inputs, work tables, batches and link components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a Python worker works on at a time.
SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, whatever else the table has; ids as long."""
    return df.select(*[F.col(f"`{c}`").cast("long").alias(c) if c.endswith("_id") else F.col(f"`{c}`") for c in columns])


def unused(df: DataFrame, name: str) -> str:
    """A name that no column of the table has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def work_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of its own only where that is unset and Spark is local."""
    from clubflow.session import shared_dir

    return shared_dir(spark).rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows once to the shared folder and go on from there: short lineage, safe against lost executors."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for made in _scopes:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


_scopes: list[list[str]] = []


@contextmanager
def work_tables() -> Iterator[list[str]]:
    """The paths of the tables that are stored meanwhile."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes[:] = [s for s in _scopes if s is not made]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        at = hadoop(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose text is about ``limit`` bytes (one longer text makes a batch of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after the other, and where each row starts (one more: the end). Null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the runs [start, start + length), one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a fixed bijection)."""
    h = h.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling; one result per complete window."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component for links (a, b) among nodes 0..n-1."""
    label = np.arange(n, dtype=np.int64)
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            break
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label


def _edges(a: Column, b: Column) -> list[Column]:
    return [a.alias("a"), b.alias("b")]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of the links (a, b) of type long.

    Alternates large-star and small-star steps: every step is one grouped minimum and one join, so no task
    and no driver ever holds a component. Each round is written to the shared folder, and the one before it removed. Nodes without a link to
    another node do not appear. Raises when the links still change after ``rounds``.
    """
    spark = edges.sparkSession
    with work_tables() as made:
        links = stored(
            edges.where("a <> b").select(*_edges(F.greatest("a", "b"), F.least("a", "b"))).distinct(), "links"
        )
    seen = None
    for _ in range(rounds):
        both = links.unionAll(links.select(*_edges(F.col("b"), F.col("a"))))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(*_edges(F.col("b"), F.col("m"))).where("a <> b").distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(*_edges(F.col("b"), F.col("m"))),
                    F.struct(*_edges(F.col("a"), F.col("m"))),
                )
            ).alias("e")
        )
        before = made
        with work_tables() as made:
            links = stored(small.select("e.a", "e.b").where("a <> b").distinct(), "links")
        remove(spark, before)
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def held_out(column: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).cast("binary")) % parts == part


def schema_of(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)
