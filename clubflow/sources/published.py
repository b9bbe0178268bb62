"""Targets that change in one step.

A target is a folder of loads, ``path/[partition=value/]_load=name/*.parquet``. No load is ever changed. A manifest,
a small file in ``path/_manifests``, names the loads each partition consists of, the schema, and the highest ids seen
by appends. A job writes its new loads first and then the next manifest: a reader sees the table before or after, and
a job that dies in between leaves the old table. Two jobs that start from one manifest cannot both publish. ``vacuum``
removes loads that no kept manifest names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Folders of loads are named as values of this column.
LOAD = "_load"
_MANIFESTS = "_manifests"


class ConcurrentLoad(RuntimeError):
    """Another job published first; this one has to run again."""


@dataclass(frozen=True)
class Manifest:
    #: Of the file this was read from, 0 before the first load.
    number: int = 0
    #: Highest number in use, also by files that were never finished.
    taken: int = 0
    #: Columns as JSON, the partition column last.
    schema: dict | None = None
    partition: str | None = None
    #: Partition folder ('' for a table without partitions) -> its loads.
    loads: Mapping[str, list[str]] = field(default_factory=dict)
    #: Highest id per column, for targets that were only appended to.
    marks: Mapping[str, int] = field(default_factory=dict)
    #: For a table that was computed from others: their names and versions at that time.
    inputs: Mapping[str, str] = field(default_factory=dict)

    def with_replaced(self, parts: Mapping[str, list[str]], marks: Mapping[str, int] | None = None) -> Manifest:
        """Some partitions with other loads; those without loads are gone."""
        loads = {k: v for k, v in {**self.loads, **parts}.items() if v}
        return replace(self, loads=loads, marks=marks or {}, inputs={})


@dataclass(frozen=True)
class Load:
    name: str
    folders: list[str]
    rows: int
    #: Highest values of the columns asked for.
    tops: Mapping[str, int | None]


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The newest finished manifest; None before the first load."""
    fs, at = _fs(spark, f"{path}/{_MANIFESTS}")
    if not fs.exists(at):
        return None
    numbers = sorted((int(s.getPath().getName().removesuffix(".json")) for s in fs.listStatus(at)), reverse=True)
    for number in numbers:
        stream = fs.open(_path(spark, _file(path, number)))
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return Manifest(**json.loads(text), number=number, taken=numbers[0])
        except ValueError:  # its writer died
            continue
    return Manifest(taken=numbers[0]) if numbers else None


def _file(path: str, number: int) -> str:
    return f"{path}/{_MANIFESTS}/{number:010d}.json"


def publish(spark: SparkSession, path: str, new: Manifest) -> None:
    """Make the manifest the current one, if nobody else has published since it was read."""
    fs, at = _fs(spark, _file(path, new.taken + 1))
    parts = {"loads": dict(new.loads), "marks": dict(new.marks), "inputs": dict(new.inputs)}
    text = json.dumps({"schema": new.schema, "partition": new.partition} | parts)
    try:
        out = fs.create(at, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            raise ConcurrentLoad(path) from error
        raise
    out.write(text.encode())
    out.close()


def version_of(spark: SparkSession, path: str) -> str:
    """What a table is at present: the number of its manifest, or a hash of the names, sizes and times of plain files."""
    manifest = current(spark, path)
    if manifest is not None:
        return str(manifest.number)
    fs, at = _fs(spark, path)
    seen, files = [], fs.listFiles(at, True)
    while files.hasNext():
        status = files.next()
        seen.append(f"{status.getPath().getName()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def described(base: Manifest | None, df: DataFrame, partition: str | None) -> Manifest:
    """The manifest to go on from, with the columns of ``df``."""
    fields = [f for f in df.schema.fields if f.name != partition] + [f for f in df.schema.fields if f.name == partition]
    schema = StructType([StructField(f.name, f.dataType, True) for f in fields])
    return replace(base or Manifest(), schema=schema.jsonValue(), partition=partition)


def write_load(
    df: DataFrame, path: str, base: Manifest | None, partition: str | None = None, tops: tuple[str, ...] = (), rebalance: bool = True
) -> Load:
    """Write rows as a new load that no manifest names yet.

    The rebalance hint groups rows by partition value, merges small groups into one task and splits large ones, so file
    sizes follow the data. Rows and highest values are counted while they are written.
    """
    spark = df.sparkSession
    name = f"{(base.taken if base else 0) + 1:010d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.max(c).alias(f"top_{i}") for i, c in enumerate(tops)])
    if partition and rebalance:
        rows = rows.hint("rebalance", F.col(partition))
    writer = rows.withColumn(LOAD, F.lit(name)).write.mode("append")
    writer.partitionBy(*([partition] if partition else []), LOAD).parquet(path)
    fs, _ = _fs(spark, path)
    if partition:
        found = fs.globStatus(_path(spark, f"{path}/*/{LOAD}={name}")) or []
        folders = [s.getPath().getParent().getName() for s in found]
    else:
        folders = [""] if fs.exists(_path(spark, f"{path}/{LOAD}={name}")) else []
    try:
        counted = seen.get
    except Py4JJavaError:
        if folders:
            raise
        counted = dict.fromkeys((f"top_{i}" for i in range(len(tops))), None) | {"rows": 0}  # planned away as empty
    return Load(name, folders, counted["rows"], {c: counted[f"top_{i}"] for i, c in enumerate(tops)})


def read(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame:
    """The rows that a manifest names."""
    schema = StructType.fromJson(manifest.schema)
    folders = [f"{path}/{part}/{LOAD}={x}" if part else f"{path}/{LOAD}={x}" for part, own in manifest.loads.items() for x in own]
    if not folders:
        return spark.createDataFrame([], schema)
    whole = StructType([*schema.fields, StructField(LOAD, StringType())])
    return spark.read.option("basePath", path).schema(whole).parquet(*folders).drop(LOAD)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove loads that the newest ``keep`` manifests do not name, and older manifests; returns the loads removed.

    Loads of jobs that have not published yet carry a higher number and stay.
    """
    fs, at = _fs(spark, f"{path}/{_MANIFESTS}")
    now = current(spark, path)
    if now is None:
        return []
    numbers = sorted((int(s.getPath().getName().removesuffix(".json")) for s in fs.listStatus(at)), reverse=True)
    named: set[str] = set()
    kept = 0
    for number in numbers:
        if kept < keep:
            stream = fs.open(_path(spark, _file(path, number)))
            try:
                own = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            except ValueError:
                continue
            finally:
                stream.close()
            named |= {x for loads in own["loads"].values() for x in loads}
            kept += 1
        else:
            fs.delete(_path(spark, _file(path, number)), False)
    gone = []
    depth = "*/" if now.partition else ""
    for status in fs.globStatus(_path(spark, f"{path}/{depth}{LOAD}=*")) or []:
        name = status.getPath().getName().split("=", 1)[1]
        if name not in named and int(name.split("-")[0]) <= now.taken:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(set(gone))
