"""From raw documents to packed training windows, stage by stage.

Each stage takes (spark, docs, sf_dir); its rows are written to the shared folder and read again for the next one.
All stages but the last return the columns of documents. When a stage starts, the rows of the one before are written,
so the work tables of earlier stages are removed, unless its input still reads them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clubflow.llm import language_id, packing, quality, simhash_dedup, suffix_dedup
from clubflow.llm.common import documents, held_out, remove, stored, unused, work_tables
from clubflow.llm.minimiser import numbered

#: A text that no language is clearly nearest to is rejected, as is one without letters.
LANGUAGE_SCORE = 0.4

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Work tables of the stages so far.
_tables: list[str] = []


def _stage(work: Stage) -> Stage:
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _tables:
            read = "\n".join({f.rsplit("/", 1)[0] for f in docs.inputFiles()})
            gone = [t for t in _tables if t.rsplit("/", 1)[1] not in read]
            remove(spark, gone)
            _tables[:] = [t for t in _tables if t not in gone]
        with work_tables() as made:
            out = work(spark, docs, sf_dir)
        _tables.extend(made)
        return out

    return run_stage


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only what the classifier scores 0.5 or more; learned from the labelled rows among these documents."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only texts with a language; learned from the rows that are not held out."""
    profiles = language_id.learn(docs.where(~held_out("doc_id", 4, 2)))
    if not profiles:  # nothing to learn from, so nothing can be judged
        return docs
    said = language_id.language_of(profiles)(F.col("text"))
    return docs.where((said["lang"] != language_id.UNKNOWN) & (said["score"] >= LANGUAGE_SCORE))


@_stage
def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first by doc_id, of each group whose fingerprints chain within the operator's own distance."""
    place = unused(docs, "row_place")
    rows = numbered(docs, place)
    groups = simhash_dedup.near_duplicates(rows.select(F.col(place).alias("doc_id"), "text"))
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias(place))
    return rows.join(kept, place, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


@_stage
def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes that stand elsewhere too."""
    return suffix_dedup.without_repeats(docs)


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 4,096 tokens: one row per piece of a document."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("language id", language_stage),
    ("simhash near-dedup", simhash_stage),
    ("suffix-array dedup", suffix_stage),
    ("packing", packing_stage),
]

#: Learned stages have no SQL; the tests hold them against held-out rows and plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    last: list[str] = []
    for name, stage in STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        with work_tables() as made:
            docs = stored(found, name.replace(" ", "-"))
        remove(spark, last)
        last = made
    return STAGES[-1][1](spark, docs, sf_dir)
