"""Mixing sources to target weights with hash-threshold histograms.

Every source has a weight and shares the words of all documents by it; a source never gives more than ``most`` times
its own words, and what it cannot give is shared again by weight among the others. A document is taken whole as often
as its source's target holds the whole source; the rest of the target is filled with the documents whose hash lies
below a threshold. The threshold comes from a histogram of words by source and hash bucket: the bucket that holds the
budget is found by a running sum over at most 4,096 buckets, and only the rows of that bucket are counted again, by the
next bits, until it holds one document. That document (or the rows of one hash) gives the words still missing. Rows are
compared with the threshold, never sorted, and nothing but two sums comes to the driver.

All work is in built-in functions. Null text has no words; a null source is a source of its own, the last one. Equal
rows have one hash: at the threshold they share the missing words in proportion. Documents without words are taken
with 0 words. An empty table gives no rows, a source without words the target 0. Other columns are not read by
``mix`` and are kept by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clubflow.llm.common import stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: A source gives at most so many times its words.
MOST = 3
#: Bits of the hash, and bits by which a histogram tells buckets apart.
HASH_BITS, BUCKET_BITS = 60, 12
#: What stands between words.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_WORD_AND_BLANKS = r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"


def word_count(text: Column) -> Column:
    """Words of a text (null: 0): each with the blanks behind it becomes one letter, so no list of words is built."""
    return F.coalesce(F.length(F.regexp_replace(F.ltrim(text, F.lit(BLANKS)), _WORD_AND_BLANKS, "x")), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """A number of ``HASH_BITS`` bits from id and text."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _measured(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        document_hash(F.col("doc_id"), F.col("text")).alias("hash"),
        *more,
    )


def _whole(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target) for rows (source, source_size), one a source.

    Each round caps the sources whose share is above ``most`` times their size and shares the rest by weight; shares
    only grow, so the rounds end when none is above. A round is one sum over the sources.
    """
    # numbers in code point order: by parts, so that no task holds all sources
    order = F.col("source").asc_nulls_last()
    laid = stored(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    offsets = laid.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("before")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = stored(
        laid.join(offsets.select("part", before.alias("before")), "part").select(
            "source", "source_size", weight.cast("long").alias("weight")
        ),
        "weights",
    )
    row = weighed.agg(F.sum(_whole(F.col("source_size"))), F.sum("weight")).first()
    total, by = row if row[1] else (0, 1)
    share, most_size = total, F.col("source_size") * most
    while True:
        above = _whole(most_size) * F.lit(by).cast("decimal(38,0)") < F.lit(share).cast("decimal(38,0)") * F.col("weight")
        row = weighed.agg(F.sum(F.when(above, _whole(most_size)).otherwise(F.lit(0))), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if not row[1] or (total - row[0], row[1]) == (share, by):
            break
        share, by = total - row[0], row[1]
    target = F.when(above, most_size.cast("double")).otherwise(
        (F.lit(int(share)) * F.col("weight")).cast("double") / F.lit(float(by))
    )
    return weighed.withColumn("target", target)


def thresholds(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """(source, low, high, wanted, amount) for rows (source, size, hash) and needs (source, need), need below the source's size.

    Documents with a hash below ``low`` are within the need; those from ``low`` to below ``high`` hold ``amount``
    words, of which ``wanted`` are still wanted.
    """
    found = None
    # what is still open: the rows of the boundary bucket, and the words wanted of it
    edge = needs.select(F.col("source").alias("of"), F.col("need").alias("wanted"))
    # in place of a prefix before the first level
    open_rows, prefix = rows.select("source", "size", "hash"), None
    for shift in range(HASH_BITS - BUCKET_BITS, -1, -BUCKET_BITS):
        same = F.col("source").eqNullSafe(F.col("of"))
        if prefix is not None:
            same = same & (F.shiftright("hash", shift + BUCKET_BITS) == F.col(prefix))
        inside = open_rows.join(edge, same).select("source", "size", "hash", "wanted")
        if prefix is not None:
            inside = open_rows = stored(inside, "edge")
            open_rows = open_rows.drop("wanted")
        counted = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(
            F.first("wanted").alias("wanted"), F.sum("size").alias("amount"), F.count("*").alias("n")
        )
        upto = F.sum("amount").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        hit = stored(
            counted.withColumn("upto", upto)
            .where("upto - amount <= wanted AND wanted < upto")
            .select("source", "bucket", (F.col("wanted") - F.col("upto") + F.col("amount")).alias("wanted"), "amount", "n"),
            "bucket",
        )
        settled = hit if not shift else hit.where("n = 1 OR wanted = 0")
        low = F.shiftleft("bucket", shift)
        out = settled.select("source", low.alias("low"), (low + (1 << shift)).alias("high"), "wanted", "amount")
        found = out if found is None else found.unionAll(out)
        edge = hit.where("n > 1 AND wanted > 0").select(F.col("source").alias("of"), F.col("bucket").alias("at"), "wanted")
        prefix = "at"
        if not shift or not edge.limit(1).count():
            break
    return found


def limits(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, times, low, high, wanted, amount) for measured rows: all that a row is compared with."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = F.floor(F.col("target") + 0.5).cast("long")
    planned = stored(
        targets(sizes, weights, most).withColumn("goal", goal).withColumn(
            "times", F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(F.lit(0)).cast("long")
        ),
        "targets",
    )
    needs = planned.select("source", (F.col("goal") - F.col("times") * F.col("source_size")).alias("need")).where("need > 0")
    edge = thresholds(rows, needs).withColumnRenamed("source", "of")
    return stored(
        planned.join(edge, F.col("source").eqNullSafe(F.col("of")), "left").select(
            "source", "source_size", "target", "times", "low", "high", "wanted", "amount"
        ),
        "limits",
    )


def _taken() -> Column:
    """Words taken of a row that stands beside its source's limits."""
    more = (
        F.when(F.col("hash") < F.col("low"), F.col("size"))
        .when(
            F.col("hash") < F.col("high"),
            F.expr("cast(size as decimal(19,0)) * cast(wanted as decimal(19,0)) div amount"),
        )
        .otherwise(F.lit(0))
    )
    return F.col("times") * F.col("size") + F.coalesce(more, F.lit(0))


def _beside(rows: DataFrame, known: DataFrame) -> DataFrame:
    return rows.join(known.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken) for documents (doc_id, text, source)."""
    rows = stored(_measured(docs), "sizes")
    return _beside(rows, limits(rows, weights, most)).select("doc_id", "size", "source_size", "target", _taken().alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: all columns of the documents, each as often as it is taken; a last copy can be the first words only."""
    known = limits(stored(_measured(docs), "sizes"), weights, most)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    taken = _beside(_measured(docs, whole), known).select("row", "size", _taken().alias("taken")).where("taken > 0")
    copies = F.expr("sequence(1L, (taken + size - 1) div size)")
    each = taken.withColumn("copy", F.explode(copies))
    words = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size"))
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)), F.lit(1), words.cast("int")), " ")
    text = F.when(words < F.col("size"), first).otherwise(F.col("row.text"))
    return each.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
