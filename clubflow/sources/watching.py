"""A stored table of watch sessions that grows with the progress rows that arrive.

An append reads the new rows and the last session of the users and videos in them; the history is not read again. A
row that comes late, at or before the end of its user's last session of the video, makes that user and video be built
again from the history. Stored sessions are never changed: a later append writes the continued session with a higher
``batch``, a rebuild all sessions with a higher ``base``, and readers take the newest. The last session of each user and
video in an append is marked, so the next one finds it among one row per key and append.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clubflow.operators.ordered import first_rows
from clubflow.operators.skew import NO_STATISTICS, KeyStatistics
from clubflow.plans.campaign import by_user_video, session_spans
from clubflow.session import stored
from clubflow.sources import load, published

_KEYS = ["user_id", "video_id"]


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """All sessions as they are now.

    One shuffle by user and video, which the windows of ``kept_sessions`` share. A key has at most eight sessions a day,
    once for each rebuild, and one row more for each append.
    """
    whole = Window.partitionBy(*_KEYS)
    own = F.struct("base", "session_number")
    ranked = load.read_target(spark, path).withColumn("_next", F.lead(own).over(whole.orderBy("base", "session_number", "batch")))
    newest = (F.col("base") == F.col("_base")) & ~own.eqNullSafe(F.col("_next"))
    return ranked.withColumn("_base", F.max("base").over(whole)).where(newest).drop("base", "batch", "is_last", "_base", "_next")


def _with_last(spans: DataFrame) -> DataFrame:
    after = F.lead("session_number").over(Window.partitionBy(*_KEYS).orderBy("session_number"))
    return spans.withColumn("is_last", after.isNull())


def add_progress(
    spark: SparkSession, path: str, new: DataFrame, history: DataFrame, shift: int = 3, large: KeyStatistics = NO_STATISTICS
) -> int:
    """Take new progress rows into the sessions; ``history`` holds all rows, the new ones too. Returns the late keys.

    Batches must not share rows; versions of one row that come in different batches make it late.
    """
    manifest = published.current(spark, path)
    batch = F.lit((manifest.taken if manifest else 0) + 1).cast("long")
    if manifest is None or manifest.schema is None:
        first = _with_last(session_spans(by_user_video(new, large), shift, large=large))
        load.append(first.withColumns({"base": batch, "batch": batch}), path)
        return 0
    # times are stored shifted
    begins = new.groupBy(*_KEYS).agg(F.min(F.col("updated_at") + F.expr(f"INTERVAL {shift} HOUR")).alias("_first"))
    ends = first_rows(published.read(spark, path, manifest).where("is_last"), _KEYS, ["base", "batch"], last=True)
    is_late = F.coalesce(F.col("_first") <= F.col("last_at"), F.lit(False))
    touched = stored(ends.join(begins, _KEYS).withColumn("_late", is_late).drop("_first"), "tails")
    late, tails = stored(touched.where("_late").select(*_KEYS), "late"), touched.where("NOT _late")
    n = late.count()
    on_time = by_user_video(new, large)
    if n:
        on_time = on_time.join(late, _KEYS, "left_anti")
    spans = session_spans(on_time, shift, by_user_video(tails.drop("base", "batch", "is_last", "_late"), large), large)
    rows = _with_last(spans).join(tails.select(*_KEYS, "base"), _KEYS, "left")
    rows = rows.withColumns({"base": F.coalesce("base", batch), "batch": batch})
    if n:
        again = by_user_video(history.join(late, _KEYS, "left_semi"), large)
        again = _with_last(session_spans(again, shift, large=large))
        rows = rows.unionByName(again.withColumns({"base": batch, "batch": batch}))
    load.append(rows, path)
    return n
