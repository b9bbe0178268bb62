"""What a query did: the files its scans opened and the jobs that a piece of code started."""

from __future__ import annotations

import uuid
from contextlib import contextmanager


def scans(df) -> list[dict]:
    """Files and rows that each Parquet scan of the query read, after running it."""
    df = df.select("*")  # a run of its own: a second run of one plan does not count its files again
    df.collect()
    found = []

    def walk(node) -> None:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            metrics = node.metrics()
            found.append({m: metrics.get(m).get().value() for m in ("numFiles", "numOutputRows")})
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@contextmanager
def jobs(spark):
    """Collects the ids of the jobs that are started inside."""
    sc, group, started = spark.sparkContext, uuid.uuid4().hex, []
    sc.setJobGroup(group, group)
    try:
        yield started
    finally:
        started += sc.statusTracker().getJobIdsForGroup(group)
        sc.setLocalProperty("spark.jobGroup.id", None)
