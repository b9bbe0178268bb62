"""Time the headline queries: ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_QUERIES`` choose what to run."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clubflow.session import build_session  # noqa: E402

# every mart, and the operators that carry most of their cost
OPERATORS = (
    "scan_latest", "write_append_above_watermark", "write_replace_range", "write_replace_month", "write_compact",
    "cte_pipeline", "join_inner_equi", "join_left_equi", "join_full_outer", "join_self_next_row",
    "join_range_interval", "join_as_attribution", "agg_sum_count_group", "agg_count_distinct", "agg_count_if",
    "agg_total_plus_detail", "win_row_number", "win_lag", "win_running_sum", "win_partition_agg",
    "win_sessionize_gap", "win_moving_quantile_rows", "topk_per_key", "arr_explode_hours", "fn_json_path",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": os.environ.get("BENCH_WORK_DIR", "/tmp/checkpoints"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from clubflow.catalog import QUERIES

    chosen = os.environ.get("BENCH_QUERIES", "")
    names = chosen.split(",") if chosen else [n for n in QUERIES if n.startswith("mart_")] + list(OPERATORS)
    # one small query first, so the first timing is not the start of the JVM
    QUERIES["scan_table"](spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
        print(f"{times[name]:8.3f} {name}", file=sys.stderr)
    result = {
        "metric": "total wall time of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
