"""Compare every query (or those named) with its oracle: ``python tests/check_oracles.py [sf] [rows] [name…]``.

``rows`` lowers the rows-per-segment limit, so that large-key handling runs
(0 keeps the default).
"""

import sys
import time

sys.path[:0] = ["/root/repo", "/root/repo/tests"]

from compare import connect, difference  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from clubflow.session import ROWS_PER_SEGMENT, build_session  # noqa: E402

sf, limit, names = sys.argv[1], int(sys.argv[2]), sys.argv[3:]
spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
spark.sparkContext.setLogLevel("ERROR")
if limit:
    spark.conf.set(ROWS_PER_SEGMENT, str(limit))
folder = f"/root/testdata/sf{sf}"
con = connect(folder)
queries, oracles = entry.queries(), entry.oracle_sql()
bad = 0
for name in names or queries:
    begin = time.time()
    try:
        df = queries[name](spark, folder)
        if name in oracles:
            found = difference(df, con, oracles[name])
        else:
            found = f"no oracle, {df.count()} rows"
    except Exception as error:  # noqa: BLE001
        found = f"{type(error).__name__}: {str(error)[:900]}"
    bad += found is not None
    print(f"{'ok ' if found is None else 'BAD'} {time.time() - begin:6.2f}s {name} {found or ''}", flush=True)
print("differences:", bad, "of", len(names or queries))
