"""Run every query against its SQL: python tests/check_all.py <sf_dir> [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import connect, differences  # noqa: E402

from sentispark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("check", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                diff = differences(df, con, oracles[name])
                state = "ok" if not diff else "DIFF " + " | ".join(diff)
            else:
                diff, state = [], f"rows {df.count()}"
        except Exception as e:
            diff, state = [e], f"ERROR {str(e)[:600]}"
        bad += bool(diff)
        print(f"{name:32s} {time.time() - start:6.2f}s {state}", flush=True)
        spark.catalog.clearCache()
    print("queries", len(queries), "with SQL", len(oracles), "bad", bad)


if __name__ == "__main__":
    main()
