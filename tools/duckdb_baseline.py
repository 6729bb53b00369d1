"""Time the oracle SQL on DuckDB with one thread (the publishing engine's
configuration) as the single-node baseline for bench.py.

usage: python tools/duckdb_baseline.py [sf_dir] [threads]
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tidepool.plans.oracle import ORACLE  # noqa: E402
from tidepool.plans.tables import TABLES  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    times = {}
    for key in sorted(ORACLE):
        best = float("inf")
        for _ in range(2):
            t0 = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TEMP TABLE _bench AS {ORACLE[key]}")
            best = min(best, time.perf_counter() - t0)
        times[key] = round(best, 3)
    print(json.dumps({"engine": f"duckdb {duckdb.__version__}", "threads": threads, "sf_dir": sf,
                      "value": round(sum(times.values()), 3), "queries": times}))


if __name__ == "__main__":
    main()
