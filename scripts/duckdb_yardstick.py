"""Time the DuckDB oracle SQL of every query (single node, all threads) as an
outside yardstick for bench.py.  Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamops.catalog import ORACLE  # noqa: E402
from tests.oracle import duck  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    con = duck(sf_dir)
    times = {}
    for name, sql in ORACLE.items():
        t0 = time.time()
        con.sql(f"SELECT count(*) FROM ({sql})").fetchall()
        times[name] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "duckdb_total_sec", "value": round(sum(times.values()), 3), "queries": times}))


if __name__ == "__main__":
    main()
