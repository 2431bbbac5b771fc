"""Compare queries with their oracles from the command line: check_queries.py [sf] [name ...]."""

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

import __spark_entry__ as entry
from oracle_compare import compare, oracle_connection
from wrenchlake.session import local_session

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = []
    for name in sys.argv[2:] or sql:
        start = time.time()
        try:
            rows, problem = compare(queries[name](spark, sf_dir), con, sql[name])
        except Exception:
            rows, problem = -1, traceback.format_exc()[-1500:]
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok':5} {name:36} {rows:8} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("failed:", failed)
