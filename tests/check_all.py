"""Every registered query against its SQL: python tests/check_all.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

from tidemark.catalogue import QUERIES, SQL  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(cpus=8)
    con = oracle.connect(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            columns, rows = oracle.spark_rows(QUERIES[name](spark, sf))
            took = time.time() - start
            if name not in SQL:
                print(f"rows  {name:24} {len(rows):7} {took:6.2f}s", flush=True)
                continue
            want_columns, want = oracle.sql_rows(con, SQL[name])
            same = columns == want_columns and rows == want
            print(f"{'ok' if same else 'DIFF':5} {name:24} {len(rows):7} {took:6.2f}s", flush=True)
            if not same:
                bad += 1
                print("   ", columns, want_columns, len(rows), len(want))
                extra, missing = set(rows) - set(want), set(want) - set(rows)
                print("    spark only", sorted(extra)[:3], "sql only", sorted(missing)[:3])
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name:24} {type(error).__name__}: {str(error)[:600]}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
