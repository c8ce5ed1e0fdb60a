"""Developer check: run registered queries in Spark and their DuckDB twins, diff.

usage: python check_oracle.py [sf_dir] [key ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tests"))

from ledgerlake.plans.registry import ORACLE, QUERIES, load_all  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402
from oracle_compare import compare, duck_connect  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if "/" not in a]
    load_all()
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    con = duck_connect(sf)
    bad = 0
    for key in keys or sorted(QUERIES):
        t0 = time.time()
        try:
            df = QUERIES[key](spark, sf)
            if key in ORACLE:
                ok, msg = compare(df, con, ORACLE[key])
            else:
                ok, msg = True, f"rows-only n={df.count()}"
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {key:28s} {time.time() - t0:6.1f}s {msg[:1500]}", flush=True)
    print(f"{len(keys or QUERIES) - bad} pass, {bad} fail")


if __name__ == "__main__":
    main(sys.argv)
