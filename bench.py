"""Benchmark: run the headline mart queries over whole tables and time them.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional).  Each query is executed completely with
the ``noop`` sink (every row computed, nothing collected to the driver).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake.plans.registry import QUERIES, load_all  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402

HEADLINE = [
    "gross_profit",          # D24 flagship: 25-way style enrichment + 8 stages
    "monthly_accum",         # D25 accumulate + text contract
    "enriched_weekly",       # D23 weekly
    "candidate_costs",       # D22 per-row as-of candidates
    "keypart_gap",           # D14 skeleton + carry-forward
    "costgap_spine",         # D20 five-way key spine (whole price-gap chain)
    "star_enrichment",       # J1
    "match_cascade",         # J12
    "duplicate_keys",        # A8
    "latest_per_key",        # W1
    "lineage_edges",         # G5
    "tagged_union",          # S7
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    load_all()
    wanted = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q in QUERIES]
    spark = build_session(f"local[{cpus}]", app="ledgerlake-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    times: dict[str, float] = {}
    for name in wanted:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
