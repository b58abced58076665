"""Wall-clock of the headline queries: one warm-up, then the median of three runs each."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from sparkcurate.session import local_session
from sparkcurate.plans.queries import QUERIES

HEADLINE = [
    "contract_validate", "batch_split", "exact_dedup_keep_first", "composition_gate", "status_funnel",
    "ols_mad_outliers", "hist50", "js_divergence", "descriptor_summary", "assemble_children", "atom_counts",
    "fragments", "mirror_pairs", "geometry_key", "extxyz_delivery", "env_frequency", "coverage_report",
    "pair_coverage", "group_maxmin", "near_dup_cluster", "global_maxmin", "tanimoto_nn",
    "realspace_identity", "conformer_filter", "budgeted_selection", "set_cover_curve", "selection_reports",
]
# Runs beyond this many seconds are timed once.
LONG = 20.0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    names = sys.argv[1:] or HEADLINE

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    out = {}
    for name in names:
        first = once(name)
        out[name] = round(first if first > LONG else statistics.median(once(name) for _ in range(3)), 3)
        print(name, out[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(out.values()), 3), "unit": "sec", "queries": out,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
