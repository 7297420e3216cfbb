"""Fused aggregates vs one action per number.

Runs analyses A-F over the stored fact three ways: one Spark action for each
column of each report over a cached fact, one aggregate per report (nothing
cached), and the analysis pack.  Prints one JSON line with the best of three
runs of each.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from registry_analytics.plans import analyses as A  # noqa: E402
from registry_analytics.plans.jobs import registry_for  # noqa: E402
from registry_analytics.session import local_session  # noqa: E402


REPORTS = (A.state_profile, A.debt_stats, A.top_places, A.size_profile, A.type_profile, A.top_activities,
           A.sector_counts, A.sex_profile, A.age_bands, A.null_columns, A.default_codes)


def per_action(fact):
    """One action for each column of each report, on a cached fact."""
    fact = fact.cache()
    for report in REPORTS:
        frame = report(fact)
        for name in frame.columns:
            frame.select(name).collect()
    fact.unpersist()


def fused(fact):
    for report in REPORTS:
        report(fact).collect()


def packed(fact):
    p = A.analysis_pack(fact)
    for k, df in p.items():
        if not k.startswith("_"):
            df.collect()
    p["_fine"].unpersist()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    fact = registry_for(spark, sf).fact
    fused(fact)
    per_action(fact)  # warm both paths once
    out = {}
    packed(fact)
    for name, fn in [("per_action", per_action), ("fused", fused), ("packed", packed)]:
        runs = []
        for _ in range(3):
            t = time.perf_counter()
            fn(fact)
            runs.append(time.perf_counter() - t)
        out[name] = round(min(runs), 3)
    out["sf"] = sf
    print(json.dumps(out))


if __name__ == "__main__":
    main()
