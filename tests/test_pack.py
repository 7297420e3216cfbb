"""The analysis pack equals the single-report functions (same columns, same rows)."""

import math

from registry_analytics.plans import analyses as A
from registry_analytics.plans import reports as R
from registry_analytics.plans.jobs import registry_for

SF = "/root/testdata/sf0.01"


def _rows(df):
    def norm(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)


def test_pack_matches_single_reports(spark):
    fact = registry_for(spark, SF).fact
    pack = A.analysis_pack(fact)
    single = {"A1": A.state_profile(fact), "A2": A.debt_stats(fact), "B1": A.top_places(fact),
              "C1": A.size_profile(fact), "C2": A.type_profile(fact), "D1": A.top_activities(fact),
              "D2": A.sector_counts(fact), "E1": A.sex_profile(fact), "E2": A.age_bands(fact),
              "F1": A.null_columns(fact), "F2": A.default_codes(fact), "R1": R.summary(fact)}
    try:
        for k, df in single.items():
            assert pack[k].columns == df.columns, k
            assert _rows(pack[k]) == _rows(df), k
    finally:
        pack["_fine"].unpersist()
