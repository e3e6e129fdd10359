import os

import pytest

from pacekit.operators.quality import QualityGateError
from pacekit.plans import analog as A
from pacekit.plans.build import build_warehouse
from pacekit.plans.queries import MART_CHECKS

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_build_writes_every_layer_and_gates(spark, tmp_dir):
    ev, cust = A.table(spark, SF, "events"), A.table(spark, SF, "customer")
    args = (spark, A.landed_activities(ev), A.threshold_tests(cust), A.athlete_history(cust))
    warn_only = [c for c in MART_CHECKS if c.get("severity") == "warn"]
    paths = build_warehouse(*args, tmp_dir, A.AS_OF, A.RIDE_TYPE, checks=warn_only,
                            min_start=A.MIN_START)
    assert paths["stg_activities"].endswith("/staging/stg_activities")
    assert paths["mart_daily"].endswith("/analytics/mart_daily")
    mart = spark.read.parquet(paths["mart_daily"])
    assert mart.count() > 0 and "tss_28d" in mart.columns
    assert {r["status"] for r in paths["quality"]} <= {"pass", "warn"}
    with pytest.raises(QualityGateError):     # the faithful uniqueness check fails (rest days)
        build_warehouse(*args, tmp_dir + "-2", A.AS_OF, A.RIDE_TYPE, checks=MART_CHECKS,
                        min_start=A.MIN_START)
