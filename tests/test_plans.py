"""Physical-plan properties that the scale design relies on (checked on sf0.001)."""
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def reference_queries():
    from pacekit.plans.queries import REGISTRY

    return REGISTRY


FILE_ROUND_TRIPS = {"snapshot_explode", "snapshot_rejects", "page_union", "entity_pages", "csv_summary",
                    "full_refresh_layers", "stream_incremental_upsert", "incremental_fact_upsert",
                    "stream_event_time_upsert", "snapshot_split", "rolling_incremental"}
# queries that write a rollup, the mart or team rows once and read it several times
STORED_ONCE = {"densified_daily", "rolling_load_7_28", "load_ratio_label", "mart_full", "quality_report",
               "mart_contract", "duplicate_keys", "team_benchmark", "secured_rides", "catalog_keyed_upsert"}


def test_building_a_query_runs_no_job(spark, monkeypatch):
    """Plans are declared, not decided by counting; only queries that write files run jobs."""
    from pacekit.plans import analog as A

    tables = {t: A.table(spark, SF, t) for t in ("events", "customer", "orders")}    # reads the footers
    monkeypatch.setattr(A, "table", lambda spark, sf_dir, name: tables[name])
    tracker = spark.sparkContext.statusTracker()
    for name, q in reference_queries().items():
        if name not in FILE_ROUND_TRIPS | STORED_ONCE:
            group = f"build-{name}"
            spark.sparkContext.setJobGroup(group, name)
            q(spark, SF)
            assert not tracker.getJobIdsForGroup(group), name
    spark.sparkContext.setJobGroup("rest", "rest")


def test_queries_leave_the_session_as_it_was(spark):
    before = dict(spark.sparkContext.getConf().getAll())
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = reference_queries()["stage_json_typed"](spark, SF).orderBy("activity_id").limit(3).collect()
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows == reference_queries()["stage_json_typed"](spark, SF).orderBy("activity_id").limit(3).collect()
    assert dict(spark.sparkContext.getConf().getAll()) == before


def test_no_cartesian_or_nested_loop_joins(spark):
    for name, q in reference_queries().items():
        if name not in FILE_ROUND_TRIPS:
            p = plan(q(spark, SF))
            assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_ride_filter_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        p = plan(reference_queries()["daily"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(event_type,purchase)" in p
    assert "payload" not in p


def test_rides_meet_one_profile_join(spark):
    p = plan(reference_queries()["weighted_means"](spark, SF))
    joins = [ln for ln in p.split("\n") if "Join" in ln.split("[")[0]]
    assert len(joins) == 1


def parents(p: str, child: str) -> list[list[str]]:
    """For every line naming ``child``: the operators on the path up to the root."""
    lines = p.split("\n")
    depth = [len(ln) - len(ln.lstrip(" :+-")) for ln in lines]
    out = []
    for i, ln in enumerate(lines):
        if child in ln:
            path, d = [], depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < d and lines[j].strip():
                    path.append(lines[j].strip(" :+-"))
                    d = depth[j]
            out.append(path)
    return out


def test_spine_is_never_shuffled(spark):
    """No Exchange between the generated days and the result, window included."""
    for name in ("rolling_load_7_28", "mart_full"):
        p = plan(reference_queries()[name](spark, SF))
        p = p.split("Subqueries")[0]
        spines = [path for path in parents(p, "Generate explode") if any(x.startswith("Window") for x in path)]
        assert spines, name
        for path in spines:
            assert not any(x.startswith("Exchange") for x in path), (name, path)


def test_checks_read_a_stored_mart(spark):
    """The mart is computed once; the checks scan what was written, and plan in no time."""
    import time

    for name in ("quality_report", "mart_contract", "duplicate_keys"):
        df = reference_queries()[name](spark, SF)
        began = time.perf_counter()
        p = plan(df)
        assert time.perf_counter() - began < 5, name
        assert "from_json" not in p and "Window" not in p and "events.parquet" not in p, name


def test_flagship_and_mart_parse_the_landed_json_once(spark, monkeypatch):
    """What they store is parsed from the landing table; nothing after it is parsed again."""
    from pacekit.plans import queries as Q

    for name in ("load_ratio_label", "mart_full"):
        stored = []
        monkeypatch.setattr(Q, "materialize", lambda sp, df, n, put=Q.materialize: stored.append(df) or put(sp, df, n))
        rest = Q.REGISTRY[name](spark, SF)
        monkeypatch.undo()
        assert [d._jdf.queryExecution().executedPlan().toString().count("Scan parquet") for d in stored]
        assert len(stored) == 1 and "from_json" in stored[0]._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in rest._jdf.queryExecution().optimizedPlan().toString()
