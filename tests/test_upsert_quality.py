import datetime as dt

import pytest

from pacekit.operators import quality as Q
from pacekit.operators.upsert import latest_per_key, upsert

T = dt.datetime


def old_table(spark):
    return spark.createDataFrame(
        [(1, 10, "a", "s1", T(2024, 1, 1), T(2024, 1, 1)),
         (1, 11, "b", "s1", T(2024, 1, 1), T(2024, 1, 1)),
         (2, 20, "c", "s2", T(2024, 1, 1), T(2024, 1, 1))],
        "athlete_id bigint, activity_id bigint, payload string, scope string, "
        "created_at timestamp, updated_at timestamp")


def batch(spark):
    # duplicate key (1, 11) inside one batch: the later extraction wins, never an error
    return spark.createDataFrame(
        [(1, 11, "b1", None, T(2024, 2, 1)), (1, 11, "b2", None, T(2024, 2, 2)),
         (3, 30, "d", "s3", T(2024, 2, 1))],
        "athlete_id bigint, activity_id bigint, payload string, scope string, extracted timestamp")


def test_latest_per_key_breaks_ties_deterministically(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (1, 4, "z")], "k int, o int, v string")
    assert [tuple(r) for r in latest_per_key(df, ["k"], ["o"]).collect()] == [(1, 5, "y")]


def run(spark, old):
    return upsert(old, batch(spark), ["athlete_id", "activity_id"], ["extracted"],
                  insert_only_cols=["created_at"], keep_if_null_cols=["scope"],
                  touch_col="updated_at", touch_value="2024-03-01 00:00:00")


def test_upsert_merges_partial_columns(spark):
    out = {(r.athlete_id, r.activity_id): r for r in run(spark, old_table(spark)).collect()}
    assert set(out) == {(1, 10), (1, 11), (2, 20), (3, 30)}
    r = out[(1, 11)]
    assert r.payload == "b2" and r.scope == "s1"                 # NULL keeps the old value
    assert r.created_at == T(2024, 1, 1) and r.updated_at == T(2024, 3, 1)
    assert out[(3, 30)].created_at is None            # not in the batch: no old value to keep
    assert out[(1, 10)].updated_at == T(2024, 1, 1)


def test_upsert_is_idempotent(spark):
    once = run(spark, old_table(spark))
    twice = run(spark, once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


CHECKS = [
    {"name": "nn", "kind": "not_null", "column": "a"},
    {"name": "vals", "kind": "accepted_values", "column": "b", "values": [0, 1]},
    {"name": "rng", "kind": "accepted_range", "column": "c", "min": 0, "max": 10, "where": "b > 0"},
    {"name": "expr", "kind": "expression", "expr": "c >= 0", "severity": "warn"},
    {"name": "uniq", "kind": "unique", "columns": ["a", "b"]},
]


def test_quality_report_counts_and_null_semantics(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (1, 0, 50.0), (None, 2, -1.0), (2, None, None),
                                (3, 1, 11.0)], "a int, b int, c double")
    rep = {r.check_name: r for r in Q.quality_report(df, CHECKS).collect()}
    assert rep["nn"].failures == 1
    assert rep["vals"].failures == 1          # NULL passes accepted_values
    assert rep["rng"].failures == 2           # where b > 0: -1.0 and 11.0
    assert rep["expr"].failures == 1 and rep["expr"].status == "warn"
    assert rep["uniq"].failures == 1
    with pytest.raises(Q.QualityGateError):
        Q.gate(Q.quality_report(df, CHECKS))
    ok = Q.gate(Q.quality_report(df.filter("a = 3"), CHECKS[:1] + CHECKS[3:4]))
    assert {r["status"] for r in ok} == {"pass"}


def test_contract_report_schema_nulls_and_key(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "b", None), (None, "c", 1.0)],
                               "athlete_id bigint, name string, extra double")
    rep = {r.check_name: r.failures for r in Q.contract_report(
        df, {"athlete_id": "bigint", "name": "int", "missing": "date"},
        primary_key=["athlete_id"]).collect()}
    assert rep["contract_type_athlete_id"] == 0 and rep["contract_type_name"] == 1
    assert rep["contract_type_missing"] == 1 and rep["contract_extra_extra"] == 1
    assert rep["contract_not_null_athlete_id"] == 1 and rep["contract_primary_key"] == 1


def test_null_keys_match_and_new_columns_are_an_error(spark):
    old = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(None, "m", 1), (2, "b", 1)], "k int, v string, o int")
    once = upsert(old, new, ["k"], ["o"])
    twice = upsert(once, new, ["k"], ["o"])
    rows = sorted(map(tuple, twice.collect()), key=str)
    assert rows == sorted(map(tuple, once.collect()), key=str) == [(1, "a"), (2, "b"), (None, "m")]
    with pytest.raises(ValueError):
        upsert(old, new.withColumn("extra", new.o), ["k"], ["o"])


def test_row_checks_are_not_counted_per_key(spark):
    """Groups of a unique key are as many as the rows; they hold the key and one count."""
    df = spark.createDataFrame([(1, "x", 1.0), (1, "x", -1.0), (2, None, None)], "k long, s string, v double")
    checks = [{"name": "s", "kind": "not_null", "column": "s"},
              {"name": "v", "kind": "accepted_range", "column": "v", "min": 0},
              {"name": "u", "kind": "unique", "columns": ["k"]}, {"name": "w", "kind": "unique", "columns": ["k", "s"], "where": "v > 0"}]
    rep = Q.quality_report(df, checks)
    assert {r.check_name: r.failures for r in rep.collect()} == {"s": 1, "v": 1, "u": 1, "w": 0}
    p = rep._jdf.queryExecution().optimizedPlan().toString()
    keyed = [ln for ln in p.split("\n") if "Aggregate [k" in ln and "s#" in ln.split("]")[0]]
    assert keyed and not any("_q" in ln for ln in keyed)
