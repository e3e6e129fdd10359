"""Declarative data-quality checks: one pass for all row checks, one for all unique checks.

A check is a small dict:

    {"name": ..., "kind": "not_null" | "accepted_values" | "accepted_range"
             | "expression" | "unique",
     "column": ..., "values": [...], "min": ..., "max": ..., "expr": "...",
     "columns": [...] (unique), "where": "sql predicate", "severity": "error"|"warn"}

Semantics follow the usual warehouse test conventions: ``accepted_values``,
``accepted_range`` (inclusive) and ``expression`` let NULL pass; ``where``
filters rows first; ``unique`` counts key combinations seen more than once.

The row checks are one aggregate without keys: a task holds one row of counts. Unique
checks read their key columns alone, grouped once by the finest key that they name, and
are answered from those counts (Spark reuses the exchange). Such groups are about as many
as the rows, so they carry no counts of the row checks. All is unpivoted into
``(check_name, column_name, kind, failures, severity, status)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityGateError(RuntimeError):
    pass


def _fail_condition(chk: Mapping) -> Column:
    kind = chk["kind"]
    col = F.col(chk["column"]) if chk.get("column") else None
    if kind == "not_null":
        fail = col.isNull()
    elif kind == "accepted_values":
        fail = ~col.isin(list(chk["values"]))
    elif kind == "accepted_range":
        ok = None
        if chk.get("min") is not None:
            ok = col >= F.lit(chk["min"])
        if chk.get("max") is not None:
            hi = col <= F.lit(chk["max"])
            ok = hi if ok is None else ok & hi
        fail = ~ok
    elif kind == "expression":
        fail = ~F.expr(chk["expr"])
    else:
        raise ValueError(f"unknown check kind {kind!r}")
    if chk.get("where"):
        fail = F.expr(chk["where"]) & fail
    return fail


def quality_report(df: DataFrame, checks: Sequence[Mapping]) -> DataFrame:
    row_checks = [c for c in checks if c["kind"] != "unique"]
    uniq_checks = [c for c in checks if c["kind"] == "unique"]
    fails = [F.sum(F.when(_fail_condition(c), 1).otherwise(0)).cast("long").alias(f"_q{i}")
             for i, c in enumerate(row_checks)]
    # rows are counted per finest key, every unique check reads those counts
    finest = list(dict.fromkeys(c for u in uniq_checks for c in u["columns"]))
    kept = [F.sum(F.when(F.expr(u["where"]) if u.get("where") else F.lit(True), 1).otherwise(0)).cast("long")
            .alias(f"_u{i}") for i, u in enumerate(uniq_checks)]
    grouped = df.groupBy(*finest).agg(*kept) if finest else None
    parts = []
    if row_checks:
        counted = df.agg(*fails)
        stack_args = ", ".join(
            f"'{c['name']}', '{c.get('column') or ''}', '{c['kind']}', "
            f"coalesce(_q{i}, 0L), '{c.get('severity', 'error')}'"
            for i, c in enumerate(row_checks))
        parts.append(counted.selectExpr(
            f"stack({len(row_checks)}, {stack_args}) "
            "as (check_name, column_name, kind, failures, severity)"))
    for i, c in enumerate(uniq_checks):
        dup = (grouped.groupBy(*c["columns"]).agg(F.sum(f"_u{i}").alias("_n")).filter(F.col("_n") > 1)
                  .agg(F.count(F.lit(1)).cast("long").alias("failures")))
        parts.append(dup.select(F.lit(c["name"]).alias("check_name"),
                                F.lit(",".join(c["columns"])).alias("column_name"),
                                F.lit("unique").alias("kind"), F.col("failures"),
                                F.lit(c.get("severity", "error")).alias("severity")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
               .when(F.col("severity") == "warn", F.lit("warn"))
               .otherwise(F.lit("fail")))
    return out.withColumn("status", status)


def contract_report(df: DataFrame, expected: Mapping[str, str],
                    primary_key: Sequence[str] = (), severity: str = "error") -> DataFrame:
    """A declared contract in one report: schema, not-null keys and key uniqueness.

    ``expected`` maps column -> Spark SQL type name (e.g. ``"bigint"``). Missing
    or mistyped columns and unexpected extra columns are found from the schema
    alone (no data pass); not-null and uniqueness of ``primary_key`` run as
    ordinary checks in the same report.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for c, t in expected.items():
        bad = int(c not in actual or actual[c] != t.lower())
        rows.append((f"contract_type_{c}", c, "schema", bad, severity))
    for c in actual:
        if c not in expected:
            rows.append((f"contract_extra_{c}", c, "schema", 1, severity))
    spark = df.sparkSession
    schema_part = spark.createDataFrame(
        rows, "check_name string, column_name string, kind string, failures bigint, severity string")
    present = [c for c in primary_key if c in actual]
    checks = [{"name": f"contract_not_null_{c}", "kind": "not_null", "column": c,
               "severity": severity} for c in present]
    if present:
        checks.append({"name": "contract_primary_key", "kind": "unique", "columns": present,
                       "severity": severity})
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
               .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    out = schema_part.withColumn("status", status)
    return out.unionByName(quality_report(df, checks)) if checks else out


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The failing rows of a uniqueness check: key combinations with count > 1."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def gate(report: DataFrame) -> list[dict]:
    """Raise when an error-severity check failed; return the (small) report rows.

    The report has one row per check, so collecting it is bounded.
    """
    rows = [r.asDict() for r in report.collect()]
    failed = [r for r in rows if r["status"] == "fail"]
    if failed:
        names = ", ".join(f"{r['check_name']}={r['failures']}" for r in failed)
        raise QualityGateError(f"quality gate failed: {names}")
    return rows
