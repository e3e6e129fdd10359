"""Row-level security: one view, other rows for each viewer.

The view joins the rows to an entitlement table by a semi-join on the viewer named in a session
variable, so who is looking is decided when the view is read, not when it is made. The join is
an ordinary equi-join: the entitlements of one viewer are filtered before they meet the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VARIABLE = "pacekit_viewer"


def declare_viewer(spark: SparkSession) -> None:
    """Make the session variable; until it is set, nobody is looking and no row is visible."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {VARIABLE} STRING DEFAULT NULL")


def set_viewer(spark: SparkSession, viewer: str | None) -> None:
    spark.sql(f"SET VARIABLE {VARIABLE} = :viewer", args={"viewer": viewer})


def secured_view(spark: SparkSession, name: str, rows: DataFrame, entitlements: DataFrame, key: str,
                 viewer_col: str = "viewer", everyone: str = "*") -> DataFrame:
    """The temporary view ``name`` of ``rows`` that the session's viewer may see.

    ``entitlements`` has (viewer, key); a viewer with the key value ``everyone`` sees all rows. Rows
    with a null key are seen by those alone.
    """
    rows.createOrReplaceTempView(f"{name}_rows")
    entitlements.selectExpr(f"cast({viewer_col} as string) as viewer", f"cast({key} as string) as entity") \
        .createOrReplaceTempView(f"{name}_entitlements")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY VIEW {name} AS
        SELECT r.* FROM {name}_rows r LEFT SEMI JOIN {name}_entitlements e
          ON cast(r.{key} AS string) = e.entity AND e.viewer = session.{VARIABLE}
          AND e.entity <> '{everyone}'
        WHERE NOT EXISTS (SELECT 1 FROM {name}_entitlements a
                          WHERE a.viewer = session.{VARIABLE} AND a.entity = '{everyone}')
        UNION ALL
        SELECT r.* FROM {name}_rows r
        WHERE EXISTS (SELECT 1 FROM {name}_entitlements a
                      WHERE a.viewer = session.{VARIABLE} AND a.entity = '{everyone}')""")
    return spark.table(name)
