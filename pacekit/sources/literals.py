"""Literal relations: VALUES lists and single literal rows as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def values_relation(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A VALUES list; a literal relation in the plan, nothing is run."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def literal_row(spark: SparkSession, schema: str, **values) -> DataFrame:
    """A table of one row; columns of ``schema`` that are not given are NULL."""
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema).names
    return values_relation(spark, [[values.get(f) for f in fields]], schema)
