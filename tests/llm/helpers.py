"""Small fixtures with the awkward rows every operator must take."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, null ids and sources."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    return docs(spark, [
        (1, None), (2, ""), (3, "a"), (4, "a"), (4, "a"), (5, long), (6, long, None),
        (None, "no id"), (None, None, None), (7, "́ \U0001f600\x00\x1c tab\tline\n end  "),
        (8, "x" * 50_000), (9, "one two three four five", "s1"), (10, " \t\n ")])


def clashing(df):
    """Extra columns named like internal and result columns."""
    from pyspark.sql import functions as F

    names = ["key", "bucket", "kept", "size", "shard", "slot", "target", "copies", "_n", "_rank",
             "count", "score", "spans", "id", "value", "component_id", "label", "features"]
    for n in names:
        df = df.withColumn(n, F.lit("clash"))
    return df
