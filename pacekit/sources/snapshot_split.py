"""Snapshot documents of any size, read by many tasks: split anywhere, resynchronised at records.

A snapshot is one JSON document ``{"extracted_at_utc": ..., "activities": [{...}, ...]}``, on one line
or pretty-printed, however large. Read as text it would be one row of one task. Here the file
is cut at every ``}`` - a separator Spark's text reader can split a file at - and the pieces are
put together again where records end:

1. a piece says, for either state it may begin in (outside or inside a string), how many
   objects it opens and closes, and whether it flips the state. Escapes are taken out first;
2. states and depths are prefix sums: within a split (the rows of one file block), then over
   the splits of a file, one row each;
3. a piece that brings the depth back to one ends a record. Pieces of a record are joined in
   file order, so a record across two splits is whole; a nested object is a piece like others.

A document that does not end (a cut-off file) gives no rows and one reject, as in
``ingest.read_snapshot``. Files may hold several documents, one after the other; a document's
fields beside ``activities`` hold no objects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacekit.sources.ingest import snapshot_roots
from pacekit.sources.sinks import materialize

HEAD = r'(?s)^.*?"activities"\s*:\s*\['


def _outside(text: Column) -> Column:
    """``text`` (no escapes) that begins outside a string, without its strings."""
    return F.regexp_replace(F.regexp_replace(text, '"[^"]*"', ""), '"[^"]*$', "")


def _count(text: Column, c: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))


def pieces(spark: SparkSession, roots: list[str], name_pattern: str) -> DataFrame:
    """The pieces of the files: (file, block, at, snapshot, value, flips, depth0, depth1)."""
    text = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(roots).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"), "value")
    bare = F.regexp_replace("value", r"\\.", "")
    flips = _count(bare, '"') % 2
    # begun inside a string, a piece counts from the quote that ends it
    inside = F.when(F.instr(bare, '"') > 0, F.regexp_replace(bare, '^[^"]*"', "")).otherwise(F.lit(""))
    return text.select(
        "file", "block", "size", "at", F.regexp_extract("file", name_pattern, 0).alias("snapshot"), "value",
        flips.alias("flips"), (_count(_outside(bare), "{") - F.when(flips == 0, 1).otherwise(0)).alias("depth0"),
        (_count(_outside(inside), "{") - F.when(flips == 1, 1).otherwise(0)).alias("depth1"))


def _placed(cut: DataFrame) -> DataFrame:
    """``cut`` with the ``depth`` after each piece (its closing brace counted), whether it begins at
    depth zero (``opens``) and whether it ends outside a string."""
    split = Window.partitionBy("file", "block").orderBy("at")
    before, upto = split.rowsBetween(Window.unboundedPreceding, -1), split.rowsBetween(Window.unboundedPreceding, 0)
    c = cut.withColumn("_f", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    # the state of a piece if the split begins outside (0) or inside (1) a string
    c = c.withColumns({f"_d{s}": F.sum(F.when((F.col("_f") + s) % 2 == 0, F.col("depth0"))
                                       .otherwise(F.col("depth1"))).over(upto) for s in (0, 1)})
    c = c.withColumn("_final", F.lead("at").over(split).isNull())
    splits = c.groupBy("file", "block").agg(F.sum("flips").alias("_flips"), F.max_by("_d0", "at").alias("_t0"),
                                            F.max_by("_d1", "at").alias("_t1"), F.max("size").alias("_size"),
                                            F.sum(F.octet_length("value") + 1).alias("_bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.withColumn("_s", F.coalesce(F.sum("_flips").over(earlier), F.lit(0)) % 2)
    total = F.when(F.col("_s") == 0, F.col("_t0")).otherwise(F.col("_t1"))
    # with one byte more than the file has, its last piece is not closed by a brace
    whole = Window.partitionBy("file")
    begins = begins.withColumn("_open", (F.sum("_bytes").over(whole) > F.col("_size"))
                               & (F.col("block") == F.max("block").over(whole)))
    begins = begins.select("file", "block", "_s", "_open", F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias("_base"))
    j = c.join(begins, ["file", "block"])
    depth = F.col("_base") + F.when(F.col("_s") == 0, F.col("_d0")).otherwise(F.col("_d1"))
    state = (F.col("_f") + F.col("_s")) % 2
    own = F.when(state == 0, F.col("depth0")).otherwise(F.col("depth1"))
    return j.select("file", "block", "at", "snapshot", "value", depth.alias("depth"),
                    (depth - own == 0).alias("opens"),
                    (((state + F.col("flips")) % 2 == 0) & ~(F.col("_final") & F.col("_open"))).alias("outside"))


def _numbered(placed: DataFrame) -> DataFrame:
    """With ``ends`` (1: a record ends here, 0: a document does), ``doc`` and ``unit``: what the piece belongs to.

    Units are numbered by the ends before them in the file, documents likewise.
    """
    ends = F.when(F.col("outside") & F.col("depth").isin(0, 1), F.col("depth"))
    p = placed.withColumn("ends", ends).withColumns({
        "_u": F.col("ends").isNotNull().cast("long"), "_o": F.coalesce(F.col("ends") == 0, F.lit(False)).cast("long")})
    split = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    totals = p.groupBy("file", "block").agg(F.sum("_u").alias("_nu"), F.sum("_o").alias("_no"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("file", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(n)
                                             for c, n in (("_nu", "_u0"), ("_no", "_o0"))])
    own = p.withColumns({"_ui": F.coalesce(F.sum("_u").over(split), F.lit(0)),
                         "_oi": F.coalesce(F.sum("_o").over(split), F.lit(0))})
    return own.join(first, ["file", "block"]).select(
        "file", "block", "at", "snapshot", "value", "opens", "ends", (F.col("_u0") + F.col("_ui")).alias("unit"),
        (F.col("_o0") + F.col("_oi")).alias("doc"))


def units(spark: SparkSession, path: str, name_pattern: str, latest_only: bool) -> DataFrame:
    """(file, snapshot, doc, unit, ends, opens, text): records (1), document ends (0), unfinished rests (null).

    The text of a unit that ``opens`` a document has the document's head before it.
    """
    cut = pieces(spark, snapshot_roots(spark, path, name_pattern, latest_only), name_pattern)
    u = _numbered(_placed(cut)).groupBy("file", "snapshot", "doc", "unit").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("_p"), F.max("ends").alias("ends"),
        F.bool_or("opens").alias("opens"))
    text = F.array_join(F.transform("_p", lambda p: p["value"]), "}")
    return materialize(spark, u.select("file", "snapshot", "doc", "unit", "ends", "opens", text.alias("text")),
                       "snapshot-units")


def _read(u: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with their document's fields, documents with ``whole``)."""
    body = F.when(F.col("opens"), F.regexp_replace("text", HEAD, "")).otherwise(F.col("text"))
    heads = u.filter("opens").select("file", "doc", F.regexp_extract("text", HEAD, 0).alias("head"))
    tails = u.filter("ends = 0").select("file", "doc", body.alias("tail"))
    docs = heads.join(tails, ["file", "doc"], "full_outer")
    fields = F.from_json(F.concat("head", "tail", F.lit("}")), "extracted_at_utc string, activities array<string>")
    docs = docs.withColumn("_d", fields).select(
        "file", "doc", F.col("_d.extracted_at_utc").alias("extracted_at_utc"),
        F.coalesce(F.col("_d.activities").isNotNull(), F.lit(False)).alias("whole"))
    record = F.regexp_replace(body, r"^[\s,]*", "")
    records = u.filter("ends = 1").select("file", "snapshot", "doc", F.concat(record, F.lit("}")).alias("payload"))
    return records, docs


def read_snapshot_split(spark: SparkSession, path: str, name_pattern: str = r"activities_raw_[^/.]*",
                        latest_only: bool = True, key: str = "$.id") -> DataFrame:
    """``ingest.read_snapshot`` for documents of any size: (activity_id, extracted_at_utc, payload, snapshot)."""
    records, docs = _read(units(spark, path, name_pattern, latest_only))
    out = records.join(docs.filter("whole"), ["file", "doc"]).select(
        F.get_json_object("payload", key).try_cast("long").alias("activity_id"),
        F.try_to_timestamp("extracted_at_utc").alias("extracted_at_utc"), "payload", "snapshot")
    return out.filter(F.col("activity_id").isNotNull())


def split_rejects(spark: SparkSession, path: str, name_pattern: str = r"activities_raw_[^/.]*",
                  latest_only: bool = True, key: str = "$.id") -> DataFrame:
    """What :func:`read_snapshot_split` leaves out: ``(snapshot, field, raw_text)``.

    A document that does not end, or has no records field, has one row with field ``$`` and the
    text after its last whole record.
    """
    u = units(spark, path, name_pattern, latest_only)
    records, docs = _read(u)
    no_id = (records.join(docs.filter("whole"), ["file", "doc"])
             .filter(F.get_json_object("payload", key).try_cast("long").isNull())
             .select("snapshot", F.lit("id").alias("field"), F.col("payload").alias("raw_text")))
    # documents that do not end, or end without records: what follows their last record
    blank = F.trim(F.regexp_replace("text", r"\s", "")) == ""
    last = u.filter(~blank | F.col("ends").isNotNull()).groupBy("file", "snapshot", "doc").agg(
        F.max_by(F.when(F.coalesce("ends", F.lit(-1)) != 1, F.col("text")).otherwise(F.lit("")), "unit").alias("raw_text"))
    broken = last.join(docs.filter("whole").select("file", "doc"), ["file", "doc"], "left_anti").select(
        "snapshot", F.lit("$").alias("field"), "raw_text")
    return no_id.unionByName(broken)
