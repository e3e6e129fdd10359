"""Raw JSON sources: landed snapshots and pages, typed staging, load audit.

Everything is a DataFrame read or column expression; the JSON document is
parsed once with ``from_json`` against an explicit schema (never inferred).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Activity document fields and their parse types (strict: a document with e.g.
# a non-integer value in an INT field is not staged, see ``stage_rejects``).
ACTIVITY_DOC = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("start_date", T.TimestampType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("sport_type", T.StringType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("moving_time", T.IntegerType()),
    T.StructField("elapsed_time", T.IntegerType()),
    T.StructField("total_elevation_gain", T.DoubleType()),
    T.StructField("average_speed", T.DoubleType()),
    T.StructField("max_speed", T.DoubleType()),
    T.StructField("average_watts", T.DoubleType()),
    T.StructField("max_watts", T.DoubleType()),
    T.StructField("kilojoules", T.DoubleType()),
    T.StructField("weighted_average_watts", T.DoubleType()),
    T.StructField("average_cadence", T.DoubleType()),
    T.StructField("average_heartrate", T.DoubleType()),
    T.StructField("max_heartrate", T.DoubleType()),
])

JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "mode": "PERMISSIVE"}

# staged column <- document field
STAGED_FIELDS = [
    ("start_date_utc", "start_date"), ("activity_name", "name"), ("activity_type", "type"),
    ("sport_type", "sport_type"), ("distance_m", "distance"), ("moving_time_s", "moving_time"),
    ("elapsed_time_s", "elapsed_time"), ("elevation_m", "total_elevation_gain"),
    ("avg_speed_mps", "average_speed"), ("max_speed_mps", "max_speed"),
    ("avg_power_w", "average_watts"), ("max_power_w", "max_watts"),
    ("kilojoules", "kilojoules"), ("weighted_average_watts", "weighted_average_watts"),
    ("average_cadence", "average_cadence"), ("avg_hr", "average_heartrate"),
    ("max_hr", "max_heartrate"),
]


def record_guard(df: DataFrame, payload: str = "payload", id_path: str = "$.id") -> DataFrame:
    """Keep documents that carry a non-null id (a JSON ``null`` id is dropped too)."""
    return df.filter(F.get_json_object(F.col(payload), id_path).isNotNull())


def _parsed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Raw columns with the typed document ``_d``; ``_d._bad`` is set where a value does not parse.

    The document is parsed by a generator of one row: filters on its fields stay above it,
    where a projection would have them pushed down with a copy of the parser each.
    """
    doc = F.from_json(F.col("payload"), T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]),
                      {**JSON_OPTIONS, "columnNameOfCorruptRecord": "_bad"})
    return raw.select("*", F.explode(F.array(doc)).alias("_d"))


def stage_activities(raw: DataFrame, min_start: str | None = "2024-01-01",
                     schema: T.StructType = ACTIVITY_DOC) -> DataFrame:
    """Typed flat projection of the raw activity documents.

    One ``from_json`` per row replaces one JSON lookup per field; missing keys
    and JSON nulls become NULL. A document with a value that does not parse, or
    without an id, is not staged: :func:`stage_rejects` has it, field by field.
    Unit conversions: km = m / 1000, minutes = seconds / 60, km/h = m/s * 3.6.
    ``min_start`` keeps activities that start on or after that day, written as
    a range on the timestamp so it can reach the scan, instead of
    ``year(ts) >= y``.
    """
    parsed = _parsed(raw, schema).filter(F.col("_d").isNotNull() & F.col("_d._bad").isNull()
                                         & F.col("_d.id").isNotNull())
    return _staged(parsed, min_start)


def _staged(parsed: DataFrame, min_start: str | None) -> DataFrame:
    """The flat projection of parsed documents."""
    out = parsed.select(
        "activity_id", "athlete_id",
        F.col("_d.start_date").alias("start_date_utc"),
        "extracted_at_utc",
        *[F.col(f"_d.{src}").alias(dst) for dst, src in STAGED_FIELDS if dst != "start_date_utc"],
    )
    out = (out.withColumn("distance_km", F.col("distance_m") / F.lit(1000))
              .withColumn("moving_time_min", F.col("moving_time_s").cast("double") / F.lit(60))
              .withColumn("avg_speed_kmh", F.col("avg_speed_mps") * F.lit(3.6)))
    if min_start is not None:
        out = out.filter(F.col("start_date_utc") >= F.lit(min_start).cast("timestamp"))
    return out


def stage_rejects(raw: DataFrame, schema: T.StructType = ACTIVITY_DOC) -> DataFrame:
    """What staging left out: ``(activity_id, athlete_id, field, raw_text)``.

    One row per value that is present but does not parse to its type, one with
    field ``id`` for a document whose id is missing or null, one with field ``$``
    and the whole text for a payload that is no JSON object. Only documents that
    the typed parse flags are looked at again.
    """
    suspect = _parsed(raw, schema).filter(_suspect())
    texts = suspect.withColumn("_t", _texts())
    each = F.explode(_rejected(schema))
    return texts.select("activity_id", "athlete_id", each.alias("r")).select("activity_id", "athlete_id", "r.*")


def _suspect() -> Column:
    """A parsed document (see :func:`_parsed`) that is not staged."""
    return F.col("_d").isNull() | F.col("_d._bad").isNotNull() | F.col("_d.id").isNull()


def _texts() -> Column:
    return F.from_json("payload", T.MapType(T.StringType(), T.StringType()))


def _rejected(schema: T.StructType) -> Column:
    """The rejected values of a suspect document with its texts ``_t``: array of (field, raw_text)."""
    fields = []
    for f in schema.fields:
        text = F.try_element_at("_t", F.lit(f.name))
        bad = text.isNotNull() & F.col(f"_d.{f.name}").isNull()
        if f.name == "id":
            bad = F.col("_t").isNotNull() & F.col("_d.id").isNull()
        fields.append(F.when(bad, F.struct(F.lit(f.name).alias("field"), text.alias("raw_text"))))
    whole = F.when(F.col("_t").isNull(), F.struct(F.lit("$").alias("field"), F.col("payload").alias("raw_text")))
    return F.array_compact(F.array(*fields, whole))


class RejectedRowsError(RuntimeError):
    pass


def require_clean(rejects: DataFrame, most: int = 0) -> DataFrame:
    """Fail loudly when more than ``most`` values were rejected; names the fields."""
    by_field = {r["field"]: r["n"] for r in rejects.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(by_field.values()) > most:
        raise RejectedRowsError(f"rejected values by field: {by_field}")
    return rejects


def parse_audit(raw: DataFrame, schema: T.StructType = ACTIVITY_DOC) -> DataFrame:
    """Per field: how many documents have a value that staging rejects (zero rows included)."""
    names = raw.sparkSession.createDataFrame([(f.name,) for f in schema.fields] + [("$",)], "field string")
    counts = stage_rejects(raw, schema).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, "field", "left").select(
        "field", F.coalesce("n", F.lit(0)).cast("long").alias("bad_values"))


def serialize_record(*cols) -> Column:
    """A record as JSON text with its null fields written out."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("extracted_at_utc", T.StringType()),
    T.StructField("activities", T.ArrayType(T.StringType())),
])


def snapshot_roots(spark: SparkSession, path: str, name_pattern: str, latest_only: bool) -> list[str]:
    """The files or folders of the chosen snapshots, from the listing alone; raises when there is none."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select(F.regexp_extract("path", f"^.*?({name_pattern})", 1).alias("name"),
                     F.regexp_extract("path", f"^(.*?{name_pattern}[^/]*)", 1).alias("root"))
             .filter("name <> ''"))                       # the listing alone: no content is read
    if latest_only:                                       # names are counted once each, the greatest is looked up
        newest = files.agg(F.max("name")).first()[0]
        files = files.filter(F.col("name") == F.lit(newest))
    roots = [r["root"] for r in files.select("root").distinct().collect()]
    if not roots:
        raise FileNotFoundError(f"no snapshot under {path}")
    return roots


def _snapshot_documents(spark: SparkSession, path: str, name_pattern: str, latest_only: bool) -> DataFrame:
    """(snapshot, text, doc): every document of the chosen snapshots.

    A file is read line by line, by as many tasks as it has splits, when each of its lines is
    one document; that is found in a first pass over the lines. Only a file whose one document
    spans lines is read as a whole.
    """
    roots = snapshot_roots(spark, path, name_pattern, latest_only)

    def text(**how) -> DataFrame:
        return spark.read.text(roots, recursiveFileLookup=True, **how).select(
            F.col("_metadata.file_path").alias("file"), "value")

    lines = text(lineSep="\n").withColumn("value", F.regexp_replace("value", r"\r\z", "")).filter(F.trim("value") != "")
    by_line = F.bool_and(F.trim("value").rlike(r"^\{.*\}$"))
    # only the names of files whose document spans lines come here, as the listing does
    spans = [r["file"] for r in lines.groupBy("file").agg(by_line.alias("by_line")).filter("not by_line").collect()]
    docs = lines
    if spans:
        docs = lines.filter(~F.col("file").isin(spans)).unionByName(text(wholetext=True).filter(F.col("file").isin(spans)))
    return docs.select(F.regexp_extract("file", name_pattern, 0).alias("snapshot"), F.col("value").alias("text"),
                       F.from_json("value", SNAPSHOT_SCHEMA).alias("doc"))


def read_snapshot(spark: SparkSession, path: str, name_pattern: str = r"activities_raw_[^/.]*",
                  latest_only: bool = True, key: str = "$.id") -> DataFrame:
    """Snapshot documents ``{"extracted_at_utc": ..., "activities": [...]}`` -> one row per activity.

    A file is one document (pretty-printed or not) or one per line; for one that fits no task
    there is ``snapshot_split``. Each activity
    object is read as its raw JSON text (a ``string`` field over a JSON object
    keeps the text verbatim, non-ASCII included). A snapshot is named by the
    ``activities_raw_<run>`` part of its path; with ``latest_only`` the listing
    decides on the greatest name and only its files are read. Raises when there
    is no snapshot. Records without an integer id and malformed documents are not
    returned: :func:`snapshot_rejects` has them.
    Returns ``(activity_id, extracted_at_utc, payload, snapshot)``.
    """
    docs = _snapshot_documents(spark, path, name_pattern, latest_only)
    act = docs.select("snapshot", "doc.extracted_at_utc", F.explode("doc.activities").alias("payload"))
    out = act.select(
        F.get_json_object(F.col("payload"), key).try_cast("long").alias("activity_id"),
        F.try_to_timestamp(F.col("extracted_at_utc")).alias("extracted_at_utc"),
        "payload", "snapshot")
    return out.filter(F.col("activity_id").isNotNull())


def snapshot_rejects(spark: SparkSession, path: str, name_pattern: str = r"activities_raw_[^/.]*",
                     latest_only: bool = True, key: str = "$.id") -> DataFrame:
    """What :func:`read_snapshot` leaves out: ``(snapshot, field, raw_text)``."""
    docs = _snapshot_documents(spark, path, name_pattern, latest_only)
    act = docs.select("snapshot", F.explode("doc.activities").alias("raw_text"))
    no_id = act.filter(F.get_json_object("raw_text", key).try_cast("long").isNull()).select(
        "snapshot", F.lit("id").alias("field"), "raw_text")
    broken = docs.filter(F.col("doc.activities").isNull()).select(
        "snapshot", F.lit("$").alias("field"), F.col("text").alias("raw_text"))
    return no_id.unionByName(broken)


def read_pages(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Union of landed page files under ``root`` (e.g. ``root/run=<n>/part-*.json``).

    Partition discovery turns ``key=value`` folder names into columns; every
    file is read in parallel (bag union of the pages). Pass ``schema`` so the
    documents are never inferred.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("basePath", root).json(root)


def active_entities(df: DataFrame, required: Sequence[str],
                    defaults: Mapping[str, object], casts: Mapping[str, str] | None = None) -> DataFrame:
    """Rows with all ``required`` columns present; NULLs elsewhere get defaults."""
    out = df
    for c in required:
        out = out.filter(F.col(c).isNotNull())
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    for c, t in (casts or {}).items():
        out = out.withColumn(c, F.col(c).cast(t))
    return out


def stale_flag(token: Column, expires_at_epoch: Column, as_of_epoch: int) -> Column:
    """True when the credential is empty or ``as_of >= expires_at``."""
    return (token == F.lit("")) | (F.lit(as_of_epoch) >= expires_at_epoch)


def load_audit(fetched: DataFrame, loaded: DataFrame, entity: str,
               entities: DataFrame | None = None, rejects: DataFrame | None = None) -> DataFrame:
    """Per entity: fetched rows, upserted rows, rejected values, whether it is listed, ok flag.

    All sides are counted with grouped aggregates (partial counts before the
    shuffle) and joined in full: a listed entity with nothing fetched appears
    with zeros, and one that is loaded but not listed appears as not listed.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(entity).agg(F.count(F.lit(1)).alias(name))

    out = counted(fetched, "fetched").join(counted(loaded, "upserted"), entity, "full_outer")
    out = out.join(counted(rejects, "errors"), entity, "full_outer") if rejects is not None \
        else out.withColumn("errors", F.lit(0))
    listed = F.lit(True)
    if entities is not None:
        out = out.join(entities.select(entity, F.lit(True).alias("_listed")), entity, "full_outer")
        listed = F.coalesce("_listed", F.lit(False))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("fetched", "upserted", "errors")]
    return out.select(entity, *counts, listed.alias("listed")).withColumn(
        "ok", (F.col("upserted") > 0) & (F.col("errors") == 0))


def audited(raw: DataFrame, schema: T.StructType = ACTIVITY_DOC) -> DataFrame:
    """Parsed raw rows, each with ``_ok`` (it is staged) and ``_errors`` (its rejected values)."""
    p = _parsed(raw, schema).withColumn("_ok", ~_suspect())
    p = p.withColumn("_t", F.when(~F.col("_ok"), _texts()))
    return p.withColumn("_errors", F.when(F.col("_ok"), 0).otherwise(F.size(_rejected(schema)))).drop("_t")


def audit_landing(raw: DataFrame, entity: str, entities: DataFrame | None = None,
                  schema: T.StructType = ACTIVITY_DOC) -> DataFrame:
    """:func:`load_audit` of a landing table in one pass: each document is read and parsed once and
    counted as fetched, loaded or rejected, with partial counts before the one shuffle."""
    out = audited(raw, schema).groupBy(entity).agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if("_ok").alias("upserted"), F.sum("_errors").alias("errors"))
    listed = F.lit(True)
    if entities is not None:
        out = out.join(entities.select(entity, F.lit(True).alias("_listed")), entity, "full_outer")
        listed = F.coalesce("_listed", F.lit(False))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("fetched", "upserted", "errors")]
    return out.select(entity, *counts, listed.alias("listed")).withColumn(
        "ok", (F.col("upserted") > 0) & (F.col("errors") == 0))


def load_staged(raw: DataFrame, path: str, min_start: str | None = None,
                schema: T.StructType = ACTIVITY_DOC) -> dict:
    """Stage a landing table into ``path``; the write itself counts what it sees.

    Returns ``fetched``, ``upserted`` (staged and written) and ``errors`` (rejected values),
    observed on the rows as they pass: nothing is read again. Raises when nothing was staged.
    """
    seen, kept = Observation(), Observation()
    p = audited(raw, schema).observe(seen, F.count(F.lit(1)).alias("fetched"),
                                     F.coalesce(F.sum("_errors"), F.lit(0)).alias("errors"))
    staged = _staged(p.filter("_ok"), min_start).observe(kept, F.count(F.lit(1)).alias("upserted"))
    staged.write.mode("overwrite").parquet(path)
    totals = {**seen.get, **kept.get}
    if not totals["upserted"]:
        raise EmptyLoadError(f"no rows were loaded: {totals}")
    return totals


class EmptyLoadError(RuntimeError):
    pass


def require_loaded(audit: DataFrame) -> dict:
    """Totals of an audit; raises when no entity is listed or no row was loaded."""
    t = audit.agg(F.count_if("listed").alias("entities"), F.sum("fetched").alias("fetched"),
                  F.sum("upserted").alias("upserted"), F.sum("errors").alias("errors"),
                  F.count_if(~F.col("ok")).alias("not_ok")).first().asDict()
    t = {k: v or 0 for k, v in t.items()}
    if not t["entities"]:
        raise EmptyLoadError("no entities to load")
    if not t["upserted"]:
        raise EmptyLoadError(f"no rows were loaded: {t}")
    return t
