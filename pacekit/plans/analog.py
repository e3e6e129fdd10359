"""Adapters from the driver tables to the activity data model.

The driver ships TPC-H-like tables plus an ``events`` stream. These functions
derive the inputs the pipeline expects, with plain column expressions:

* ``landed_activities(events)`` - the raw landing table
  ``(athlete_id, activity_id, extracted_at_utc, payload JSON)``: one JSON
  activity document per event (``user_id`` is the athlete, ``event_id`` the
  activity, ``event_type`` the activity type, ``value`` the distance in km).
* ``threshold_tests(customer)`` - threshold (FTP) tests: every customer with a
  non-negative balance tested on 2024-01-03; those with a balance of at least
  4500 retested between 2024-01-14 and 2024-01-20. Customers with a negative
  balance never tested, so some athletes have no threshold.
* ``athlete_history(customer)`` - the athlete table as a version history: one
  row per customer added 2024-01-01, and a second version (new max heart rate)
  on 2024-01-15 for the 'BUILDING' segment.

Every derived value is a deterministic function of the row, so the same rules
written in SQL give the same tables (see ``pacekit.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacekit.functions.metrics import round_half_up

RUN_TS = "2024-02-01 00:00:00"      # the one UTC run timestamp of the load
AS_OF = "2024-01-31"                 # "current_date" of the mart, a parameter
MIN_START = "2024-01-01"             # staging keeps activities from this day on
RIDE_TYPE = "purchase"               # the event type that plays the ride type

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scan of fewer splits than there are cores, dealt out by ``key``; any other as it is.

    The driver's tables are one file of one row group: one task, however many cores. A
    table of many files has splits enough, and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if splits >= cores else df.repartition(cores, key)


def landed_activities(events: DataFrame, extracted_at: str = RUN_TS, also: dict | None = None) -> DataFrame:
    """The raw landing rows; ``also`` adds columns of ``events`` by name."""
    eid = F.col("event_id")
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    moving = F.lit(600) + eid % 5400
    dist_m = F.col("value") * F.lit(1000)
    power = F.lit(100) + (eid * 7) % 120
    np_ = F.when(eid % 11 == 0, F.lit(None)).otherwise(F.lit(105) + (eid * 7) % 120)
    hr = F.when(eid % 13 == 0, F.lit(None)).otherwise(F.lit(85) + k)
    doc = F.struct(
        eid.alias("id"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("start_date"),
        F.concat(F.lit("ride "), eid.cast("string")).alias("name"),
        F.col("event_type").alias("type"),
        F.upper(F.col("event_type")).alias("sport_type"),
        dist_m.alias("distance"),
        moving.alias("moving_time"),
        (moving + 60).alias("elapsed_time"),
        (F.col("value") * F.lit(10)).alias("total_elevation_gain"),
        (dist_m / moving).alias("average_speed"),
        (dist_m / moving * F.lit(1.5)).alias("max_speed"),
        power.alias("average_watts"),
        (power + 200).alias("max_watts"),
        (power * moving / F.lit(1000.0)).alias("kilojoules"),
        np_.alias("weighted_average_watts"),
        (F.lit(80) + eid % 15).alias("average_cadence"),
        hr.alias("average_heartrate"),
        (hr + 25).alias("max_heartrate"),
    )
    return events.select(
        F.col("user_id").alias("athlete_id"),
        eid.alias("activity_id"),
        F.lit(extracted_at).cast("timestamp").alias("extracted_at_utc"),
        F.to_json(doc).alias("payload"),
        *[c.alias(n) for n, c in (also or {}).items()],
    )


def staged_activities(events: DataFrame, extracted_at: str = RUN_TS,
                      min_start: str | None = MIN_START) -> DataFrame:
    """The typed staging rows of the same activities, column by column.

    Equal to ``ingest.stage_activities(landed_activities(events))`` (tested);
    models read this form, so their scans are pruned to the columns they use.
    """
    eid = F.col("event_id")
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    moving = (F.lit(600) + eid % 5400).cast("int")
    dist_m = F.col("value") * F.lit(1000)
    power = (F.lit(100) + (eid * 7) % 120).cast("double")
    np_ = F.when(eid % 11 == 0, F.lit(None)).otherwise(F.lit(105) + (eid * 7) % 120).cast("double")
    hr = F.when(eid % 13 == 0, F.lit(None)).otherwise(F.lit(85) + k).cast("double")
    start = F.col("ts").cast("timestamp")
    rows = events if min_start is None else events.filter(
        F.col("ts") >= F.lit(min_start).cast("timestamp_ntz"))
    return rows.select(
        eid.alias("activity_id"), F.col("user_id").alias("athlete_id"), start.alias("start_date_utc"),
        F.lit(extracted_at).cast("timestamp").alias("extracted_at_utc"),
        F.concat(F.lit("ride "), eid.cast("string")).alias("activity_name"),
        F.col("event_type").alias("activity_type"), F.upper(F.col("event_type")).alias("sport_type"),
        dist_m.alias("distance_m"), moving.alias("moving_time_s"), (moving + 60).alias("elapsed_time_s"),
        (F.col("value") * F.lit(10)).alias("elevation_m"), (dist_m / moving).alias("avg_speed_mps"),
        (dist_m / moving * F.lit(1.5)).alias("max_speed_mps"), power.alias("avg_power_w"),
        (power + 200).alias("max_power_w"), (power * moving / F.lit(1000.0)).alias("kilojoules"),
        np_.alias("weighted_average_watts"), (F.lit(80) + eid % 15).cast("double").alias("average_cadence"),
        hr.alias("avg_hr"), (hr + 25).alias("max_hr"),
        (dist_m / F.lit(1000)).alias("distance_km"), (moving.cast("double") / F.lit(60)).alias("moving_time_min"),
        (dist_m / moving * F.lit(3.6)).alias("avg_speed_kmh"))


def dirty_activities(events: DataFrame) -> DataFrame:
    """The landing table with values that do not parse: every 17th start date, every 19th
    moving time (``n.0`` in an integer field), every 23rd id null, every 29th payload cut off."""
    eid, p = F.col("activity_id"), F.col("payload")
    bad = (F.when(eid % 29 == 0, F.substring(p, 1, 20))
           .when(eid % 23 == 0, F.regexp_replace(p, r'"id":\d+', '"id":null'))
           .when(eid % 19 == 0, F.regexp_replace(p, r'"moving_time":(\d+)', '"moving_time":$1.0'))
           .when(eid % 17 == 0, F.regexp_replace(p, r'"start_date":"[^"]*"', '"start_date":"soon"'))
           .otherwise(p))
    return landed_activities(events).withColumn("payload", bad)


def threshold_tests(customer: DataFrame) -> DataFrame:
    c = customer.filter(F.col("c_acctbal") >= 0)
    key = F.col("c_custkey")
    weight = F.lit(55) + key % 30

    def one(n: int, frame: DataFrame, test_date, test_type: str) -> DataFrame:
        watts = (F.lit(130) + (key * 3 + n * 9) % 70).cast("int")
        return frame.select(
            (key * 10 + n).cast("int").alias("ftp_id"),
            key.alias("athlete_id"),
            watts.alias("ftp_watts"),
            round_half_up(watts / weight, 2).alias("ftp_wkg"),
            test_date.alias("test_date"),
            F.lit(test_type).alias("test_type"),
        )

    first = one(0, c, F.lit("2024-01-03").cast("date"), "ramp")
    again = one(1, c.filter(F.col("c_acctbal") >= 4500),
                F.date_add(F.lit("2024-01-14").cast("date"), (F.col("c_nationkey") % 7).cast("int")),
                "20min")
    return first.unionByName(again)


def athlete_history(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")

    def version(frame: DataFrame, hr_base: int, added: str) -> DataFrame:
        return frame.select(
            key.alias("athlete_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            (F.lit(55) + key % 30).cast("double").alias("weight_kg"),
            (F.lit(hr_base) + key % 20).cast("int").alias("max_hr"),
            (F.lit(50) + key % 15).cast("int").alias("resting_hr"),
            F.lit(added).cast("date").alias("added_at"),
        )

    return version(customer, 175, "2024-01-01").unionByName(
        version(customer.filter(F.col("c_mktsegment") == "BUILDING"), 180, "2024-01-15"))
