"""Views of the supplied tables in the shape of the library's inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.calendar import calendar_parts, to_local


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slot(ts: Column, seconds: int) -> Column:
    """Start of the grid slot a stamp falls into."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / seconds) * seconds)


def money(c: Column) -> Column:
    """Exact decimal sum as a double, so that the order of addition does not matter."""
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def metered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as meter readings: each counts for its own series and for ``total``."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.explode(F.array(F.col("event_type"), F.lit("total"))).alias("series_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        "user_id",
        "value",
        "props",
    )


def load_table(spark: SparkSession, sf_dir: str, shift_days: int = 0) -> DataFrame:
    """Quarter-hour load: sums of values; small and large values form the customer groups."""
    readings = metered_events(spark, sf_dir)
    if shift_days:
        readings = readings.withColumn(
            "ts", F.col("ts") + F.make_dt_interval(F.lit(shift_days))
        )
    value = F.col("value")
    load = readings.groupBy("series_id", slot(F.col("ts"), 900).alias("ts")).agg(
        money(value).alias("load_kwh"),
        money(F.when(value < 50, value)).alias("base_customers"),
        money(F.when(value >= 50, value)).alias("free_customers"),
    )
    local = to_local("ts")
    return load.withColumns({n: c.cast("bigint") for n, c in calendar_parts(local).items()})


def weather_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ten-minute weather readings, with repeats across two files.

    Large values come from the later file, so it wins wherever both have a stamp.
    """
    readings = metered_events(spark, sf_dir)
    value = F.col("value")
    return readings.select(
        "series_id",
        slot(F.col("ts"), 600).alias("ts"),
        F.when(value >= 50, 1).otherwise(0).alias("file_no"),
        F.col("event_id").alias("row_no"),
        value.alias("temp_2m"),
        F.when(value >= 20, value * 2).alias("global_rad"),
        F.col("user_id").cast("double").alias("wind_scalar_ms"),
        F.col("props").alias("note"),
    )
