"""Small tables from literals."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

ORIGIN = datetime(2024, 1, 1)


def stamp(minutes: float) -> datetime:
    return ORIGIN + timedelta(minutes=minutes)


def series(spark, rows, columns, series_id="a"):
    """Rows ``(minutes, …)`` as a table keyed by series and stamp."""
    data = [(series_id, stamp(r[0]).strftime("%Y-%m-%d %H:%M:%S"), *r[1:]) for r in rows]
    df = spark.createDataFrame(data, ", ".join(["series_id string", "ts string", *columns]))
    return df.withColumn("ts", F.to_timestamp("ts"))


def values(df, *cols):
    """Rows in key order as tuples."""
    rows = df.orderBy("series_id", "ts").select(*cols).collect()
    return [tuple(r) if len(cols) > 1 else r[0] for r in rows]
