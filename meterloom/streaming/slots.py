"""Hours and days of a stream of load rows.

A slot of the stream (an hour) is held in state as a sum and two counts, one row for each
series, and written once: when the latest stamp seen lies ``delay`` past its end. Hourly means
and local-day totals are read from the written slots, so no row is read a second time.

A row that comes after its slot was written is late: it changes nothing. Slots that are not
closed yet stay in the checkpoint and are written by a later run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterloom.config import LOCAL_TZ, TARGET
from meterloom.functions.calendar import to_local
from meterloom.operators.ordering import KEYS


def slot_sums(
    rows: DataFrame,
    target: str = TARGET,
    *,
    slot: str = "1 hour",
    delay: str = "2 hours",
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
) -> DataFrame:
    """``total``, ``n_known`` and ``n_rows`` of every slot; ``ts`` is its start. Rows without a stamp have no slot.

    Of a stream only closed slots come out. On a stored table the delay plays no part.
    """
    slots = rows.withWatermark(ts, delay).groupBy(*keys, F.window(ts, slot).alias("_slot"))
    sums = slots.agg(
        F.sum(F.col(target).cast("double")).alias("total"),
        F.count(target).alias("n_known"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return sums.select(*keys, F.col("_slot.start").alias(ts), "total", "n_known", "n_rows")


def write_closed(sums: DataFrame, path: str, **trigger) -> StreamingQuery:
    """Start writing the closed slots of ``slot_sums`` under ``path``, each one once.

    ``path`` also holds the checkpoint, so the next run goes on where this one ended, also after
    a failure. By default the run ends when it has read what is there; ``processingTime="1 minute"``
    keeps it going. One run at a time may use a path.
    """
    sink = sums.writeStream.format("parquet").outputMode("append").option("path", f"{path}/slots")
    return sink.option("checkpointLocation", f"{path}/checkpoint").trigger(**trigger or {"availableNow": True}).start()


def read_closed(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The slots written so far; ``like`` has their columns (none closed: no rows)."""
    return spark.read.schema(like.schema).parquet(f"{path}/slots")


def hourly_means(slots: DataFrame, target: str = TARGET, *, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """Mean of every slot with a known value, as ``resample.hourly_mean`` has it."""
    known = slots.where(F.col("n_known") > 0)
    return known.select(*keys, ts, (F.col("total") / F.col("n_known")).alias(target))


def day_totals(
    slots: DataFrame, how: str = "sum", *, tz: str = LOCAL_TZ, keys: Sequence[str] = KEYS, ts: str = "ts"
) -> DataFrame:
    """Local-day totals or means ``y`` and known values ``n_slots``, as ``resample.local_days`` has them.

    Local midnight must fall between two slots, as it does with hours where the zone's offset is whole hours.
    """
    if how not in ("sum", "mean"):
        raise ValueError(f"how must be 'sum' or 'mean', not {how!r}")
    total, known = F.sum("total"), F.sum("n_known")
    value = F.coalesce(total, F.lit(0.0)) if how == "sum" else total / F.nullif(known, F.lit(0))
    return slots.groupBy(*keys, F.to_date(to_local(ts, tz)).alias("ds")).agg(value.alias("y"), known.alias("n_slots"))
