"""Coarser grids: hourly means, local days, complete days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.config import LOCAL_TZ, SLOTS_PER_DAY, TARGET
from meterloom.functions.calendar import to_local
from meterloom.operators.ordering import KEYS


def between(ts: str, start: str, end: str) -> Column:
    """Closed time range; reaches the Parquet scan as a pushed filter."""
    return F.col(ts).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))


def whole_days(ts: str, first_day: str, last_day: str) -> Column:
    """UTC calendar days, both included."""
    start = F.lit(first_day).cast("timestamp")
    stop = F.lit(last_day).cast("timestamp") + F.expr("interval 1 day")
    return (F.col(ts) >= start) & (F.col(ts) < stop)


def at_local_midnight(ts: str = "ts", tz: str = LOCAL_TZ) -> Column:
    """True where the local clock shows 00:00."""
    local = to_local(ts, tz)
    return (F.hour(local) == 0) & (F.minute(local) == 0)


def hourly_mean(
    df: DataFrame, target: str = TARGET, *, keys: Sequence[str] = KEYS, ts: str = "ts"
) -> DataFrame:
    """Mean per hour; hours without a known value have no row."""
    return (
        df.groupBy(*keys, F.date_trunc("hour", ts).alias(ts))
        .agg(F.avg(target).alias(target))
        .where(F.col(target).isNotNull())
    )


def local_days(
    df: DataFrame,
    target: str = TARGET,
    how: str = "sum",
    *,
    tz: str = LOCAL_TZ,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
) -> DataFrame:
    """Local-day totals or means ``y`` per ``ds``, with the number of known slots."""
    if how not in ("sum", "mean"):
        raise ValueError(f"how must be 'sum' or 'mean', not {how!r}")
    value = F.coalesce(F.sum(target), F.lit(0.0)) if how == "sum" else F.avg(target)
    return df.groupBy(*keys, F.to_date(to_local(ts, tz)).alias("ds")).agg(
        value.alias("y"), F.count(target).alias("n_slots")
    )


def complete_days(days: DataFrame, slots: int = SLOTS_PER_DAY) -> DataFrame:
    """Days with exactly ``slots`` known values: the two clock-change days drop out."""
    return days.where((F.col("n_slots") == slots) & F.col("y").isNotNull())
