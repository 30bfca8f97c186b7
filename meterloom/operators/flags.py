"""Flags for unusual slots: extreme weather, suspicious forecast errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.operators.ordering import KEYS, salted_join
from meterloom.operators.ranks import exact_quantiles


def extreme_flag(
    df: DataFrame,
    value: str,
    *,
    low: float = 0.01,
    high: float = 0.99,
    keys: Sequence[str] = KEYS,
    name: str = "is_extreme",
    ts: str = "ts",
) -> DataFrame:
    """1 where ``value`` lies outside the given quantiles of its series, 0 inside, null if unknown."""
    limits = exact_quantiles(df, value, {"_low": low, "_high": high}, keys=keys).drop("n_values")
    outside = (F.col(value) < F.col("_low")) | (F.col(value) > F.col("_high"))
    rows = salted_join(df, limits, keys, [ts], how="left")
    return rows.withColumn(name, outside.cast("int")).drop("_low", "_high")


def residual_anomalies(
    df: DataFrame,
    *,
    k: float = 3.0,
    keys: Sequence[str] = KEYS,
    y: str = "y",
    yhat: str = "yhat",
    ts: str = "ts",
) -> DataFrame:
    """Standardised forecast error ``z`` per series and a flag where it exceeds ``k`` deviations."""
    error = F.col(y) - F.col(yhat)
    spread = df.groupBy(*keys).agg(F.avg(error).alias("_mean"), F.stddev_pop(error).alias("_std"))
    rows = salted_join(df, spread, keys, [ts])
    z = (error - F.col("_mean")) / F.nullif("_std", F.lit(0.0))
    return (
        rows.withColumn("z", z)
        .withColumn("is_anomaly", (F.abs("z") > k).cast("int"))
        .drop("_mean", "_std")
    )
