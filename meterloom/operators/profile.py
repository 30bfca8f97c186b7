"""Profiles, distributions and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.config import TARGET
from meterloom.functions.calendar import WEEKDAY_HEADERS
from meterloom.functions.numeric import with_inverse_normal
from meterloom.operators.ordering import KEYS, salted_join
from meterloom.operators.ranks import exact_quantiles, explode_ranks, value_ranks
from meterloom.session import stage


def daily_profile(
    df: DataFrame, target: str = TARGET, *, keys: Sequence[str] = KEYS, ts: str = "ts"
) -> DataFrame:
    """Mean per UTC hour of the day."""
    return df.groupBy(*keys, F.hour(ts).alias("hour")).agg(F.avg(target).alias("mean"))


def hour_weekday_pivot(
    df: DataFrame, target: str = TARGET, *, keys: Sequence[str] = KEYS, ts: str = "ts"
) -> DataFrame:
    """Mean per UTC hour (rows) and weekday (columns Monday to Sunday)."""
    day = F.weekday(ts)
    cells = [
        F.avg(F.when(day == i, F.col(target))).alias(name)
        for i, name in enumerate(WEEKDAY_HEADERS)
    ]
    return df.groupBy(*keys, F.hour(ts).alias("hour")).agg(*cells)


def box_stats(df: DataFrame, value: str = TARGET, *, keys: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and number of outliers per group.

    A whisker ends at the farthest value inside its fence, at least at the quartile.
    """
    known = stage(df.where(F.col(value).isNotNull()).select(*keys, value), "known")
    quartiles = exact_quantiles(known, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys=keys)
    rows = salted_join(known, quartiles, keys, [value])
    v = F.col(value)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    low, high = F.col("q1") - reach, F.col("q3") + reach
    box = rows.groupBy(*keys, "n_values", "q1", "median", "q3").agg(
        F.min(F.when(v >= low, v)).alias("_low"),
        F.max(F.when(v <= high, v)).alias("_high"),
        F.count(F.when((v < low) | (v > high), 1)).alias("n_outliers"),
    )
    return box.select(
        *keys,
        "n_values",
        "q1",
        "median",
        "q3",
        F.least("_low", "q1").alias("whisker_low"),
        F.greatest("_high", "q3").alias("whisker_high"),
        "n_outliers",
    )


def outliers(df: DataFrame, value: str, boxes: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the whiskers of their group."""
    fences = boxes.select(*keys, "whisker_low", "whisker_high")
    rows = salted_join(df, fences, keys, [value])
    beyond = (F.col(value) < F.col("whisker_low")) | (F.col(value) > F.col("whisker_high"))
    return rows.where(beyond).drop("whisker_low", "whisker_high")


def histogram(
    df: DataFrame, value: str = TARGET, bins: int = 100, *, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum, the last bin closed, empty bins kept."""
    known = df.where(F.col(value).isNotNull()).select(*keys, value)
    bounds = known.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    lo, width = F.col("_lo"), F.col("_hi") - F.col("_lo")

    def edge(i):
        return F.when(i >= bins, F.col("_hi")).otherwise(lo + i * (width / bins))

    rows = salted_join(known, bounds, keys, [value])
    v = F.col(value)
    guess = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - lo) / F.nullif(width, F.lit(0.0)) * bins), F.lit(bins - 1))
    )
    rows = rows.withColumn("_guess", guess.cast("int"))
    g = F.col("_guess")
    # Settle the last rounding bit against the printed edges.
    settled = (
        F.when(v < edge(g), g - 1).when((v >= edge(g + 1)) & (g < bins - 1), g + 1).otherwise(g)
    )
    counts = rows.groupBy(*keys, settled.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    grid = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    i = F.col("bin")
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        edge(i).alias("low"),
        edge(i + 1).alias("high"),
        F.coalesce("_n", F.lit(0)).alias("n_values"),
    )


def describe(df: DataFrame, cols: Sequence[str], *, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per series and column: count, nulls, mean, deviation, extremes and quartiles."""
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(keys), list(cols), "column", "value"
    )
    group = [*keys, "column"]
    simple = long.groupBy(*group).agg(
        F.count("value").alias("n_values"),
        F.count(F.when(F.col("value").isNull(), 1)).alias("n_null"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(
        long, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys=group
    ).drop("n_values")
    return simple.join(quartiles, group, "left")


def normal_qq(df: DataFrame, value: str = TARGET, *, keys: Sequence[str] = KEYS) -> DataFrame:
    """Ordered values against normal quantiles at Filliben's order-statistic medians."""
    rows = explode_ranks(value_ranks(df, value, keys=keys))
    n, i = F.col("n_values"), F.col("rank") + 1
    end = F.pow(F.lit(0.5), 1 / n)
    median = (
        F.when(i == n, end).when(i == 1, 1 - end).otherwise((i - 0.3175) / (n + 0.365))
    )
    return with_inverse_normal(rows, median, "theoretical").select(
        *keys, "rank", "theoretical", value
    )


def qq_line(points: DataFrame, value: str = TARGET, *, keys: Sequence[str] = KEYS) -> DataFrame:
    """Least-squares line through the Q-Q points and its correlation."""
    y, x = F.col(value), F.col("theoretical")
    return points.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.corr(y, x).alias("r"),
    )
