"""Forecast errors: global, per split and per day block."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.functions.numeric import SMALL, non_zero
from meterloom.operators.ranks import exact_quantiles

METRICS = ("mae", "rmse", "r2", "mape")
Scorer = Callable[[Column, Column], Column]


def mae(y: Column, yhat: Column) -> Column:
    return F.avg(F.abs(y - yhat))


def rmse(y: Column, yhat: Column) -> Column:
    return F.sqrt(F.avg((y - yhat) * (y - yhat)))


def r2(y: Column, yhat: Column) -> Column:
    """Share of variance explained; constant actuals score 1 if every error is 0, else 0."""
    pair = y.isNotNull() & yhat.isNotNull()
    n = F.count(F.when(pair, 1))
    left_over = F.sum((y - yhat) * (y - yhat))
    spread = F.var_pop(F.when(pair, y)) * n
    constant = F.when(left_over == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    value = F.when(spread == 0, constant).otherwise(1 - left_over / F.nullif(spread, F.lit(0.0)))
    return F.when(n >= 2, value)


def mape(y: Column, yhat: Column) -> Column:
    """Mean absolute percentage error; an actual of exactly zero counts as a small number."""
    return F.avg(F.abs((y - yhat) / non_zero(y))) * 100


def mape_floor(y: Column, yhat: Column) -> Column:
    """Second variant: actuals below a small positive number count as that number."""
    return F.avg(F.abs((y - yhat) / F.greatest(y, F.lit(SMALL)))) * 100


def bias(y: Column, yhat: Column) -> Column:
    return F.avg(yhat - y)


def neg_rmse(y: Column, yhat: Column) -> Column:
    return -rmse(y, yhat)


def neg_mae(y: Column, yhat: Column) -> Column:
    return -mae(y, yhat)


def regression_metrics(
    df: DataFrame, *, keys: Sequence[str] = (), y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """MAE, RMSE, R² and MAPE over all rows of a group, in one aggregate."""
    a, b = F.col(y), F.col(yhat)
    columns = [m(a, b).alias(n) for n, m in zip(METRICS, (mae, rmse, r2, mape))]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *columns)


def score_by(
    df: DataFrame, scorer: Scorer, keys: Sequence[str] = (), *, y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """Any aggregate of actual and forecast as ``score`` per group."""
    return df.groupBy(*keys).agg(scorer(F.col(y), F.col(yhat)).alias("score"))


def train_test_metrics(
    df: DataFrame, *, keys: Sequence[str] = (), y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """One row per group with ``<metric>_train`` and ``<metric>_test``."""
    columns = []
    for part in ("train", "test"):
        here = F.col("split") == part
        a, b = F.when(here, F.col(y)), F.when(here, F.col(yhat))
        columns += [
            m(a, b).alias(f"{n}_{part}") for n, m in zip(METRICS, (mae, rmse, r2, mape))
        ]
    return df.groupBy(*keys).agg(*columns)


def block_metrics(
    df: DataFrame,
    *,
    block: Sequence[str] = ("series_id", "origin"),
    max_missing: int | None = 4,
    min_used: int = 10,
    y: str = "y",
    yhat: str = "yhat",
) -> DataFrame:
    """Errors per forecast block, for blocks with few missing and enough usable actuals."""
    a, b = F.when(F.col(y).isNotNull(), F.col(y)), F.col(yhat)
    blocks = df.groupBy(*block).agg(
        F.count(y).alias("n_used"),
        F.count(F.when(F.col(y).isNull(), 1)).alias("_missing"),
        *[m(a, b).alias(n) for n, m in zip(METRICS, (mae, rmse, r2, mape))],
    )
    kept = blocks.where(F.col("n_used") >= min_used)
    if max_missing is not None:
        kept = kept.where(F.col("_missing") <= max_missing)
    return kept.drop("_missing")


def block_summary(blocks: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Number of blocks, mean of each error and median of the absolute error."""
    means = blocks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_blocks"), *[F.avg(m).alias(f"{m}_mean") for m in METRICS]
    )
    medians = exact_quantiles(blocks, "mae", {"mae_median": 0.5}, keys=keys).drop("n_values")
    if keys:
        return means.join(medians, list(keys), "left")
    one = F.lit(0).alias("_one")
    return means.select(one, "*").join(medians.select(one, "*"), "_one", "left").drop("_one")


def mean_block_rmse(blocks: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of the block RMSE as ``score``; null if no block is left."""
    return blocks.groupBy(*keys).agg(F.avg("rmse").alias("score"))


def best_model(comparison: DataFrame, *, keys: Sequence[str] = (), by: str = "rmse_test") -> DataFrame:
    """Name and error of the model with the smallest error; ties go to the first name."""
    best = F.min(F.struct(F.col(by), F.col("model"))).alias("_best")
    return comparison.groupBy(*keys).agg(best).select(
        *keys, F.col("_best.model").alias("model"), F.col(f"_best.{by}").alias(by)
    )
