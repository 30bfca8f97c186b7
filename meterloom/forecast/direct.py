"""Direct multi-horizon forecasts: all of the next 96 slots from one row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.config import SLOTS_PER_DAY
from meterloom.forecast.boosting import BoostedTrees, Boosting, fit_boosted
from meterloom.forecast.leastsquares import column_means, solve, summed_products
from meterloom.forecast.models import fit_one_step, score
from meterloom.forecast.recursive import LinearStep
from meterloom.operators.lags import horizon_rows
from meterloom.session import Shared

KEY = ("series_id", "ts")


@dataclass(frozen=True)
class DirectLinear:
    """One linear model per horizon; missing features count as their training mean."""

    features: tuple[str, ...]
    fill: dict[str, float]
    weights: np.ndarray  # (1 + features) x horizons, intercept first

    def inputs(self):
        return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(self.fill[c])) for c in self.features])

    def forecast(self, x: np.ndarray) -> np.ndarray:
        """Forecasts (rows x horizons) from features (rows x features, NaN if missing)."""
        means = np.array([self.fill[c] for c in self.features])
        return np.where(np.isnan(x), means, x) @ self.weights[1:] + self.weights[0]

    def changed(self, x: np.ndarray, known: np.ndarray, i: int, values: np.ndarray) -> np.ndarray:
        """The forecasts if feature ``i`` had other values; ``known`` are those of ``x``."""
        old, new = (np.where(np.isnan(v), self.fill[self.features[i]], v) for v in (x[:, i], values))
        return known + np.outer(new - old, self.weights[i + 1])

    def shared(self, spark: SparkSession) -> Shared:
        """Broadcast; its size is that of the feature list times the horizons."""
        return Shared(spark, self)

    def predict(self, df: DataFrame, name: str = "forecasts") -> DataFrame:
        """Add the array of forecasts for all horizons."""
        weights = self.weights

        @F.pandas_udf("array<double>")
        def apply(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(np.vstack(x.to_numpy()) @ weights[1:] + weights[0]))

        return df.withColumn(name, apply(self.inputs()))


def one_horizon(step: LinearStep) -> DirectLinear:
    """A linear one-step model as the model of a single horizon."""
    weights = np.array([step.intercept, *step.weights.values()], float)[:, None]
    return DirectLinear(tuple(step.features), {c: float(step.fill.get(c, 0.0)) for c in step.features}, weights)


def fit_direct_linear(
    train: DataFrame, features: Sequence[str], *, horizon: int = SLOTS_PER_DAY
) -> DirectLinear:
    """Independent least-squares models of all horizons from one pass over the rows.

    ``train`` has the ``targets`` array of ``horizon_targets``.
    """
    fill = column_means(train, features)
    empty = DirectLinear(tuple(features), fill, np.zeros((len(features) + 1, horizon)))
    data = train.select(empty.inputs().alias("x"), F.col("targets").alias("y"))
    sums = summed_products(data, "x", "y", len(features), horizon)
    return DirectLinear(tuple(features), fill, solve(sums))


def normal_equations(rows: DataFrame, fitted: DirectLinear) -> list[tuple[int, int, float, float]]:
    """``(h, rows, mean forecast, slope left)`` of each horizon, from one pass over the rows the models were fitted on.

    The slope left is the largest correlation of the errors with a feature, in units of the target: zero
    at the least squares. One row a horizon, whatever the number of rows.
    """
    error = F.zip_with("targets", "forecasts", lambda y, yhat: y - yhat)
    both = fitted.predict(rows).select(fitted.inputs().alias("x"), F.concat(error, "forecasts").alias("y"))
    horizon, p = fitted.weights.shape[1], len(fitted.features) + 1
    sums = summed_products(both, "x", "y", p - 1, 2 * horizon)
    n, size = sums[0, 0], np.sqrt(np.maximum(np.diag(sums[:, :p]), 1e-300))
    left = np.abs(sums[:, p : p + horizon] / size[:, None]).max(0) / np.sqrt(n)
    means = sums[0, p + horizon :] / n
    return [(h + 1, int(n), float(means[h]), float(left[h])) for h in range(horizon)]


def fit_direct_pooled(
    train: DataFrame, features: Sequence[str], model: str | Estimator = "gbt", **settings
) -> PipelineModel:
    """One model for all horizons, with the horizon ``h`` as a further feature."""
    long = horizon_rows(train.select(*KEY, *features, "targets"))
    return fit_one_step(long, [*features, "h"], model, target="y", **settings)


def fit_direct_each(train: DataFrame, features: Sequence[str], plan: Boosting = Boosting()) -> BoostedTrees:
    """One boosted model per horizon, all grown together from the same passes over the rows.

    ``train`` has the ``targets`` array of ``horizon_targets``; nothing is repeated for a horizon.
    """
    return fit_boosted(train, features, "targets", plan)


def paired(df: DataFrame, keep: Sequence[str] = KEY) -> DataFrame:
    """Long rows ``h, y, yhat`` from the arrays ``targets`` and ``forecasts``."""
    both = F.posexplode(F.arrays_zip("targets", "forecasts")).alias("_i", "_pair")
    return df.select(*keep, both).select(
        *keep,
        (F.col("_i") + 1).alias("h"),
        F.col("_pair.targets").alias("y"),
        F.col("_pair.forecasts").alias("yhat"),
    )


def predict_pooled(model: PipelineModel, df: DataFrame, keep: Sequence[str] = KEY) -> DataFrame:
    """Long rows ``h, y, yhat`` from the pooled model."""
    return score(model, horizon_rows(df)).select(*keep, "h", "y", "yhat")


def predict_each(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """Add the array of forecasts from one model per horizon, in one projection."""
    return model.predict(df)
