"""Daily baseline: trend, weekly and yearly seasonality and holidays, one model per series."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.forecast.leastsquares import products, solve_sparse
from meterloom.functions.calendar import EASTER_HOLIDAYS, FIXED_HOLIDAYS, holiday_flags
from meterloom.operators.ordering import KEYS, salted_join, with_position
from meterloom.operators.split import with_split


@dataclass(frozen=True)
class DailyModel:
    """Shape of the additive model and how strongly its parts are held back."""

    changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_scale: float = 0.05
    weekly_order: int = 3
    yearly_order: int = 10
    seasonality_scale: float = 10.0
    noise: float = 0.05

    @property
    def holidays(self) -> list[str]:
        return [*FIXED_HOLIDAYS, *EASTER_HOLIDAYS]

    @property
    def parts(self) -> dict[str, int]:
        """Number of columns of each component, in order."""
        return {
            "trend": 1 + self.changepoints,
            "weekly": 2 * self.weekly_order,
            "yearly": 2 * self.yearly_order,
            "holidays": len(self.holidays),
        }

    @property
    def ridge(self) -> np.ndarray:
        """Penalty of squares per column for a target scaled to at most 1; none on the trend."""
        other = (self.noise / self.seasonality_scale) ** 2
        trend = self.parts["trend"]
        return np.array([0.0] * trend + [other] * (sum(self.parts.values()) - trend))

    @property
    def lasso(self) -> np.ndarray:
        """Penalty of absolute values per column: the trend changes at few of its points."""
        change = [0.0] + [self.noise**2 / self.changepoint_scale] * self.changepoints
        return np.array(change + [0.0] * (sum(self.parts.values()) - len(change)))

    def columns(self, ds: str = "ds") -> Column:
        """Model columns of a day; needs ``first_day`` and ``span`` (training days) of its series."""
        day = F.unix_date(ds)
        t = (day - F.unix_date("first_day")) / F.greatest(F.col("span"), F.lit(1))
        trend = [t.cast("double")] + [
            F.greatest(t - self.changepoint_range * i / self.changepoints, F.lit(0.0))
            for i in range(1, self.changepoints + 1)
        ]
        waves = []
        for order, period in ((self.weekly_order, 7.0), (self.yearly_order, 365.25)):
            for k in range(1, order + 1):
                angle = F.lit(2.0 * k) * F.pi() * day / F.lit(period)
                waves += [F.sin(angle), F.cos(angle)]
        flags = holiday_flags(ds)
        return F.array(*trend, *waves, *[flags[h].cast("double") for h in self.holidays])


def daily_frame(days: DataFrame, train_ratio: float = 0.7) -> DataFrame:
    """Daily rows with position and ``split``; days of one year make a chunk."""
    rows = days.select(*KEYS, "ds", "y").withColumn("_chunk", F.year("ds").cast("long"))
    numbered = with_position(rows.repartition(*KEYS, "_chunk"), order=("ds",))
    return with_split(numbered, 1 - train_ratio).drop("_chunk")


def fit_daily(frame: DataFrame, model: DailyModel) -> DataFrame:
    """Coefficients per series, fitted on its training days.

    Cross products are summed per series and year, then per series: no task
    sees more than the days of a year or the years of a series.
    """
    train = frame.where(F.col("split") == "train")
    spans = train.groupBy(*KEYS).agg(
        F.min("ds").alias("first_day"),
        (F.datediff(F.max("ds"), F.min("ds"))).alias("span"),
        F.max(F.abs("y")).alias("scale"),
    )
    rows = salted_join(train, spans, KEYS, ["ds"]).select(
        *KEYS,
        F.year("ds").alias("year"),
        model.columns().alias("x"),
        (F.col("y") / F.nullif("scale", F.lit(0.0))).alias("y"),
    )
    width = sum(model.parts.values())
    ridge, lasso = model.ridge, model.lasso

    def of_year(key, pdf: pd.DataFrame) -> pd.DataFrame:
        known = pdf.dropna(subset=["y"])
        if not len(known):
            return pd.DataFrame({"series_id": [], "sums": []})
        sums = products(np.vstack(known["x"].to_numpy()), known["y"].to_numpy()[:, None])
        return pd.DataFrame({"series_id": [key[0]], "sums": [sums.ravel()]})

    def of_series(key, pdf: pd.DataFrame) -> pd.DataFrame:
        sums = np.sum(np.vstack(pdf["sums"].to_numpy()), axis=0).reshape(width + 1, width + 2)
        return pd.DataFrame({"series_id": [key[0]], "weights": [solve_sparse(sums, ridge, lasso)]})

    yearly = rows.groupBy(*KEYS, "year").applyInPandas(of_year, "series_id string, sums array<double>")
    weights = yearly.groupBy(*KEYS).applyInPandas(of_series, "series_id string, weights array<double>")
    return weights.join(spans, list(KEYS))


def predict_daily(frame: DataFrame, fitted: DataFrame, model: DailyModel) -> DataFrame:
    """Days with ``yhat`` and its components ``trend, weekly, yearly, holidays``."""
    rows = salted_join(frame, fitted, KEYS, ["ds"]).withColumn("_x", model.columns())

    def add(a: Column, b: Column) -> Column:
        return a + b

    columns, start = {}, 1
    for name, width in model.parts.items():
        x, w = F.slice("_x", start, width), F.slice("weights", start + 1, width)
        part = F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), add)
        if name == "trend":
            part = part + F.element_at("weights", 1)
        columns[name] = part * F.col("scale")
        start += width
    out = rows.withColumns(columns)
    total = sum((F.col(n) for n in model.parts), F.lit(0.0))
    return out.withColumn("yhat", total).select(
        *frame.columns, *model.parts, "yhat"
    )


def gradient(frame: DataFrame, fitted: DataFrame, model: DailyModel) -> DataFrame:
    """Per series and column (0 is the intercept) the least slope of half the penalised squares per training day.

    Zero where the fit is the best one: a column with a lasso that is not in use may pull with
    its penalty in either direction.
    """
    train = frame.where((F.col("split") == "train") & F.col("y").isNotNull())
    rows = salted_join(train, fitted, KEYS, ["ds"])
    rows = rows.withColumn("_x", F.concat(F.array(F.lit(1.0)), model.columns()))
    guess = F.aggregate(F.zip_with("_x", "weights", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    miss = F.col("y") / F.col("scale") - guess
    terms = rows.select(*KEYS, "weights", miss.alias("_miss"), F.posexplode("_x").alias("column", "_value"))
    sums = terms.groupBy(*KEYS, "column", "weights").agg(
        F.sum(F.col("_miss") * F.col("_value")).alias("_sum"), F.count(F.lit(1)).alias("_days")
    )
    ridge = F.lit([0.0, *model.ridge.tolist()])
    weight = F.get("weights", F.col("column"))
    slope = F.col("_sum") - F.get(ridge, F.col("column")) * weight
    held = F.get(F.lit([0.0, *model.lasso.tolist()]), F.col("column"))
    idle = F.signum(slope) * F.greatest(F.abs(slope) - held, F.lit(0.0))
    left = F.when(weight == 0, idle).otherwise(slope - held * F.signum(weight))
    return sums.select(*KEYS, "column", (left / F.col("_days")).alias("gradient"))
