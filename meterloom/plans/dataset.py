"""Feature table to modelling data: period, cyclic columns, feature list, split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.config import DatasetConfig, Selection
from meterloom.functions.calendar import add_cyclic
from meterloom.operators.align import as_utc
from meterloom.operators.ordering import CHUNK, chunked, with_position
from meterloom.operators.resample import between
from meterloom.operators.split import with_split
from meterloom.sources.readers import read_features
from meterloom.sources.writers import MONTH, MONTH_FORMAT


@dataclass(frozen=True)
class Group:
    """A feature group: named columns, or all columns with a suffix."""

    name: str
    columns: tuple[str, ...] = ()
    suffix: str | None = None

    def members(self, available: Sequence[str]) -> list[str]:
        if self.suffix:
            return [c for c in available if c.endswith(self.suffix)]
        return [c for c in self.columns if c in available]


# Feature groups in model order.
GROUPS = (
    Group(
        "calendar",
        (
            "month_sin", "month_cos",
            "weekday_sin", "weekday_cos",
            "hour_sin", "hour_cos",
            "day_of_year_sin", "day_of_year_cos",
            "week", "is_workday", "is_sunday",
        ),
    ),
    Group(
        "lags",
        (
            "lag_15m", "lag_30m", "lag_1h", "lag_24h",
            "base_customers_lag_15m", "free_customers_lag_15m", "diff_15m",
        ),
    ),
    Group("weather", suffix="_lag15"),
)


@dataclass(frozen=True)
class Dataset:
    """Modelling rows with ``pos``, ``n_rows`` and ``split``, and the feature names."""

    rows: DataFrame
    features: list[str]
    cfg: DatasetConfig

    @property
    def train(self) -> DataFrame:
        return self.rows.where(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.rows.where(F.col("split") == "test")


def feature_list(columns: Sequence[str], selection: Selection) -> list[str]:
    """Columns of the selected groups that the table has, in group order."""
    members = (c for g in GROUPS if g.name in selection.groups for c in g.members(columns))
    return [c for c in members if c not in selection.without]


def with_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Add every absent feature as a null, so that a stored model can score the table."""
    absent = [c for c in features if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else df


def model_rows(features: DataFrame, cfg: DatasetConfig, extra: tuple[str, ...] = ()) -> Dataset:
    """Add cyclic columns, choose features, number and split the rows (of the period, if one is given).

    Only key, target, chosen features and ``extra`` columns go on.
    """
    kept = features.withColumn("ts", as_utc("ts"))
    if cfg.period:
        kept = in_period(kept, *cfg.period)
    encoded = add_cyclic(kept.drop(MONTH))
    names = feature_list(encoded.columns, cfg.selection)
    narrow = encoded.select(
        "series_id", "ts", F.col(cfg.target).cast("double").alias(cfg.target),
        *[c for c in extra if c not in names], *names,
    )
    rows = with_split(with_position(chunked(narrow)), cfg.test_size).drop(CHUNK)
    return Dataset(rows, names, cfg)


def in_period(features: DataFrame, first: str, last: str) -> DataFrame:
    """Rows from the first to the last stamp; the months of a stored table prune its folders."""
    if MONTH in features.columns:
        months = [F.date_format(F.lit(x).cast("timestamp"), MONTH_FORMAT) for x in (first, last)]
        features = features.where(F.col(MONTH).between(*months))
    return features.where(between("ts", first, last))


def load_and_split(
    spark: SparkSession, path: str, cfg: DatasetConfig | None = None
) -> Dataset:
    """Stored feature table to training and test rows."""
    return model_rows(read_features(spark, path), cfg or DatasetConfig())
