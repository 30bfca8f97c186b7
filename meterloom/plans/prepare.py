"""Raw load and weather tables to the feature table, as one lazily composed plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.config import PrepareConfig
from meterloom.functions.calendar import day_flags, local_parts
from meterloom.functions.numeric import try_double, try_long
from meterloom.operators.align import keep_last, regrid, time_axis, weather_slots
from meterloom.operators.fill import (
    chunk_neighbours,
    knot_carries,
    last_or_next,
    line_between,
)
from meterloom.operators.lags import load_features
from meterloom.operators.ordering import CHUNK, KEYS, chunk_carry


def clean_weather(weather: DataFrame, order: tuple[str, ...] = ("file_no", "row_no")) -> DataFrame:
    """Weather rows with a stamp, one per stamp: the row of the later file wins."""
    latest = keep_last(weather.where(F.col("ts").isNotNull()), order)
    return latest.drop(*order)


def merged_grid(load: DataFrame, weather: DataFrame | None, cfg: PrepareConfig) -> DataFrame:
    """Load and weather side by side on the full axis of the load, gaps as nulls.

    Measurements sit on equal stamps only; text comes from the nearest reading
    within the tolerance.  All parts share the (series, chunk) layout.
    """
    step = cfg.step_seconds
    grid = regrid(load, time_axis(load, step=step), step=step)
    if weather is None:
        return grid
    measured, text = weather_parts(weather, cfg)
    start = load.groupBy(*KEYS).agg(F.min("ts").alias("start"))
    slots = weather_slots(weather, start, measured, text, cfg.text_tolerance_seconds, step=step)
    return grid.join(slots, [*KEYS, CHUNK, "ts"], "left")


def weather_parts(weather: DataFrame, cfg: PrepareConfig) -> tuple[list[str], list[str]]:
    """Measurement columns and text columns of a weather table."""
    measured = [c for c in cfg.weather_columns if c in weather.columns]
    return measured, [c for c in weather.columns if c not in (*KEYS, "ts", *measured)]


def positioned_rows(grid: DataFrame, cfg: PrepareConfig, measured=(), text=()) -> DataFrame:
    """Grid rows with a known target: weather gaps filled over the full axis, positions counted.

    Filling and counting share one chunk summary and one pass.
    """
    filled = [*measured, *text]
    carry = chunk_carry(
        grid,
        sums={"_offset": F.count(cfg.target)},
        totals={"n_rows": F.count(cfg.target)},
        **knot_carries(filled),
    )
    by_time = Window.partitionBy(*KEYS, CHUNK).orderBy("ts")
    up = by_time.rowsBetween(Window.unboundedPreceding, 0)
    again = F.raise_error(F.concat(F.lit("repeated load key: "), F.concat_ws(" ", *KEYS, "ts"))).cast("bigint")
    number = F.when(F.lag("ts").over(by_time) == F.col("ts"), again).otherwise(F.count(cfg.target).over(up))
    found = (
        grid.withColumns({"_number": number} | chunk_neighbours(filled))
        .where(F.col(cfg.target).isNotNull())
        .join(carry, [*KEYS, CHUNK])
    )
    lines = {c: line_between(c) for c in measured} | {c: last_or_next(c) for c in text}
    return found.select(
        *[lines[c].alias(c) if c in lines else c for c in grid.columns],
        "n_rows",
        (F.col("_offset") + F.col("_number") - 1).alias("pos"),
    )


def typed(df: DataFrame, cfg: PrepareConfig, measured=()) -> DataFrame:
    """Coerce calendar columns to integers and quantities to doubles; bad text becomes null."""
    whole = [c for c in cfg.integer_columns if c in df.columns]
    doubles = [c for c in (cfg.target, *cfg.customer_columns, *measured) if c in df.columns]
    return df.withColumns({c: try_long(c) for c in whole} | {c: try_double(c) for c in doubles})


def prepare(
    load: DataFrame, weather: DataFrame | None = None, cfg: PrepareConfig | None = None
) -> DataFrame:
    """Feature table of every series.

    ``load``: ``series_id, ts``, target, customer groups and calendar columns,
    unique by key.  ``weather``: ``series_id, ts``, measurements and text
    columns, unique by key (see :func:`clean_weather`).  A repeated load key raises
    when the plan runs.  Both are read more than once, so a costly input should be
    staged first.
    """
    cfg = cfg or PrepareConfig()
    measured, text = weather_parts(weather, cfg) if weather is not None else ([], [])
    grid = merged_grid(load, weather, cfg)
    rows = typed(positioned_rows(grid, cfg, measured, text), cfg, measured)
    features = load_features(rows, cfg, measured)
    features = features.withColumns(local_parts("ts", cfg.local_tz) | day_flags("weekday"))
    return features.drop(*cfg.drop_columns, CHUNK, "pos", "n_rows")
