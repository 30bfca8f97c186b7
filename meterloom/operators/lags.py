"""Positional lags, leads and moving means.

Shifts count rows, not time: after a gap "96 rows ago" is earlier than 24 hours ago.
All functions expect the position column made by ``with_position``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.config import SLOTS_PER_DAY, PrepareConfig
from meterloom.operators.ordering import CHUNK_ROWS, KEYS, block_window, with_frames


def lagged(c: str, k: int, keys: Sequence[str] = KEYS) -> Column:
    """Value of ``c`` ``k`` rows earlier, over the blocks of ``with_frames``."""
    return F.lag(c, k).over(block_window(keys))


def add_lags(
    df: DataFrame, lags: Mapping[str, tuple[str, int]], *, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Add ``name -> (column, rows back)`` lag columns in one pass."""
    reach = max(k for _, k in lags.values())
    return with_frames(
        df, {name: lagged(c, k, keys) for name, (c, k) in lags.items()}, before=reach
    )


def load_features(
    df: DataFrame, cfg: PrepareConfig, weather: Sequence[str], *, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Load, customer and weather lags, the difference feature, without incomplete rows.

    ``df`` holds rows with a known target and their positions.  The rows without
    all target lags are exactly the first ``reach`` of a series.  Weather is
    shifted after those rows are gone, so the first row that stays has no
    weather.  The unshifted customer and weather columns are left out.
    """
    reach = max(k for _, k in cfg.target_lags)
    columns = {name: lagged(cfg.target, k, keys) for name, k in cfg.target_lags}
    columns |= {f"{c}_lag_15m": lagged(c, 1, keys) for c in cfg.customer_columns}
    first = F.col("pos") == reach
    columns |= {f"{c}_lag15": F.when(~first, lagged(c, 1, keys)) for c in weather}
    out = with_frames(df, columns, before=reach).where(F.col("pos") >= reach)
    return out.withColumn("diff_15m", F.col("lag_15m") - F.col("lag_30m")).drop(
        *cfg.customer_columns, *weather
    )


def horizon_targets(
    df: DataFrame,
    target: str,
    *,
    horizon: int = SLOTS_PER_DAY,
    keys: Sequence[str] = KEYS,
    name: str = "targets",
) -> DataFrame:
    """Array of the next ``horizon`` targets of every row that has all of them.

    Targets are known in all rows, so the last ``horizon`` rows of a series drop
    out; positions stay and ``n_rows`` counts the rows that are left.
    """
    ahead = F.collect_list(target).over(block_window(keys).rowsBetween(1, horizon))
    out = with_frames(df, {name: ahead}, after=horizon, size=CHUNK_ROWS)
    return out.where(F.size(name) == horizon).withColumn("n_rows", F.col("n_rows") - horizon)


def horizon_rows(df: DataFrame, *, name: str = "targets") -> DataFrame:
    """Long form of :func:`horizon_targets`: one row per horizon ``h`` (1 = next row)."""
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.posexplode(name).alias("_i", "y")).select(
        *rest, (F.col("_i") + 1).alias("h"), "y"
    )


def rolling_means(
    df: DataFrame, target: str, rows: Mapping[str, int], *, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Mean of the ``k`` rows before the current one (fewer at the start of a series)."""
    w = block_window(keys)
    return with_frames(
        df,
        {name: F.avg(target).over(w.rowsBetween(-k, -1)) for name, k in rows.items()},
        before=max(rows.values()),
    )


def every_nth(df: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """Keep positions 0, n, 2n, … of each series."""
    return df.where(F.col(pos) % n == 0)


def centred_mean(
    df: DataFrame, c: str, period: int, *, keys: Sequence[str] = KEYS, name: str = "trend"
) -> DataFrame:
    """Centred moving mean over ``period`` rows; null within half a period of either end.

    An even period uses one row more with half weight on both outer rows.
    """
    half = period // 2
    w = block_window(keys)
    left = F.avg(c).over(w.rowsBetween(-half, period - half - 1))
    if period % 2 == 0:
        right = F.avg(c).over(w.rowsBetween(-half + 1, half))
        mean = (left + right) / 2
    else:
        mean = left
    inside = (F.col("pos") >= half) & (F.col("pos") < F.col("n_rows") - half)
    return with_frames(df, {name: F.when(inside, mean)}, before=half, after=half)
