"""Gap filling: linear interpolation in time, forward and backward fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.config import STEP_SECONDS
from meterloom.operators.ordering import CHUNK, KEYS, chunk_carry, chunked


def knot(c: str, ts: str = "ts") -> Column:
    """Stamp and value where the value is known, else null."""
    return F.when(F.col(c).isNotNull(), F.struct(F.col(ts).alias("t"), F.col(c).alias("v")))


def knot_carries(cols: Sequence[str], ts: str = "ts") -> dict[str, dict[str, Column]]:
    """What chunks hand on to fill gaps: each chunk's last and first known values."""
    return {
        "last": {f"_before_{c}": F.max(knot(c, ts)) for c in cols},
        "first": {f"_after_{c}": F.min(knot(c, ts)) for c in cols},
    }


def chunk_neighbours(
    cols: Sequence[str], keys: Sequence[str] = KEYS, ts: str = "ts"
) -> dict[str, Column]:
    """``_prev_<c>`` / ``_next_<c>``: nearest known stamp and value inside the chunk of a row."""
    inside = Window.partitionBy(*keys, CHUNK)
    up = inside.orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    down = inside.orderBy(F.desc(ts)).rowsBetween(Window.unboundedPreceding, 0)
    found = {f"_prev_{c}": F.last(knot(c, ts), True).over(up) for c in cols}
    return found | {f"_next_{c}": F.last(knot(c, ts), True).over(down) for c in cols}


def before(c: str) -> Column:
    """Nearest known stamp and value at or before a row, in its chunk or carried from earlier ones."""
    return F.coalesce(f"_prev_{c}", f"_before_{c}")


def after(c: str) -> Column:
    """Nearest known stamp and value at or after a row, in its chunk or carried from later ones."""
    return F.coalesce(f"_next_{c}", f"_after_{c}")


def line_between(c: str, ts: str = "ts") -> Column:
    """Known value, else the straight line in time between the neighbours, flat at the ends."""
    at = F.unix_micros(ts)
    t0, t1 = F.unix_micros(before(c)["t"]), F.unix_micros(after(c)["t"])
    v0, v1 = before(c)["v"], after(c)["v"]
    return (
        F.when(F.col(c).isNotNull(), F.col(c))
        .when(t0.isNull(), v1)
        .when(t1.isNull(), v0)
        .otherwise(v0 + (v1 - v0) / (t1 - t0) * (at - t0))
    )


def last_or_next(c: str) -> Column:
    """Last known value, else the first known one."""
    return F.coalesce(before(c)["v"], after(c)["v"])


def _filled(df, cols, keys, ts, step, fill) -> DataFrame:
    if not cols:
        return df
    if CHUNK not in df.columns:
        df = chunked(df, keys=keys, ts=ts, step=step)
    carry = chunk_carry(df, keys=keys, **knot_carries(cols, ts))
    found = df.withColumns(chunk_neighbours(cols, keys, ts)).join(carry, [*keys, CHUNK])
    return found.select(*[fill(c).alias(c) if c in cols else c for c in df.columns])


def interpolate_time(
    df: DataFrame,
    cols: Sequence[str],
    *,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
    step: int = STEP_SECONDS,
) -> DataFrame:
    """Fill nulls linearly in time between known values, flat beyond both ends, without limit."""
    return _filled(df, cols, keys, ts, step, lambda c: line_between(c, ts))


def ffill_bfill(
    df: DataFrame,
    cols: Sequence[str],
    *,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
    step: int = STEP_SECONDS,
) -> DataFrame:
    """Fill nulls with the last known value, then leading nulls with the first known one."""
    return _filled(df, cols, keys, ts, step, last_or_next)
