"""Time axes, regridding, as-of matches, de-duplication and gap reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.config import STEP_SECONDS
from meterloom.operators.ordering import (
    CHUNK,
    CHUNK_ROWS,
    KEYS,
    chunk_carry,
    chunk_of,
    salted_join,
)


def time_axis(
    df: DataFrame,
    *,
    step: int = STEP_SECONDS,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Every grid stamp from the first to the last stamp of each series.

    Stamps are generated chunk by chunk, so no array grows with the series.
    The result is laid out by ``(keys, chunk)``.
    """
    width = step * rows
    bounds = df.groupBy(*keys).agg(
        F.unix_seconds(F.min(ts)).alias("_lo"), F.unix_seconds(F.max(ts)).alias("_hi")
    )
    chunks = bounds.select(
        *keys,
        "_lo",
        "_hi",
        F.explode(
            F.sequence(F.floor(F.col("_lo") / width), F.floor(F.col("_hi") / width))
        ).alias(CHUNK),
    ).repartition(*keys, CHUNK)
    edge = F.col(CHUNK) * width
    first = F.greatest(
        F.col("_lo"), F.col("_lo") + F.ceil((edge - F.col("_lo")) / step) * step
    )
    last = F.least(
        F.col("_hi"), F.col("_lo") + F.floor((edge + width - 1 - F.col("_lo")) / step) * step
    )
    return (
        chunks.select(*keys, CHUNK, first.alias("_first"), last.alias("_last"))
        .where("_first <= _last")
        .select(
            *keys,
            CHUNK,
            F.explode(F.sequence("_first", "_last", F.lit(step).cast("long"))).alias("_at"),
        )
        .select(*keys, CHUNK, F.timestamp_seconds("_at").alias(ts))
    )


def regrid(
    df: DataFrame,
    axis: DataFrame,
    *,
    step: int = STEP_SECONDS,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Put ``df`` on the axis by exact stamp: gaps become nulls, off-axis rows go."""
    right = df.drop(CHUNK).withColumn(CHUNK, chunk_of(ts, step, rows)).repartition(*keys, CHUNK)
    return axis.join(right, [*keys, CHUNK, ts], "left")


def weather_slots(
    weather: DataFrame,
    axis_start: DataFrame,
    numbers: Sequence[str],
    text: Sequence[str],
    tolerance: int,
    *,
    step: int = STEP_SECONDS,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Readings moved onto a regular axis: numbers by equal stamp, text from the nearest reading.

    A reading can only serve the few axis slots within ``tolerance`` of it, so
    it is copied to those and the best copy per slot is kept by an aggregate:
    smallest distance, then the earlier reading.  ``axis_start`` has one row per
    series with the first axis stamp ``start``.
    """
    placed = salted_join(weather, axis_start, keys, [ts])
    away = F.unix_seconds(ts) - F.unix_seconds("start")
    low, high = F.ceil((away - tolerance) / step), F.floor((away + tolerance) / step)
    copies = (
        placed.withColumn("_low", low)
        .withColumn("_high", high)
        .where("_low <= _high")
        .withColumn("_k", F.explode(F.sequence("_low", "_high")))
        .withColumn("_slot", F.timestamp_seconds(F.unix_seconds("start") + F.col("_k") * step))
        .withColumn(CHUNK, chunk_of("_slot", step, rows))
        .repartition(*keys, CHUNK)
    )
    gap = F.unix_micros(ts) - F.unix_micros("_slot")
    best = [F.max(F.when(gap == 0, F.col(c))).alias(c) for c in numbers]
    if text:
        near = F.when(F.abs(gap) <= tolerance * 1_000_000, F.struct(F.abs(gap), gap > 0))
        best.append(F.min_by(F.struct(*text), near).alias("_text"))
    slots = copies.groupBy(*keys, CHUNK, F.col("_slot").alias(ts)).agg(*best)
    return slots.select(
        *keys, CHUNK, ts, *numbers, *[F.col("_text").getField(c).alias(c) for c in text]
    )


def truth_at(forecast: DataFrame, truth: DataFrame, *, keys=KEYS, ts: str = "ts") -> DataFrame:
    """Actual values for forecast stamps; stamps without an actual keep a null."""
    return forecast.join(truth, [*keys, ts], "left")


def keep_matching(df: DataFrame, wanted: DataFrame, *, keys=KEYS, ts: str = "ts") -> DataFrame:
    """Rows of ``df`` whose key occurs in ``wanted``."""
    return df.join(wanted.select(*keys, ts), [*keys, ts], "left_semi")


def keep_last(
    df: DataFrame, order: Sequence[str], *, keys: Sequence[str] = KEYS, ts: str = "ts"
) -> DataFrame:
    """One row per key: the one that comes last by ``order`` (e.g. file, then row number).

    An aggregate, not a ranking: repeated keys shrink before the shuffle.
    """
    payload = [c for c in df.columns if c not in (*keys, ts)]
    winner = F.max_by(F.struct(*payload), F.struct(*order)).alias("_row")
    return df.groupBy(*keys, ts).agg(winner).select(*keys, ts, "_row.*")


def unite_files(*frames: DataFrame, ordinal: str = "file_no") -> DataFrame:
    """Stack yearly files by column name; absent columns become null, ``ordinal`` keeps the order."""
    result = None
    for number, frame in enumerate(frames):
        part = frame.withColumn(ordinal, F.lit(number))
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    return result


def _matches(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    step: int,
    rows: int,
    forward: bool,
) -> DataFrame:
    """Left rows with ``_back`` (and ``_ahead``): stamp and values of the neighbouring right rows."""
    values = [c for c in right.columns if c not in (*keys, ts, CHUNK)]
    left_cols = [c for c in left.columns if c not in (*keys, ts, CHUNK)]
    left_row = F.struct(*left_cols) if left_cols else F.struct(F.lit(True).alias("_present"))
    hit = F.struct(F.col(ts).alias("ts"), F.struct(*values).alias("row"))
    # Right rows sort before left rows of the same stamp: an equal stamp is a match.
    probes = left.select(*keys, ts, F.lit(1).alias("_side"), left_row.alias("_left"))
    knots = right.select(*keys, ts, F.lit(0).alias("_side"), hit.alias("_hit"))
    both = probes.unionByName(knots, allowMissingColumns=True)
    both = both.withColumn(CHUNK, chunk_of(ts, step, rows)).repartition(*keys, CHUNK)

    inside = Window.partitionBy(*keys, CHUNK)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    stamp = F.when(F.col("_side") == 0, F.col(ts))
    seen = F.last("_hit", True)
    last = {"_carry_back": F.max_by("_hit", stamp)}
    nearest = {"_back": seen.over(inside.orderBy(ts, "_side").rowsBetween(*so_far))}
    first = {}
    if forward:
        first = {"_carry_ahead": F.min_by("_hit", stamp)}
        nearest["_ahead"] = seen.over(inside.orderBy(F.desc(ts), "_side").rowsBetween(*so_far))
    found = {n: F.coalesce(n, f"_carry{n}") for n in nearest}
    carry = chunk_carry(both, keys=keys, last=last, first=first)
    result = (
        both.withColumns(nearest)
        .where("_side = 1")
        .join(carry, [*keys, CHUNK])
        .select(*keys, CHUNK, ts, "_left", *[c.alias(n) for n, c in found.items()])
    )
    kept = [F.col("_left").getField(c).alias(c) for c in left_cols]
    return result.select(*keys, CHUNK, ts, *kept, *found)


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    tolerance: int,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
    step: int = STEP_SECONDS,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Each left row with the nearest right row at most ``tolerance`` seconds away.

    A tie goes to the earlier row; the nearest *row* counts even if its values
    are null; left rows without a match keep nulls.  ``right`` has unique keys.
    """
    values = [c for c in right.columns if c not in (*keys, ts, CHUNK)]
    matched = _matches(left, right, keys, ts, step, rows, forward=True)
    at = F.unix_micros(ts)
    back_gap = at - F.unix_micros("_back.ts")
    ahead_gap = F.unix_micros("_ahead.ts") - at
    limit = F.lit(tolerance * 1_000_000)
    back_ok = F.coalesce(back_gap <= limit, F.lit(False))
    ahead_ok = F.coalesce(ahead_gap <= limit, F.lit(False))
    best = F.when(back_ok & (~ahead_ok | (back_gap <= ahead_gap)), F.col("_back.row")).when(
        ahead_ok, F.col("_ahead.row")
    )
    kept = [c for c in matched.columns if c not in ("_back", "_ahead")]
    return matched.withColumn("_best", best).select(
        *kept, *[F.col("_best").getField(c).alias(c) for c in values]
    )


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
    step: int = STEP_SECONDS,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Each left row with the latest right row at or before it."""
    values = [c for c in right.columns if c not in (*keys, ts, CHUNK)]
    matched = _matches(left, right, keys, ts, step, rows, forward=False)
    kept = [c for c in matched.columns if c != "_back"]
    return matched.select(*kept, *[F.col("_back.row").getField(c).alias(c) for c in values])


def missing_slots(
    df: DataFrame, *, step: int = STEP_SECONDS, keys: Sequence[str] = KEYS, ts: str = "ts"
) -> DataFrame:
    """Grid stamps between first and last stamp of a series that have no row."""
    axis = time_axis(df, step=step, keys=keys, ts=ts)
    present = df.select(*keys, ts).withColumn(CHUNK, chunk_of(ts, step)).repartition(*keys, CHUNK)
    return axis.join(present, [*keys, CHUNK, ts], "left_anti").drop(CHUNK)


def duplicate_keys(df: DataFrame, *, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counts = df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where("n_rows > 1")


def gap_report(
    df: DataFrame, *, step: int = STEP_SECONDS, keys: Sequence[str] = KEYS, ts: str = "ts"
) -> DataFrame:
    """Per series: expected, present and missing slots and surplus rows of repeated keys."""
    per_stamp = df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("_n"))
    seconds = F.unix_seconds(ts)
    span = F.max(seconds) - F.min(seconds)
    return (
        per_stamp.groupBy(*keys)
        .agg(
            (F.floor(span / step) + 1).alias("expected"),
            F.count(F.lit(1)).alias("present"),
            F.sum(F.col("_n") - 1).alias("surplus_rows"),
        )
        .withColumn("missing", F.col("expected") - F.col("present"))
    )


def assert_unique(df: DataFrame, *, keys: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """Fail if a key repeats: regridding needs unique stamps."""
    clash = duplicate_keys(df, keys=keys, ts=ts).limit(1).count()
    if clash:
        raise ValueError(f"repeated key in {[*keys, ts]}; apply keep_last first")
    return df


def as_utc(col: str | Column) -> Column:
    """Stamp without zone read as UTC; stamp with zone unchanged (session zone is UTC)."""
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp")
