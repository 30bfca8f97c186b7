"""Recursive day-ahead forecasts: own predictions feed the lags.

All forecast origins advance together as rows of one table.  Each row carries
the last 96 values and what is known about the coming steps, so a step needs
no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.config import LOCAL_TZ, SLOTS_PER_DAY, STEP_SECONDS, TARGET
from meterloom.forecast.boosting import BoostedTrees
from meterloom.forecast.models import VECTOR, scoring_parts
from meterloom.functions.calendar import calendar_parts, cyclic, day_flags, to_local
from meterloom.operators.align import asof_backward
from meterloom.operators.ordering import CHUNK, KEYS
from meterloom.operators.resample import at_local_midnight
from meterloom.session import stage

LAG_ROWS = {"lag_15m": 1, "lag_30m": 2, "lag_1h": 4, "lag_24h": 96}
CUSTOMER_LAGS = ("base_customers_lag_15m", "free_customers_lag_15m")
CALENDAR_MODES = ("reference", "consistent")


def midnight_origins(rows: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Rows at local midnight: where the day-ahead blocks start."""
    return rows.where(at_local_midnight("ts", tz))


def histories(
    rows: DataFrame,
    origins: DataFrame,
    *,
    target: str = TARGET,
    days: int = 7,
    keys: Sequence[str] = KEYS,
    step: int = STEP_SECONDS,
) -> DataFrame:
    """Per origin the last 96 values before it and the first stamp to forecast.

    ``rows`` and ``origins`` carry positions.  Rows are packed by 96 positions,
    so an origin needs two packs.  An origin is left out if fewer than 96 rows
    lie in the ``days`` before it.  After a gap the block starts one step after
    the last known row, not at the origin.
    """
    n = SLOTS_PER_DAY
    customers = [c for c in CUSTOMER_LAGS if c in rows.columns]
    entry = F.struct("pos", "ts", F.col(target).alias("y"), *customers)
    packs = rows.groupBy(*keys, F.floor(F.col("pos") / n).alias("_pack")).agg(
        F.collect_list(entry).alias("_rows")
    )
    at = F.col("_at")
    wanted = origins.where(F.col("pos") >= n).select(
        *keys,
        F.col("ts").alias("origin"),
        F.col("pos").alias("_at"),
        F.explode(
            F.sequence(F.floor((F.col("pos") - n) / n), F.floor((F.col("pos") - 1) / n))
        ).alias("_pack"),
    )
    found = (
        wanted.join(packs, [*keys, "_pack"])
        .groupBy(*keys, "origin", "_at")
        .agg(F.flatten(F.collect_list("_rows")).alias("_rows"))
    )
    recent = F.filter("_rows", lambda r: (r["pos"] >= at - n) & (r["pos"] < at))
    found = found.withColumn("_rows", F.array_sort(recent))
    oldest = F.unix_seconds(F.element_at("_rows", 1)["ts"])
    limit = F.unix_seconds("origin") - step - days * 86400
    last = F.element_at("_rows", -1)
    return found.where((F.size("_rows") == n) & (oldest >= limit)).select(
        *keys,
        "origin",
        F.timestamp_seconds(F.unix_seconds(last["ts"]) + step).alias("start"),
        F.transform("_rows", lambda r: r["y"]).alias("hist"),
        *[last[c].alias(c) for c in customers],
    )


def step_slots(starts: DataFrame, keep: Sequence[str], horizon: int, step: int) -> DataFrame:
    """One row for each step ``h`` of every block, with its stamp."""
    h = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")
    return starts.select(*keep, "start", h).select(
        *keep,
        "h",
        F.timestamp_seconds(F.unix_seconds("start") + (F.col("h") - 1) * step).alias("ts"),
    )


def step_calendar(ts: str = "ts", tz: str = LOCAL_TZ, mode: str = "reference") -> dict[str, Column]:
    """Calendar features of a forecast stamp.

    ``reference`` takes hour and day of year from local time but month, weekday,
    week and day flags from UTC; ``consistent`` takes all from local time, as in
    training.
    """
    if mode not in CALENDAR_MODES:
        raise ValueError(f"mode must be one of {CALENDAR_MODES}, not {mode!r}")
    local = calendar_parts(to_local(ts, tz))
    main = calendar_parts(ts) if mode == "reference" else local
    pairs = {
        "month": cyclic(main["month"], 12),
        "weekday": cyclic(main["weekday"], 7),
        "hour": cyclic(F.hour(to_local(ts, tz)), 24),
        "day_of_year": cyclic(local["day_of_year"], 365),
    }
    columns = {f"{n}_{f}": c for n, p in pairs.items() for f, c in zip(("sin", "cos"), p)}
    return columns | {"week": main["week"]} | day_flags(main["weekday"])


def _collected(slots: DataFrame, starts: DataFrame, columns, block: Sequence[str]) -> DataFrame:
    """One row per block: history and the ordered array of its steps."""
    steps = slots.groupBy(*block).agg(
        F.array_sort(F.collect_list(F.struct("h", "ts", *columns))).alias("steps")
    )
    return starts.select(*block, "hist").join(steps, list(block))


def recomputed_steps(
    starts: DataFrame,
    rows: DataFrame,
    features: Sequence[str],
    *,
    horizon: int = SLOTS_PER_DAY,
    tz: str = LOCAL_TZ,
    mode: str = "reference",
    keys: Sequence[str] = KEYS,
    step: int = STEP_SECONDS,
    combine: Callable[[], Column] | None = None,
) -> DataFrame:
    """Blocks whose calendar is recomputed per step and whose weather is the actual one.

    A stamp without a row takes the weather of the last row before it.  Customer
    lags are known for the first step only.  ``combine`` may shrink the step's
    features to one column ``score`` before they are gathered.
    """
    block = [*keys, "origin"]
    calendar = {n: c for n, c in step_calendar("ts", tz, mode).items() if n in features}
    weather = [c for c in features if c not in calendar and c not in LAG_ROWS
               and c not in CUSTOMER_LAGS and c != "diff_15m"]
    customers = [c for c in CUSTOMER_LAGS if c in features and c in starts.columns]
    slots = step_slots(starts, [*block, *customers], horizon, step)
    if weather:
        slots = asof_backward(slots, rows.select(*keys, "ts", *weather), keys=keys, step=step)
    first_only = {c: F.when(F.col("h") == 1, F.col(c)) for c in customers}
    slots = slots.drop(CHUNK).withColumns(calendar | first_only)
    if combine is not None:
        return _collected(slots.withColumn("score", combine()), starts, ["score"], block)
    return _collected(slots, starts, [*calendar, *weather, *customers], block)


def unbroken() -> Column:
    """The steps before the first missing one: they are numbered from 1, and later ones are out of place."""
    return F.filter("steps", lambda s, i: s["h"] == i + 1)


def table_steps(
    starts: DataFrame,
    table: DataFrame,
    features: Sequence[str],
    *,
    horizon: int = SLOTS_PER_DAY,
    keys: Sequence[str] = KEYS,
    variant: Sequence[str] = (),
    step: int = STEP_SECONDS,
    combine: Callable[[], Column] | None = None,
) -> DataFrame:
    """Blocks whose features are read from ``table`` at each stamp, ending at the first missing one.

    ``variant`` columns of ``table`` (e.g. permuted feature and repeat) make
    separate blocks.
    """
    block = [*keys, "origin"]
    outside = [c for c in features if c not in LAG_ROWS and c != "diff_15m"]
    slots = step_slots(starts, block, horizon, step).join(
        table.select(*keys, "ts", *variant, *outside), [*keys, "ts"]
    )
    if combine is not None:
        slots, outside = slots.withColumn("score", combine()), ["score"]
    steps = slots.groupBy(*block, *variant).agg(
        F.array_sort(F.collect_list(F.struct("h", "ts", *outside))).alias("steps")
    )
    return starts.select(*block, "hist").join(steps.withColumn("steps", unbroken()), block)


def lag_inputs(hist: Column, features: Sequence[str]) -> dict[str, Column]:
    """Lag features of the next step from the values so far."""
    inputs = {c: F.element_at(hist, -k) for c, k in LAG_ROWS.items() if c in features}
    if "diff_15m" in features:
        inputs["diff_15m"] = F.element_at(hist, -1) - F.element_at(hist, -2)
    return inputs


def forecast_rows(blocks: DataFrame) -> DataFrame:
    """Long forecast rows of finished blocks, with the actual value ``y`` if the steps carry it."""
    block = [c for c in blocks.columns if c not in ("hist", "steps")]
    truth = [F.col("_p.s.y").alias("y")] if "y" in blocks.schema["steps"].dataType.elementType.names else []
    made = F.slice("hist", SLOTS_PER_DAY + 1, F.greatest(F.size("steps"), F.lit(1)))
    pairs = F.explode(F.arrays_zip(F.col("steps").alias("s"), made.alias("yhat"))).alias("_p")
    return (
        blocks.where(F.size("steps") > 0)
        .select(*block, pairs)
        .select(*block, F.col("_p.s.h").alias("h"), F.col("_p.s.ts").alias("ts"), *truth, F.col("_p.yhat").alias("yhat"))
    )


@dataclass(frozen=True)
class LinearStep:
    """Linear one-step model; a missing feature counts as ``fill`` (0 if not named)."""

    intercept: float
    weights: Mapping[str, float]
    fill: Mapping[str, float] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return list(self.weights)

    def outside_score(self, value: Callable[[str], Column] = F.col) -> Column:
        """Part of the forecast that does not depend on earlier forecasts; ``value`` finds a feature."""
        total = F.lit(float(self.intercept))
        for c, w in self.weights.items():
            if c not in LAG_ROWS and c != "diff_15m":
                known = F.coalesce(value(c).cast("double"), F.lit(float(self.fill.get(c, 0.0))))
                total = total + F.lit(float(w)) * known
        return total

    def advance(self, blocks: DataFrame) -> DataFrame:
        """All steps of all blocks in one projection (``steps`` carry ``score``)."""

        def following(values: Column, s: Column) -> Column:
            total = s["score"]
            for c, value in lag_inputs(values, self.features).items():
                total = total + F.lit(float(self.weights[c])) * value
            return F.concat(values, F.array(total))

        return blocks.withColumn("hist", F.aggregate("steps", F.col("hist"), following))


def linear_step(model: PipelineModel) -> LinearStep:
    """The fitted linear pipeline as a :class:`LinearStep`."""
    names, fill, fitted = scoring_parts(model)
    weights = dict(zip(names, map(float, fitted.coefficients)))
    return LinearStep(float(fitted.intercept), weights, fill)


def advance_with_model(
    blocks: DataFrame,
    model: PipelineModel,
    *,
    horizon: int = SLOTS_PER_DAY,
    stage_every: int = 12,
) -> DataFrame:
    """Advance all blocks step by step with any fitted pipeline.

    Each step is a projection and a ``transform`` without shuffle.  Every few
    steps the state is written to the shared folder, which keeps the plan short.
    """
    names, fill, predictor = scoring_parts(model)
    block = [c for c in blocks.columns if c not in ("hist", "steps")]
    outside = blocks.schema["steps"].dataType.elementType.names
    lags = {c: f"element_at(hist, -{k})" for c, k in LAG_ROWS.items()}
    lags["diff_15m"] = "element_at(hist, -1) - element_at(hist, -2)"
    state = blocks
    for h in range(1, horizon + 1):
        now = {c: f"get(steps, {h - 1}).`{c}`" for c in outside} | lags
        known = [f"coalesce(double({now.get(c, 'null')}), {fill[c]!r}D)" for c in names]
        inputs = state.selectExpr(*block, "hist", "steps", f"array({', '.join(known)}) as _x")
        vector = array_to_vector(F.col("_x")).alias(VECTOR)
        scored = predictor.transform(inputs.select(*block, "hist", "steps", vector))
        grown = f"if(size(steps) >= {h}, concat(hist, array(prediction)), hist) as hist"
        state = scored.selectExpr(*block, grown, "steps")
        if h % stage_every == 0 and h < horizon:
            state = stage(state, "recursion")
    return state


def advance_with_trees(blocks: DataFrame, model: BoostedTrees, *, horizon: int = SLOTS_PER_DAY) -> DataFrame:
    """Advance all blocks with boosted trees: all steps of a batch of blocks in one Arrow map.

    Histories have one length; blocks with fewer steps end earlier. Features that neither
    the steps nor the history have are missing values.
    """
    shared = model.shared(blocks.sparkSession)
    names = model.features

    def run(batches):
        model = shared.value
        for batch in batches:
            n, steps, hist = batch.num_rows, batch.column("steps"), batch.column("hist")
            if not n:
                continue
            sizes = pc.list_value_length(steps).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(n), sizes)
            at = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            flat = steps.flatten()
            x = np.full((n, max(horizon, int(sizes.max())), len(names)), np.nan)
            kinds = flat.type
            for i, name in enumerate(names):
                if kinds.get_field_index(name) >= 0:
                    x[rows, at, i] = flat.field(name).cast(pa.float64()).to_numpy(zero_copy_only=False)
            past = hist.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)
            known = past.shape[1]
            values = np.concatenate([past, np.full((n, horizon), np.nan)], axis=1)
            for h in range(horizon):
                now = x[:, h].copy()
                for i, name in enumerate(names):
                    if name in LAG_ROWS:
                        now[:, i] = values[:, known + h - LAG_ROWS[name]]
                    elif name == "diff_15m":
                        now[:, i] = values[:, known + h - 1] - values[:, known + h - 2]
                values[:, known + h] = model.predict_bins(model.bins(now))[:, 0]
            ends = known + np.minimum(sizes, horizon)
            grown = pa.array([v[:e] for v, e in zip(values, ends)], pa.list_(pa.float64()))
            yield batch.set_column(batch.schema.get_field_index("hist"), "hist", grown)

    return blocks.withColumn("hist", F.col("hist").cast("array<double>")).mapInArrow(
        run, blocks.withColumn("hist", F.col("hist").cast("array<double>")).schema
    )


def forecast_trees(
    rows: DataFrame,
    origins: DataFrame,
    model: BoostedTrees,
    *,
    target: str = TARGET,
    horizon: int = SLOTS_PER_DAY,
    mode: str = "reference",
) -> DataFrame:
    """Recursive forecast of every origin with boosted trees; nothing is written between the steps."""
    starts = histories(rows, origins, target=target)
    blocks = recomputed_steps(starts, rows, model.features, horizon=horizon, mode=mode)
    return forecast_rows(advance_with_trees(blocks, model, horizon=horizon))


def forecast_linear(
    rows: DataFrame,
    origins: DataFrame,
    model: LinearStep,
    *,
    target: str = TARGET,
    horizon: int = SLOTS_PER_DAY,
    mode: str = "reference",
) -> DataFrame:
    """Recursive forecast of every origin with a linear model."""
    starts = histories(rows, origins, target=target)
    blocks = recomputed_steps(
        starts, rows, model.features, horizon=horizon, mode=mode, combine=model.outside_score
    )
    return forecast_rows(model.advance(blocks))


def forecast_model(
    rows: DataFrame,
    origins: DataFrame,
    model: PipelineModel,
    features: Sequence[str],
    *,
    target: str = TARGET,
    horizon: int = SLOTS_PER_DAY,
    mode: str = "reference",
) -> DataFrame:
    """Recursive forecast of every origin with a fitted pipeline."""
    starts = histories(rows, origins, target=target)
    blocks = stage(recomputed_steps(starts, rows, features, horizon=horizon, mode=mode), "blocks")
    return forecast_rows(advance_with_model(blocks, model, horizon=horizon))


def with_truth(forecast: DataFrame, rows: DataFrame, target: str = TARGET) -> DataFrame:
    """Forecast rows with the actual value ``y``, null where there is none."""
    truth = rows.select(*KEYS, "ts", F.col(target).alias("y"))
    return forecast.join(truth, [*KEYS, "ts"], "left")


def next_day_forecast(rows: DataFrame, advance: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Forecast from the last local midnight of every series, for a daily job.

    ``advance`` takes the origins and returns forecast rows.
    """
    last = midnight_origins(rows).groupBy(*KEYS).agg(F.max_by(F.struct("ts", "pos"), "ts").alias("_o"))
    return advance(last.select(*KEYS, "_o.ts", "_o.pos"))
