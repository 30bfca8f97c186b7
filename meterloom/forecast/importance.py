"""Permutation importance: how much worse forecasts get when one feature is shuffled.

Every row gets, as one array, the features that it takes over in each repeat.  All variants are
then made and scored inside the task that holds the row; only sums of errors travel.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.config import SLOTS_PER_DAY, STEP_SECONDS, TARGET
from meterloom.forecast.boosting import BoostedTrees
from meterloom.forecast.direct import DirectLinear
from meterloom.forecast.recursive import (
    LAG_ROWS,
    forecast_rows,
    histories,
    midnight_origins,
    step_slots,
    unbroken,
)
from meterloom.metrics import Scorer, block_metrics, mean_block_rmse, neg_mae, neg_rmse, score_by
from meterloom.operators.ordering import CHUNK, KEYS, chunked, with_position
from meterloom.operators.split import seeded_order, seeded_sample, tail_rows
from meterloom.session import stage

VARIANT = ("feature", "repeat")


ArrayModel = DirectLinear | BoostedTrees


def donated(
    rows: DataFrame,
    features: Sequence[str],
    repeats: int,
    seed: int = 42,
    *,
    receivers: DataFrame | None = None,
) -> DataFrame:
    """``rows`` with ``own``, their features as numbers, and ``others``: for each repeat, those of another row.

    A repeat permutes the rows of a series; one permutation serves all features.  Permutations are
    drawn from keys and stamps alone; then each row sends its features once a repeat, and no row is
    repeated otherwise.  ``rows`` has positions 0…n-1.  With ``receivers`` (keys and ``pos``), only
    these rows come back, and only their donors send.
    """
    own = F.array(*[F.col(f).cast("double") for f in features]).alias("own")
    repeat = F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat")
    drawn = rows.select(*KEYS, "ts", F.col("pos").alias("_from"), repeat)
    taken = seeded_order(drawn, ["_from"], seed, keys=[*KEYS, "repeat"])
    kept = rows
    if receivers is not None:
        taken = taken.join(receivers, [*KEYS, "pos"], "left_semi")
        kept = rows.join(receivers, [*KEYS, "pos"], "left_semi")
    sent = taken.groupBy(*KEYS, "_from").agg(F.collect_list(F.struct("pos", "repeat")).alias("_to"))
    given = (
        rows.select(*KEYS, F.col("pos").alias("_from"), own)
        .join(sent, [*KEYS, "_from"])
        .select(*KEYS, "own", F.explode("_to").alias("_t"))
        .groupBy(*KEYS, F.col("_t.pos").alias("pos"))
        .agg(F.array_sort(F.collect_list(F.struct("_t.repeat", "own"))).alias("_got"))
        .select(*KEYS, "pos", F.transform("_got", lambda g: g["own"]).alias("others"))
    )
    return kept.withColumn("own", own).join(given, [*KEYS, "pos"])


def permuted(
    rows: DataFrame, features: Sequence[str], repeats: int, seed: int = 42
) -> DataFrame:
    """``rows`` once per feature and repeat, with that feature shuffled within its series.

    For models that score rows only: the copies are made after the shuffle, where they are scored.
    Features come back as doubles.
    """
    names = F.array(*[F.lit(f) for f in features])
    each = donated(rows, features, repeats, seed).select(
        "*", F.posexplode("others").alias("_repeat", "_other")
    ).select("*", F.explode(names).alias("feature"), (F.col("_repeat") + 1).alias("repeat"))
    return each.withColumns(
        {
            f: F.when(F.col("feature") == f, F.col("_other")[i]).otherwise(F.col("own")[i])
            for i, f in enumerate(features)
        }
    ).drop("own", "others", "_repeat", "_other")


def _finite(value: float | None) -> float:
    if value is None or not math.isfinite(value):
        raise ValueError("the score of the unchanged rows is not finite")
    return value


def _ranked(changes: DataFrame, top: int | None) -> DataFrame:
    """Mean and deviation over the repeats, most important first."""
    table = changes.groupBy("feature").agg(
        F.avg("change").alias("importance_mean"), F.stddev_pop("change").alias("importance_std")
    )
    ordered = table.orderBy(F.desc("importance_mean"), "feature")
    return ordered.limit(top) if top else ordered


def numbered(rows: DataFrame) -> DataFrame:
    return with_position(chunked(rows)).drop(CHUNK)


def row_importance(
    rows: DataFrame,
    features: Sequence[str],
    predict: Callable[[DataFrame], DataFrame],
    *,
    scorer: Scorer = neg_rmse,
    repeats: int = 10,
    seed: int = 42,
    top: int | None = None,
) -> DataFrame:
    """Drop of the score per shuffled feature.  ``predict`` adds ``y`` and ``yhat`` and keeps other columns."""
    ready = stage(numbered(rows.drop("pos", "n_rows")), "evaluation")
    base = _finite(score_by(predict(ready), scorer).first()["score"])
    scored = score_by(predict(permuted(ready, features, repeats, seed)), scorer, VARIANT)
    return _ranked(scored.withColumn("change", F.lit(base) - F.col("score")), top)


def _error_sums(rows: DataFrame, model: ArrayModel) -> DataFrame:
    """Errors of every variant, summed by task, from ``own``, ``others`` and the array ``y``.

    Feature -1 in repeat 0 are the rows as they are.  A missing actual value counts nowhere.
    """
    shared, features = model.shared(rows.sparkSession), len(model.features)
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64()]
    names = ["feature", "repeat", "n", "absolute", "squared"]

    def run(batches):
        model, sums = shared.value, {}

        def add(feature, repeat, y, forecasts):
            gaps = forecasts - y
            known = ~np.isnan(y)
            gaps = gaps[known]
            old = sums.get((feature, repeat), (0, 0.0, 0.0))
            new = (len(gaps), float(np.abs(gaps).sum()), float(gaps @ gaps))
            sums[feature, repeat] = tuple(a + b for a, b in zip(old, new))

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = numbers(batch.column("own")).reshape(n, features)
            others = numbers(batch.column("others").flatten()).reshape(n, -1, features)
            y = numbers(batch.column("y")).reshape(n, -1)
            plain = model.forecast(x)
            add(-1, 0, y, plain)
            for repeat in range(others.shape[1]):
                for i in range(features):
                    add(i, repeat + 1, y, model.changed(x, plain, i, others[:, repeat, i]))
        if sums:
            columns = zip(*[(*key, *cells) for key, cells in sums.items()])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def numbers(lists):
        return lists.flatten().to_numpy(zero_copy_only=False).astype(float)

    return rows.select("own", "others", "y").mapInArrow(
        run, "feature int, repeat int, n long, absolute double, squared double"
    )


def model_importance(
    rows: DataFrame,
    model: ArrayModel,
    y: Column,
    *,
    loss: str = "rmse",
    repeats: int = 10,
    seed: int = 42,
    top: int | None = None,
) -> DataFrame:
    """Increase of the error (``rmse`` or ``mae``) per shuffled feature of a model that scores arrays.

    ``y`` is an array of one length: one actual value for each target of the model, null if missing;
    rows whose array is null are left out of the errors, but give their features to others.  One pass
    over the rows scores them as they are and in all variants.
    """
    ready = stage(numbered(rows.drop("pos", "n_rows")).withColumn("y", y.cast("array<double>")), "evaluation")
    table = donated(ready, model.features, repeats, seed).where("y is not null")
    n, error = F.sum("n"), {"rmse": F.sqrt(F.sum("squared") / F.nullif(F.sum("n"), F.lit(0)))}
    error["mae"] = F.sum("absolute") / F.nullif(n, F.lit(0))
    sums = _error_sums(table, model).groupBy("feature", "repeat")
    scores = stage(sums.agg(error[loss].alias("score")), "scores")
    base = scores.where("feature = -1").first()
    change = F.col("score") - F.lit(_finite(base and base["score"]))
    names = F.array(*[F.lit(f) for f in model.features])
    return _ranked(
        scores.where("feature >= 0").select(F.get(names, F.col("feature")).alias("feature"), change.alias("change")), top
    )


def one_step_importance(
    test: DataFrame,
    features: Sequence[str],
    predict: Callable[[DataFrame], DataFrame] | ArrayModel,
    *,
    size: int | None = None,
    repeats: int = 10,
    seed: int = 42,
    top: int | None = None,
) -> DataFrame:
    """One-step importance on all rows, or the last ``size`` of each series: increase of the RMSE.

    ``predict`` is a model that scores arrays (with the features ``features``) or any function of rows.
    """
    rows = tail_rows(test, size) if size else test
    if not callable(predict):
        return model_importance(rows, predict, F.array(TARGET), repeats=repeats, seed=seed, top=top)
    return row_importance(rows, features, predict, repeats=repeats, seed=seed, top=top)


def multi_output_importance(
    test: DataFrame,
    features: Sequence[str],
    predict: Callable[[DataFrame], DataFrame] | ArrayModel,
    *,
    size: int | None = None,
    repeats: int = 3,
    seed: int = 42,
    top: int | None = None,
) -> DataFrame:
    """Importance over all horizons on all rows, or a seeded sample of ``size``: increase of the MAE.

    ``predict`` is a model that scores arrays (actual values in ``targets``) or any function of rows.
    """
    rows = seeded_sample(test, size, seed) if size else test
    if callable(predict):
        table = row_importance(rows, features, predict, scorer=neg_mae, repeats=repeats, seed=seed, top=top)
    else:
        table = model_importance(rows, predict, F.col("targets"), loss="mae", repeats=repeats, seed=seed, top=top)
    return table.select("feature", F.col("importance_mean").alias("importance"))


def recursive_importance(
    rows: DataFrame,
    features: Sequence[str],
    advance: Callable[[DataFrame], DataFrame],
    *,
    target: str = TARGET,
    blocks: int | None = None,
    repeats: int = 5,
    seed: int = 42,
    max_missing: int = 4,
    horizon: int = SLOTS_PER_DAY,
    combine=None,
    top: int | None = None,
) -> DataFrame:
    """Increase of the mean block RMSE when a feature is shuffled over the test rows.

    All midnight origins of the test rows count, or a seeded sample of ``blocks``; then only rows
    in their blocks get other features.  ``rows`` has positions and ``split``, one row a stamp.
    Lag features cannot matter, as the recursion overwrites them: their change is zero without
    a run.  A block gathers its steps once, with the other features as arrays; its variants are
    made from there.  ``combine`` may shrink the features of a step to one column ``score``; it is
    given a function that finds a feature's value.
    """
    block = [*KEYS, "origin"]
    test = rows.where(F.col("split") == "test")
    origins = midnight_origins(test)
    origins = stage(seeded_sample(origins, blocks, seed) if blocks else origins, "origins")
    starts = stage(histories(rows, origins, target=target), "starts")
    outside = [c for c in features if c not in LAG_ROWS and c != "diff_15m"]
    ready = stage(numbered(test.select(*KEYS, "ts", F.col(target).alias("y"), *outside)), "evaluation")
    slots = step_slots(starts, block, horizon, STEP_SECONDS)
    receivers = ready.join(slots, [*KEYS, "ts"], "left_semi").select(*KEYS, "pos") if blocks else None
    table = donated(ready, outside, repeats, seed, receivers=receivers)
    entry = F.struct("h", "ts", "y", "own", "others")
    steps = (
        slots.join(table.select(*KEYS, "ts", "y", "own", "others"), [*KEYS, "ts"])
        .groupBy(*block)
        .agg(F.array_sort(F.collect_list(entry)).alias("steps"))
        .withColumn("steps", unbroken())
    )
    # Variant 0 is unchanged; variant 1 + i * repeats + r shuffles feature i in repeat r.
    which = F.col("variant") - 1
    count = len(outside) * repeats

    def varied(s: Column) -> Column:
        def value(c: str) -> Column:
            i = outside.index(c)
            other = F.get(F.get(s["others"], F.pmod(which, F.lit(repeats))), F.lit(i))
            mine = (F.col("variant") > 0) & (F.floor(which / repeats) == i)
            return F.when(mine, other).otherwise(F.get(s["own"], F.lit(i)))

        values = [value(c).alias(c) for c in outside] if combine is None else [combine(value).alias("score")]
        return F.struct(s["h"].alias("h"), s["ts"].alias("ts"), s["y"].alias("y"), *values)

    variants = (
        starts.select(*block, "hist")
        .join(steps, block)
        .withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(count))))
        .withColumn("steps", F.transform("steps", varied))
    )
    forecast = forecast_rows(advance(stage(variants, "blocks")))
    scored = block_metrics(forecast, block=[*block, "variant"], max_missing=max_missing)
    scores = stage(mean_block_rmse(scored, keys=["variant"]), "scores")
    base = scores.where("variant = 0").first()
    names = F.array(*[F.lit(c) for c in outside])
    changes = scores.where("variant > 0").select(
        F.get(names, F.floor(which / repeats).cast("int")).alias("feature"),
        (F.col("score") - F.lit(_finite(base and base["score"]))).alias("change"),
    )
    overwritten = [c for c in features if c not in outside]
    if overwritten:
        zero = scores.where("variant = 0").select(
            F.explode(F.array(*[F.lit(c) for c in overwritten])).alias("feature"), F.lit(0.0).alias("change")
        )
        changes = changes.unionByName(zero)
    return _ranked(changes, top).select(
        "feature",
        F.col("importance_mean").alias("delta_rmse_mean"),
        F.col("importance_std").alias("delta_rmse_std"),
    )
