import contextlib
import io
import itertools
import math
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from helpers import series, stamp, values
from pyspark.sql import functions as F

from meterloom.config import DatasetConfig, Selection
from meterloom.forecast import daily, direct, importance, models, recursive
from meterloom.forecast.boosting import Boosting, fit_boosted
from meterloom.forecast.leastsquares import products, solve, solve_sparse
from meterloom.functions.calendar import calendar_parts, to_local
from meterloom.metrics import regression_metrics
from meterloom.operators import lags, split
from meterloom.plans.dataset import model_rows
from meterloom.plans.prepare import prepare
from meterloom.session import stage
from meterloom.sources import writers

CFG = DatasetConfig(Selection(without=frozenset()))


def periodic(spark, days=12, drop=(), noise=3.0):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(96 * days):
        if i not in drop:
            level = 100 + 30 * math.sin(2 * math.pi * i / 96) + 10 * math.cos(2 * math.pi * i / 672)
            rows.append((15 * i, float(level + rng.normal(0, noise))))
    df = series(spark, rows, ["load_kwh double"]).withColumns(
        {"base_customers": F.col("load_kwh") / 2, "free_customers": F.col("load_kwh") / 4}
    )
    return df.withColumns({n: c.cast("bigint") for n, c in calendar_parts(to_local("ts")).items()})


@pytest.fixture(scope="module")
def data(spark):
    loads = periodic(spark)
    weather = series(spark, [(30 * i, float(i % 48)) for i in range(48 * 12)], ["temp_2m double"])
    made = model_rows(stage(prepare(loads, weather)), CFG)
    return replace(made, rows=stage(made.rows))


def plain_recursion(frame, model, origin, mode="reference"):
    """The same forecast, one origin and one slot at a time."""
    import pandas as pd

    hist = frame[(frame.ts < origin) & (frame.ts >= origin - pd.Timedelta("15min") - pd.Timedelta(days=7))]
    if len(hist) < 96:
        return None
    y, last = list(hist.load_kwh), hist.ts.iloc[-1]
    out = []
    for h in range(1, 97):
        ts = last + pd.Timedelta("15min") * h
        local = ts.tz_localize("UTC").tz_convert("Europe/Zurich")
        seen = frame[frame.ts <= ts].iloc[-1]
        x = {
            "hour_cos": math.cos(2 * math.pi * local.hour / 24),
            "weekday_sin": math.sin(2 * math.pi * ts.weekday() / 7),
            "temp_2m_lag15": 0.0 if pd.isna(seen.temp_2m_lag15) else seen.temp_2m_lag15,
            "lag_15m": y[-1], "lag_1h": y[-4], "lag_24h": y[-96], "diff_15m": y[-1] - y[-2],
            "base_customers_lag_15m": hist.base_customers_lag_15m.iloc[-1] if h == 1 else 0.0,
        }
        y.append(model.intercept + sum(w * x[c] for c, w in model.weights.items()))
        out.append((ts, y[-1]))
    return out


MODEL = recursive.LinearStep(
    3.0,
    {"hour_cos": 2.0, "weekday_sin": 1.0, "temp_2m_lag15": 0.1, "lag_15m": 0.3, "lag_1h": 0.2, "lag_24h": 0.4,
     "diff_15m": -0.2, "base_customers_lag_15m": 0.05},
)


def test_linear_recursion_equals_a_plain_loop_with_gaps(spark):
    gaps = set(range(700, 712)) | {400, 401} | set(range(95 * 6, 95 * 6 + 3)) | {668, 669, 670, 671}
    loads = periodic(spark, drop=gaps)
    weather = series(spark, [(30 * i, float(i % 48)) for i in range(48 * 12)], ["temp_2m double"])
    rows = stage(model_rows(prepare(loads, weather), CFG).rows)
    origins = recursive.midnight_origins(rows)
    got = recursive.forecast_linear(rows, origins, MODEL).toPandas()
    frame = rows.orderBy("ts").toPandas()
    for origin in origins.orderBy("ts").toPandas().ts:
        want = plain_recursion(frame, MODEL, origin)
        mine = got[got.origin == origin].sort_values("h")
        if want is None:
            assert len(mine) == 0
            continue
        assert list(mine.ts) == [t for t, _ in want]
        assert list(mine.yhat) == pytest.approx([v for _, v in want], rel=1e-9)


def test_short_history_is_skipped(spark, data):
    early = data.rows.where("pos in (95, 96)")
    starts = recursive.histories(data.rows, early)
    assert [r.origin for r in starts.collect()] == values(data.rows.where("pos = 96"), "ts")


def test_block_starts_after_the_last_known_row(spark):
    rows = model_rows(prepare(periodic(spark, drop=set(range(668, 672)))), CFG).rows
    origin = rows.where(F.col("ts") == F.lit(stamp(15 * 672)).cast("timestamp"))
    start = recursive.histories(rows, origin).first().start
    assert start == stamp(15 * 668)
    blocks = recursive.table_steps(recursive.histories(rows, origin), rows, ["lag_1h"])
    assert blocks.count() == 0 or recursive.forecast_rows(
        recursive.LinearStep(0.0, {"lag_1h": 1.0}).advance(blocks.withColumn(
            "steps", F.transform("steps", lambda s: F.struct(s["h"], s["ts"], F.lit(0.0).alias("score")))))
    ).count() == 0


def test_calendar_modes_differ_only_between_utc_and_local_midnight(spark):
    df = series(spark, [(15 * 94,), (15 * 40,)], [])
    for mode, want in (("reference", [0, 0]), ("consistent", [0, 1])):
        flags = df.select("series_id", "ts", recursive.step_calendar("ts", mode=mode)["weekday_sin"].alias("s"))
        first = values(flags, "s")
        assert [int(abs(v) > 1e-9) for v in first] == want
    with pytest.raises(ValueError):
        recursive.step_calendar(mode="other")


def test_trees_beat_the_day_before(spark, data):
    fitted = models.fit_one_step(data.train, data.features, "gbt", rounds=20, depth=5)
    scored = models.score(fitted, data.test, data.features).withColumnRenamed("load_kwh", "y")
    error = regression_metrics(scored).first().rmse
    naive = regression_metrics(scored, yhat="lag_24h").first().rmse
    assert error < naive


def test_tree_recursion_with_linear_model_equals_projection(spark, data):
    fitted = models.fit_one_step(data.train, data.features, "linear")
    step = recursive.linear_step(fitted)
    origins = recursive.midnight_origins(data.test)
    a = recursive.forecast_linear(data.rows, origins, step, horizon=14).toPandas()
    b = recursive.forecast_model(data.rows, origins, fitted, step.features, horizon=14).toPandas()
    a, b = (d.sort_values(["origin", "h"]) for d in (a, b))
    assert len(a) and list(a.yhat) == pytest.approx(list(b.yhat), rel=1e-8)


def test_saved_model_scores_alike_and_keeps_its_features(spark, data, tmp_path):
    fitted = models.fit_one_step(data.train, data.features, "gbt", rounds=2, depth=2)
    writers.save_model(fitted, str(tmp_path / "m"))
    again = writers.load_model(str(tmp_path / "m"))
    assert writers.model_features(again) == data.features
    assert values(models.score(again, data.test), "yhat") == values(models.score(fitted, data.test), "yhat")


def test_comparison_and_ablation(spark, data):
    fitted, table = models.compare_models(
        data, {"linear": models.linear(), "gbt": models.boosted_trees(rounds=2, depth=2)}
    )
    best = models.choose_best(table)
    rows = {r.model: r.rmse_test for r in table.collect()}
    assert set(rows) == set(fitted) and rows[best] == min(rows.values())


def test_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) * [1, 100, 0.01]
    y = np.column_stack([5 + x @ [1, 2, 3], -1 + x @ [0, -1, 4]])
    assert solve(products(x, y)) == pytest.approx(np.array([[5, -1], [1, 0], [2, -1], [3, 4]]), abs=1e-6)
    constant = np.column_stack([x, np.full(200, 7.0)])
    assert solve(products(constant, y))[4] == pytest.approx([0, 0])


def direct_rows(data):
    rows = lags.horizon_targets(data.rows.drop("split"), "load_kwh")
    return stage(split.with_split(rows))


def test_direct_linear_equals_separate_fits(spark, data):
    rows = direct_rows(data)
    train = rows.where("split = 'train'")
    features = ["hour_sin", "hour_cos", "lag_1h", "lag_24h"]
    fitted = direct.fit_direct_linear(train, features)
    frame = train.select(*features, "targets").toPandas()
    x = np.column_stack([np.ones(len(frame)), frame[features]])
    want = np.linalg.lstsq(x, np.vstack(frame.targets), rcond=None)[0]
    assert fitted.weights == pytest.approx(want, rel=1e-6, abs=1e-6)
    long = direct.paired(fitted.predict(rows))
    assert long.count() == rows.count() * 96
    assert regression_metrics(long).first().r2 > 0.5


def test_direct_models_per_horizon(spark, data):
    rows = direct_rows(data)
    fits = direct.fit_direct_each(rows, ["lag_1h", "hour_sin"], Boosting(rounds=2, leaves=4))
    out = direct.predict_each(fits, rows)
    assert out.where(F.size("forecasts") != 96).count() == 0
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        out.explain()
    assert plan.getvalue().count("ArrowEvalPython") == 1 and "Generate" not in plan.getvalue()


def test_recursion_with_trees_equals_a_plain_loop(spark, data):
    features = ["lag_15m", "lag_24h", "diff_15m", "hour_sin", "is_workday", "temp_2m_lag15", "not_there"]
    known = [c for c in features if c in data.rows.columns]
    model = fit_boosted(data.train, known, "load_kwh", Boosting(rounds=4, leaves=8, step=0.5))
    model = replace(model, features=tuple(features[: len(known)]))
    origins = recursive.midnight_origins(data.test)
    starts = recursive.histories(data.rows, origins)
    blocks = stage(recursive.recomputed_steps(starts, data.rows, model.features))
    got = {(r.series_id, r.origin): r.hist for r in recursive.advance_with_trees(blocks, model).collect()}
    assert len(got) == blocks.count() > 0
    for r in blocks.collect():
        hist = list(r.hist)
        for s in r.steps:
            now = s.asDict() | {c: hist[-k] for c, k in recursive.LAG_ROWS.items()} | {"diff_15m": hist[-1] - hist[-2]}
            x = np.array([[np.nan if now.get(c) is None else float(now[c]) for c in model.features]])
            hist.append(float(model.predict_bins(model.bins(x))[0, 0]))
        assert got[r.series_id, r.origin] == pytest.approx(hist)
    table = recursive.forecast_trees(data.rows, origins, model)
    assert table.count() == sum(len(r.steps) for r in blocks.collect())


def test_comparison_saves_every_model(spark, data, tmp_path):
    fitted, _ = models.compare_models(data, {"linear": models.linear()}, folder=str(tmp_path))
    again = writers.load_model(f"{tmp_path}/linear")
    rows = [models.score(m, data.test, data.features).agg(F.sum("yhat")).first()[0] for m in (fitted["linear"], again)]
    assert rows[0] == rows[1]


def test_unused_feature_has_no_importance(spark, data):
    step = recursive.LinearStep(0.0, {"lag_15m": 1.0})

    def predict(rows):
        return rows.withColumn("y", F.col("load_kwh")).withColumn("yhat", F.col("lag_15m"))

    table = importance.one_step_importance(data.test, ["lag_15m", "lag_1h"], predict, size=300, repeats=3)
    rows = {r.feature: r for r in table.collect()}
    assert rows["lag_15m"].importance_mean > 0 and rows["lag_1h"].importance_mean == 0.0
    assert step.features == ["lag_15m"]


def test_models_of_arrays_equal_scored_copies(spark, data):
    """Errors summed inside the map, against every copy scored as a row."""
    names = ["lag_15m", "lag_24h", "hour_cos", "temp_2m_lag15"]
    rows = data.test.withColumn("load_kwh", F.when(F.col("pos") % 50 != 0, F.col("load_kwh")))
    known = data.train.where("load_kwh is not null")
    trees = fit_boosted(known, names, "load_kwh", Boosting(rounds=3, leaves=6, bins=16))
    linear = direct.one_horizon(recursive.LinearStep(3.0, dict(zip(names, (0.5, 0.3, 2.0, 0.1))), {"temp_2m_lag15": 9.0}))
    for model in (trees, linear):

        def predict(table):
            return model.predict(table).withColumn("yhat", F.col("forecasts")[0]).withColumn("y", F.col("load_kwh"))

        fast = importance.one_step_importance(rows, names, model, repeats=2).collect()
        plain = {r.feature: r for r in importance.one_step_importance(rows, names, predict, repeats=2).collect()}
        assert [r.feature for r in fast] == sorted(names, key=lambda f: (-plain[f].importance_mean, f))
        for r in fast:
            assert r.importance_mean == pytest.approx(plain[r.feature].importance_mean, abs=1e-9)
            assert r.importance_std == pytest.approx(plain[r.feature].importance_std, abs=1e-9)


def test_donors_are_a_permutation(spark, data):
    rows = importance.numbered(data.test.drop("pos", "n_rows")).select("series_id", "ts", "pos", "lag_15m", "lag_24h")
    table = importance.donated(rows, ["lag_15m", "lag_24h"], 2).collect()
    assert len(table) == rows.count() and all(len(r.others) == 2 for r in table)

    def counted(pairs):
        return Counter((s, *["null" if v is None else v for v in x]) for s, x in pairs)

    own = counted((r.series_id, r.own) for r in table)
    for k in range(2):
        assert counted((r.series_id, r.others[k]) for r in table) == own
    assert any(r.others[0] != r.others[1] for r in table)
    some = rows.where("pos % 7 = 0").select("series_id", "pos")
    full = {(r.series_id, r.pos): (r.own, r.others) for r in table}
    part = importance.donated(rows, ["lag_15m", "lag_24h"], 2, receivers=some).collect()
    assert len(part) == some.count() and all(full[r.series_id, r.pos] == (r.own, r.others) for r in part)


def test_no_copy_of_a_row_is_shuffled(spark, data):
    """Only keys are repeated before an exchange, and the features that other rows take."""
    rows = stage(importance.numbered(data.test.drop("pos", "n_rows")), "rows")
    plan = importance.donated(rows, ["lag_15m", "lag_24h"], 2)._jdf.queryExecution().optimizedPlan().toString()
    generated = [line for line in plan.splitlines() if "Generate explode" in line]
    assert generated and all("load_kwh" not in line for line in generated)


def test_without_actual_values_importance_is_an_error(spark, data):
    model = direct.one_horizon(recursive.LinearStep(0.0, {"lag_15m": 1.0}))
    for rows in (data.test.where("false"), data.test.withColumn("load_kwh", F.lit(None).cast("double"))):
        with pytest.raises(ValueError):
            importance.one_step_importance(rows, ["lag_15m"], model)


def test_recursion_takes_shuffled_features_for_any_model(spark, data):
    """A model that is scored step by step and the same one as a projection."""
    model = recursive.LinearStep(20.0, {"hour_sin": 10.0, "temp_2m_lag15": 0.5, "lag_15m": 0.5, "lag_24h": 0.3})

    def advance(blocks):
        score = F.transform("steps", lambda s: F.struct(
            s["h"].alias("h"), s["ts"].alias("ts"), s["y"].alias("y"), model.outside_score(lambda c: s[c]).alias("score")))
        return model.advance(blocks.withColumn("steps", score))

    settings = {"repeats": 2, "max_missing": 96}
    one = importance.recursive_importance(data.rows, model.features, model.advance, combine=model.outside_score, **settings)
    two = importance.recursive_importance(data.rows, model.features, advance, **settings)
    assert [r.feature for r in one.collect()] == [r.feature for r in two.collect()]
    for a, b in zip(one.collect(), two.collect()):
        assert a.delta_rmse_mean == pytest.approx(b.delta_rmse_mean, abs=1e-9)


def test_recursion_ignores_shuffled_lags(spark, data):
    model = recursive.LinearStep(20.0, {"hour_sin": 10.0, "lag_15m": 0.5, "lag_24h": 0.3})
    table = importance.recursive_importance(
        data.rows, model.features, model.advance, blocks=2, repeats=2, max_missing=96, combine=model.outside_score
    )
    rows = {r.feature: r.delta_rmse_mean for r in table.collect()}
    assert rows["lag_15m"] == 0.0 and rows["lag_24h"] == 0.0 and rows["hour_sin"] != 0.0


def test_sparse_fit_is_the_best_of_all_sign_patterns():
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=(60, 2)), rng.normal(size=(60, 3)) @ rng.normal(size=(3, 3))])
    y = 2 + x[:, 0] - 3 * x[:, 2] + 0.3 * rng.normal(size=60)
    ridge, lasso = np.array([0.0, 0.5, 0, 0, 0]), np.array([0, 0, 9.0, 9.0, 9.0])
    got = solve_sparse(products(x, y[:, None]), ridge, lasso)

    def cost(w):
        left = y - w[0] - x @ w[1:]
        return (left @ left + ridge @ w[1:] ** 2) / 2 + lasso @ np.abs(w[1:])

    full, best = np.column_stack([np.ones(60), x]), math.inf
    gram = full.T @ full + np.diag([0.0, *ridge])
    for signs in itertools.product((-1, 0, 1), repeat=3):
        on = [0, 1, 2, *[3 + i for i, s in enumerate(signs) if s]]
        w = np.zeros(6)
        pull = np.array([0, 0, 0, *[9.0 * s for s in signs]])
        w[on] = np.linalg.solve(gram[np.ix_(on, on)], (full.T @ y - pull)[on])
        best = min(best, cost(w))
    assert cost(got) == pytest.approx(best, rel=1e-12)
    assert (got[3:] == 0).any() and (got[3:] != 0).any()


def test_daily_trend_changes_at_few_points(spark):
    days = spark.range(1200).select(
        F.lit("a").alias("series_id"),
        F.date_add(F.lit("2019-01-01").cast("date"), F.col("id").cast("int")).alias("ds"),
        (100 + 0.1 * F.greatest(F.col("id") - 300, F.lit(0)) + F.sin(F.col("id") * 7.3)).alias("y"),
    )
    model = daily.DailyModel()
    frame = daily.daily_frame(days)
    fitted = stage(daily.fit_daily(frame, model))
    weights = np.array(fitted.first().weights)
    assert 0 < np.count_nonzero(weights[2:27]) <= 8
    assert daily.gradient(frame, fitted, model).select(F.max(F.abs("gradient"))).first()[0] < 1e-9


def test_daily_baseline_finds_week_and_parts_add_up(spark):
    days = spark.range(900).select(
        F.lit("a").alias("series_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("ds"),
        (100 + 0.05 * F.col("id") + F.when(F.col("id") % 7 == 3, 20).otherwise(0)).alias("y"),
    )
    model = daily.DailyModel()
    frame = daily.daily_frame(days)
    assert frame.where("split = 'train'").count() == 630
    out = daily.predict_daily(frame, daily.fit_daily(frame, model), model)
    row = regression_metrics(out.where("split = 'test'")).first()
    assert row.r2 > 0.9
    gap = out.select(F.max(F.abs(F.col("trend") + F.col("weekly") + F.col("yearly") + F.col("holidays") - F.col("yhat"))))
    assert gap.first()[0] < 1e-9


def test_normal_equations_show_weights_that_are_not_the_best(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b), [float(3 * a - b + e), float(a + 2 * e)]) for a, b, e in rng.normal(size=(200, 3))]
    df = spark.createDataFrame(rows, "a double, b double, targets array<double>")
    fitted = direct.fit_direct_linear(df, ["a", "b"], horizon=2)
    facts = direct.normal_equations(df, fitted)
    assert [f[:2] for f in facts] == [(1, 200), (2, 200)]
    assert [f[2] for f in facts] == pytest.approx([np.mean([r[2][h] for r in rows]) for h in (0, 1)])
    assert max(f[3] for f in facts) < 1e-12
    fitted.weights[2, 1] += 0.01
    off = direct.normal_equations(df, fitted)
    assert off[0][3] < 1e-12 and off[1][3] > 1e-3
