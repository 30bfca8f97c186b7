import math
from statistics import NormalDist

import numpy as np
import pytest
from helpers import series, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterloom import metrics
from meterloom.functions.numeric import with_inverse_normal
from meterloom.operators import correlate, profile
from meterloom.operators.ranks import exact_quantiles, explode_ranks, value_ranks


def pairs(spark, rows):
    return spark.createDataFrame(rows, "g string, y double, yhat double")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-20, 20).map(float), min_size=1, max_size=200), st.integers(2, 40))
def test_ranks_and_quantiles_are_exact(spark, data, ranges):
    df = spark.createDataFrame([(v,) for v in data], "v double")
    ranks = value_ranks(df, "v", ranges=ranges, split_over=3)
    got = [(r.rank, r.v) for r in explode_ranks(ranks).orderBy("rank").collect()]
    assert got == list(enumerate(sorted(data)))
    row = exact_quantiles(df, "v", {"q1": 0.25, "q2": 0.5, "q9": 0.9}, split_over=3).first()
    assert [row.q1, row.q2, row.q9] == pytest.approx(list(np.quantile(data, [0.25, 0.5, 0.9])))


def test_one_value_holding_most_rows(spark):
    df = spark.range(200000).select(F.when(F.col("id") < 150000, 5.0).otherwise(F.col("id") * 1.0).alias("v"))
    row = exact_quantiles(df, "v", {"m": 0.5, "q": 0.9}, split_over=1000).first()
    assert (row.m, row.q) == (5.0, pytest.approx(179999.1))
    assert explode_ranks(value_ranks(df, "v")).agg(F.countDistinct("rank")).first()[0] == 200000


def test_box_whiskers_end_at_data(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]], "v double")
    row = profile.box_stats(df, "v").first()
    assert (row.q1, row.median, row.q3) == (3.25, 5.5, 7.75)
    assert (row.whisker_low, row.whisker_high, row.n_outliers) == (1.0, 9.0, 1)


def test_histogram_matches_numpy(spark):
    data = np.random.default_rng(0).normal(size=500).round(2)
    df = series(spark, [(15 * i, float(v)) for i, v in enumerate(data)], ["v double"])
    rows = profile.histogram(df, "v", 20).orderBy("bin").collect()
    counts, edges = np.histogram(data, 20)
    assert [r.n_values for r in rows] == list(counts)
    assert [r.low for r in rows] == pytest.approx(list(edges[:-1]))


def test_constant_series_has_one_full_bin(spark):
    df = series(spark, [(15 * i, 3.0) for i in range(9)], ["v double"])
    assert profile.histogram(df, "v", 4).agg(F.sum("n_values")).first()[0] == 9


def test_inverse_normal(spark):
    ps = [1e-12, 1e-6, 0.01, 0.075, 0.3, 0.5, 0.7, 0.925, 0.99, 1 - 1e-9]
    df = with_inverse_normal(spark.createDataFrame([(p,) for p in ps], "p double"), F.col("p"), "z")
    got = [r.z for r in df.orderBy("p").collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(p) for p in ps], rel=1e-12, abs=1e-13)


def test_autocorrelation_of_many_blocks_short_and_constant_series(spark):
    rng = np.random.default_rng(3)
    values = {"long": 1e6 + rng.normal(0, 1, 9000).cumsum(), "short": rng.normal(0, 1, 5), "flat": np.full(40, 0.1)}
    rows = [(k, i, None if k == "long" and i % 11 == 5 else float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "series_id string, i int, load_kwh double").select(
        "series_id", F.timestamp_seconds(F.col("i") * 900).alias("ts"), "load_kwh"
    )
    got = {}
    for r in correlate.autocorrelation(df, max_lag=30, thin=2).collect():
        got.setdefault(r.series_id, {})[r.lag] = r.acf
    for key in ("long", "short"):
        x = np.array([v for k, _, v in rows if k == key and v is not None])[::2]
        x = x - x.mean()
        want = {k: (x[: len(x) - k] @ x[k:]) / (x @ x) for k in range(min(31, len(x)))}
        assert got[key] == pytest.approx(want, abs=1e-9)
    assert len(got["flat"]) == 20 and set(got["flat"].values()) == {None}


def test_autocorrelation_matches_direct_sum(spark):
    y = np.random.default_rng(2).normal(size=400).cumsum()
    df = series(spark, [(15 * i, float(v)) for i, v in enumerate(y)], ["load_kwh double"])
    rows = correlate.autocorrelation(df, max_lag=10).orderBy("lag").collect()
    x = y[::4] - y[::4].mean()
    want = [float((x[: len(x) - k] * x[k:]).sum() / (x * x).sum()) for k in range(11)]
    assert [r.acf for r in rows] == pytest.approx(want)
    assert rows[0].band == 0.0 and rows[1].band == pytest.approx(correlate.Z_95 / math.sqrt(len(x)))


def test_decomposition_recovers_trend_and_season(spark):
    season = [3.0, -1.0, -2.0, 0.0]
    df = series(spark, [(60 * i, 2.0 * i + season[i % 4]) for i in range(60)], ["y double"])
    rows = correlate.seasonal_parts(df, "y", period=4).orderBy("ts").collect()
    assert all(r.trend is None for r in rows[:2] + rows[-2:])
    assert [r.seasonal for r in rows[:4]] == pytest.approx(season)
    assert [r.trend for r in rows[2:-2]] == pytest.approx([2.0 * i for i in range(2, 58)])
    assert [r.resid for r in rows[2:-2]] == pytest.approx([0.0] * 56, abs=1e-9)
    assert correlate.seasonal_parts(df, "y", period=4, min_rows=60).count() == 0


def test_metrics_by_hand(spark):
    row = metrics.regression_metrics(pairs(spark, [("a", 2.0, 1.0), ("a", 4.0, 6.0)])).first()
    assert (row.mae, row.rmse) == (1.5, pytest.approx(math.sqrt(2.5)))
    assert row.r2 == pytest.approx(1 - 5 / 2) and row.mape == pytest.approx(50.0)
    assert row.mae <= row.rmse


def test_zero_actual_uses_a_small_denominator(spark):
    df = pairs(spark, [("a", 0.0, 1e-6)])
    assert metrics.regression_metrics(df).first().mape == pytest.approx(100.0)


@pytest.mark.parametrize("yhat, want", [(3.0, 1.0), (4.0, 0.0)])
def test_constant_actuals(spark, yhat, want):
    df = pairs(spark, [("a", 3.0, yhat), ("a", 3.0, 3.0)])
    assert metrics.regression_metrics(df).first().r2 == want


@pytest.mark.parametrize("missing, kept", [(4, 1), (5, 0)])
def test_block_acceptance(spark, missing, kept):
    rows = [("a", None if i < missing else float(i), 1.0) for i in range(96)]
    df = pairs(spark, rows).withColumnRenamed("g", "origin")
    assert metrics.block_metrics(df, block=["origin"]).count() == kept


def test_blocks_with_few_values_are_left_out(spark):
    df = pairs(spark, [("a", float(i), 1.0) for i in range(9)] + [("b", float(i), 1.0) for i in range(10)])
    assert metrics.block_metrics(df, block=["g"]).first().g == "b"


def test_summary_and_score_of_no_blocks(spark):
    none = metrics.block_metrics(pairs(spark, [("a", 1.0, 1.0)]), block=["g"])
    assert metrics.mean_block_rmse(none).first().score is None
    df = pairs(spark, [(g, float(i), float(i + d)) for g, d in (("a", 1), ("b", 2), ("c", 6)) for i in range(10)])
    row = metrics.block_summary(metrics.block_metrics(df, block=["g"])).first()
    assert (row.n_blocks, row.mae_mean, row.mae_median) == (3, 3.0, 2.0)


def test_any_scorer(spark):
    df = pairs(spark, [("a", 1.0, 3.0), ("b", 1.0, 0.0)])
    got = metrics.score_by(df, lambda y, yhat: F.max(yhat - y), ["g"]).orderBy("g").collect()
    assert [r.score for r in got] == [2.0, -1.0]
