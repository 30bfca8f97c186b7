"""Boosted trees against a plain loop, and their files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.forecast.boosting import BoostedTrees, Boosting, binned, fit_boosted


def plain_boosting(x, y, plan):
    """Fitted values of one target: a loop over leaves, features and values; all features in every tree."""
    at = np.full(len(y), y.mean())
    for _ in range(plan.rounds):
        left, leaves, waiting, spare = y - at, {0: np.arange(len(y))}, {0}, plan.leaves - 1
        found, name = {}, 1
        while waiting:
            for leaf in waiting:
                rows, best = leaves[leaf], None
                for f in range(x.shape[1]):
                    for cut in np.unique(x[rows, f])[:-1]:
                        low = rows[x[rows, f] <= cut]
                        high = rows[x[rows, f] > cut]
                        if min(len(low), len(high)) < plan.least_rows:
                            continue
                        gain = np.float32(sum(left[s].sum() ** 2 / len(s) for s in (low, high)) - left[rows].sum() ** 2 / len(rows))
                        if best is None or gain > best[0]:
                            best = gain, low, high
                if best and best[0] > plan.least_gain:
                    found[leaf] = best
            fresh = set()
            for leaf in sorted(found, key=lambda i: (-found[i][0], i))[:spare]:
                _, low, high = found.pop(leaf)
                del leaves[leaf]
                leaves |= {name: low, name + 1: high}
                fresh |= {name, name + 1}
                name, spare = name + 2, spare - 1
            waiting = fresh if spare else set()
        for rows in leaves.values():
            at[rows] += plan.step * left[rows].mean()
    return at


@pytest.fixture(scope="module")
def case(spark):
    rng = np.random.default_rng(7)
    x = np.stack([rng.integers(0, 7, 300), rng.integers(0, 4, 300), rng.integers(-20, 20, 300)], axis=1).astype(float)
    y = np.stack([10 * (x[:, 0] > 3) * (x[:, 1] == 2) + x[:, 2], np.where(x[:, 2] > 5, 7, x[:, 0]), x[:, 1] ** 2], axis=1)
    y += rng.normal(size=y.shape)
    rows = [(i, *map(float, a), [float(v) for v in b]) for i, (a, b) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id long, a double, b double, c double, targets array<double>").repartition(5)


def fitted(model, df):
    return np.array([r.forecasts for r in model.predict(df).orderBy("id").collect()])


def test_all_targets_as_a_plain_loop_fits_each(case):
    x, y, df = case
    for leaves, least in ((2, 1), (7, 3)):
        plan = Boosting(rounds=4, leaves=leaves, step=0.5, column_share=1.0, least_rows=least, stage_every=3)
        model = fit_boosted(df, ["a", "b", "c"], "targets", plan)
        want = np.stack([plain_boosting(x, y[:, t], plan) for t in range(3)], axis=1)
        assert np.allclose(fitted(model, df), want, atol=1e-9)
        assert all((t.feature >= 0).sum(axis=1).max() < leaves for t in model.rounds)


def test_files_keep_the_model(spark, case, tmp_path):
    _, y, df = case
    model = fit_boosted(df, ["a", "b", "c"], "targets", Boosting(rounds=3, leaves=6, least_rows=5))
    model.save(spark, str(tmp_path / "m"))
    again = BoostedTrees.load(spark, str(tmp_path / "m"))
    assert again.features == model.features and (fitted(again, df) == fitted(model, df)).all()
    error = lambda m: ((fitted(m, df) - y) ** 2).mean()
    assert error(model) < ((y - y.mean(axis=0)) ** 2).mean()


def test_missing_values_and_one_target(spark, case):
    _, _, df = case
    one = df.select("id", F.when(F.col("id") % 3 > 0, F.col("a")).alias("a"), F.lit(None).cast("double").alias("none"),
                    F.when(F.col("id") % 3 == 0, 100.0).otherwise(F.col("a")).alias("y"))
    one = one.unionByName(spark.createDataFrame([(1000, float("nan"), None, None)], one.schema))
    model = fit_boosted(one, ["a", "none"], "y", Boosting(rounds=1, leaves=2, step=1.0, column_share=1.0))
    got = {r.id: r.forecasts[0] for r in model.predict(one.drop("none")).collect()}
    assert got[0] == pytest.approx(100) and got[1000] == pytest.approx(100) and got[1] < 7
    with pytest.raises(ValueError):
        fit_boosted(one.limit(0), ["a"], "y")


def test_constant_targets_need_no_split(spark):
    df = spark.createDataFrame([(i, float(i), [3.0, 4.0]) for i in range(60)], "id long, a double, targets array<double>")
    model = fit_boosted(df, ["a"], "targets", Boosting(rounds=2, leaves=4))
    assert (model.rounds[0].feature == -1).all() and np.allclose(fitted(model, df), [[3, 4]] * 60)


def test_bins():
    x = np.array([[np.nan, 0.0], [1.0, 5.0], [2.0, 5.1], [9.0, -1.0]])
    assert binned(x, [np.array([1.0, 2.0]), np.array([5.0])]).tolist() == [[0, 1], [1, 1], [2, 2], [3, 1]]


def test_trees_in_flight_fit_as_well(case):
    _, y, df = case
    errors = []
    for flight, rounds in ((1, 6), (4, 12)):
        model = fit_boosted(df, ["a", "b", "c"], "targets", Boosting(rounds=rounds, leaves=6, step=0.2, least_rows=5, flight=flight))
        assert len(model.rounds) == rounds and all((t.feature >= 0).any() for t in model.rounds)
        errors.append(((fitted(model, df) - y) ** 2).mean())
    assert errors[1] < errors[0]
