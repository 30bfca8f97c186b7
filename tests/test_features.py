import math

import numpy as np
import pandas as pd
import pytest
from helpers import series, stamp, values
from pyspark.sql import functions as F

from meterloom.config import DatasetConfig, Selection
from meterloom.functions import calendar as cal
from meterloom.operators import lags, resample, split
from meterloom.operators.ordering import CHUNK, chunked, with_position
from meterloom.plans.dataset import feature_list, model_rows, with_features
from meterloom.plans.prepare import prepare

CALENDAR = ["year", "month", "day", "weekday", "day_of_year", "quarter", "week"]


def load(spark, loads, series_id="a"):
    df = series(
        spark,
        [(15 * i, v) for i, v in enumerate(loads)],
        ["load_kwh double"],
        series_id,
    ).withColumns({"base_customers": F.col("load_kwh") / 2, "free_customers": F.col("load_kwh") / 4})
    local = cal.to_local("ts")
    return df.withColumns({n: c.cast("bigint") for n, c in cal.calendar_parts(local).items()})


def numbered(df, rows=8):
    return with_position(chunked(df, rows=rows)).drop(CHUNK)


@pytest.mark.parametrize("rows", [3, 50, 10000])
@pytest.mark.parametrize("partitions", [1, 4, 32])
def test_positions_do_not_depend_on_layout(spark, rows, partitions):
    minutes = sorted(set(np.random.default_rng(0).integers(0, 4000, 300).tolist()))
    df = series(spark, [(m, 1.0) for m in minutes], ["v double"]).repartition(partitions)
    out = numbered(df, rows)
    assert values(out, "pos") == list(range(len(minutes)))
    assert set(values(out, "n_rows")) == {len(minutes)}


@pytest.mark.parametrize("size", [2, 5, 1000])
def test_lag_and_lead_frames_cross_block_borders(spark, size):
    df = numbered(series(spark, [(15 * i, float(i)) for i in range(40)], ["v double"]))
    from meterloom.operators.ordering import block_window, with_frames

    w = block_window()
    out = with_frames(
        df, {"back": F.lag("v", 7).over(w), "ahead": F.lead("v", 9).over(w)}, before=7, after=9, size=size
    )
    want = [(float(i - 7) if i >= 7 else None, float(i + 9) if i < 31 else None) for i in range(40)]
    assert values(out, "back", "ahead") == want


def test_lag_counts_rows_not_time(spark):
    loads = [float(i) for i in range(120)]
    loads[50] = None
    out = prepare(load(spark, loads))
    after_gap = out.where(F.col("ts") == F.lit(stamp(15 * 97)).cast("timestamp")).first()
    # 97 is row 96 once slot 50 is gone: its 96th predecessor is slot 0.
    assert after_gap.lag_24h == 0.0 and after_gap.lag_15m == 96.0
    assert out.count() == 120 - 1 - 96


def test_first_surviving_row_has_no_weather(spark):
    loads = load(spark, [float(i) for i in range(98)])
    weather = series(spark, [(30 * i, float(i), f"t{i}") for i in range(60)], ["temp_2m double", "note string"])
    out = prepare(loads, weather)
    assert values(out, "temp_2m_lag15") == [None, 48.0]
    assert values(out, "lag_24h") == [0.0, 1.0]
    assert "temp_2m" not in out.columns and "base_customers" not in out.columns


def test_prepare_matches_pandas(spark):
    rng = np.random.default_rng(5)
    n = 700
    loads = rng.uniform(10, 90, n)
    loads[rng.choice(np.arange(1, n - 1), 60, replace=False)] = np.nan
    keep = [None if math.isnan(v) else float(v) for v in loads]
    ten = np.sort(rng.choice(n * 3 // 2 - 30, 600, replace=False))
    temps = rng.uniform(-5, 25, len(ten))
    df = load(spark, keep)
    weather = series(spark, [(int(10 * i), float(t), f"s{i}") for i, t in zip(ten, temps)],
                     ["temp_2m double", "note string"])
    got = prepare(df, weather).orderBy("ts").toPandas()

    axis = pd.date_range("2024-01-01", periods=n, freq="15min")
    wx = pd.DataFrame({"temp": temps, "note": [f"s{i}" for i in ten]},
                      index=pd.Timestamp("2024-01-01") + pd.to_timedelta(ten * 10, unit="min"))
    frame = pd.DataFrame({"y": loads}, index=axis)
    frame["temp"] = wx["temp"].reindex(axis).interpolate(method="time", limit_direction="both")
    near = pd.merge_asof(pd.DataFrame(index=axis), wx[["note"]], left_index=True, right_index=True,
                         direction="nearest", tolerance=pd.Timedelta("7min30s"))
    frame["note"] = near["note"].ffill().bfill()
    frame = frame.dropna(subset=["y"])
    for name, k in (("lag_15m", 1), ("lag_30m", 2), ("lag_1h", 4), ("lag_24h", 96)):
        frame[name] = frame["y"].shift(k)
    frame = frame.dropna(subset=["lag_24h"])
    frame["temp_lag"] = frame["temp"].shift(1)
    assert len(got) == len(frame)
    for ours, theirs in (("lag_15m", "lag_15m"), ("lag_24h", "lag_24h"), ("temp_2m_lag15", "temp_lag")):
        assert got[ours].to_numpy(float) == pytest.approx(frame[theirs].to_numpy(float), nan_ok=True)
    assert list(got["note"]) == list(frame["note"])


def test_series_do_not_mix(spark):
    both = load(spark, [float(i) for i in range(100)]).unionByName(
        load(spark, [1000.0 + i for i in range(100)], "b")
    )
    out = prepare(both)
    assert out.where("series_id = 'a' and lag_24h >= 1000").count() == 0
    assert out.groupBy("series_id").count().where("count = 4").count() == 2


def test_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("abc", "1.5"), ("7", "x")], "a string, b string")
    from meterloom.functions.numeric import try_double, try_long

    rows = df.select(try_long("a"), try_double("b")).collect()
    assert [tuple(r) for r in rows] == [(None, 1.5), (7, None)]


def test_clock_change_days(spark):
    spring = series(spark, [(15 * i, 1.0) for i in range(96 * 2)], ["load_kwh double"]).withColumn(
        "ts", F.col("ts") + F.make_dt_interval(F.lit(89))
    )
    days = {str(r.ds): r.n_slots for r in resample.local_days(spring).collect()}
    assert days["2024-03-31"] == 92
    autumn = series(spark, [(15 * i, 1.0) for i in range(96 * 3)], ["load_kwh double"]).withColumn(
        "ts", F.col("ts") + F.make_dt_interval(F.lit(299))
    )
    days = resample.local_days(autumn)
    assert {str(r.ds): r.n_slots for r in days.collect()}["2024-10-27"] == 100
    assert "2024-10-27" not in {str(r.ds) for r in resample.complete_days(days).collect()}


def test_day_aggregate_must_be_sum_or_mean(spark):
    with pytest.raises(ValueError):
        resample.local_days(load(spark, [1.0]), how="median")


def test_cyclic_pairs_and_missing_base(spark):
    df = load(spark, [1.0] * 5).withColumn("local_hour", F.hour("ts"))
    out = cal.add_cyclic(df)
    for name, _, _ in cal.CYCLES:
        ones = values(out, (F.col(f"{name}_sin") ** 2 + F.col(f"{name}_cos") ** 2).alias("one"))
        assert ones == pytest.approx([1.0] * 5)
    with pytest.raises(KeyError):
        cal.add_cyclic(df.drop("month"))


def test_easter_dates(spark):
    want = {1999: "04-04", 2000: "04-23", 2008: "03-23", 2011: "04-24", 2019: "04-21", 2024: "03-31", 2025: "04-20",
            1981: "04-19", 1954: "04-18", 2049: "04-18"}
    df = spark.createDataFrame([(y,) for y in want], "y int").select("y", cal.easter_sunday("y").alias("d"))
    assert {r.y: str(r.d)[5:] for r in df.collect()} == want


def test_split_is_chronological_and_complete(spark):
    df = split.with_split(numbered(series(spark, [(15 * i, 1.0) for i in range(11)], ["v double"])))
    assert values(df, "split") == ["train"] * 7 + ["test"] * 4


def test_shuffle_is_a_permutation_and_repeatable(spark):
    df = numbered(series(spark, [(15 * i, float(i)) for i in range(200)], ["v double"]))
    once = values(split.shuffled_columns(df, ["v"], 7), "v")
    assert sorted(once) == [float(i) for i in range(200)] and once != sorted(once)
    assert once == values(split.shuffled_columns(df.repartition(5), ["v"], 7), "v")
    assert once != values(split.shuffled_columns(df, ["v"], 8), "v")


def test_horizon_targets_need_all_rows(spark):
    df = numbered(series(spark, [(15 * i, float(i)) for i in range(100)], ["v double"]))
    out = lags.horizon_targets(df, "v")
    assert values(out, "targets")[3] == [float(i) for i in range(4, 100)] and out.count() == 4


def test_feature_list_follows_switches(spark):
    columns = ["hour_sin", "hour_cos", "week", "lag_1h", "lag_15m", "temp_2m_lag15", "wind_dir_lag15"]
    assert feature_list(columns, Selection()) == ["hour_sin", "hour_cos", "week", "lag_1h", "temp_2m_lag15"]
    assert feature_list(columns, Selection(frozenset({"lags"}), frozenset())) == [
        "lag_15m", "lag_1h"]


def test_period_is_closed_and_absent_features_are_null(spark):
    features = prepare(load(spark, [float(i) for i in range(110)]))
    cfg = DatasetConfig(period=("2024-01-02 00:15:00", "2024-01-02 01:15:00"))
    assert model_rows(features, DatasetConfig()).rows.count() == features.count()
    rows = model_rows(features, cfg).rows
    assert rows.count() == 5
    assert with_features(rows, ["lag_1h", "gone"]).select("gone").first().gone is None
