import numpy as np
import pandas as pd
import pytest
from helpers import series, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterloom.operators import align
from meterloom.operators.fill import ffill_bfill, interpolate_time
from meterloom.operators.ordering import CHUNK, chunked


def test_axis_is_complete_and_starts_at_first_stamp(spark):
    df = series(spark, [(5, 1.0), (65, 2.0)], ["v double"])
    axis = align.time_axis(df).drop(CHUNK)
    assert [t.minute for t in values(axis, "ts")] == [5, 20, 35, 50, 5]


def test_axis_over_many_chunks(spark):
    df = series(spark, [(0, 1.0), (15 * 999, 2.0)], ["v double"])
    axis = align.time_axis(df, rows=7).drop(CHUNK)
    assert axis.count() == 1000 and axis.distinct().count() == 1000


def test_regrid_drops_rows_off_the_axis_and_keeps_gaps(spark):
    df = series(spark, [(0, 1.0), (20, 9.0), (45, 4.0)], ["v double"])
    assert values(align.regrid(df, align.time_axis(df)).drop(CHUNK), "v") == [1.0, None, None, 4.0]


def test_nearest_tie_goes_to_the_earlier_row(spark):
    left = series(spark, [(15,)], [])
    right = series(spark, [(10, "a"), (20, "b")], ["note string"])
    assert values(align.asof_nearest(left, right, 450), "note") == ["a"]


def test_nearest_outside_tolerance_is_null(spark):
    left, right = series(spark, [(15,)], []), series(spark, [(0, "a")], ["note string"])
    assert values(align.asof_nearest(left, right, 450), "note") == [None]


def test_nearest_takes_the_row_even_if_its_value_is_null(spark):
    left = series(spark, [(15,)], [])
    right = series(spark, [(9, "far"), (14, None)], ["note string"])
    assert values(align.asof_nearest(left, right, 450), "note") == [None]


def test_nearest_matches_pandas_with_carries_over_chunks(spark):
    rng = np.random.default_rng(1)
    left_min = np.sort(rng.choice(6000, 300, replace=False))
    right_min = np.sort(rng.choice(6000, 200, replace=False))
    left = series(spark, [(int(m),) for m in left_min], [])
    right = series(spark, [(int(m), float(m)) for m in right_min], ["v double"])
    for tolerance in (300, 3600, 10**6):
        got = values(align.asof_nearest(left, right, tolerance, rows=16), "v")
        want = pd.merge_asof(
            pd.DataFrame({"m": left_min}),
            pd.DataFrame({"m": right_min, "v": right_min.astype(float)}),
            on="m",
            direction="nearest",
            tolerance=tolerance // 60,
        )["v"]
        assert [np.nan if g is None else g for g in got] == pytest.approx(list(want), nan_ok=True)


def test_backward_match_uses_equal_stamp_or_the_last_before(spark):
    left = series(spark, [(0,), (30,), (45,), (9000,)], [])
    right = series(spark, [(15, 1.0), (45, 2.0)], ["v double"])
    assert values(align.asof_backward(left, right, rows=4), "v") == [None, 1.0, 2.0, 2.0]


def test_ten_minute_squares_interpolate_to_the_mean_of_on_axis_values(spark):
    load = series(spark, [(0, 1.0), (30, 1.0)], ["y double"])
    weather = series(spark, [(0, 0.0), (10, 1.0), (20, 4.0), (30, 9.0)], ["v double"])
    grid = align.regrid(weather, align.time_axis(load))
    assert values(interpolate_time(grid, ["v"]), "v") == [0.0, 4.5, 9.0]


def test_ends_are_flat_without_limit(spark):
    rows = [(15 * i, None) for i in range(40)]
    rows[10], rows[20] = (150, 2.0), (300, 4.0)
    got = values(interpolate_time(chunked(series(spark, rows, ["v double"]), rows=8), ["v"]), "v")
    assert got[:11] == [2.0] * 11 and got[20:] == [4.0] * 20 and got[15] == pytest.approx(3.0)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=2, max_size=60),
    st.integers(2, 9),
)
def test_fills_match_pandas_for_any_chunk_size(spark, data, rows):
    df = chunked(series(spark, [(15 * i, v) for i, v in enumerate(data)], ["v double"]), rows=rows)
    index = pd.date_range("2024-01-01", periods=len(data), freq="15min")
    want = pd.Series(data, index=index, dtype=float)
    lines = want.interpolate(method="time", limit_direction="both")
    got = [np.nan if v is None else v for v in values(interpolate_time(df, ["v"]), "v")]
    assert got == pytest.approx(list(lines), nan_ok=True)
    got = [np.nan if v is None else v for v in values(ffill_bfill(df, ["v"]), "v")]
    assert got == pytest.approx(list(want.ffill().bfill()), nan_ok=True)


def test_weather_slots_agree_with_the_general_match(spark):
    rng = np.random.default_rng(3)
    load = series(spark, [(5, 1.0), (2000, 1.0)], ["y double"])
    minutes = np.sort(rng.choice(2000, 400, replace=False))
    weather = series(spark, [(int(m), f"n{m}") for m in minutes], ["note string"])
    start = load.groupBy("series_id").agg({"ts": "min"}).toDF("series_id", "start")
    axis = align.time_axis(load, rows=32)
    slots = align.weather_slots(weather, start, [], ["note"], 450, rows=32)
    on_axis = axis.join(slots, ["series_id", CHUNK, "ts"], "left").drop(CHUNK)
    assert values(on_axis, "note") == values(
        align.asof_nearest(axis.drop(CHUNK), weather, 450, rows=32), "note"
    )


def test_keep_last_prefers_the_later_file(spark):
    first = series(spark, [(0, 1.0), (10, 2.0)], ["v double"]).withColumn("row_no", align.F.lit(5))
    second = series(spark, [(10, 3.0)], ["v double"]).withColumn("row_no", align.F.lit(1))
    both = align.unite_files(first, second)
    assert values(align.keep_last(both, ["file_no", "row_no"]), "v") == [1.0, 3.0]


def test_unite_fills_absent_columns(spark):
    first = series(spark, [(0, 1.0)], ["v double"])
    second = series(spark, [(15, "x")], ["w string"])
    assert values(align.unite_files(first, second), "v", "w") == [(1.0, None), (None, "x")]


def test_repeated_key_is_an_error(spark):
    with pytest.raises(ValueError):
        align.assert_unique(series(spark, [(0, 1.0), (0, 2.0)], ["v double"]))


def test_gap_report_counts_before_regridding(spark):
    df = series(spark, [(0, 1.0), (0, 1.0), (45, 2.0)], ["v double"])
    row = align.gap_report(df).first()
    assert (row.expected, row.present, row.missing, row.surplus_rows) == (4, 2, 2, 1)
    assert align.missing_slots(df).count() == 2
