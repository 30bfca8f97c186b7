"""One query per operator over the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.catalog.adapters import load_table, table, weather_readings
from meterloom.config import DEFAULT_EXCLUDED_LAGS, DatasetConfig, Selection
from meterloom.forecast import daily, direct, importance, models, recursive
from meterloom.forecast.boosting import BoostedTrees, Boosting, fit_boosted
from meterloom.functions import calendar as cal
from meterloom.metrics import (
    best_model,
    bias,
    block_metrics,
    block_summary,
    mape_floor,
    mean_block_rmse,
    regression_metrics,
    score_by,
    train_test_metrics,
)
from meterloom.operators import align, correlate, flags, lags, profile, resample, split
from meterloom.operators.fill import ffill_bfill, interpolate_time
from meterloom.operators.ordering import CHUNK, chunked, with_position
from meterloom.plans.dataset import Dataset, load_and_split, model_rows, with_features
from meterloom.plans.prepare import clean_weather, prepare
from meterloom.session import configure, shared_folder, stage, stage_folder
from meterloom.sources.headers import LOAD_HEADERS, WEATHER_NUMBER_HEADERS
from meterloom.sources.readers import read_features, read_load_csv, read_weather_csv
from meterloom.sources.writers import (
    load_model,
    read_forecasts,
    save_model,
    store_forecasts,
    write_features,
    write_features_csv,
    write_report,
)
from meterloom.streaming import slots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(configure(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


# Moves values off exact ties of the sixth digit, which engines round differently.
OFF_TIE = 1.2345e-8


def r6(c: str | Column) -> Column:
    """Rounded so that engines that add in different orders agree; no negative zero."""
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(OFF_TIE), 6) + F.lit(0.0)


def plain(df: DataFrame) -> DataFrame:
    """Output types every client reads alike: stamps without zone, dates as text, whole numbers long."""
    out = []
    for field in df.schema.fields:
        kind, c = field.dataType.simpleString(), F.col(field.name)
        if kind == "timestamp":
            c = c.cast("timestamp_ntz")
        elif kind == "date":
            c = c.cast("string")
        elif kind == "int":
            c = c.cast("bigint")
        elif kind == "boolean":
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return df.select(*out)


def rounded(df: DataFrame) -> DataFrame:
    """All doubles rounded."""
    return df.select(
        *[
            r6(f.name).alias(f.name) if f.dataType.simpleString() == "double" else f.name
            for f in df.schema.fields
        ]
    )


def staged_load(spark: SparkSession, sf_dir: str, shift_days: int = 0) -> DataFrame:
    """Load table written once: the plans below read it several times, the events only here."""
    return stage(load_table(spark, sf_dir, shift_days), "load")


def staged_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(clean_weather(weather_readings(spark, sf_dir)), "weather")


def positioned(load: DataFrame) -> DataFrame:
    return with_position(chunked(load)).drop(CHUNK)


# --- axis, regridding, gaps ---------------------------------------------------------------


@query
def load_15min_regrid(spark, sf_dir):
    load = staged_load(spark, sf_dir)
    grid = align.regrid(load, align.time_axis(load))
    return grid.select("series_id", "ts", "load_kwh", "base_customers", "free_customers")


@query
def gap_report(spark, sf_dir):
    return align.gap_report(load_table(spark, sf_dir))


@query
def missing_slots(spark, sf_dir):
    return align.missing_slots(staged_load(spark, sf_dir).select("series_id", "ts"))


@query
def duplicate_keys(spark, sf_dir):
    return align.duplicate_keys(weather_readings(spark, sf_dir))


# --- positions, lags, leads ---------------------------------------------------------------


@query
def row_position(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts"))
    return rows.select("series_id", "ts", "pos", "n_rows")


@query
def load_lag_features(spark, sf_dir):
    load = staged_load(spark, sf_dir)
    features = prepare(load)
    return rounded(
        features.select(
            "series_id", "ts", "load_kwh", "lag_15m", "lag_30m", "lag_1h", "lag_24h",
            "base_customers_lag_15m", "free_customers_lag_15m", "diff_15m",
        )
    )


@query
def week_lag(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh"))
    return lags.add_lags(rows, {"lag_week": ("load_kwh", 672)}).drop("pos", "n_rows")


@query
def rolling_means(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh"))
    spans = {"mean_3h": 12, "mean_12h": 48, "mean_24h": 96}
    return rounded(lags.rolling_means(rows, "load_kwh", spans).drop("pos", "n_rows"))


@query
def multi_horizon_targets(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh"))
    wide = lags.horizon_targets(rows, "load_kwh")
    total = F.aggregate("targets", F.lit(0.0), lambda a, v: a + v)
    return wide.select(
        "series_id",
        "ts",
        F.element_at("targets", 1).alias("t_1"),
        F.element_at("targets", 48).alias("t_48"),
        F.element_at("targets", 96).alias("t_96"),
        r6(total).alias("t_sum"),
    )


@query
def horizon_long_form(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh"))
    long = lags.horizon_rows(lags.horizon_targets(rows, "load_kwh"))
    return rounded(
        long.groupBy("series_id", "h").agg(
            F.count(F.lit(1)).alias("n_rows"), F.avg("y").alias("mean_y")
        )
    )


@query
def every_fourth_row(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh"))
    return lags.every_nth(rows, 4).select("series_id", "ts", "load_kwh")


@query
def half_hour_rows(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh"))
    return lags.every_nth(rows, 2).select("series_id", "ts", "load_kwh")


# --- calendar -----------------------------------------------------------------------------


@query
def calendar_local(spark, sf_dir):
    load = load_table(spark, sf_dir, shift_days=80)
    parts = cal.local_parts("ts") | cal.day_flags("weekday")
    return load.select(
        "series_id", "ts", "year", "month", "day", "weekday", "day_of_year", "quarter", "week",
        *[c.alias(n) for n, c in parts.items()],
        cal.day_name("ts").alias("day_name"),
        cal.month_name("month").alias("month_name"),
        cal.season("month").alias("season"),
    )


@query
def cyclic_encoding(spark, sf_dir):
    load = load_table(spark, sf_dir, shift_days=80).withColumns(
        {"local_hour": cal.local_parts("ts")["local_hour"]}
    )
    encoded = cal.add_cyclic(load)
    names = [f"{n}_{f}" for n, _, _ in cal.CYCLES for f in ("sin", "cos")]
    return rounded(encoded.select("series_id", "ts", *names))


@query
def dst_local_day_counts(spark, sf_dir):
    load = staged_load(spark, sf_dir, shift_days=80)
    axis = align.time_axis(load)
    local = cal.to_local("ts")
    return axis.groupBy("series_id", F.to_date(local).alias("local_date")).agg(
        F.count(F.lit(1)).alias("n_slots"),
        F.count(F.when(F.hour(local) == 2, 1)).alias("n_slots_hour_2"),
    )


@query
def zone_round_trip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stamp = F.col("o_orderdate").cast("timestamp") + F.expr("interval 12 hours")
    return orders.select(
        "o_orderkey",
        cal.without_zone(cal.to_local(stamp)).alias("local_ts"),
        cal.to_utc(cal.to_local(stamp)).alias("utc_ts"),
    )


@query
def holiday_flags(spark, sf_dir):
    days = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("ds")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    holidays = cal.holiday_flags("ds")
    return days.select(
        "ds", "n_orders", *[c.alias(n) for n, c in holidays.items()],
        cal.is_holiday("ds").alias("is_holiday"),
    )


# --- weather ------------------------------------------------------------------------------


@query
def weather_keep_last(spark, sf_dir):
    return clean_weather(weather_readings(spark, sf_dir))


@query
def weather_interpolate_15min(spark, sf_dir):
    load, weather = staged_load(spark, sf_dir), staged_weather(spark, sf_dir)
    numbers = ["temp_2m", "global_rad", "wind_scalar_ms"]
    grid = align.regrid(weather.select("series_id", "ts", *numbers), align.time_axis(load))
    return rounded(interpolate_time(grid, numbers).drop(CHUNK))


@query
def weather_asof_nearest(spark, sf_dir):
    load, weather = staged_load(spark, sf_dir), staged_weather(spark, sf_dir)
    probes, notes = load.select("series_id", "ts"), weather.select("series_id", "ts", "note", "temp_2m")
    return align.asof_nearest(probes, notes, 450).drop(CHUNK)


@query
def weather_text_on_axis(spark, sf_dir):
    load, weather = staged_load(spark, sf_dir), staged_weather(spark, sf_dir)
    start = load.groupBy("series_id").agg(F.min("ts").alias("start"))
    slots = align.weather_slots(
        weather.select("series_id", "ts", "note"), start, [], ["note"], 450
    )
    axis = align.time_axis(load)
    return axis.join(slots, ["series_id", CHUNK, "ts"], "left").drop(CHUNK)


@query
def ffill_then_bfill(spark, sf_dir):
    load, weather = staged_load(spark, sf_dir), staged_weather(spark, sf_dir)
    cols = ["global_rad", "note"]
    grid = align.regrid(weather.select("series_id", "ts", *cols), align.time_axis(load))
    return ffill_bfill(grid, cols).drop(CHUNK)


@query
def weather_asof_backward(spark, sf_dir):
    load, weather = staged_load(spark, sf_dir), staged_weather(spark, sf_dir)
    probes, known = load.select("series_id", "ts", "load_kwh"), weather.select("series_id", "ts", "temp_2m", "note")
    return align.asof_backward(probes, known).drop(CHUNK)


@query
def merged_features(spark, sf_dir):
    return rounded(prepare(staged_load(spark, sf_dir), staged_weather(spark, sf_dir)))


# --- resampling and profiles --------------------------------------------------------------


@query
def hourly_mean(spark, sf_dir):
    return rounded(resample.hourly_mean(load_table(spark, sf_dir)))


@query
def daily_totals(spark, sf_dir):
    return rounded(resample.local_days(load_table(spark, sf_dir, shift_days=80)))


@query
def daily_complete_days(spark, sf_dir):
    days = resample.local_days(load_table(spark, sf_dir, shift_days=80), how="mean")
    return rounded(resample.complete_days(days))


def closed_slots(spark, sf_dir, shift_days: int = 0) -> DataFrame:
    """Hours of the stored load, read as a stream, that the watermark has closed."""
    folder = f"{stage_folder(spark)}/feed-{uuid.uuid4().hex}"
    load = load_table(spark, sf_dir, shift_days).select("series_id", "ts", "load_kwh")
    load.write.parquet(f"{folder}/in")
    sums = slots.slot_sums(spark.readStream.schema(load.schema).parquet(f"{folder}/in"))
    slots.write_closed(sums, folder).awaitTermination()
    return slots.read_closed(spark, folder, sums)


@query
def streamed_hourly_mean(spark, sf_dir):
    return rounded(slots.hourly_means(closed_slots(spark, sf_dir)))


@query
def streamed_daily_totals(spark, sf_dir):
    return rounded(slots.day_totals(closed_slots(spark, sf_dir, shift_days=80)))


@query
def hour_weekday_pivot(spark, sf_dir):
    return rounded(profile.hour_weekday_pivot(load_table(spark, sf_dir)))


@query
def daily_profile(spark, sf_dir):
    return rounded(profile.daily_profile(load_table(spark, sf_dir)))


@query
def box_by_weekday(spark, sf_dir):
    load = staged_load(spark, sf_dir).select("load_kwh", cal.day_name("ts").alias("day_name"))
    return rounded(profile.box_stats(load, keys=["day_name"]))


@query
def box_by_month(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_totalprice", cal.month_name(F.month("o_orderdate")).alias("month_name")
    )
    return rounded(profile.box_stats(orders, "o_totalprice", keys=["month_name"]))


@query
def box_global(spark, sf_dir):
    return rounded(profile.box_stats(table(spark, sf_dir, "events"), "value"))


@query
def outlier_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    boxes = profile.box_stats(events, "value", keys=["event_type"])
    return profile.outliers(events, "value", boxes, keys=["event_type"])


@query
def histogram_100(spark, sf_dir):
    return rounded(profile.histogram(staged_load(spark, sf_dir)))


@query
def histogram_centre(spark, sf_dir):
    """Mean and median beside the histogram."""
    return rounded(profile.describe(staged_load(spark, sf_dir), ["load_kwh"]).select("series_id", "mean", "median"))


@query
def describe_columns(spark, sf_dir):
    load = staged_load(spark, sf_dir)
    return rounded(profile.describe(load, ["load_kwh", "base_customers", "free_customers"]))


@query
def normal_qq(spark, sf_dir):
    points = profile.normal_qq(staged_load(spark, sf_dir))
    return rounded(points)


@query
def normal_qq_line(spark, sf_dir):
    return rounded(profile.qq_line(profile.normal_qq(staged_load(spark, sf_dir))))


# --- correlation --------------------------------------------------------------------------

CORRELATED = (
    "load_kwh", "lag_15m", "lag_30m", "lag_1h", "lag_24h", "base_customers_lag_15m",
    "free_customers_lag_15m", "diff_15m", "temp_2m_lag15", "global_rad_lag15",
    "wind_scalar_ms_lag15", "local_hour", "is_sunday", "is_workday", "day",
)


@query
def corr_with_target_top20(spark, sf_dir):
    features = prepare(staged_load(spark, sf_dir), staged_weather(spark, sf_dir))
    return rounded(correlate.correlation_ranking(features, CORRELATED).drop("place"))


@query
def corr_matrix(spark, sf_dir):
    features = prepare(staged_load(spark, sf_dir), staged_weather(spark, sf_dir))
    return rounded(correlate.correlation_matrix(features, CORRELATED[:9]))


@query
def corr_top5(spark, sf_dir):
    features = prepare(staged_load(spark, sf_dir), staged_weather(spark, sf_dir))
    return rounded(correlate.correlation_ranking(features, CORRELATED, top=5).drop("place"))


@query
def corr_matrix_of_top6(spark, sf_dir):
    """Ranking over all series, then the matrix of the strongest columns for each series."""
    features = stage(prepare(staged_load(spark, sf_dir), staged_weather(spark, sf_dir)), "features")
    ranking = correlate.correlation_ranking(features, CORRELATED, top=6, keys=())
    strongest = [r.feature for r in ranking.orderBy("place").collect()]
    return rounded(correlate.correlation_matrix(features, strongest))


@query
def linfit_lag1(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh"))
    lagged = lags.add_lags(rows, {"lag_15m": ("load_kwh", 1)})
    return rounded(correlate.line_fit(lagged, "load_kwh", "lag_15m"))


@query
def acf_168(spark, sf_dir):
    return rounded(correlate.autocorrelation(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh")))


@query
def seasonal_decompose(spark, sf_dir):
    hourly = stage(resample.hourly_mean(load_table(spark, sf_dir)), "hourly")
    return rounded(correlate.seasonal_parts(hourly))


@query
def seasonal_decompose_daily(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    days = orders.groupBy(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("timestamp").alias("ts")
    ).agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / 1000).alias("y"))
    return rounded(correlate.seasonal_parts(stage(days, "days"), "y", period=7, step=86400))


# --- splits and samples -------------------------------------------------------------------


@query
def time_split(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts"))
    return split.with_split(rows).select("series_id", "ts", "split")


@query
def tail_sample(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh"))
    return split.tail_rows(rows, 500).select("series_id", "ts", "load_kwh")


@query
def seeded_sample(spark, sf_dir):
    return split.seeded_sample(load_table(spark, sf_dir).select("series_id", "ts", "load_kwh"), 8000)


@query
def seeded_origins(spark, sf_dir):
    load = load_table(spark, sf_dir).select("series_id", "ts")
    return split.seeded_sample(load.where(resample.at_local_midnight()), 40)


@query
def column_shuffle(spark, sf_dir):
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh", "base_customers"))
    return split.shuffled_columns(rows, ["load_kwh"]).select("series_id", "ts", "load_kwh", "base_customers")


@query
def day_slice(spark, sf_dir):
    load = load_table(spark, sf_dir)
    return load.where(resample.whole_days("ts", "2024-01-08", "2024-01-14")).select("series_id", "ts", "load_kwh")


@query
def semi_join_keys(spark, sf_dir):
    load = load_table(spark, sf_dir).select("series_id", "ts", "load_kwh")
    return align.keep_matching(load, clean_weather(weather_readings(spark, sf_dir)))


# --- metrics ------------------------------------------------------------------------------


def naive_forecast(spark, sf_dir) -> DataFrame:
    """Seasonal-naive stand-in: the forecast is the value 96 rows earlier."""
    rows = positioned(staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh"))
    shifted = lags.add_lags(rows, {"yhat": ("load_kwh", 96), "yhat_1": ("load_kwh", 1)})
    return split.with_split(shifted.where("pos >= 96").withColumnRenamed("load_kwh", "y"))


@query
def metrics_naive96(spark, sf_dir):
    return rounded(regression_metrics(naive_forecast(spark, sf_dir), keys=["series_id"]))


@query
def metrics_train_test(spark, sf_dir):
    return rounded(train_test_metrics(naive_forecast(spark, sf_dir), keys=["series_id"]))


@query
def score_bias_and_floor_mape(spark, sf_dir):
    forecast = naive_forecast(spark, sf_dir)
    low = score_by(forecast, bias, ["series_id"]).withColumnRenamed("score", "bias")
    return rounded(low.join(
        score_by(forecast, mape_floor, ["series_id"]).withColumnRenamed("score", "mape_floor"),
        "series_id",
    ))


@query
def example_day_metrics(spark, sf_dir):
    day = naive_forecast(spark, sf_dir).where(resample.whole_days("ts", "2024-01-15", "2024-01-15"))
    return rounded(regression_metrics(day, keys=["series_id"]))


@query
def best_model_by_rmse(spark, sf_dir):
    forecast = naive_forecast(spark, sf_dir)
    both = forecast.select(
        "series_id", "split", "y",
        F.explode(F.create_map(F.lit("day_before"), "yhat", F.lit("slot_before"), "yhat_1")).alias("model", "yhat"),
    )
    comparison = train_test_metrics(both, keys=["series_id", "model"])
    return rounded(best_model(comparison, keys=["series_id"]))


def midnight_blocks(spark, sf_dir) -> DataFrame:
    """Blocks of 96 slots from each local midnight with a load row; forecast is the value 96 rows before the origin-based slot."""
    load = staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh")
    origins = load.where(resample.at_local_midnight()).select("series_id", F.col("ts").alias("origin"), F.col("load_kwh").alias("yhat"))
    h = F.explode(F.sequence(F.lit(1), F.lit(96)))
    slots = origins.withColumn("h", h).withColumn(
        "ts", F.timestamp_seconds(F.unix_seconds("origin") + (F.col("h") - 1) * 900)
    )
    return align.truth_at(slots, load).withColumnRenamed("load_kwh", "y")


@query
def block_metrics_midnight(spark, sf_dir):
    return rounded(block_metrics(midnight_blocks(spark, sf_dir)))


@query
def block_metrics_summary(spark, sf_dir):
    blocks = block_metrics(midnight_blocks(spark, sf_dir))
    return rounded(block_summary(blocks, keys=["series_id"]))


@query
def block_rmse_score(spark, sf_dir):
    return rounded(mean_block_rmse(block_metrics(midnight_blocks(spark, sf_dir))))


# --- modelling frame ----------------------------------------------------------------------

JANUARY = DatasetConfig(period=("2024-01-03 00:00:00", "2024-01-30 12:00:00"))


@query
def modelling_rows(spark, sf_dir):
    features = stage(prepare(staged_load(spark, sf_dir), staged_weather(spark, sf_dir)), "features")
    data = model_rows(features, JANUARY)
    return rounded(data.rows)


# --- flags --------------------------------------------------------------------------------


@query
def extreme_weather_flag(spark, sf_dir):
    weather = staged_weather(spark, sf_dir).select("series_id", "ts", "temp_2m")
    return flags.extreme_flag(weather, "temp_2m", low=0.05, high=0.95)


@query
def anomaly_flags(spark, sf_dir):
    marked = flags.residual_anomalies(naive_forecast(spark, sf_dir), k=2.5)
    return rounded(marked.select("series_id", "ts", "y", "yhat", "z", "is_anomaly"))


# --- files --------------------------------------------------------------------------------


def fresh_path(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def load_csv_round_trip(spark, sf_dir):
    """Load table to a ``;`` file under the file headers and back through the reader."""
    back = {name: header for header, name in LOAD_HEADERS.items()}
    load = load_table(spark, sf_dir).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX"))
    path = fresh_path(spark, "load-csv")
    load.withColumnsRenamed(back).write.csv(path, sep=";", header=True)
    return read_load_csv(spark, path)


@query
def weather_csv_round_trip(spark, sf_dir):
    """Two weather files with decimal commas, read in order, later file wins."""
    headers = {name: header for header, name in WEATHER_NUMBER_HEADERS.items()}
    names = {c: headers[c] for c in ("temp_2m", "global_rad", "wind_scalar_ms")}
    readings = stage(weather_readings(spark, sf_dir), "readings")
    paths = []
    for number in (0, 1):
        # Several part files in row order, with repeated stamps: the last row of a stamp must win.
        rows = readings.where(F.col("file_no") == number).repartitionByRange(4, "row_no").sortWithinPartitions("row_no")
        text = rows.select(
            "series_id",
            "note",
            F.date_format("ts", "dd.MM.yyyy HH:mm").alias("Date and Time"),
            *[F.translate(F.col(c).cast("string"), ".", ",").alias(h) for c, h in names.items()],
        )
        paths.append(fresh_path(spark, f"weather-csv-{number}"))
        text.write.csv(paths[-1], sep=";", header=True, encoding="ISO-8859-1")
    return clean_weather(read_weather_csv(spark, paths)).select("series_id", "ts", *names, "note")


@query
def features_csv_round_trip(spark, sf_dir):
    features = stage(prepare(staged_load(spark, sf_dir), staged_weather(spark, sf_dir)).drop("note"), "features")
    path = fresh_path(spark, "features") + ".csv"
    write_features_csv(features, path)
    return rounded(read_features(spark, path))


@query
def features_parquet_round_trip(spark, sf_dir):
    path = fresh_path(spark, "features-parquet")
    write_features(prepare(staged_load(spark, sf_dir)), path)
    data = load_and_split(spark, path)
    return data.rows.groupBy("series_id", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query
def report_round_trip(spark, sf_dir):
    """Metrics table to a report file and back."""
    report = rounded(regression_metrics(naive_forecast(spark, sf_dir), keys=["series_id"]))
    path = fresh_path(spark, "report")
    write_report(report, path)
    return spark.read.schema(report.schema).csv(path, header=True)


# --- forecasts ----------------------------------------------------------------------------

EVERYTHING = DatasetConfig(Selection(without=frozenset()))
NO_SHORT_LAGS = DatasetConfig(Selection(without=frozenset(DEFAULT_EXCLUDED_LAGS)))
FIXED_MODEL = recursive.LinearStep(
    4.0,
    {
        "hour_cos": 1.5, "weekday_sin": -0.75, "week": 0.05, "is_workday": 0.5, "temp_2m_lag15": 0.02,
        "base_customers_lag_15m": 0.01, "lag_15m": 0.25, "lag_1h": 0.2, "lag_24h": 0.4, "diff_15m": -0.1,
    },
)


def model_data(spark, sf_dir, cfg=EVERYTHING, extra=()) -> Dataset:
    features = stage(prepare(staged_load(spark, sf_dir), staged_weather(spark, sf_dir)), "features")
    data = model_rows(features, cfg, extra)
    return Dataset(stage(data.rows, "model-rows"), data.features, cfg)


@query
def recursive_linear_24h(spark, sf_dir):
    rows = model_data(spark, sf_dir).rows
    return rounded(recursive.forecast_linear(rows, recursive.midnight_origins(rows), FIXED_MODEL))


@query
def recursive_linear_blocks(spark, sf_dir):
    rows = model_data(spark, sf_dir).rows
    forecast = recursive.forecast_linear(rows, recursive.midnight_origins(rows), FIXED_MODEL)
    return rounded(block_metrics(recursive.with_truth(forecast, rows)))


@query
def recursive_table_linear(spark, sf_dir):
    rows = model_data(spark, sf_dir).rows
    starts = recursive.histories(rows, recursive.midnight_origins(rows))
    blocks = recursive.table_steps(starts, rows, FIXED_MODEL.features, combine=FIXED_MODEL.outside_score)
    return rounded(recursive.forecast_rows(FIXED_MODEL.advance(blocks)))


@query
def next_day_forecast(spark, sf_dir):
    rows = model_data(spark, sf_dir).rows
    return rounded(recursive.next_day_forecast(
        rows, lambda origins: recursive.forecast_linear(rows, origins, FIXED_MODEL)
    ))


@query
def next_day_stored(spark, sf_dir):
    """Forecast of the daily job through its sink."""
    rows = model_data(spark, sf_dir).rows
    forecast = recursive.next_day_forecast(rows, lambda origins: recursive.forecast_linear(rows, origins, FIXED_MODEL))
    path = fresh_path(spark, "next-day")
    write_features(forecast, path)
    return rounded(read_features(spark, path).drop("ts_month"))


@query
def next_day_runs(spark, sf_dir):
    """The daily job for two days, the second one run again for some of the series: every block once."""
    rows = model_data(spark, sf_dir).rows
    path = fresh_path(spark, "daily-job")
    last = recursive.midnight_origins(rows).groupBy("series_id").agg(F.max("ts").alias("_last"))
    earlier = rows.join(last, "series_id").where("ts < _last").drop("_last")

    def advance(origins):
        return recursive.forecast_linear(rows, origins, FIXED_MODEL)

    store_forecasts(recursive.next_day_forecast(earlier, advance), path)
    second = recursive.next_day_forecast(rows, advance)
    store_forecasts(second, path)
    store_forecasts(second.where(F.pmod(F.xxhash64("series_id"), F.lit(2)) == 0), path)
    return rounded(read_forecasts(spark, path).drop("origin_day", "series_part"))


@query
def score_absent_feature(spark, sf_dir):
    """Fixed model on a table that lacks one of its features."""
    data = model_data(spark, sf_dir)
    rows = with_features(data.rows.drop("temp_2m_lag15"), FIXED_MODEL.features)
    return rounded(fixed_prediction(rows).select("series_id", "ts", "yhat"))


@query
def model_save_load(spark, sf_dir):
    """A stored pipeline scores as the fitted one does."""
    data = model_data(spark, sf_dir)
    fitted = fitted_linear(data)
    path = fresh_path(spark, "model")
    save_model(fitted, path)
    again = models.score(load_model(path), data.rows, data.features).select("series_id", "ts", F.col("yhat").alias("again"))
    both = models.score(fitted, data.rows, data.features).join(again, ["series_id", "ts"])
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("yhat") - F.col("again"))).alias("max_diff")
    )


@query
def direct_linear_weights(spark, sf_dir):
    """All 96 single-feature models from one pass."""
    load = staged_load(spark, sf_dir).select("series_id", "ts", "load_kwh")
    rows = lags.horizon_targets(positioned(load), "load_kwh")
    fitted = direct.fit_direct_linear(rows, ["load_kwh"])
    weights = [(h + 1, float(a), float(b)) for h, (a, b) in enumerate(fitted.weights.T)]
    return rounded(spark.createDataFrame(weights, "h long, intercept double, slope double"))


def direct_data(spark, sf_dir) -> Dataset:
    data = model_data(spark, sf_dir)
    rows = split.with_split(lags.horizon_targets(data.rows.drop("split"), "load_kwh"))
    return Dataset(stage(rows, "direct-rows"), data.features, data.cfg)


@query
def direct_linear_metrics(spark, sf_dir):
    data = direct_data(spark, sf_dir)
    fitted = direct.fit_direct_linear(data.train, data.features)
    long = direct.paired(fitted.predict(data.rows), ("series_id", "ts", "split"))
    return rounded(regression_metrics(long, keys=["split"]))


@query
def direct_linear_optimality(spark, sf_dir):
    """All features, all horizons: mean forecast of the fitted rows, and the largest slope of the squares left in any weight."""
    data = direct_data(spark, sf_dir)
    fitted = direct.fit_direct_linear(data.train, data.features)
    facts = direct.normal_equations(data.train, fitted)
    return rounded(spark.createDataFrame(facts, "h long, n_rows long, mean_forecast double, slope_left double"))


@query
def direct_linear_blocks(spark, sf_dir):
    data = direct_data(spark, sf_dir)
    fitted = direct.fit_direct_linear(data.train, data.features)
    midnight = data.rows.where(resample.at_local_midnight())
    long = direct.paired(fitted.predict(midnight), ("series_id", "ts", "split"))
    blocks = block_metrics(long, block=["series_id", "split", "ts"], max_missing=None)
    return rounded(block_summary(blocks, keys=["split"]))


@query
def direct_pooled_trees(spark, sf_dir):
    data = direct_data(spark, sf_dir)
    fitted = direct.fit_direct_pooled(data.train, data.features, rounds=2, depth=3)
    long = direct.predict_pooled(fitted, data.rows, ("series_id", "ts", "split"))
    return rounded(regression_metrics(long, keys=["split"]))


# A few small trees over columns of few values, which SQL can enumerate.
EACH_FEATURES = ["weekday", "day", "week"]
EACH_PLAN = Boosting(rounds=2, leaves=4, step=0.3, column_share=1.0)


@query
def direct_each_trees(spark, sf_dir):
    """One boosted model for each of the 96 horizons: errors on the rows they were fitted on."""
    rows = stage(lags.horizon_targets(positioned(staged_load(spark, sf_dir)), "load_kwh"), "direct-rows")
    fitted = direct.fit_direct_each(rows, EACH_FEATURES, EACH_PLAN)
    long = direct.paired(direct.predict_each(fitted, rows), ())
    y, yhat = F.col("y"), F.col("yhat")
    errors = [F.avg(F.abs(y - yhat)).alias("mae"), F.sqrt(F.avg((y - yhat) ** 2)).alias("rmse")]
    extremes = [F.min(yhat).alias("least"), F.max(yhat).alias("most")]
    return rounded(long.groupBy(F.col("h").cast("long").alias("h")).agg(F.count(F.lit(1)).alias("n_rows"), *errors, *extremes))


@query
def one_step_boosted(spark, sf_dir):
    """The published size, 500 trees of 64 leaves: fitted, saved, read back and scored, beside the value of a day before."""
    data = model_data(spark, sf_dir)
    plan = Boosting(flight=16)
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/boosted-{uuid.uuid4().hex}"
    fit_boosted(data.train, data.features, "load_kwh", plan).save(spark, path)
    scored = BoostedTrees.load(spark, path).predict(data.rows).withColumnRenamed("load_kwh", "y")
    table = train_test_metrics(scored.withColumn("yhat", F.get("forecasts", F.lit(0)))).select(F.lit("boosted").alias("model"), "*")
    naive = train_test_metrics(scored.withColumn("yhat", F.col("lag_24h"))).select(F.lit("day_before").alias("model"), "*")
    return rounded(table.unionByName(naive))


@query
def recursive_boosted_24h(spark, sf_dir):
    """All 96 steps of every test day with boosted trees."""
    data = model_data(spark, sf_dir, NO_SHORT_LAGS)
    fitted = fit_boosted(data.train, data.features, "load_kwh", Boosting(rounds=100, flight=16))
    return rounded(recursive.forecast_trees(data.rows, recursive.midnight_origins(data.test), fitted))


@query
def one_step_trees(spark, sf_dir):
    data = model_data(spark, sf_dir)
    fitted = models.fit_one_step(data.train, data.features, "gbt", rounds=5, depth=4)
    scored = models.score(fitted, data.rows, data.features).withColumnRenamed("load_kwh", "y")
    return rounded(scored.select("series_id", "ts", "split", "y", "yhat"))


@query
def model_comparison(spark, sf_dir):
    data = model_data(spark, sf_dir)
    candidates = {
        "linear": models.linear(),
        "gbt": models.boosted_trees(rounds=3, depth=3),
        "rf": models.random_forest(trees=5, depth=5),
    }
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/models-{uuid.uuid4().hex}"
    return rounded(models.compare_models(data, candidates, folder)[1])


@query
def feature_ablation(spark, sf_dir):
    features = stage(prepare(staged_load(spark, sf_dir), staged_weather(spark, sf_dir)), "features")
    selections = {
        "all": EVERYTHING,
        "no_weather": DatasetConfig(Selection(frozenset({"calendar", "lags"}), frozenset())),
        "calendar_only": DatasetConfig(Selection(frozenset({"calendar"}), frozenset())),
        "default": NO_SHORT_LAGS,
    }
    return rounded(models.ablation(features, selections))


@query
def recursive_trees_24h(spark, sf_dir):
    data = model_data(spark, sf_dir, NO_SHORT_LAGS)
    fitted = models.fit_one_step(data.train, data.features, "gbt", rounds=3, depth=3)
    origins = recursive.midnight_origins(data.test)
    return rounded(recursive.forecast_model(data.rows, origins, fitted, data.features))


def fitted_linear(data: Dataset):
    return models.fit_one_step(data.train, data.features, "linear")


@query
def perm_importance_one_step(spark, sf_dir):
    data = model_data(spark, sf_dir)
    model = direct.one_horizon(recursive.linear_step(fitted_linear(data)))
    return rounded(importance.one_step_importance(data.test, model.features, model))


@query
def perm_importance_boosted(spark, sf_dir):
    """One-step importance of boosted trees, scored inside the map that holds the rows."""
    data = model_data(spark, sf_dir)
    known = data.train.where(F.col("load_kwh").isNotNull())
    model = fit_boosted(known, data.features, "load_kwh", Boosting(rounds=40, leaves=16, flight=4))
    return rounded(importance.one_step_importance(data.test, data.features, model))


def fixed_prediction(rows: DataFrame) -> DataFrame:
    """Forecast of the fixed linear model from the table's own features."""
    outside = FIXED_MODEL.outside_score()
    own = sum(F.lit(FIXED_MODEL.weights[c]) * F.col(c) for c in ("lag_15m", "lag_1h", "lag_24h", "diff_15m"))
    return rows.withColumn("yhat", outside + own).withColumnRenamed("load_kwh", "y")


@query
def perm_importance_fixed_model(spark, sf_dir):
    data = model_data(spark, sf_dir)
    model = direct.one_horizon(FIXED_MODEL)
    return rounded(importance.one_step_importance(data.test, model.features, model))


@query
def perm_importance_fixed_recursion(spark, sf_dir):
    data = model_data(spark, sf_dir)
    return rounded(importance.recursive_importance(
        data.rows, FIXED_MODEL.features, FIXED_MODEL.advance, combine=FIXED_MODEL.outside_score
    ))


@query
def perm_importance_multi_output(spark, sf_dir):
    data = direct_data(spark, sf_dir)
    fitted = direct.fit_direct_linear(data.train, data.features)
    return rounded(importance.multi_output_importance(data.test, data.features, fitted))


@query
def perm_importance_recursive(spark, sf_dir):
    data = model_data(spark, sf_dir)
    model = recursive.linear_step(fitted_linear(data))
    return rounded(importance.recursive_importance(
        data.rows, model.features, model.advance, combine=model.outside_score
    ))


def order_days(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("ds")
    ).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("y"))


@query
def daily_seasonal_forecast(spark, sf_dir):
    model = daily.DailyModel()
    frame = daily.daily_frame(stage(order_days(spark, sf_dir), "days"))
    return rounded(daily.predict_daily(frame, daily.fit_daily(frame, model), model).drop("pos", "n_rows"))


@query
def daily_seasonal_gradient(spark, sf_dir):
    """Slope of the penalised squares at the fitted weights: zero for each series and column."""
    model = daily.DailyModel()
    frame = daily.daily_frame(stage(order_days(spark, sf_dir), "days"))
    fitted = stage(daily.fit_daily(frame, model), "fitted")
    return daily.gradient(frame, fitted, model).select(
        "series_id", "column", (F.round("gradient", 6) + F.lit(0.0)).alias("gradient")
    )


def load_days(spark, sf_dir) -> DataFrame:
    """Mean load of the complete local days, gaps of the grid filled in time."""
    load = staged_load(spark, sf_dir)
    grid = align.regrid(load, align.time_axis(load)).select("series_id", "ts", "load_kwh", CHUNK)
    return resample.complete_days(resample.local_days(interpolate_time(grid, ["load_kwh"]), how="mean"))


@query
def daily_load_gradient(spark, sf_dir):
    """Daily baseline on load days: optimality of the fit, zero for each series and column."""
    model = daily.DailyModel()
    frame = daily.daily_frame(stage(load_days(spark, sf_dir), "days"))
    fitted = stage(daily.fit_daily(frame, model), "fitted")
    return daily.gradient(frame, fitted, model).select(
        "series_id", "column", (F.round("gradient", 6) + F.lit(0.0)).alias("gradient")
    )


@query
def daily_seasonal_metrics(spark, sf_dir):
    model = daily.DailyModel()
    frame = daily.daily_frame(stage(order_days(spark, sf_dir), "days"))
    forecast = daily.predict_daily(frame, daily.fit_daily(frame, model), model)
    errors = regression_metrics(forecast, keys=["series_id", "split"]).drop("mape")
    low = score_by(forecast, bias, ["series_id", "split"]).withColumnRenamed("score", "bias")
    share = score_by(forecast, mape_floor, ["series_id", "split"]).withColumnRenamed("score", "mape")
    key = ["series_id", "split"]
    return rounded(errors.join(low, key).join(share, key))
