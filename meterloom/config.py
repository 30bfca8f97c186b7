"""Typed settings shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

STEP_SECONDS = 900  # 15-minute grid
SLOTS_PER_DAY = 96
LOCAL_TZ = "Europe/Zurich"
TARGET = "load_kwh"

# ASCII names of the 23 weather measurements, in source order.
WEATHER_COLUMNS = (
    "global_rad",
    "diffuse_rad",
    "longwave_rad",
    "sunshine_min",
    "gust3s_kmh",
    "gust3s_ms",
    "gust1s_kmh",
    "gust1s",
    "chill_temp",
    "vapour_pressure",
    "pressure_qff",
    "pressure_qnh",
    "pressure_station",
    "temp_2m",
    "temp_grass",
    "temp_surface",
    "precip_mm",
    "dew_point",
    "wind_scalar_ms",
    "wind_vector",
    "wind_kmh",
    "wind_dir",
    "rel_humidity",
)

# Weather columns left out of the default model.
DEFAULT_EXCLUDED_WEATHER = (
    "gust3s_kmh_lag15",
    "gust3s_ms_lag15",
    "gust1s_kmh_lag15",
    "pressure_qff_lag15",
    "pressure_qnh_lag15",
    "pressure_station_lag15",
    "temp_grass_lag15",
    "temp_surface_lag15",
    "wind_vector_lag15",
    "wind_kmh_lag15",
    "wind_dir_lag15",
    "rel_humidity_lag15",
)

# Lag columns left out of the default model.
DEFAULT_EXCLUDED_LAGS = (
    "base_customers_lag_15m",
    "free_customers_lag_15m",
    "lag_15m",
    "lag_30m",
    "diff_15m",
)


@dataclass(frozen=True)
class Selection:
    """Feature groups in use, and columns of theirs that stay out."""

    groups: frozenset[str] = frozenset({"calendar", "lags", "weather"})
    without: frozenset[str] = frozenset(DEFAULT_EXCLUDED_WEATHER + DEFAULT_EXCLUDED_LAGS)


@dataclass(frozen=True)
class DatasetConfig:
    """How to turn a feature table into modelling rows.  ``period`` (first and last stamp) is open unless given."""

    selection: Selection = Selection()
    period: tuple[str, str] | None = None
    test_size: float = 0.30
    target: str = TARGET


@dataclass(frozen=True)
class PrepareConfig:
    """Settings of the raw-files-to-features plan."""

    target: str = TARGET
    step_seconds: int = STEP_SECONDS
    local_tz: str = LOCAL_TZ
    text_tolerance_seconds: int = 450
    target_lags: tuple[tuple[str, int], ...] = (
        ("lag_15m", 1),
        ("lag_30m", 2),
        ("lag_1h", 4),
        ("lag_24h", 96),
    )
    customer_columns: tuple[str, ...] = ("base_customers", "free_customers")
    integer_columns: tuple[str, ...] = (
        "year",
        "month",
        "day",
        "weekday",
        "day_of_year",
        "quarter",
        "week",
    )
    weather_columns: tuple[str, ...] = WEATHER_COLUMNS
    drop_columns: tuple[str, ...] = (
        "year",
        "date_text",
        "time_text",
        "stamp_text",
        "ts_text",
        "station",
    )
