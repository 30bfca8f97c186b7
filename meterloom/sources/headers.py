"""File headers and the column names used inside the library (fixed values)."""

from __future__ import annotations

LOAD_HEADERS = {
    "Start der Messung": "ts",
    "Start der Messung (Text)": "ts_text",
    "Stromverbrauch": "load_kwh",
    "Grundversorgte Kunden": "base_customers",
    "Freie Kunden": "free_customers",
    "Jahr": "year",
    "Monat": "month",
    "Tag": "day",
    "Wochentag": "weekday",
    "Tag des Jahres": "day_of_year",
    "Quartal": "quarter",
    "Woche des Jahres": "week",
}

# Three gust headers are stored double-encoded in the files and read as such.
WEATHER_NUMBER_HEADERS = {
    "Globalstrahlung; Zehnminutenmittel": "global_rad",
    "Diffusstrahlung; Zehnminutenmittel": "diffuse_rad",
    "Langwellige Einstrahlung; Zehnminutenmittel": "longwave_rad",
    "Sonnenscheindauer; Zehnminutensumme": "sunshine_min",
    "BÃ¶enspitze (3-SekundenbÃ¶e); Maximum in km/h": "gust3s_kmh",
    "BÃ¶enspitze (3-SekundenbÃ¶e); Maximum in m/s": "gust3s_ms",
    "BÃ¶enspitze (SekundenbÃ¶e); Maximum in km/h": "gust1s_kmh",
    "Böenspitze (Sekundenböe)": "gust1s",
    "Chilltemperatur": "chill_temp",
    "Dampfdruck 2 m ü. Boden": "vapour_pressure",
    "Luftdruck reduziert auf Meeresniveau (QFF)": "pressure_qff",
    "Luftdruck reduziert auf Meeresniveau mit Standardatmosphäre (QNH)": "pressure_qnh",
    "Luftrdruck auf Barometerhöhe": "pressure_station",
    "Lufttemperatur 2 m ü. Boden": "temp_2m",
    "Lufttemperatur 2 m ü. Gras": "temp_grass",
    "Lufttemperatur Bodenoberfläche": "temp_surface",
    "Niederschlag; Zehnminutensumme": "precip_mm",
    "Taupunkt 2 m ü. Boden": "dew_point",
    "Windgeschwindigkeit skalar; Zehnminutenmittel in m/s": "wind_scalar_ms",
    "Windgeschwindigkeit vektoriell": "wind_vector",
    "Windgeschwindigkeit; Zehnminutenmittel in km/h": "wind_kmh",
    "Windrichtung; Zehnminutenmittel": "wind_dir",
    "relative Luftfeuchtigkeit": "rel_humidity",
}

WEATHER_TEXT_HEADERS = {
    "station_abbr": "station",
    "Date and Time": "stamp_text",
    "Date": "date_text",
    "Time": "time_text",
}

FEATURE_HEADERS = {
    "Start der Messung (UTC)": "ts",
    "Stromverbrauch": "load_kwh",
    "Monat": "month",
    "Tag": "day",
    "Wochentag": "weekday",
    "Tag des Jahres": "day_of_year",
    "Quartal": "quarter",
    "Woche des Jahres": "week",
    "Datum (Lokal)": "local_date",
    "Zeit (Lokal)": "local_time",
    "Stunde (Lokal)": "local_hour",
    "IstSonntag": "is_sunday",
    "IstArbeitstag": "is_workday",
    "Lag_15min": "lag_15m",
    "Lag_30min": "lag_30m",
    "Lag_1h": "lag_1h",
    "Lag_24h": "lag_24h",
    "Grundversorgte Kunden_Lag_15min": "base_customers_lag_15m",
    "Freie Kunden_Lag_15min": "free_customers_lag_15m",
    "Diff_15min": "diff_15m",
    **{f"{source}_lag15": f"{name}_lag15" for source, name in WEATHER_NUMBER_HEADERS.items()},
}

# Columns of the feature file that are not doubles.
FEATURE_TYPES = {
    "month": "bigint",
    "day": "bigint",
    "weekday": "bigint",
    "day_of_year": "bigint",
    "quarter": "bigint",
    "week": "bigint",
    "local_date": "date",
    "local_time": "string",
    "local_hour": "int",
    "is_sunday": "int",
    "is_workday": "int",
    "series_id": "string",
}
