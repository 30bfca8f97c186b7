"""Readers for load, weather and feature files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.numeric import try_double, try_long
from meterloom.operators.align import as_utc, unite_files
from meterloom.sources.headers import (
    FEATURE_HEADERS,
    FEATURE_TYPES,
    LOAD_HEADERS,
    WEATHER_NUMBER_HEADERS,
    WEATHER_TEXT_HEADERS,
)

LATIN1 = "ISO-8859-1"
DAY_FIRST = "dd.MM.yyyy HH:mm"
MONTH_FIRST = "MM/dd/yyyy HH:mm"


def _text_table(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """``;`` file (or folder of files) with header, every column as text under its stripped header.

    Files of one folder must have the same columns in the same order; reading fails otherwise.
    """
    try:
        first = spark.read.csv(path, sep=";", header=True, encoding=encoding).schema
        # Every file's header is compared with the first one's: another column order fails.
        raw = spark.read.schema(first).csv(path, sep=";", header=True, encoding=encoding, enforceSchema=False)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            raise FileNotFoundError(f"file not found: {path}") from error
        raise
    return raw.withColumnsRenamed({c: c.strip() for c in raw.columns if c != c.strip()})


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def parse_stamp(c: str | Column, *, dayfirst: bool = True, strict: bool = True) -> Column:
    """Stamp text without zone read as UTC.  Bad text raises, or is null when not ``strict``."""
    col = F.col(c) if isinstance(c, str) else c
    pattern = F.lit(DAY_FIRST if dayfirst else MONTH_FIRST)
    parsed = F.try_to_timestamp(col, pattern)
    if strict:  # whatever the session's ANSI setting
        bad = F.raise_error(F.concat(F.lit("not a stamp: "), col)).cast("timestamp")
        return F.when(col.isNotNull() & parsed.isNull(), bad).otherwise(parsed)
    return parsed


def read_load_csv(
    spark: SparkSession, path: str, *, series_id: str = "load", encoding: str = "UTF-8"
) -> DataFrame:
    """Load file: ISO stamps with offset to UTC (bad ones null), numbers typed, columns renamed."""
    df = _renamed(_text_table(spark, path, encoding), LOAD_HEADERS)
    typed: dict[str, Column] = {}
    if "ts" in df.columns:
        typed["ts"] = F.try_to_timestamp(F.col("ts"))
    doubles = ("load_kwh", "base_customers", "free_customers")
    text = ("ts", "ts_text", "series_id", *doubles)
    typed |= {c: try_double(c) for c in doubles if c in df.columns}
    typed |= {c: try_long(c) for c in LOAD_HEADERS.values() if c in df.columns and c not in text}
    df = df.withColumns(typed)
    return df if "series_id" in df.columns else df.withColumn("series_id", F.lit(series_id))


def read_weather_csv(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    series_id: str = "load",
    strict: bool = True,
    encoding: str = LATIN1,
) -> DataFrame:
    """Weather files in order: day-first UTC stamps, decimal commas, file and row order kept.

    ``file_no`` and ``row_no`` say which of two rows with the same stamp is later.
    """
    frames = []
    for path in paths:
        df = _text_table(spark, path, encoding)
        if "Date and Time" not in df.columns:
            raise ValueError("column 'Date and Time' is missing")
        # Files of a folder by name, splits of a file by where they start, rows of one by their id.
        order = F.struct(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
        )
        df = df.withColumn("row_no", order)
        df = _renamed(df, WEATHER_NUMBER_HEADERS | WEATHER_TEXT_HEADERS)
        numbers = [c for c in WEATHER_NUMBER_HEADERS.values() if c in df.columns]
        frames.append(
            df.withColumns(
                {c: F.expr(f"try_cast(replace(`{c}`, ',', '.') as double)") for c in numbers}
                | {"ts": parse_stamp("stamp_text", strict=strict)}
            )
        )
    stacked = unite_files(*frames)
    if "series_id" not in stacked.columns:
        stacked = stacked.withColumn("series_id", F.lit(series_id))
    return stacked


def read_features(spark: SparkSession, path: str, *, series_id: str = "load") -> DataFrame:
    """Feature table from Parquet, or from the ``;`` latin1 file if the path ends in ``.csv``."""
    if not path.rstrip("/").endswith(".csv"):
        df = spark.read.parquet(path)
        # A month such as 2024-01 would be taken for a date.
        if "ts_month" in df.columns and df.schema["ts_month"].dataType.simpleString() == "date":
            df = df.withColumn("ts_month", F.date_format("ts_month", "yyyy-MM"))
        return df.withColumn("ts", as_utc("ts"))
    df = _renamed(_text_table(spark, path, LATIN1), FEATURE_HEADERS)
    kinds = {c: FEATURE_TYPES.get(c, "double") for c in df.columns if c != "ts"}
    df = df.withColumns(
        {c: F.expr(f"try_cast(`{c}` as {kind})") for c, kind in kinds.items()}
        | {"ts": F.to_timestamp("ts")}
    )
    return df if "series_id" in df.columns else df.withColumn("series_id", F.lit(series_id))
