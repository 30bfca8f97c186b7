"""Time the headline queries and print one JSON line.

``published_*`` runs the pipeline at the size of the published single-node run: one
series of about 480,000 load and 790,000 weather rows with 23 measurements, CSV files
in and a CSV table out.  The supplied tables are repeated month after month for it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from meterloom.catalog.adapters import load_table, weather_readings  # noqa: E402
from meterloom.catalog.queries import QUERIES  # noqa: E402
from meterloom.plans.prepare import clean_weather, prepare  # noqa: E402
from meterloom.session import clear_stages, get_session, shared_folder, stage  # noqa: E402
from meterloom.sources.headers import LOAD_HEADERS, WEATHER_NUMBER_HEADERS  # noqa: E402
from meterloom.sources.readers import read_load_csv, read_weather_csv  # noqa: E402
from meterloom.sources.writers import write_features_csv  # noqa: E402

HEADLINE = (
    "merged_features",
    "load_lag_features",
    "weather_interpolate_15min",
    "weather_asof_nearest",
    "weather_keep_last",
    "daily_totals",
    "hour_weekday_pivot",
    "box_by_month",
    "histogram_100",
    "corr_with_target_top20",
    "acf_168",
    "seasonal_decompose",
    "normal_qq_line",
    "column_shuffle",
    "block_metrics_midnight",
    "recursive_linear_24h",
    "direct_linear_metrics",
    "one_step_trees",
    "daily_seasonal_metrics",
)
PUBLISHED_LOAD_ROWS = 481_959
PUBLISHED_WEATHER_ROWS = 788_977


def finish(df: DataFrame) -> None:
    """Compute every column of every row, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def months_on(df: DataFrame, rows: int) -> DataFrame:
    """``df`` repeated in later months up to about ``rows`` rows."""
    n = max(1, round(rows / df.count()))
    shift = F.make_dt_interval(F.col("_copy") * 31)
    many = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return many.withColumn("ts", F.col("ts") + shift).drop("_copy")


def published_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """CSV files of one long series, written before the clock starts."""
    folder = f"{shared_folder(spark)}/bench-{time.time_ns()}"
    load = stage(load_table(spark, sf_dir).where("series_id = 'total'"), "load")
    load = months_on(load, PUBLISHED_LOAD_ROWS).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX"))
    names = {name: header for header, name in LOAD_HEADERS.items()}
    load.withColumnsRenamed(names).write.csv(f"{folder}/load", sep=";", header=True)
    readings = clean_weather(weather_readings(spark, sf_dir)).where("series_id = 'total'").select("series_id", "ts", "temp_2m")
    readings = months_on(stage(readings, "readings"), PUBLISHED_WEATHER_ROWS)
    readings.select(
        "series_id",
        F.date_format("ts", "dd.MM.yyyy HH:mm").alias("Date and Time"),
        *[
            F.translate((F.col("temp_2m") + k).cast("string"), ".", ",").alias(header)
            for k, header in enumerate(WEATHER_NUMBER_HEADERS)
        ],
    ).write.csv(f"{folder}/weather", sep=";", header=True, encoding="ISO-8859-1")
    return f"{folder}/load", f"{folder}/weather"


def published_pipeline(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Seconds to read, to make the features, and to export them."""
    load_path, weather_path = published_files(spark, sf_dir)
    marks = [time.time()]
    load = stage(read_load_csv(spark, load_path), "load")
    weather = stage(clean_weather(read_weather_csv(spark, [weather_path])), "weather")
    marks.append(time.time())
    features = stage(prepare(load, weather), "features")
    marks.append(time.time())
    write_features_csv(features, load_path + "-features.csv")
    marks.append(time.time())
    names = ("published_read", "published_features", "published_export")
    return {n: round(b - a, 3) for n, a, b in zip(names, marks, marks[1:])}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "meterloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(max(8, int(cpus) if cpus.isdigit() else 8)),
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    finish(QUERIES["hourly_mean"](spark, sf_dir))  # start the engine
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        start = time.time()
        finish(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.time() - start, 3)
        clear_stages(spark)
    if not sys.argv[1:]:
        seconds |= published_pipeline(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
