"""Writers for feature tables, reports and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.calendar import to_local
from meterloom.operators.ordering import KEYS
from meterloom.session import stage
from meterloom.sources.headers import FEATURE_HEADERS
from meterloom.sources.readers import LATIN1

DAY, DAY_FORMAT = "origin_day", "yyyy-MM-dd"
MONTH = "ts_month"
MONTH_FORMAT = "yyyy-MM"
STAMP = "yyyy-MM-dd HH:mm:ssXXX"


def write_features(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Parquet by month of the stamp, each file sorted by time, then series.

    A period reads its months only, and inside a month the row groups whose stamps
    lie in it.  Rows are rebalanced by month: large months are split and small ones
    kept to files of even size.
    """
    (
        df.withColumn(MONTH, F.date_format("ts", MONTH_FORMAT))
        .hint("rebalance", F.col(MONTH))
        .sortWithinPartitions(MONTH, "ts", *KEYS)
        .write.mode(mode)
        .partitionBy(MONTH)
        .parquet(path)
    )


def store_forecasts(
    forecast: DataFrame, path: str, *, parts: int = 16, block: Sequence[str] = (*KEYS, "origin")
) -> None:
    """Sink of a daily job: each block of forecasts is there once, however often the job runs.

    The table is laid out by local day of the origin and ``parts`` groups of series.  A run
    replaces the folders that it touches and no others; in these, blocks that it does not
    forecast stay.  A block that comes again is replaced whole.  Without rows, nothing changes.
    One job at a time may write a day.
    """
    spark = forecast.sparkSession
    place = [DAY, "series_part"]
    new = stage(
        forecast.withColumns(
            {
                DAY: F.date_format(to_local("origin"), DAY_FORMAT),
                "series_part": F.pmod(F.xxhash64(*KEYS), F.lit(parts)).cast("int"),
            }
        ),
        "forecasts",
    )
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        stored = spark.read.schema(new.schema).parquet(path)
        touched = new.select(*place).distinct()
        rest = stored.join(touched, place, "left_semi").join(new.select(*block).distinct(), list(block), "left_anti")
        new = stage(new.unionByName(rest.select(*new.columns)), "forecasts")
    (
        new.hint("rebalance", *[F.col(c) for c in place])
        .sortWithinPartitions(*place, *block)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*place)
        .parquet(path)
    )


def read_forecasts(spark: SparkSession, path: str) -> DataFrame:
    """The table of :func:`store_forecasts`; a filter on ``origin_day`` (text) reads its folders only."""
    names = spark.read.parquet(path).schema
    kinds = ", ".join(f"`{f.name}` {'string' if f.name == DAY else f.dataType.simpleString()}" for f in names)
    return spark.read.schema(kinds).parquet(path)


def write_features_csv(
    df: DataFrame, path: str, *, source_names: bool = True, mode: str = "errorifexists"
) -> None:
    """``;`` latin1 text with header, under the file headers or the library names."""
    out = df.withColumn("ts", F.date_format("ts", STAMP))
    if source_names:
        back = {name: header for header, name in FEATURE_HEADERS.items()}
        out = out.withColumnsRenamed({c: back[c] for c in out.columns if c in back})
    out.write.mode(mode).csv(path, sep=";", header=True, encoding=LATIN1)


def write_report(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Small result table as one text file."""
    df.coalesce(1).write.mode(mode).csv(path, header=True)


def save_model(model: PipelineModel, path: str) -> None:
    """Fitted pipeline to a folder, replacing what is there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Fitted pipeline from a folder."""
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> list[str]:
    """Feature names a fitted pipeline expects, in order."""
    for part in model.stages:
        if isinstance(part, VectorAssembler):
            return [c.removesuffix("__known") for c in part.getInputCols()]
    raise ValueError("the pipeline has no feature assembler")
