"""Correlation, line fits, autocorrelation and seasonal decomposition."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.config import TARGET
from meterloom.operators.lags import centred_mean
from meterloom.operators.ordering import (
    BLOCK,
    CHUNK_ROWS,
    KEYS,
    chunked,
    salted_join,
    with_halo,
    with_position,
)

# Fixed value: 97.5 % point of the standard normal distribution.
Z_95 = 1.959963984540054
# Squares below this share of the squared mean are rounding errors of equal values.
ROUNDING = 1e-24


def correlation_ranking(
    df: DataFrame,
    cols: Sequence[str],
    target: str = TARGET,
    *,
    top: int = 20,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Absolute correlation of each column with the target, strongest first.

    One aggregate over all columns; each pair skips its own nulls.  The target
    itself takes part if listed.
    """
    wide = df.groupBy(*keys).agg(*[F.abs(F.corr(c, target)).alias(c) for c in cols])
    long = wide.unpivot(list(keys), list(cols), "feature", "abs_r")
    order = Window.partitionBy(*keys).orderBy(F.col("abs_r").desc_nulls_last(), "feature")
    return long.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def correlation_matrix(
    df: DataFrame, cols: Sequence[str], *, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Lower triangle of the correlation matrix as rows ``(a, b, r)``, pairwise complete."""
    pairs = list(combinations(cols, 2))
    wide = df.groupBy(*keys).agg(*[F.corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(*keys, F.explode(cells).alias("_cell")).select(*keys, "_cell.*")


def line_fit(df: DataFrame, y: str, x: str, *, keys: Sequence[str] = KEYS) -> DataFrame:
    """Least-squares line of ``y`` on ``x``."""
    return df.groupBy(*keys).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
    )


def autocorrelation(
    df: DataFrame,
    value: str = TARGET,
    *,
    max_lag: int = 168,
    thin: int = 4,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Autocorrelation at row lags 0…``max_lag`` of every ``thin``-th known value, with Bartlett band.

    Values are gathered in blocks of positions that overlap by ``max_lag``; a block becomes two short
    vectors of sums by lag, from one Fourier transform.  They are taken around the mean of all
    known values, which the numbering knows already; the mean of the thinned ones comes in at the
    end.  Lags without a pair have no row; a constant series has nulls.
    """
    known = df.where(F.col(value).isNotNull()).select(*keys, "ts", F.col(value).cast("double").alias("_x"))
    rows = with_position(chunked(known, keys=keys), keys=keys, totals={"_sum": F.sum("_x")})
    centre = F.col("_sum") / F.col("n_rows")
    thinned = rows.where(F.col("pos") % thin == 0).select(
        *keys,
        F.floor(F.col("pos") / thin).alias("pos"),
        F.ceil(F.col("n_rows") / thin).alias("n_rows"),
        centre.alias("_centre"),
        (F.col("_x") - centre).alias("_x"),
    )
    size = max(CHUNK_ROWS, 4 * max_lag)
    whole = [*keys, "n_rows", "_centre"]
    blocks = (
        with_halo(thinned, after=max_lag, size=size)
        .groupBy(*whole, BLOCK)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "_x"))).alias("_rows"))
        .select(*whole, BLOCK, F.transform("_rows", lambda r: r["_x"]).alias("_values"))
    )
    vectors = lagged_sums(blocks, max_lag, size)
    sums = (
        vectors.select(*whole, F.posexplode(F.arrays_zip("products", "pairs")).alias("lag", "_v"))
        .groupBy(*whole, "lag")
        .agg(F.sum("_v.products").alias("_s"), F.sum("_v.pairs").alias("_p"))
        .where(F.col("lag") < F.col("n_rows"))
    )
    series = Window.partitionBy(*keys).orderBy("lag")
    upto = series.rowsBetween(Window.unboundedPreceding, 0)
    # At lag 0 every value is paired with itself, so the pairs add up to twice the values.
    mean = F.first("_p").over(upto) / (2 * F.col("n_rows"))
    product = F.col("_s") - mean * F.col("_p") + (F.col("n_rows") - F.col("lag")) * mean * mean
    centred = sums.withColumn("_c", product)
    first = F.first("_c").over(upto)
    spread = first > F.col("n_rows") * F.col("_centre") * F.col("_centre") * ROUNDING
    acf = centred.withColumn("acf", F.when(spread, F.col("_c") / F.nullif(first, F.lit(0.0))))
    # Lag 0 is no evidence; lag k sums the squares of lags 1…k-1.
    past = F.sum(F.when(F.col("lag") > 0, F.col("acf") ** 2).otherwise(0.0)).over(
        series.rowsBetween(Window.unboundedPreceding, -1)
    )
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(
        F.sqrt((1 + 2 * past) / F.col("n_rows")) * Z_95
    )
    return acf.select(*keys, "lag", "acf", band.alias("band"))


def lagged_sums(blocks: DataFrame, max_lag: int, size: int) -> DataFrame:
    """``products`` and ``pairs`` by lag: sums of x[i] x[i+lag] and of x[i] + x[i+lag], for the first ``size`` values i."""
    kept = [f for f in blocks.schema.fields if f.name != "_values"]
    schema = T.StructType([*kept, *[T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("products", "pairs")]])
    lags = np.arange(max_lag + 1)

    def sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = x[:size]
        room = len(x) + max_lag + 1
        products = np.fft.irfft(np.fft.rfft(x, room) * np.conj(np.fft.rfft(own, room)), room)[: max_lag + 1]
        upto = np.concatenate([[0.0], np.cumsum(x)])
        first = upto[np.clip(len(x) - lags, 0, len(own))]
        second = upto[np.minimum(len(own) + lags, len(x))] - upto[np.minimum(lags, len(x))]
        return products, first + second

    def run(batches):
        for batch in batches:
            values, starts = batch.column("_values").flatten().to_numpy(zero_copy_only=False), 0
            made = []
            for n in pc.list_value_length(batch.column("_values")).to_numpy(zero_copy_only=False):
                made.append(sums(values[starts : starts + n]))
                starts += n
            arrays = [pa.array([m[i] for m in made], pa.list_(pa.float64())) for i in (0, 1)]
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], schema.names)

    return blocks.mapInArrow(run, schema)


def seasonal_parts(
    df: DataFrame,
    value: str = TARGET,
    *,
    period: int = 168,
    step: int = 3600,
    min_rows: int = 0,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Additive decomposition: trend (centred mean), seasonal (phase mean, centred), residual.

    The phase counts rows.  Series need two full periods and more than ``min_rows`` rows.
    """
    rows = with_position(chunked(df, keys=keys, step=step))
    enough = (F.col("n_rows") >= 2 * period) & (F.col("n_rows") > min_rows)
    trend = centred_mean(rows.where(enough), value, period, keys=keys).withColumn(
        "phase", F.col("pos") % period
    )
    phases = trend.groupBy(*keys, "phase").agg(F.avg(F.col(value) - F.col("trend")).alias("_mean"))
    centre = F.avg("_mean").over(Window.partitionBy(*keys))
    seasonal = phases.select(*keys, "phase", (F.col("_mean") - centre).alias("seasonal"))
    joined = salted_join(trend, seasonal, [*keys, "phase"], ["pos"])
    return joined.select(
        *keys,
        "ts",
        value,
        "trend",
        "seasonal",
        (F.col(value) - F.col("trend") - F.col("seasonal")).alias("resid"),
    )
