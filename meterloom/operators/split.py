"""Chronological splits, repeatable samples and shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.operators.ordering import CHUNK, KEYS, with_position


def in_train(test_size: float = 0.3) -> Column:
    """True for the first ``int(n * (1 - test_size))`` rows of a series (needs positions)."""
    return F.col("pos") < F.floor(F.col("n_rows") * F.lit(1 - test_size))


def with_split(df: DataFrame, test_size: float = 0.3) -> DataFrame:
    """Add ``split``: ``train`` or ``test`` in time order."""
    return df.withColumn("split", F.when(in_train(test_size), "train").otherwise("test"))


def tail_rows(df: DataFrame, size: int) -> DataFrame:
    """The last ``size`` rows of each series (needs positions)."""
    return df.where(F.col("pos") >= F.col("n_rows") - size)


def draw(seed: int | str, *cols: str | Column) -> Column:
    """Repeatable random text of a row's key: equal on every layout and every attempt."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *cols))


def row_draw(seed: int | str, keys: Sequence[str] = KEYS, ts: str = "ts") -> Column:
    """Draw of a row keyed by series and stamp."""
    return draw(seed, *keys, F.unix_seconds(ts).cast("string"))


def seeded_sample(
    df: DataFrame, size: int, seed: int = 42, *, keys: Sequence[str] = KEYS, ts: str = "ts"
) -> DataFrame:
    """``size`` rows chosen by their draw: a top-k that each task cuts down first."""
    return df.orderBy(row_draw(seed, keys, ts), *keys, ts).limit(size)


def seeded_order(
    df: DataFrame,
    cols: Sequence[str],
    seed: int | str = 42,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
    digits: int = 2,
) -> DataFrame:
    """``keys``, ``pos`` and ``cols``: position i has the values of the row with the i-th draw of its series.

    Draws are spread evenly, so their first ``digits`` hex digits cut a series into equal parts.
    """
    drawn = df.select(*keys, *cols, row_draw(seed, keys, ts).alias("_draw"))
    part = F.conv(F.substring("_draw", 1, digits), 16, 10).cast("long")
    laid_out = drawn.withColumn(CHUNK, part).repartition(*keys, CHUNK)
    return with_position(laid_out, keys=keys, order=("_draw",), total="_n").select(*keys, "pos", *cols)


def shuffled_columns(
    df: DataFrame,
    cols: Sequence[str],
    seed: int | str = 42,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
    digits: int = 2,
) -> DataFrame:
    """Exchange the values of ``cols`` among the rows of each series by a seeded permutation.

    The row at position i gets the values of the row with the i-th draw.  ``df`` has positions 0…n-1.
    """
    donors = seeded_order(df, cols, seed, keys=keys, ts=ts, digits=digits)
    return df.drop(*cols).join(donors, [*keys, "pos"])
