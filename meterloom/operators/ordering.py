"""Row positions and neighbour access for series of any length.

A plain ``Window.partitionBy("series_id")`` puts a whole series into one task.
Here a series is cut into time chunks of bounded size; what has to cross a
chunk border (row counts, last known values, the rows just before it) travels
through small per-chunk summaries or a short overlap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.config import STEP_SECONDS
from meterloom.session import stage

CHUNK = "_chunk"
BLOCK = "_block"
OWN = "_own"
# 28 days of quarter hours.  A chunk of a regular grid holds at most this many
# rows, and the calendar range of a timestamp holds at most about 130,000 chunks.
CHUNK_ROWS = 2688
KEYS = ("series_id",)


def chunk_of(ts: str | Column, step: int = STEP_SECONDS, rows: int = CHUNK_ROWS) -> Column:
    """Chunk number of a stamp: same for all stamps in ``rows`` consecutive grid slots."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(col) / F.lit(step * rows))


def chunked(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = "ts",
    step: int = STEP_SECONDS,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add the chunk number and lay rows out by ``(keys, chunk)``."""
    return df.withColumn(CHUNK, chunk_of(ts, step, rows)).repartition(*keys, CHUNK)


def chunk_carry(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    sums: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
    first: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per chunk with what the other chunks of its series contribute.

    Each entry is ``name -> aggregate over the rows of one chunk``.  ``sums``
    adds up the chunks before, ``totals`` all chunks, ``last`` takes the nearest
    non-null among the chunks before and ``first`` among the chunks after.  The
    windows run over chunks, not rows, so they stay small for any series.  Join
    the result on (keys, chunk) after the windows inside the chunks, so that
    their sorts do not carry it.
    """
    sums, totals, last, first = sums or {}, totals or {}, last or {}, first or {}
    summary = df.groupBy(*keys, CHUNK).agg(
        *[a.alias(n) for group in (sums, totals, last, first) for n, a in group.items()]
    )
    series = Window.partitionBy(*keys)
    before = series.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    after = series.orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(
        *keys,
        CHUNK,
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums],
        *[F.sum(n).over(series).alias(n) for n in totals],
        *[F.last(n, True).over(before).alias(n) for n in last],
        *[F.last(n, True).over(after).alias(n) for n in first],
    )


def with_position(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    order: Sequence[str | Column] = ("ts",),
    pos: str = "pos",
    total: str = "n_rows",
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Number the rows of each series 0…n-1 in key order and add the series length.

    ``totals`` adds further aggregates over the whole series in the same pass.

    ``df`` carries a chunk column whose value never decreases along ``order``
    (see :func:`chunked`).
    """
    rows = F.count(F.lit(1))
    carry = chunk_carry(df, keys=keys, sums={"_offset": rows}, totals={total: rows, **(totals or {})})
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    return (
        df.withColumn("_number", F.row_number().over(inside))
        .join(carry, [*keys, CHUNK])
        .withColumn(pos, F.col("_offset") + F.col("_number") - 1)
        .drop("_offset", "_number")
    )


def with_halo(
    df: DataFrame,
    *,
    before: int = 0,
    after: int = 0,
    size: int = CHUNK_ROWS,
    pos: str = "pos",
) -> DataFrame:
    """Cut positions into blocks of ``size`` and copy the rows near a border into the next block.

    A block then holds every row that a frame of ``before`` preceding and
    ``after`` following rows can reach.  Copies have ``_own = false``.
    """
    first = F.greatest(F.floor((F.col(pos) - after) / size), F.lit(0))
    last = F.floor((F.col(pos) + before) / size)
    return df.withColumn(BLOCK, F.explode(F.sequence(first, last))).withColumn(
        OWN, F.col(BLOCK) == F.floor(F.col(pos) / size)
    )


def block_window(keys: Sequence[str] = KEYS, pos: str = "pos"):
    """Window over the blocks made by :func:`with_halo`."""
    return Window.partitionBy(*keys, BLOCK).orderBy(pos)


def with_frames(
    df: DataFrame,
    columns: dict[str, Column],
    *,
    before: int = 0,
    after: int = 0,
    size: int | None = None,
    pos: str = "pos",
) -> DataFrame:
    """Add window columns written over :func:`block_window`, reaching over block borders."""
    size = size or max(CHUNK_ROWS, 4 * (before + after))
    return (
        with_halo(df, before=before, after=after, size=size, pos=pos)
        .withColumns(columns)
        .where(F.col(OWN))
        .drop(BLOCK, OWN)
    )


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    *,
    salts: int = 16,
    how: str = "inner",
) -> DataFrame:
    """Attach one row per key to many rows per key without gathering a hot key in one task.

    ``small`` is computed and written first, so that its true size is known when
    the join is planned: below the broadcast threshold the rows of ``big`` stay
    where they are.  Above it ``small`` is repeated ``salts`` times and
    ``spread``, columns of ``big``, picks the copy by hash.
    """
    small = stage(small, "attached")
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
