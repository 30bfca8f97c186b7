"""Exact ranks and quantiles for groups of any size.

Equal values collapse into one counted row, the rest is spread over value
ranges, and range totals are summed up.  No task holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.operators.ordering import CHUNK, chunk_carry, salted_join
from meterloom.session import stage

EXPLODE_STEP = 65536
# Half the width of a bracket, and the accuracy of its ends (errors up to 1 / ACCURACY), as shares of the rows.
BRACKET = 0.001
ACCURACY = 10_000


def with_offsets(
    counts: DataFrame,
    value: str,
    *,
    keys: Sequence[str] = (),
    ranges: int | None = None,
    split_over: int = 50_000,
) -> DataFrame:
    """Add ``n_below``, the sum of ``n_equal`` over smaller values of a group, and ``n_values``, that of the group.

    ``counts`` is a stored table with one row per key and value.  Groups of more than ``split_over``
    rows are cut into value ranges of about that many (or into ``ranges``); others stay whole.
    Approximate quantiles only choose the cuts; the sums are exact.
    """
    stored = counts.count()
    if stored > split_over:
        ranges = ranges or max(2, -(-stored // split_over))
        cuts = [i / ranges for i in range(1, ranges)]
        splits = (
            counts.groupBy(*keys)
            .agg(
                F.count(F.lit(1)).alias("_distinct"),
                F.percentile_approx(value, cuts, max(ACCURACY, 4 * ranges)).alias("_splits"),
            )
            .where(F.col("_distinct") > split_over)
            .drop("_distinct")
        )
        below = F.size(F.filter("_splits", lambda s: s < F.col(value)))
        part = F.when(F.col("_splits").isNotNull(), below).otherwise(0)
        placed = salted_join(counts, splits, keys, [value], how="left").withColumn(CHUNK, part).drop("_splits")
    else:
        placed = counts.withColumn(CHUNK, F.lit(0))
    placed = placed.repartition(*keys, CHUNK)
    rows = F.sum("n_equal")
    inside = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = chunk_carry(placed, keys=keys, sums={"_offset": rows}, totals={"n_values": rows})
    smaller = F.coalesce(rows.over(inside), F.lit(0))
    return (
        placed.withColumn("_smaller", smaller)
        .join(carry, [*keys, CHUNK])
        .withColumn("n_below", F.col("_offset") + F.col("_smaller"))
        .drop("_offset", "_smaller", CHUNK)
    )


def value_ranks(
    df: DataFrame,
    value: str,
    *,
    keys: Sequence[str] = (),
    ranges: int | None = None,
    split_over: int = 50_000,
) -> DataFrame:
    """Per key and distinct value: ``n_equal`` rows have it, ``n_below`` are smaller, of ``n_values``.

    The input is read once; groups of any size are ranked by :func:`with_offsets`.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n_equal"))
    )
    ranked = with_offsets(stage(counts, "counts"), value, keys=keys, ranges=ranges, split_over=split_over)
    return ranked.select(*keys, value, "n_equal", "n_below", "n_values")


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    *,
    keys: Sequence[str] = (),
    split_over: int = 50_000,
) -> DataFrame:
    """Linearly interpolated quantiles ``name -> probability`` per key.

    The input is read twice.  First, approximate quantiles on both sides of each probability
    bracket its exact rank.  Then one aggregate counts equal values inside the brackets, well
    under a hundredth of all rows, and keeps count and ends of each gap between them.  Running
    sums over this small table give exact ranks; a rank just outside a bracket is the end of a
    gap.  A rank deeper in a gap, which the accuracy rules out, is an error.
    """
    known = df.where(F.col(value).isNotNull()).select(*keys, value)
    wanted = sorted(quantiles.items(), key=lambda x: x[1])
    sides = [x for _, p in wanted for x in (max(p - BRACKET, 0.0), min(p + BRACKET, 1.0))]
    brackets = known.groupBy(*keys).agg(F.percentile_approx(value, sides, ACCURACY).alias("_sides"))
    rows = salted_join(known, brackets, keys, [value])
    v, inside, passed = F.col(value), F.lit(False), F.lit(0)
    for i in range(len(wanted)):
        low, high = F.col("_sides")[2 * i], F.col("_sides")[2 * i + 1]
        inside = inside | ((v >= low) & (v <= high))
        passed = passed + F.when(v > high, 1).otherwise(0)
    # Gaps and the values between them do not overlap, so their least values order them.
    entries = rows.groupBy(*keys, F.when(inside, v).alias("_at"), F.when(~inside, passed).alias("_gap")).agg(
        F.count(F.lit(1)).alias("n_equal"), F.min(v).alias("_least"), F.max(v).alias("_most")
    )
    ranked = with_offsets(stage(entries, "brackets"), "_least", keys=keys, split_over=split_over)

    first, last = F.col("n_below"), F.col("n_below") + F.col("n_equal") - 1
    lost = F.raise_error(F.lit("a rank lies outside its bracket"))
    held, results = [], []
    for name, p in wanted:
        place = (F.col("n_values") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            at = F.when(rank == first, F.col("_least")).when(rank == last, F.col("_most"))
            at = at.when(F.col("_gap").isNull(), F.col("_least")).otherwise(lost)
            held.append(F.max(F.when((rank >= first) & (rank <= last), at)).alias(f"_{side}_{name}"))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        results.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    named = dict(zip([name for name, _ in wanted], results))
    return ranked.groupBy(*keys, "n_values").agg(*held).select(*keys, "n_values", *[named[n] for n in quantiles])


def explode_ranks(ranks: DataFrame) -> DataFrame:
    """One row per original value with its 0-based ``rank``; a very frequent value is split first."""
    blocks = F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("n_equal") - 1) / EXPLODE_STEP).cast("long")
    )
    split = ranks.withColumn("_block", F.explode(blocks))
    start = F.col("_block") * EXPLODE_STEP
    stop = F.least(start + EXPLODE_STEP, F.col("n_equal")) - 1
    rest = [c for c in ranks.columns if c not in ("n_equal", "n_below")]
    return (
        split.withColumn("_i", F.explode(F.sequence(start, stop)))
        .withColumn("rank", F.col("n_below") + F.col("_i"))
        .select(*rest, "rank")
    )
