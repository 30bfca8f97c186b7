"""Distributed least-significant-digit radix sort, as one counting sort for each digit.

Rows lie in chunks, in order of their place. A pass counts the digits of every chunk, turns
the counts into global offsets (rows with smaller digits, then rows with the same digit in
earlier chunks) and adds the row's place among its chunk's rows of that digit. The sum is the
row's new place; new chunks are runs of places. So chunks are cut by place, never by value,
and a value that many rows share makes no large task. Every pass is stable, reads and writes
a table in the shared folder, and costs one shuffle of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

_SIGN = -(1 << 63)
_ALL = (1 << 64) - 1


@dataclass(frozen=True)
class Radix:
    """Bits of a digit; chunks aimed at, and the fewest and most rows of one."""

    bits: int = 16
    chunks: int = 64
    least_rows: int = 4096
    most_rows: int = 1 << 20


def ascending(value: Column) -> Column:
    """Key bits that, taken as unsigned, order a long upwards."""
    return value.cast("long").bitwiseXOR(F.lit(_SIGN))


def descending(value: Column) -> Column:
    """Key bits that order a long downwards."""
    return F.bitwise_not(ascending(value))


def digits(used: Sequence[int], bits: int) -> list[list[tuple[int, int, int]]]:
    """Digits of a composite key from the least significant one on; each is a list of ``(key, shift, width)``.

    ``used`` holds for each key word, the most significant first, the bits in which rows
    differ. Bits below and above them are left out; a digit may span key words.
    """
    out, room = [], 0
    for word in range(len(used) - 1, -1, -1):
        shift = (used[word] & -used[word]).bit_length() - 1
        while shift < used[word].bit_length() and used[word]:
            if not room:
                out.append([])
                room = bits
            width = min(room, used[word].bit_length() - shift)
            out[-1].append((word, shift, width))
            shift, room = shift + width, room - width
    return out


def counting_sort(rows: DataFrame, digit: Column) -> DataFrame:
    """``rows`` with their ``place`` after a stable sort by ``digit``, from ``chunk`` and ``place`` before it."""
    rows = rows.withColumn("digit", digit)
    counts = rows.groupBy("digit", "chunk").agg(F.count(F.lit(1)).alias("n"))
    until = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # one row a digit
    smaller = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    smaller = smaller.select("digit", F.coalesce(F.sum("n").over(until), F.lit(0)).alias("smaller"))
    earlier = Window.partitionBy("digit").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row a chunk
    counts = counts.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(smaller, "digit")
    offsets = counts.select("digit", "chunk", (F.col("smaller") + F.col("earlier")).alias("offset"))
    among = F.row_number().over(Window.partitionBy("chunk", "digit").orderBy("place"))
    rows = rows.withColumn("among", among).join(offsets, ["chunk", "digit"])
    return rows.withColumn("place", F.col("offset") + F.col("among") - 1).drop("digit", "among", "offset")


def radix_sort(rows: DataFrame, keys: Sequence[Column], plan: Radix = Radix()) -> tuple[DataFrame, int]:
    """``rows`` with the column ``place``, from 0 on in order of ``keys`` (the most significant first), and their number.

    ``rows`` is a stored table with the columns ``chunk`` and ``place``, which give the order
    of equal rows. ``keys`` are non-null longs made by ``ascending`` or ``descending``, or
    not negative. An empty table stays empty; without differing keys, one pass numbers the rows.
    """
    names = [f"key{i}" for i in range(len(keys))]
    rows = rows.withColumns(dict(zip(names, keys)))
    facts = [F.count(F.lit(1)).alias("n")]
    for name in names:
        facts += [F.bit_or(name).alias(f"or_{name}"), F.bit_and(name).alias(f"and_{name}")]
    found = rows.agg(*facts).first()
    if not found["n"]:
        return rows.drop(*names), 0
    used = [(found[f"or_{k}"] ^ found[f"and_{k}"]) & _ALL for k in names]
    size = min(max(-(-found["n"] // plan.chunks), plan.least_rows), plan.most_rows)
    for fields in digits(used, plan.bits) or [[]]:
        digit, at = F.lit(0), 0
        for word, shift, width in fields:
            part = F.shiftrightunsigned(names[word], shift).bitwiseAND(F.lit((1 << width) - 1)).cast("int")
            digit, at = digit.bitwiseOR(F.shiftleft(part, at)), at + width
        rows = counting_sort(rows, digit).withColumn("chunk", F.floor(F.col("place") / size))
        rows = stage(rows, "radix")
    return rows.drop("chunk", *names), found["n"]
