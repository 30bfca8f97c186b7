"""Compression of vectors to codes: one small codebook for each of eight parts of a vector.

Components become integers, so every sum and distance is exact. Codebooks start from the
vectors with the smallest ids and move to the floor of their parts' means in a fixed number
of rounds over all vectors; sums are made by Spark, and a codebook is a few hundred numbers.

The nearest entry is found by equal-average search. Entries are sorted by the sum of their
components. A part starts at the place of its own sum and looks outwards, at the entry with
the smaller gap of sums first. By Cauchy and Schwarz, the squared gap divided by the
dimension is no more than the squared distance: once it strictly exceeds the best distance
so far, no entry beyond can be nearer, or equally near with a smaller index.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import stage
from .common import ship_code

# Integers up to this size keep all distances within 64 bits, for parts of up to 256 components.
_MOST = 1 << 26
_FAR = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Coding:
    """Parts of a vector, entries of a codebook, rounds of training, units of a component's integer."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    units: int = 4096


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row, ties to the lower one, and the squared distance."""
    entries, width = book.shape
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, own = sums[order], x.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    index, best = np.full(len(x), entries), np.full(len(x), _FAR)
    # Gaps beyond both ends are larger than any real one.
    ends = np.concatenate([sums, [1 << 40, -(1 << 40)]])
    open_rows = np.arange(len(x))
    while len(open_rows):
        lo, hi, here = left[open_rows], right[open_rows], own[open_rows]
        gap_lo, gap_hi = here - ends[np.where(lo < 0, entries + 1, lo)], ends[np.minimum(hi, entries)] - here
        go_lo = gap_lo <= gap_hi
        gap = np.where(go_lo, gap_lo, gap_hi)
        limit = best[open_rows]
        on = (gap < 1 << 38) & ((limit == _FAR) | (gap * gap <= np.minimum(limit, _FAR // max(width, 1)) * width))
        open_rows, go_lo = open_rows[on], go_lo[on]
        left[open_rows] -= go_lo
        right[open_rows] += ~go_lo
        entry = order[np.where(go_lo, lo[on], hi[on])]
        apart = x[open_rows] - book[entry]
        distance = np.einsum("ij,ij->i", apart, apart)
        better = (distance < best[open_rows]) | ((distance == best[open_rows]) & (entry < index[open_rows]))
        index[open_rows[better]], best[open_rows[better]] = entry[better], distance[better]
    return index, best


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of every part of every vector, and squared distances; ``books`` is parts x entries x width."""
    found = [nearest(np.ascontiguousarray(x[:, p]), book) for p, book in enumerate(books)]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _parts(column: pa.Array, books: np.ndarray) -> np.ndarray:
    """Vectors x parts x width of a batch; vectors of another length than the codebooks' are an error."""
    parts, _, width = books.shape
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) != len(column) * parts * width or (np.diff(column.offsets.to_numpy()) != parts * width).any():
        raise ValueError(f"all vectors must have {parts * width} components")
    return flat.reshape(len(column), parts, width)


def whole_vectors(table: DataFrame, coding: Coding, key: str, vector: str, label: str) -> DataFrame:
    """``vec_id``, ``label`` and integer components ``x`` of the rows whose vector has neither null nor non-finite components."""
    units = F.col(vector).cast("array<double>")
    good = F.forall(units, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))  # NaN is above infinity
    small = F.when(F.exists("x", lambda v: F.abs(v) > _MOST), F.raise_error(F.lit(f"components beyond {_MOST} units"))).otherwise(F.col("x"))
    rows = table.select(table[key].alias("vec_id"), table[label].alias("label"), units.alias("x")).where(table[vector].isNotNull() & good)
    x = F.transform("x", lambda v: F.floor(v * float(coding.units)))
    return rows.select("vec_id", "label", x.alias("x")).select("vec_id", "label", small.cast("array<int>").alias("x"))


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: the floor of the mean of each entry's parts; unused entries stay."""

    def run(batches):
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            x = _parts(batch.column(0), books)
            index, _ = assign(x, books)
            for p in range(len(books)):
                np.add.at(sums[p], index[:, p], x[:, p])
                counts[p] += np.bincount(index[:, p], minlength=books.shape[1])
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], list(sums[part, entry])]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "entry", "n", "sums"])

    found = rows.select("x").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = found.groupBy("part", "entry").agg(F.sum("n"), *[F.sum(F.get("sums", F.lit(i))) for i in range(books.shape[2])])
    out = books.copy()
    for part, entry, n, *sums in total.collect():  # one row an entry
        out[part, entry] = [s // n for s in sums]
    return out


def fit(rows: DataFrame, coding: Coding = Coding()) -> np.ndarray | None:
    """Codebooks (parts x entries x width) of the stored rows of ``whole_vectors``; None if there are none.

    With fewer vectors than entries, there are as many entries as vectors. Vectors that share
    an id count by their components; null ids come last.
    """
    seeds = [r.x for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(coding.entries).collect()]
    if not seeds:
        return None
    if len({len(s) for s in seeds}) > 1 or len(seeds[0]) % coding.parts:
        raise ValueError(f"vectors must have one length, a multiple of {coding.parts}")
    width = len(seeds[0]) // coding.parts
    books = np.array(seeds, np.int64).reshape(len(seeds), coding.parts, width).swapaxes(0, 1).copy()
    for _ in range(coding.rounds if width else 0):
        books = _moved(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (array of entries by part) and ``error`` of each stored vector."""
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"]])
    schema = T.StructType(schema.fields + T.StructType.fromDDL("code array<int>, error long").fields)
    kinds = [f.type for f in to_arrow_schema(schema)]

    def run(batches):
        for batch in batches:
            index, distance = assign(_parts(batch.column("x"), books), books)
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(list(index), kinds[2]), pa.array(distance.sum(axis=1), kinds[3])]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)


def decode(codes: DataFrame, books: np.ndarray, name: str = "decoded") -> DataFrame:
    """``codes`` with the integer components that a row's ``code`` stands for."""
    parts = [F.array(*[F.array(*[F.lit(int(v)) for v in entry]) for entry in book]) for book in books]
    return codes.withColumn(name, F.concat(*[F.get(part, F.get("code", F.lit(p))) for p, part in enumerate(parts)]))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, decimal, a comma between."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    table: DataFrame, coding: Coding = Coding(), key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, np.ndarray | None]:
    """Stored codes (``vec_id``, ``label``, ``code``, ``error``) of all whole vectors, and the codebooks.

    Rows whose vector is null or holds a null or non-finite component are left out. Repeated
    rows count and repeat. An empty vector has distance zero to everything. Vectors of
    different lengths, of a length that parts do not divide, or with components beyond
    2^26 units (distances would leave 64 bits) are an error. Without vectors, the codes are
    empty and there are no codebooks. Other columns are not read.
    """
    ship_code()
    rows = stage(whole_vectors(table, coding, key, vector, label), "vectors")
    books = fit(rows, coding)
    if books is None:
        empty = rows.withColumns({"code": F.col("x"), "error": F.lit(0).cast("long")})
        return empty.drop("x"), None
    return stage(encode(rows, books), "codes"), books


def _hex_pairs(code: Column) -> Column:
    return F.lower(F.array_join(F.transform(code, lambda i: F.lpad(F.hex(i), 2, "0")), ""))


def code_table(
    table: DataFrame, coding: Coding = Coding(), key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id``, ``code`` as hex pairs, ``error``, ``label_error`` and ``codebooks_sha256`` of all whole vectors.

    ``label_error`` is the error of all vectors of the row's label, nulls together; labels are
    summed before they meet the rows. See ``compress`` for odd rows.
    """
    codes, books = compress(table, coding, key, vector, label)
    sums = stage(codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    rows = codes.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    sha = F.lit(digest(books) if books is not None else None).cast("string")
    return rows.select("vec_id", _hex_pairs(F.col("code")).alias("code"), "error", "label_error", sha.alias("codebooks_sha256"))
