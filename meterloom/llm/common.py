"""Helpers shared by the text operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Text bytes that a task works on at once; one text may be longer.
SLICE_BYTES = 4 << 20

# ASCII white space as the word definitions of these operators have it.
SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_code() -> None:
    """Send this package's functions with their code, so executors need no installed copy."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])


def per_process(key: tuple, make: Callable):
    """``make()`` once in the life of a Python worker; functions sent by value keep no globals."""
    store = sys.modules.setdefault("_meterloom_worker", types.ModuleType("_meterloom_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``limit`` text bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_texts(
    docs: DataFrame, prepare: Callable[[], Callable], columns: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Apply ``prepare()``, made once in each task, to ``(key, text)`` of every row.

    It gets an Arrow batch with the columns ``doc_id`` and ``text`` (null as null)
    and returns a dict of arrays for ``doc_id`` and ``columns``. Other columns are not read.
    """
    ship_code()
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType)])
    schema = T.StructType(schema.fields + T.StructType.fromDDL(columns).fields)
    kinds = {f.name: f.type for f in to_arrow_schema(schema)}

    def typed(name: str, values) -> pa.Array:
        return values if isinstance(values, pa.Array) else pa.array(values, kinds[name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            for part in slices(batch, "text"):
                out = work(part)
                yield pa.RecordBatch.from_arrays([typed(c, out[c]) for c in kinds], list(kinds))

    return docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(run, schema)


def keep_rows(docs: DataFrame, prepare: Callable[[], Callable], text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose text ``prepare()`` says True for; it gets an Arrow text array."""
    ship_code()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(work(part.column(text)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of an array of texts, in order, and each word's row."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, rows = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)
    return words.filter(full), rows.filter(full).to_numpy(zero_copy_only=False).astype(np.int64)


def codes(values: pa.Array | np.ndarray) -> tuple[np.ndarray, int]:
    """Equal values to equal small integers, and how many there are."""
    coded = pa.array(values).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(key: Column) -> Column:
    """Rows kept from all learning."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def range_count(rows: DataFrame, size: Column, most: int = 128 << 20, least: int = 4 << 20) -> int:
    """Ranges for a layout of ``rows`` by their bytes: three a core, none far above ``most`` bytes or below ``least``."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(-(-total // most), min(-(-total // least), 3 * cores), 1)
