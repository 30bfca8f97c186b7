"""Resampling of documents towards a target distribution, ranked by a distributed radix sort.

Features are runs of one to three words, hashed into buckets by CRC-32. Two counts of the
buckets, of all documents and of all target texts, give each bucket a gain; a document's
weight is the sum of the gains of its features. Gumbel noise from a hash of the id turns the
highest scores into a draw without replacement.

The CRC of a run follows from the CRCs of its words: appending bytes is a linear map of the
old CRC, so each different word is hashed once and runs are made by table lookups in numpy.

The ranks come from a distributed radix sort (``radix``).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import stage
from .common import SLICE_BYTES, free_name, per_process, ship_code, slices, words_of
from .crc import Appender
from .radix import Radix, ascending, descending, radix_sort

# Lower-case A-Z; every other ASCII byte that is no letter or digit parts words.
_AS_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


@dataclass(frozen=True)
class Draw:
    """Longest run of words, buckets, percent of the eligible documents drawn, words that make one eligible, seed of the noise."""

    run: int = 3
    buckets: int = 10_000
    percent: int = 5
    least_words: int = 20
    seed: int = 42


class Runs:
    """Buckets of the word runs of texts."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets = longest, buckets
        self.appended = per_process(("crc",), Appender)

    def _of(self, texts: pa.Array, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text, and the text and bucket of each run; the first ``context`` words only lead into runs."""
        words, rows = words_of(texts)
        coded = words.dictionary_encode()
        number = coded.indices.to_numpy(zero_copy_only=False)
        known = [w.encode() for w in coded.dictionary.to_pylist()]
        of_known = lambda f, kind: np.fromiter(map(f, known), kind, len(known))[number]
        alone, spaced = of_known(zlib.crc32, np.uint32), of_known(lambda w: zlib.crc32(b" " + w), np.uint32)
        size = of_known(len, np.int64) + 1
        counts = np.bincount(rows, minlength=len(texts))
        place = np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]
        owners, found, crc = [], [], alone
        for length in range(1, self.longest + 1):
            if length > 1:  # the run of one word less that ends before this word, and this word
                crc = self.appended(np.concatenate([crc[:1], crc[:-1]]), size) ^ spaced
            there = place >= max(context, length - 1)
            owners.append(rows[there])
            found.append(crc[there] % np.uint32(self.buckets))
        return counts - context, np.concatenate(owners), np.concatenate(found).astype(np.int64)

    def of(self, texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(words of each text, text of each run, bucket of each run)`` of successive parts of the texts.

        Texts above ``limit`` bytes come one by one, in parts of about that size that start with
        the last words of the part before; results of a text's parts add up.
        """
        texts = pc.fill_null(texts, "")
        data = [_as_words(texts)]
        if len(texts) != 1 or len(data[0]) <= limit:
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
            offsets = np.concatenate([np.zeros(1, np.int64), ends])
            yield self._of(_strings(offsets, data[0]), 0)
            return
        text, start, lead = data[0], 0, []
        while start < len(text):
            cut = text.find(b" ", start + limit)
            stop = len(text) if cut < 0 else cut
            part = b" ".join([*lead, text[start:stop]])
            yield self._of(_strings(np.array([0, len(part)]), part), len(lead))
            lead = part.rsplit(None, self.longest)[1 - self.longest :] if self.longest > 1 else []
            start = stop


def _as_words(texts: pa.Array) -> bytes:
    """All bytes of the texts, one after another, with blanks between words."""
    return b"".join(texts.cast(pa.large_binary()).to_pylist()).translate(_AS_WORDS)


def _strings(offsets: np.ndarray, data: bytes) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def bucket_counts(texts: DataFrame, draw: Draw, text: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts: a vector of ``draw.buckets`` counts, summed in Spark."""
    ship_code()

    def run(batches):
        runs, total = Runs(draw.run, draw.buckets), np.zeros(draw.buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for _, _, found in runs.of(part.column("text")):
                    total += np.bincount(found, minlength=draw.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])

    found = texts.select(texts[text].cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(draw.buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[row.bucket] = row.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Rounded log ratio of smoothed shares, in thousandths."""
    size = len(source)
    s_all, t_all = int(source.sum()) + size, int(target.sum()) + size
    ratios = (float(int(t) + 1) * s_all / (float(int(s) + 1) * t_all) for s, t in zip(source, target))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.float64)


def weigh(docs: DataFrame, gains: np.ndarray, draw: Draw, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of every row, and its ``chunk`` and ``place`` for the sort."""
    ship_code()
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType)])
    schema = T.StructType(
        schema.fields + T.StructType.fromDDL("n_words long, n_features long, weight long, chunk long, place long").fields
    )
    kinds = [f.type for f in to_arrow_schema(schema)]

    def run(batches):
        runs, chunk, place = Runs(draw.run, draw.buckets), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text"):
                n = part.num_rows
                words, features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
                for counts, owners, found in runs.of(part.column("text")):
                    words += counts
                    features += np.bincount(owners, minlength=n)
                    weight += np.bincount(owners, gains[found], n)
                columns = [part.column("doc_id"), words, features, weight.astype(np.int64), np.full(n, chunk), place + np.arange(n)]
                place += n
                columns = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(run, schema)


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel noise in thousandths, from a hash of seed and key."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 32)
    return F.floor(-1000 * F.log(-F.log(share)))


def rank_documents(
    docs: DataFrame, target: DataFrame, draw: Draw = Draw(), radix: Radix = Radix(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``; ``rank`` only of the drawn.

    ``target`` has the column ``text``. The key is an integer. Drawn are, of the rows with enough words, the stated percent
    (rounded down) with the highest scores, ties to the smaller key; a null key comes last
    among ties and gets the noise of an empty one. Repeated rows count and rank each for
    itself, in any order among equals. Null and empty texts have no features, weight 0, and
    are not drawn. An empty target makes every gain one of smoothing alone; empty ``docs``
    give an empty result. Only key and text are read.
    """
    gains = bucket_gains(bucket_counts(docs, draw, text), bucket_counts(target, draw))
    scored = weigh(docs, gains, draw, key, text)
    scored = stage(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), draw.seed)), "weighed")
    able = scored.where(F.col("n_words") >= draw.least_words)
    keys = [descending(F.col("score")), F.col("doc_id").isNull().cast("long"), ascending(F.coalesce("doc_id", F.lit(0)))]
    ranked, n = radix_sort(able, keys, radix)
    rank = F.when(F.col("place") < draw.percent * n // 100, F.col("place") + 1)
    out = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < draw.least_words).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*out, rank.alias("rank")).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, draw: Draw = Draw(), radix: Radix = Radix(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The drawn rows of ``docs``, all columns; rows that share the key of a drawn one come along.

    Null keys are never drawn here.
    """
    drawn = rank_documents(docs, target, draw, radix, key, text).where("rank is not null")
    drawn = stage(drawn.select(F.col("doc_id").alias(free_name(docs, "_drawn"))).distinct(), "drawn")
    return docs.join(drawn, docs[key] == drawn[drawn.columns[0]], "left_semi")
