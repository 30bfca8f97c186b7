"""Quality classifier: supervised subword embeddings.

A document is the mean of the vectors of its features: hashed words, pairs of words (a word
after itself is one feature of its own) and character n-grams. A softmax layer sits on top.
Vectors and layer are learned together by stochastic gradient descent in numpy, from a
bounded sample of labelled documents. As both are linear, each feature's vector and the
layer are folded into one number for scoring, so a task gathers a single float per feature.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import codes, held_out, map_texts, words_of


@dataclass(frozen=True)
class Settings:
    """``fit_rows`` bounds the labelled documents that are learned from; scores use every row."""

    fit_rows: int = 3000
    bits: int = 17
    dimensions: int = 16
    epochs: int = 8
    rate: float = 0.5
    seed: int = 7
    shortest: int = 2
    longest: int = 3


@dataclass(frozen=True)
class Model:
    """Folded weight of each bucket, and the offset."""

    weights: np.ndarray
    offset: float
    settings: Settings


# Characters of a text whose features are in memory at once; longer texts go in pieces.
PIECE_CHARS = 1 << 20
_SPACE = re.compile("[\x20\t-\r]")
_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def features(texts: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every feature of an array of texts."""
    shift = np.uint64(64 - settings.bits)
    words, at = words_of(texts)
    number, _ = codes(words)
    # Numbers stand in order of first appearance, as the dictionary does.
    names = words.dictionary_encode().dictionary.to_pylist() if len(words) else []
    hashes = np.array([xxhash.xxh64_intdigest(w, 0) for w in names], np.uint64)[number]
    pair = hashes[:-1] * _STEP + hashes[1:]
    pair = np.where(hashes[:-1] == hashes[1:], np.uint64(1), pair)[at[:-1] == at[1:]]
    found = [(hashes * _MIX) >> shift, ((pair + np.uint64(2)) * _MIX) >> shift]
    rows = [at, at[:-1][at[:-1] == at[1:]]]
    plain = [x or "" for x in texts.to_pylist()]
    chars = np.frombuffer("".join(plain).encode("utf-32-le", "replace"), np.uint32)
    row = np.repeat(np.arange(len(plain)), [len(x) for x in plain])
    code = np.zeros(len(chars), np.uint64)
    for n in range(1, settings.longest + 1):
        size = max(len(chars) - n + 1, 0)
        code = code[:size] * _STEP + chars[n - 1 : n - 1 + size]
        if n >= settings.shortest:
            whole = row[:size] == row[n - 1 : n - 1 + size]
            found.append(((code[whole] + np.uint64(n << 32)) * _MIX) >> shift)
            rows.append(row[:size][whole])
    return np.concatenate(rows), np.concatenate(found).astype(np.int64)


def buckets_in_pieces(text: str, settings: Settings) -> Iterator[np.ndarray]:
    """The buckets that ``features`` gives for one text: words by pieces cut at white space, characters by pieces of one size."""
    shift, last, start = np.uint64(64 - settings.bits), np.zeros(0, np.uint64), 0
    while start < len(text):
        space = _SPACE.search(text, start + PIECE_CHARS)
        end = space.start() if space else len(text)
        words, _ = words_of(pa.array([text[start:end]]))
        start = end
        number, _ = codes(words)
        names = words.dictionary_encode().dictionary.to_pylist() if len(words) else []
        own = np.array([xxhash.xxh64_intdigest(w, 0) for w in names], np.uint64)[number]
        yield ((own * _MIX) >> shift).astype(np.int64)
        run = np.concatenate([last, own])
        pair = np.where(run[:-1] == run[1:], np.uint64(1), run[:-1] * _STEP + run[1:])
        yield (((pair + np.uint64(2)) * _MIX) >> shift).astype(np.int64)
        last = run[-1:]
    for start in range(0, len(text), PIECE_CHARS):
        for n in range(settings.shortest, settings.longest + 1):
            part = text[max(start - n + 1, 0) : start + PIECE_CHARS]
            chars = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
            size = max(len(chars) - n + 1, 0)
            code = np.zeros(size, np.uint64)
            for i in range(n):
                code = code * _STEP + chars[i : i + size]
            yield (((code + np.uint64(n << 32)) * _MIX) >> shift).astype(np.int64)


def _short(texts: pa.Array) -> tuple[pa.Array, dict[int, str]]:
    """The texts with the long ones emptied, and those by their row."""
    long = pc.greater(pc.fill_null(pc.utf8_length(texts), 0), PIECE_CHARS)
    rows = np.flatnonzero(long.to_numpy(zero_copy_only=False))
    return pc.if_else(long, "", texts) if len(rows) else texts, {int(i): texts[i].as_py() for i in rows}


def _sparse(texts: pa.Array, settings: Settings) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Different buckets of each text and their shares of its features."""
    texts, long = _short(texts)
    row, bucket = features(texts, settings)
    both, counts = np.unique(row << settings.bits | bucket, return_counts=True)
    row, bucket = both >> settings.bits, both & ((1 << settings.bits) - 1)
    cuts = np.searchsorted(row, np.arange(1, len(texts)))
    totals = np.maximum(np.bincount(row, counts, minlength=len(texts)), 1)
    shares = (counts / totals[row]).astype(np.float32)
    buckets, shares = np.split(bucket.astype(np.int32), cuts), np.split(shares, cuts)
    for i, text in long.items():
        sums = sum(np.bincount(x, minlength=1 << settings.bits) for x in buckets_in_pieces(text, settings))
        full = np.flatnonzero(sums)
        buckets[i], shares[i] = full.astype(np.int32), (sums[full] / sums.sum()).astype(np.float32)
    return buckets, shares


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Descent over ``(buckets, shares, label)``; the learning rate falls to zero in a line."""
    size, rng = 1 << settings.bits, np.random.default_rng(settings.seed)
    if not samples:
        return Model(np.zeros(size, np.float32), 0.0, settings)
    vectors = rng.uniform(-1 / settings.dimensions, 1 / settings.dimensions, (size, settings.dimensions))
    vectors = vectors.astype(np.float32)
    layer, offset = np.zeros((settings.dimensions, 2), np.float32), np.zeros(2, np.float32)
    steps, step = settings.epochs * len(samples), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(samples)):
            buckets, shares, label = samples[i]
            rate = settings.rate * (1 - step / steps)
            step += 1
            mean = shares @ vectors[buckets]
            logits = mean @ layer + offset
            odds = np.exp(logits - logits.max())
            miss = odds / odds.sum()
            miss[label] -= 1
            back = layer @ miss
            layer -= rate * np.outer(mean, miss)
            offset -= 0.1 * rate * miss
            # A feature's share is small; the step is scaled up as if a text had few features.
            vectors[buckets] -= (rate * np.sqrt(len(buckets)) * shares)[:, None] * back
    weights = vectors @ (layer[:, 1] - layer[:, 0])
    return Model(weights.astype(np.float32), float(offset[1] - offset[0]), settings)


def fit(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", label: str = "quality"
) -> Model:
    """Model of at most ``fit_rows`` labelled documents, those with the smallest hashes of their ids.

    Null labels and ids are left out; an id labelled twice takes the smaller label; of
    documents that share an id one is taken. Labels other than 1 count as 0. Without
    labelled documents every score is one half.
    """
    known = labels.select(labels[key].alias("_id"), labels[label].alias("label")).where("_id is not null and label is not null")
    known = known.groupBy("_id").agg((F.min("label") == 1).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(settings.fit_rows)
    rows = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"))
    # The sample has fit_rows ids and labels at most.
    rows = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(
        F.max(F.struct("text", "label")).alias("row")
    )
    rows = rows.select(F.concat_ws(":", "doc_id", "row.label").alias("doc_id"), F.col("row.text").alias("text"))

    def prepare():
        def work(batch):
            buckets, shares = _sparse(batch.column("text"), settings)
            return {
                "doc_id": batch.column("doc_id"),
                "buckets": pa.array(buckets, pa.list_(pa.int32())),
                "shares": pa.array(shares, pa.list_(pa.float32())),
            }

        return work

    got = map_texts(rows, prepare, "buckets array<int>, shares array<float>").toArrow()
    samples = []
    for name, buckets, shares in zip(got["doc_id"].to_pylist(), got["buckets"], got["shares"]):
        pair = (np.asarray(buckets.values), np.asarray(shares.values))
        samples.append((name, *pair, int(name.rpartition(":")[2])))
    return train([x[1:] for x in sorted(samples, key=lambda x: x[0])], settings)


def score(model: Model, texts: pa.Array) -> np.ndarray:
    """Probability of label 1; a text without features gets that of the offset alone."""
    texts, long = _short(texts)
    row, bucket = features(texts, model.settings)
    total = np.bincount(row, model.weights[bucket], minlength=len(texts))
    many = np.maximum(np.bincount(row, minlength=len(texts)), 1)
    for i, text in long.items():
        total[i], many[i] = 0.0, 0
        for part in buckets_in_pieces(text, model.settings):
            total[i] += model.weights[part].sum(dtype=np.float64)
            many[i] += len(part)
    return 1 / (1 + np.exp(-np.clip(total / many + model.offset, -30, 30)))


def predict(docs: DataFrame, model: Model, limit: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Null counts as empty. Texts are scored whole; repeated rows repeat; an empty table gives
    an empty result; a null key is not held out. Only key and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.offset))
    settings = model.settings

    def prepare():
        own = Model(*shared.value, settings)
        return lambda batch: {"doc_id": batch.column("doc_id"), "score": score(own, batch.column("text"))}

    out = map_texts(docs, prepare, "score double", key, text)
    return out.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
    )


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), limit: float = 0.3) -> DataFrame:
    """Learn from labels of documents that are not held out, score all documents."""
    return predict(docs, fit(docs, labels.where(~held_out(labels["doc_id"])), settings), limit)
