"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; letters stay, every run of other characters is one blank. Each n-gram
of one to three characters falls into one of a fixed number of buckets. Tasks count buckets
by language, Spark sums the counts, and the log-probability matrix (languages x buckets,
checked against a limit before it is sent) goes to all tasks, which score whole batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_texts, per_process, ship_code, slices

UNKNOWN = "und"
# Characters of a text whose n-grams are in memory at once; longer texts go in pieces.
PIECE_CHARS = 1 << 20


@dataclass(frozen=True)
class Shape:
    """Buckets (a power of two), longest n-gram, added count, and the most languages a model may have."""

    bits: int = 16
    longest: int = 3
    added: float = 0.1
    max_languages: int = 256


@dataclass(frozen=True)
class Model:
    """Languages in order, log prior of each, and log probability of each bucket in each."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray
    shape: Shape


def _letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for all else."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        ch = chr(i)
        if ch.isalpha():
            low = ch.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def ngrams(texts: list[str], shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every n-gram, row by row in order within each length, and which rows have a letter."""
    table = per_process(("letters",), _letters)
    chars = table[np.frombuffer("".join(f"\0{x}\0" for x in texts).encode("utf-32-le", "replace"), np.uint32)]
    rows = np.repeat(np.arange(len(texts)), [len(x) + 2 for x in texts])
    stays = chars != 0
    stays[1:] |= (chars[:-1] != 0) | (rows[1:] != rows[:-1])
    if len(stays):
        stays[0] = True
    chars, rows = chars[stays], rows[stays]
    lettered = np.bincount(rows[chars != 0], minlength=len(texts)) > 0
    code = np.zeros(len(chars), np.uint64)
    found_rows, found = [], []
    for n in range(1, shape.longest + 1):
        size = max(len(chars) - n + 1, 0)
        code = code[:size] * np.uint64(0x9E3779B97F4A7C15) + chars[n - 1 : n - 1 + size]
        whole = (rows[:size] == rows[n - 1 : n - 1 + size]) & ((chars[:size] != 0) | (n > 1))
        mixed = (code[whole] + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
        found.append((mixed >> np.uint64(64 - shape.bits)).astype(np.int64))
        found_rows.append(rows[:size][whole])
    return np.concatenate(found_rows), np.concatenate(found), lettered


def buckets_in_pieces(text: str, shape: Shape) -> Iterator[np.ndarray]:
    """The buckets that ``ngrams`` gives for one text, piece by piece; the last letters of a piece go along to the next."""
    table = per_process(("letters",), _letters)
    kept = np.ones(0, np.uint32)
    for start in range(0, len(text) + 2, PIECE_CHARS):
        # The text has a blank on either side, at places 0 and len + 1.
        piece = text[max(start - 1, 0) : start - 1 + PIECE_CHARS]
        piece = "\0" * (start == 0) + piece + "\0" * (start <= len(text) + 1 < start + PIECE_CHARS)
        chars = table[np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)]
        before = np.concatenate([kept[-1:] if len(kept) else [1], chars[:-1]])
        chars = np.concatenate([kept, chars[(chars != 0) | (before != 0)]])
        for n in range(1, shape.longest + 1):
            part = chars[max(len(kept) - n + 1, 0) :]
            size = max(len(part) - n + 1, 0)
            code = np.zeros(size, np.uint64)
            for i in range(n):
                code = code * np.uint64(0x9E3779B97F4A7C15) + part[i : i + size]
            whole = (part[:size] != 0) | (n > 1)
            mixed = (code[whole] + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            yield (mixed >> np.uint64(64 - shape.bits)).astype(np.int64)
        kept = chars[len(chars) - min(len(chars), max(shape.longest - 1, 1)) :]


def fit(docs: DataFrame, shape: Shape = Shape(), text: str = "text", lang: str = "lang") -> Model:
    """Model of all rows of ``docs`` with a language; null and empty texts only count for the prior.

    Without such rows the model has no languages. Columns other than the two are not read.
    """
    ship_code()
    rows = docs.select(docs[lang].cast("string").alias("lang"), docs[text].cast("string").alias("text")).where("lang is not null")
    names = sorted(r[0] for r in rows.select("lang").distinct().limit(shape.max_languages + 1).collect())
    if len(names) > shape.max_languages:
        raise ValueError(f"more than {shape.max_languages} languages to learn")
    size = 1 << shape.bits

    def count(batches):
        sums = {}
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [x or "" for x in part.column("text").to_pylist()]
                place = np.array([names.index(x) for x in part.column("lang").to_pylist()], np.int64)
                for i, text in enumerate(texts):
                    if len(text) > PIECE_CHARS:
                        own = sums.setdefault(int(place[i]), np.zeros(size + 1, np.int64))
                        for bucket in buckets_in_pieces(text, shape):
                            own[:size] += np.bincount(bucket, minlength=size)
                        texts[i] = ""
                row, bucket, _ = ngrams(texts, shape)
                for k in np.unique(place):
                    mine = place[row] == k
                    own = sums.setdefault(int(k), np.zeros(size + 1, np.int64))
                    own[:size] += np.bincount(bucket[mine], minlength=size)
                    own[size] += int((place == k).sum())  # documents
        for k, own in sums.items():
            full = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(full), k, np.int32)), pa.array(full.astype(np.int32)), pa.array(own[full])],
                ["lang", "bucket", "n"],
            )

    counted = rows.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counted.toArrow()  # languages x buckets at most
    sums = np.zeros((len(names), size + 1))
    sums[got["lang"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
    prior = np.log(sums[:, size] / max(sums[:, size].sum(), 1))
    grams = sums[:, :size] + shape.added
    weights = np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32)
    return Model(names, prior, weights, shape)


def score(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Best language of each text (the first of equals) and its posterior probability."""
    long = {i: x for i, x in enumerate(texts) if len(x) > PIECE_CHARS}
    row, bucket, lettered = ngrams(["" if i in long else x for i, x in enumerate(texts)], model.shape)
    for i, text in long.items():
        lettered[i] = any(map(str.isalpha, text))
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    logs = np.stack(
        [np.bincount(row, w[bucket], minlength=len(texts)) + p for w, p in zip(model.weights, model.prior)], axis=1
    )
    for i, text in long.items():
        logs[i] = model.prior
        for part in buckets_in_pieces(text, model.shape):
            logs[i] += [w[part].sum(dtype=np.float64) for w in model.weights]
    logs -= logs.max(1, keepdims=True)
    best = logs.argmax(1)
    return (
        [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered)],
        np.where(lettered, 1 / np.exp(logs).sum(1), 0.0),
    )


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row.

    Texts without a letter (null and empty ones too) are ``und`` with score 0, and so are all
    if the model has no languages. Repeated rows repeat; an empty table gives an empty
    result; a null key is not held out. Only key and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.prior, model.weights))
    shape = model.shape

    def prepare():
        own = Model(*shared.value, shape)

        def work(batch):
            names, scores = score(own, [x or "" for x in batch.column("text").to_pylist()])
            return {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": scores}

        return work

    out = map_texts(docs, prepare, "lang_pred string, score double", key, text)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame, shape: Shape = Shape(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    return predict(docs, fit(docs.where(~held_out(docs[key])), shape, text, lang), key, text)


