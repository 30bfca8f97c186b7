"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut before encoding where no match of the split pattern can cross: before a
space or line feed that follows a character other than white space. The pieces' ids are
those of the whole text. Ids are turned back into raw bytes, never into text, so a token
that ends within a character does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .common import map_texts, per_process

# Characters encoded at once.
PIECE_CHARS = 1 << 18
_CUT = re.compile(r"(?<=\S)[ \n]")


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """Encoding of the content of a rank file: lines of base64 bytes and rank."""
    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut at safe boundaries; without any, one part."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(coder: tiktoken.Encoding, text: str | None) -> list[int]:
    return [i for part in pieces(text or "") for i in coder.encode_ordinary(part)]


def _coder_of(shared):
    """The encoding of a broadcast ``(rank file, pattern)``, built once in a worker."""
    ranks, pattern = shared.value
    return per_process(("bpe", hashlib.sha256(ranks).digest(), pattern), lambda: encoding(ranks, pattern))


def _share(docs: DataFrame, rank_file: str, pattern: str):
    # A vocabulary of about 1 MB, read on the driver: executors need no copy of the file.
    with open(rank_file, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast((f.read(), pattern))


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int), ``n_tokens`` and ``exact`` (the ids decode to the text's bytes) of every row.

    Null counts as empty: no ids, ``exact`` true. Texts are encoded whole; repeated rows
    repeat; an empty table gives an empty result. Only key and text are read.
    """
    shared = _share(docs, rank_file, pattern)

    def prepare():
        coder = _coder_of(shared)

        def work(batch):
            texts = batch.column("text").to_pylist()
            ids = [encode(coder, x) for x in texts]
            return {
                "doc_id": batch.column("doc_id"),
                "ids": pa.array(ids, pa.list_(pa.int32())),
                "n_tokens": np.array([len(x) for x in ids], np.int64),
                "exact": [coder.decode_bytes(i) == (x or "").encode() for i, x in zip(ids, texts)],
            }

        return work

    return map_texts(docs, prepare, "ids array<int>, n_tokens long, exact boolean", key, text)


def digests(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, SHA-256 of the ids (decimal, one space between) and of the decoded bytes of every row.

    As ``encode_texts``, without carrying the ids.
    """
    shared = _share(docs, rank_file, pattern)

    def prepare():
        coder = _coder_of(shared)

        def work(batch):
            counts, ids_sha, bytes_sha = [], [], []
            for value in batch.column("text").to_pylist():
                ids = encode(coder, value)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                bytes_sha.append(hashlib.sha256(coder.decode_bytes(ids)).hexdigest())
            return {
                "doc_id": batch.column("doc_id"),
                "n_tokens": np.array(counts, np.int64),
                "ids_sha256": ids_sha,
                "decoded_sha256": bytes_sha,
            }

        return work

    return map_texts(docs, prepare, "n_tokens long, ids_sha256 string, decoded_sha256 string", key, text)
