"""Token ids in binary tables: fixed-size blocks, byte or bit planes, zstandard, a block index.

Documents are laid out by ranges of their id, each range in order, and encoded where they
lie. Each part is one stream of ids, cut into blocks of a fixed number of ids. A block is
transposed: all lowest bytes (or bits) of its ids, then all next ones; each plane is
compressed by itself. A block's row names the documents that end in it and where, and how
much of its first document stands before it, so each block can be cut again by itself. The blocks table holds the planes; the index table gives each
block's place in the whole stream and the size of each plane, so a reader can pick blocks.
Both are Parquet: Spark's commit makes the files whole after lost executors, and any
store that Spark can write will do.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from .common import per_process, range_count, ship_code, slices
from .crc import Appender

END = 2
# Word parts that a worker remembers, and text bytes whose words it looks up at once.
PARTS, LOOKUP_BYTES = 300_000, 3 << 20
_BETWEEN = "\x01"
_MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
_TAIL = r"(?P<tail>[!\"#$%&()*+,\-./:;<=>?@\[\]^_`{|}~]+)$"


@dataclass(frozen=True)
class Layout:
    """Ids in a block, planes of ``byte`` or ``bit``, zstandard level."""

    block: int = 65_536
    planes: str = "byte"
    level: int = 3


def pack(ids: np.ndarray, layout: Layout) -> tuple[bytes, list[int]]:
    """Compressed planes of a block of unsigned 32-bit ids, and their sizes; planes above the largest id are left out."""
    columns = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if layout.planes == "bit":
        planes = np.packbits(np.unpackbits(columns, axis=1, bitorder="little").T, axis=1)
        used = int(ids.max()).bit_length() if len(ids) else 0
    else:
        planes = np.ascontiguousarray(columns.T)
        used = -(-int(ids.max()).bit_length() // 8) if len(ids) else 0
    squeeze = zstandard.ZstdCompressor(level=layout.level)
    parts = [squeeze.compress(plane.tobytes()) for plane in planes[:used]]
    return b"".join(parts), [len(x) for x in parts]


def unpack(payload: bytes, sizes: list[int], n: int, planes: str) -> np.ndarray:
    """The ids of a block."""
    open_up, start = zstandard.ZstdDecompressor(), 0
    width = 4 if planes == "byte" else 32
    length = n if planes == "byte" else -(-n // 8)
    whole = np.zeros((width, length), np.uint8)
    for i, size in enumerate(sizes):
        whole[i] = np.frombuffer(open_up.decompress(payload[start : start + size]), np.uint8)
        start += size
    if planes == "bit":
        bits = np.unpackbits(whole, axis=1, count=n)
        whole = np.packbits(bits, axis=0, bitorder="little")
    return np.ascontiguousarray(whole.T).view("<u4").reshape(-1)


class WordCoder:
    """Encodes texts with a tokenizer that splits at white space and drops it, each different word part once.

    Further, it splits between a letter and an ASCII mark other than an apostrophe, and lower-cases:
    so ``Word,`` is ``word`` and ``,``, each encoded once. A word around the name of an added
    token goes to the tokenizer as it is.
    """

    def __init__(self, content: str):
        self.tokenizer = Tokenizer.from_str(content)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        between = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        self._forget()

    def _forget(self) -> None:
        """Known parts, and where their ids stand; the first part is the empty one."""
        self.known = pa.array([""], pa.large_string())
        self.flat, self.stops = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def _cut(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Two parts of each word: a lower-case stem and the marks it ends with, or all of it and nothing.

        Only pure ASCII is lower-cased here: elsewhere normalisation comes first.
        """
        low = pc.ascii_lower(words)
        own = pa.array(np.ones(len(words), bool))
        for name in self.added:
            own = pc.and_(own, pc.invert(pc.match_substring(low, name.lower())))
        low = pc.if_else(pc.and_(own, pc.string_is_ascii(words)), low, words)
        stem = pc.utf8_rtrim(low, characters=_MARKS)
        closed = pc.and_(own, pc.less(pc.binary_length(stem), pc.binary_length(low)))
        closed = pc.and_(closed, pc.match_substring_regex(pc.utf8_slice_codeunits(stem, -1), r"\p{L}"))
        tails = pc.struct_field(pc.extract_regex(low.filter(closed), _TAIL), "tail")
        empty = pa.array([""], low.type).take(pa.array(np.zeros(len(low), np.int64)))
        return pc.if_else(closed, stem, low), pc.replace_with_mask(empty, closed, tails)

    def _numbers(self, parts: pa.Array) -> np.ndarray:
        """Places of the parts among the known ones; new ones are encoded and added."""
        if len(self.known) > PARTS:
            self._forget()
        found = pc.index_in(parts, value_set=self.known)
        missing = pc.is_null(found)
        out = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        new = parts.filter(missing).dictionary_encode()
        if len(new):
            out[missing.to_numpy(zero_copy_only=False)] = new.indices.to_numpy(zero_copy_only=False) + len(self.known)
            ids, sizes = self._encode(new.dictionary)
            self.known = pa.concat_arrays([self.known, new.dictionary])
            self.flat = np.concatenate([self.flat, ids])
            self.stops = np.concatenate([self.stops, self.stops[-1] + np.cumsum(sizes)])
        return out

    def _encode(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts in a row, and how many each has."""
        letters = pc.match_substring_regex(parts, r"^\p{L}+$").to_numpy(zero_copy_only=False)
        ids, sizes = self._encode_words(parts.filter(pa.array(letters)).to_pylist())
        more, more_sizes = self._encode_groups(parts.filter(pa.array(~letters)).to_pylist())
        order = np.empty(len(parts), np.int64)
        order[np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])] = np.arange(len(parts))
        stops = np.concatenate([[0], np.cumsum(np.concatenate([sizes, more_sizes]))])
        return _gather(np.concatenate([ids, more]), stops, order)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters, many in one text: each ends with the next id that ends a word.

        Where normalisation makes more of a letter, or the vocabulary has no such ids, the
        numbers differ, and the words go the other way.
        """
        groups = [words[i : i + 1024] for i in range(0, len(words), 1024)]
        got = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        out, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for group, found in zip(groups, got):
            ids = np.array(found.ids, np.uint32)
            size = np.diff(np.concatenate([[-1], np.flatnonzero(self.ends_word[ids])]))
            if len(size) != len(group):
                ids, size = self._encode_groups(group)
            out.append(ids)
            sizes.append(size)
        return np.concatenate(out), np.concatenate(sizes)

    def _encode_groups(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Any words, many in one text with a mark between them.

        Words that hold the mark, and groups that come back with other marks, go one by one.
        """
        groups = [words[i : i + 256] for i in range(0, len(words), 256)]
        safe = [self.between is not None and not any(_BETWEEN in w for w in g) for g in groups]
        joined = [f" {_BETWEEN} ".join(g) for g, whole in zip(groups, safe) if whole]
        got = iter(self.tokenizer.encode_batch_fast(joined, add_special_tokens=False))
        out, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for group, whole in zip(groups, safe):
            ids = np.array(next(got).ids if whole else [], np.uint32)
            cuts = np.flatnonzero(ids == self.between) if whole else ids
            if whole and len(cuts) + 1 == len(group):
                out.append(np.delete(ids, cuts))
                sizes.append(np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1)
            else:
                alone = [x.ids for x in self.tokenizer.encode_batch_fast(group, add_special_tokens=False)]
                out += [np.array(x, np.uint32) for x in alone]
                sizes.append(np.array([len(x) for x in alone], np.int64))
        return np.concatenate(out), np.concatenate(sizes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        coded, rows = lists.flatten().dictionary_encode(), pc.list_parent_indices(lists)
        stems, tails = self._cut(coded.dictionary)
        both = self._numbers(pa.concat_arrays([stems, tails]))
        # Ids of the different words: the stem's, then the tail's.
        ids, sizes = _gather(self.flat, self.stops, both.reshape(2, -1).T.reshape(-1))
        stops = np.concatenate([[0], np.cumsum(sizes)[1::2]])
        ids, sizes = _gather(ids, stops, coded.indices.to_numpy(zero_copy_only=False))
        counts = np.bincount(rows.to_numpy(zero_copy_only=False), sizes, minlength=len(texts)).astype(np.int64)
        return ids, counts


def _gather(flat: np.ndarray, stops: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` with the wanted numbers, in a row, and their sizes; run i is from ``stops[i]`` to ``stops[i + 1]``."""
    sizes = (stops[1:] - stops[:-1])[wanted]
    shift = stops[wanted] - (np.cumsum(sizes) - sizes)
    return flat[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes


def write_ids(
    docs: DataFrame, path: str, tokenizer_file: str, layout: Layout = Layout(), key: str = "doc_id", text: str = "text"
) -> None:
    """Encode whole texts (null as empty), end each with id 2, and write blocks and index below ``path`` in ascending id order.

    Rows that share an id follow by a hash of the text; null ids come first. A text without
    words has the end id alone. An empty table gives empty tables. Only key and text are read.
    """
    ship_code()
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:  # a vocabulary of a few MB, read on the driver
        shared = spark.sparkContext.broadcast(f.read())
    doc_type = docs.schema[key].dataType
    schema = T.StructType(
        [
            *T.StructType.fromDDL("part int, block int, n_ids int, planes string, sizes array<int>, lead long").fields,
            T.StructField("doc_ids", T.ArrayType(doc_type)),
            *T.StructType.fromDDL("ends array<int>, payload binary").fields,
        ]
    )

    def run(batches):
        coder = per_process(("words", hashlib.sha256(shared.value.encode()).digest()), lambda: WordCoder(shared.value))
        part, block = TaskContext.get().partitionId(), 0
        held, n_held = [], 0  # ids of the open block
        docs_here, ends = [], []  # documents that end in it or later, and where, from its start
        lead = 0  # ids of its first document in earlier blocks

        def cut(n: int) -> pa.RecordBatch:
            nonlocal held, n_held, docs_here, ends, block, lead
            ids = np.concatenate(held)
            payload, sizes = pack(ids[:n], layout)
            stop = int(np.searchsorted(ends, n, side="right"))
            row = [part, block, n, layout.planes, sizes, lead, docs_here[:stop], [int(e) for e in ends[:stop]], payload]
            lead = n - ends[stop - 1] if stop else lead + n
            held, n_held = [ids[n:]], n_held - n
            docs_here, ends = docs_here[stop:], [e - n for e in ends[stop:]]
            block += 1
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], schema.names)

        types = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            types = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.int64(), pa.list_(id_type), pa.list_(pa.int32()), pa.binary()]
            for rows in slices(batch, "text", LOOKUP_BYTES):
                ids, counts = coder.encode(rows.column("text"))
                stops = np.cumsum(counts)
                ids = np.insert(ids, stops, END)
                docs_here += rows.column("doc_id").to_pylist()
                ends += (n_held + stops + np.arange(1, len(stops) + 1)).tolist()
                held.append(ids)
                n_held += len(ids)
                while n_held >= layout.block:
                    yield cut(layout.block)
            pa.default_memory_pool().release_unused()  # an executor's workers share its memory
        if n_held:
            yield cut(n_held)

    rows = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"))
    parts = range_count(rows, F.octet_length("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    blocks = rows.mapInArrow(run, schema)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    written = spark.read.schema(schema).parquet(f"{path}/blocks").select("part", "block", "n_ids", "sizes")
    sums = written.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each task of the layout
    starts = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    before = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids")
    index = written.withColumn("before", before).join(starts, "part")
    index.select("part", "block", (F.col("part_start") + F.col("before")).alias("start"), "n_ids", "sizes").write.parquet(f"{path}/index")


def read_ids(spark, path: str, start: int, n: int) -> DataFrame:
    """Ids ``start`` to ``start + n`` of the whole stream as rows ``(start, ids)``, one for each block they lie in.

    The index picks the blocks; no other is unpacked.
    """
    ship_code()
    wanted = spark.read.parquet(f"{path}/index").where((F.col("start") < start + n) & (F.col("start") + F.col("n_ids") > start))
    found = spark.read.parquet(f"{path}/blocks").drop("n_ids", "sizes").join(wanted, ["part", "block"])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["sizes"], row["n_ids"], row["planes"])
                first = max(start - row["start"], 0)
                ids = ids[first : start + n - row["start"]]
                yield pa.RecordBatch.from_arrays([pa.array([row["start"] + first]), pa.array([ids], pa.list_(pa.int64()))], ["start", "ids"])

    return found.select("start", "payload", "sizes", "n_ids", "planes").mapInArrow(run, "start long, ids array<long>")


def read_documents(spark, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files alone.

    ``start`` is how many ids stand before the document, ``ids_crc32`` the CRC-32 of its ids
    as little-endian unsigned 32-bit integers, end id included. Blocks are read where they
    lie; the index tells where each stands. Only the pieces of documents that cross a block's
    border meet, and their CRCs are joined.
    """
    ship_code()
    blocks = spark.read.parquet(f"{path}/blocks")
    doc_type = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType.fromDDL("part int, block int, at long, done long, n long, crc long, ended boolean")
    schema = T.StructType([*schema.fields, T.StructField("doc_id", doc_type)])

    def run(batches):
        for batch in batches:
            kinds = [f.type for f in to_arrow_schema(schema)]
            for i in range(batch.num_rows):
                got = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                ids = memoryview(unpack(got["payload"], got["sizes"], got["n_ids"], got["planes"]).tobytes())
                ends = np.array(got["ends"], np.int64)
                open_end = not len(ends) or ends[-1] < got["n_ids"]
                stops = np.append(ends, got["n_ids"]) if open_end else ends
                starts = np.concatenate([[0], stops[:-1]])
                k = len(stops)
                done = np.zeros(k, np.int64)  # ids of the document in earlier blocks
                done[0] = got["lead"]
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist())]
                ended = np.ones(k, bool)
                ended[len(ends) :] = False
                columns = [np.full(k, got["part"]), np.full(k, got["block"]), starts, done, stops - starts, crc, ended]
                columns.append(got["doc_ids"] + [None] * (k - len(ends)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], schema.names)

    def join_pieces(batches):
        appended = per_process(("crc",), Appender)
        for batch in batches:
            crc = []
            for pieces in batch.column("pieces").to_pylist():
                whole = np.zeros(1, np.uint32)
                for piece in pieces:
                    whole = appended(whole, np.array([4 * piece["n"]])) ^ np.uint32(piece["crc"])
                crc.append(int(whole[0]))
            kept = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    index = spark.read.parquet(f"{path}/index").select("part", "block", "start")
    found = blocks.mapInArrow(run, schema).join(index, ["part", "block"])
    found = found.withColumn("start", F.col("start") + F.col("at") - F.col("done"))
    whole = F.col("ended") & (F.col("done") == 0)
    out = found.where(whole).select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    # A document's pieces are as many as the blocks it fills; start tells documents apart.
    pieces = found.where(~whole).groupBy("start").agg(
        F.max(F.when(F.col("ended"), F.col("doc_id"))).alias("doc_id"),
        F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("done", "n", "crc"))).alias("pieces"),
    )
    joined = T.StructType([T.StructField("doc_id", doc_type), *T.StructType.fromDDL("start long, n_tokens long, ids_crc32 long").fields])
    return out.unionByName(pieces.select("doc_id", "start", "n_tokens", "pieces").mapInArrow(join_pieces, joined))
