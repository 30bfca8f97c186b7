"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints at distance ``d <= 3`` have a word halfway: within 1 of one of them and
within 2 of the other. So every fingerprint emits the words around it, words are the
shuffle key, and those who meet are linked. Where the distance is 3, the two fingerprints
differ in parity: only odd ones emit words at distance 2. Of the three differing bits, two
lie in one half of the word, so both flipped bits of these words come from one half.

Whoever is within 1 of a word is within 3 of all who meet there, so each word needs only
links to one of them (a star, not all pairs); the links are verified again by distance.
Copies are collapsed to one fingerprint before, so a group's size never enters.
"""

from __future__ import annotations

import re
from itertools import combinations, islice

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import free_name, map_texts
from .components import connected_components

BITS = 64
RADIUS = 3
SEED = 42
# Different fingerprints that share a half from which on its words are shuffled one by one.
HOT = 2000
# Bytes of text whose words are in memory at once.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\t-\r]")


def _words(data: bytes):
    """White-space separated words; a long text is cut at white space, never held as one list."""
    start = 0
    while start < len(data):
        space = _SPACE.search(data, start + PIECE)
        end = space.start() if space else len(data)
        yield from data[start:end].split()
        start = end


def _shingles(data: bytes, width: int):
    words, last = _words(data), []
    last = list(islice(words, width))
    if last:
        yield b" ".join(last)
    for word in words:
        last = [*last[1:], word]
        yield b" ".join(last)


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text; 0 without words."""
    data = (text or "").encode().lower()  # bytes: only A-Z change
    if len(data) <= PIECE:
        words = data.split()
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
        if len(words) < width:
            shingles = iter([b" ".join(words)] if words else ())
    else:
        shingles = _shingles(data, width)
    ones, n = np.zeros(BITS, np.int64), 0
    digest = xxhash.xxh64_intdigest
    while len(part := np.fromiter((digest(x, SEED) for x in islice(shingles, 65536)), "<u8")):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, signed 64-bit ``fp`` and ``text_hash`` (Spark's xxhash64 of the text, null as empty) of every row."""

    def prepare():
        def work(batch):
            texts = batch.column("text").to_pylist()
            found = np.array([fingerprint(x, width) for x in texts], np.uint64)
            hashes = np.array([xxhash.xxh64_intdigest((x or "").encode(), SEED) for x in texts], np.uint64)
            return {"doc_id": batch.column("doc_id"), "fp": found.view(np.int64), "text_hash": hashes.view(np.int64)}

        return work

    return map_texts(docs, prepare, "fp long, text_hash long", key, text)


def _flips() -> dict[str, np.ndarray]:
    """Bits to flip. ``low`` and ``top``: one bit of that half; ``low2`` and ``top2``: two."""
    out = {}
    for name, bits in (("low", range(BITS // 2)), ("top", range(BITS // 2, BITS))):
        out[name] = [1 << i for i in bits]
        out[name + "2"] = [1 << i | 1 << j for i, j in combinations(bits, 2)]
    return {name: np.array(x, np.uint64).view(np.int64) for name, x in out.items()}


def links(marks: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that join all of the different fingerprints ``fp`` within the radius.

    Words whose flipped bits lie in one half share the other half. So the shuffle key is a
    half: a fingerprint is sent once by each of its halves, and once for each half with one
    bit flipped (66 rows); the words that share the half are only made where they meet.
    Where more than ``HOT`` fingerprints have a half, words are made first and shuffled one by one: at
    most 2081 fingerprints lie within two bits of a word, so no task holds a group without bound.
    """
    flip, none = _flips(), np.zeros(1, np.int64)
    tasks = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_top = F.shiftrightunsigned(F.col("word"), BITS // 2)
    by_low = F.col("word").bitwiseAND(F.lit((1 << BITS // 2) - 1)) + F.lit(1 << BITS // 2)
    # Halves that many share, and those one bit beside them, which the same fingerprints reach.
    own = marks.select(F.col("fp").alias("word")).select(F.explode(F.array(by_top, by_low)).alias("own"))
    hot = own.groupBy("own").count().where(F.col("count") > HOT)
    beside = F.lit(np.array([0] + [1 << i for i in range(BITS // 2)], np.int64))
    hot = hot.select("own", F.explode(beside).alias("bit")).select(F.col("own").bitwiseXOR(F.col("bit")).alias("half"))
    hot = stage(hot.distinct(), "hot-halves")

    sent = F.lit(np.concatenate([none, flip["top"], none, flip["low"]]))
    sides = len(flip["top"]) + 1
    rows = marks.repartition(tasks, "fp").select("fp", F.posexplode(sent).alias("at", "flip"))
    rows = rows.withColumn("word", F.col("fp").bitwiseXOR(F.col("flip")))
    rows = rows.select("fp", "flip", F.when(F.col("at") < sides, by_top).otherwise(by_low).alias("half"))
    odd, top = F.bit_count("fp") % 2 == 1, F.col("half") < 1 << BITS // 2
    here = (
        F.when(F.col("flip") != 0, F.array("flip"))
        .when(top & odd, F.lit(np.concatenate([none, flip["low"], flip["low2"]])))
        .when(top, F.lit(np.concatenate([none, flip["low"]])))
        .when(odd, F.lit(np.concatenate([none, flip["top"], flip["top2"]])))
        .otherwise(F.lit(np.concatenate([none, flip["top"]])))
    )

    def words(some: DataFrame) -> DataFrame:
        met = some.select("fp", "half", F.explode(here).alias("flip"))
        return met.select("half", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))

    def stars(met: DataFrame) -> DataFrame:
        within_one = F.bit_count(F.col("fp").bitwiseXOR(F.col("word"))) <= 1
        hub = F.min(F.when(within_one, F.col("fp"))).over(Window.partitionBy("word", "half"))
        return met.withColumn("hub", hub).where("hub != fp").select("fp", "hub")

    few = stars(words(rows.join(hot, "half", "left_anti").repartition(tasks, "half")))
    many = stars(words(rows.join(hot, "half", "left_semi")).repartition(tasks, "half", "word"))
    found = few.union(many).distinct()
    return found.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= RADIUS).toDF("a", "b")


def _roots(rows: DataFrame) -> DataFrame:
    """``(fp, root)`` of every different fingerprint of ``rows``."""
    marks = stage(rows.select("fp").distinct(), "marks")
    found = connected_components(links(marks))
    return marks.join(found, marks["fp"] == found["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest ``doc_id`` reachable over links of distance 3 or
    less, itself included (null if all of a component's ids are null). Texts without words
    have fingerprint zero and are linked like any other. Repeated rows give repeated rows;
    an empty table gives an empty result. Columns other than key and text play no part.
    """
    rows = stage(fingerprints(docs, key=key, text=text), "fingerprints")
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first")).join(_roots(rows), "fp")
    smallest = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(firsts.join(smallest, "root").select("fp", "component_id"), "components")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(named, "fp").select("doc_id", hexed, "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, with one row of each component: that of the smallest ``key``.

    Where rows of a component share that key, the smallest text hash decides, and of rows
    equal in key and text one stays. Rows without a key stay only if no other row of the
    component has one.
    """
    rows = stage(fingerprints(docs, key=key, text=text), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = rows.groupBy("fp").agg(F.min(order).alias("best")).join(_roots(rows), "fp")
    best = best.groupBy("root").agg(F.min("best").alias("best"))
    # One column names a row, so that the join and the removal of repeats share one shuffle of the texts.
    name = free_name(docs, "_row")
    chosen = F.struct(F.col("best.doc_id").alias("id"), F.col("best.text_hash").alias("hash")).alias(name)
    best = stage(best.select(chosen), "kept")
    own = F.struct(F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("hash"))
    rows = docs.withColumn(name, own.cast(best.schema[name].dataType))
    return rows.join(best, name, "left_semi").dropDuplicates([name]).drop(name)
