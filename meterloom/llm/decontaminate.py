"""Benchmark leaks by pigeonhole edit matching.

An item of ``n`` characters may differ in up to ``k`` edits (a share of ``n``, made odd).
It is split into ``k + 1`` pieces, so one piece of any such copy is untouched. An
Aho-Corasick automaton of all pieces finds exact piece hits. Pieces form a binary tree, and
the pigeonhole holds at each node: some untouched piece also has its pair within one edit,
its four within three, and so on up to the item within ``k``. Hits climb this tree; Myers'
bit-parallel distance verifies each level, and nearly all chance hits fall at the first.

Items too short for edits count only as exact copies between word borders.

Documents are scanned where they lie, without a shuffle. Items reach the tasks in blocks of
a fixed number of characters, one scan per block, so no broadcast grows with the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, map_texts


@dataclass(frozen=True)
class Budget:
    """Edits allowed for each character of an item, the shortest item that may have edits, characters in a block."""

    rate: float = 0.08
    min_chars: int = 24
    block_chars: int = 1_000_000


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


def myers(ones: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """Fewest edits between a pattern (its characters' bit masks) and any part of ``text``, and the first end of such a part."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best, at = full, 0, size, size, 0
    for i, ch in enumerate(text, 1):
        eq = ones.get(ch, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise = down | (full & ~(diagonal | up))
        fall = up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        vertical = eq | down
        up, down = fall | (full & ~(vertical | rise)), rise & vertical
        if score < best:
            best, at = score, i
    return best, at


def bit_masks(pattern: str) -> dict[str, int]:
    ones: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        ones[ch] = ones.get(ch, 0) | 1 << i
    return ones


class ShortItem:
    """A benchmark text that only counts as an exact copy between word borders."""

    budget = 0
    cuts = (0,)

    def __init__(self, item_id, text: str):
        self.item_id, self.text = item_id, text

    def pieces(self) -> Iterator[tuple[str, int]]:
        yield self.text, 0

    def verify(self, j: int, text: str, begin: int) -> tuple[int, int] | None:
        """No edits and the end, if no word of ``text`` goes on beyond the copy at ``begin``."""
        end = begin + len(self.text)
        for edge in (begin, end):
            if 0 < edge < len(text) and text[edge - 1].isalnum() and text[edge].isalnum():
                return None
        return 0, end


class Item:
    """A benchmark text, its pieces, and the nodes above each pair of pieces, smallest first."""

    def __init__(self, item_id, text: str, budget: int):
        self.item_id, self.text, self.budget = item_id, text, budget
        count = budget + 1
        self.cuts = [len(text) * j // count for j in range(count + 1)]
        self.above: list[list[tuple[int, int, int]]] = [[] for _ in range(count // 2)]
        self._climb(0, count // 2)
        self.masks: dict[tuple[int, int], dict[str, int]] = {}

    def _climb(self, first: int, stop: int) -> None:
        """Nodes of the pairs ``first`` to ``stop``: their text range and how many edits it may have."""
        if stop - first > 1:
            middle = (first + stop) // 2
            self._climb(first, middle)
            self._climb(middle, stop)
        for pair in range(first, stop):
            self.above[pair].append((self.cuts[2 * first], self.cuts[2 * stop], 2 * (stop - first) - 1))

    def pieces(self) -> Iterator[tuple[str, int]]:
        for j in range(self.budget + 1):
            yield self.text[self.cuts[j] : self.cuts[j + 1]], j

    def other_near(self, j: int, text: str, begin: int) -> bool:
        """Whether the other piece of the pair can be beside an exact hit of piece ``j`` with one edit: a half of it is exact."""
        cuts = self.cuts
        if j % 2:
            other, edge = self.text[cuts[j - 1] : cuts[j]], begin + cuts[j]
            half = len(other) // 2
            left, right = other[:half], other[half:]
            if text.startswith(right, max(0, edge - len(right))):
                return True
            return any(text.startswith(left, max(0, edge - len(other) + d)) for d in (-1, 0, 1))
        other, edge = self.text[cuts[j + 1] : cuts[j + 2]], begin + cuts[j + 1]
        half = len(other) // 2
        left, right = other[:half], other[half:]
        return text.startswith(left, edge) or any(text.startswith(right, edge + half + d) for d in (-1, 0, 1))

    def verify(self, j: int, text: str, begin: int) -> tuple[int, int] | None:
        """Edits and end of what stands where the item would begin at ``begin``, if all nodes above piece ``j`` but the last hold."""
        if not self.other_near(j, text, begin):
            return None
        for start, stop, allowed in self.above[j // 2]:
            if (ones := self.masks.get((start, stop))) is None:
                ones = self.masks[start, stop] = bit_masks(self.text[start:stop])
            at = max(0, begin + start - allowed)
            edits, end = myers(ones, stop - start, text[at : begin + stop + allowed])
            if edits > allowed and stop - start < len(self.text):
                return None
        return edits, at + end


class Scanner:
    """All items of a block, ready to scan texts."""

    def __init__(self, block: list[tuple], budget: Budget):
        self.items = []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in block:
            short = len(text) < budget.min_chars
            item = ShortItem(item_id, text) if short else Item(item_id, text, int(len(text) * budget.rate) | 1)
            for piece, j in item.pieces():
                places.setdefault(piece, []).append((len(self.items), j))
            self.items.append(item)
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def scan(self, text: str | None, first_only: bool = False) -> dict[int, tuple[int, int]]:
        """Items with a copy in the text: their fewest edits and the first end of such a copy."""
        text = normal(text)
        found: dict[int, tuple[int, int]] = {}
        done = set()
        for last, (size, where) in self.automaton.iter(text):
            for k, j in where:
                item = self.items[k]
                begin = last + 1 - size - item.cuts[j]
                if (k, begin) in done:
                    continue
                if got := item.verify(j, text, begin):
                    done.add((k, begin))
                    if got[0] <= item.budget and (k not in found or got < found[k]):
                        found[k] = got
                        if first_only:
                            return found
        return found


def blocks(benchmark: DataFrame, budget: Budget, item: str = "item_id", text: str = "text") -> Iterator[list[tuple]]:
    """Different normalised items in lists of about ``block_chars`` characters.

    Items without a letter or digit (null and empty ones too) are no evidence and left out.
    """
    rows = benchmark.select(benchmark[item].alias("i"), benchmark[text].cast("string").alias("t")).where("t is not null")
    rows = rows.distinct()
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    parts = -(-total // budget.block_chars)
    part = F.pmod(F.xxhash64("i", "t"), F.lit(max(parts, 1)))
    for n in range(parts):
        block = [(r.i, normal(r.t)) for r in rows.where(part == n).collect()]
        if block := sorted({x for x in block if any(map(str.isalnum, x[1]))}, key=lambda x: (x[0] is None, x)):
            yield block


def leaks(
    docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``item_id``, ``edits``, ``budget``, ``end_char``: every pair of a row of ``docs`` and an item it holds a copy of.

    ``edits`` is the least found, ``end_char`` where the first such copy ends in the
    normalised document. Null and empty texts hold nothing; repeated rows and repeated item
    texts under other ids each give rows; an empty table on either side gives no rows.
    Texts are scanned whole. Only key and text of ``docs`` are read.
    """
    spark = docs.sparkSession
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    columns = f"item_id {item_type}, edits int, budget int, end_char long"

    def search(shared):
        def prepare():
            scanner = Scanner(shared.value, budget)

            def work(batch):
                rows, hits = [], []
                for row, value in enumerate(batch.column("text").to_pylist()):
                    for k, got in scanner.scan(value).items():
                        rows.append(row)
                        hits.append((scanner.items[k].item_id, got[0], scanner.items[k].budget, got[1]))
                ids, edits, allowed, ends = zip(*hits) if hits else ((), (), (), ())
                return {
                    "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    "item_id": list(ids),
                    "edits": np.array(edits, np.int32),
                    "budget": np.array(allowed, np.int32),
                    "end_char": np.array(ends, np.int64),
                }

            return work

        return map_texts(docs, prepare, columns, key, text)

    found = [search(spark.sparkContext.broadcast(block)) for block in blocks(benchmark, budget)]
    if not found:
        doc_type = docs.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"doc_id {doc_type}, {columns}")
    return reduce(DataFrame.union, found)


def without_leaks(docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, that hold no copy of any item.

    Null and empty texts hold nothing and stay; repeated rows stay or go together; an empty
    table on either side leaves all rows. Texts are scanned whole.
    """

    def clean(rows, shared):
        def prepare():
            scanner = Scanner(shared.value, budget)
            return lambda texts: [not scanner.scan(x, first_only=True) for x in texts.to_pylist()]

        return keep_rows(rows, prepare, text)

    for block in blocks(benchmark, budget):
        docs = clean(docs, docs.sparkSession.sparkContext.broadcast(block))
    return docs
