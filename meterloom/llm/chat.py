"""Conversations as token ids with a loss mask.

Every turn is an opening control id, its text's byte-level BPE ids, and a closing control id.
Texts are encoded by themselves and control ids are spliced in, so no text can make one; in
the rendered form, control strings inside texts are escaped with backslashes. The loss mask
covers the text ids of assistant turns. It is a prefix sum: plus one behind an assistant's
opening id, minus one at its closing id.

Conversations are laid out by ranges of id and turn, so a huge one spans tasks. A stored row
is a run of whole turns of one conversation; ``piece`` orders the rows of a conversation, and
``whole`` tells that the row is all of it. A reader takes whole rows where they lie and
brings only the rest together, two conversations for each task of the writer at least.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import bpe
from .common import per_process, range_count, ship_code, slices


@dataclass(frozen=True)
class Template:
    """Openings by role, the opening and inner mark of any other role, the closing string, and the role that is learned.

    Control ids follow the vocabulary in this order.
    """

    openings: tuple[tuple[str, str], ...] = (
        ("system", "### System: "),
        ("user", "### User: "),
        ("assistant", "### Assistant: "),
    )
    other: str = "### Role "
    body: str = ": "
    closing: str = "</turn>\n"
    learned: str = "assistant"
    controls: tuple[str, ...] = ("###", "</turn>")  # every opening and closing string holds one

    def strings(self) -> list[str]:
        return [s for _, s in self.openings] + [self.other, self.body, self.closing]

    def escape(self, text: str) -> str:
        """The text with a backslash before each control string, and backslashes that stood there doubled."""
        if not any(c in text for c in self.controls):
            return text
        return re.sub(rf"(\\*)({self._any()})", r"\1\1\\\2", text)

    def unescape(self, text: str) -> str:
        if not any(c in text for c in self.controls):
            return text
        return re.sub(rf"(\\+)({self._any()})", lambda m: m[1][: len(m[1]) // 2] + m[2], text)

    def _any(self) -> str:
        return "|".join(map(re.escape, self.controls))


class Formatter:
    """Turns to ids and back, with one vocabulary and template."""

    def __init__(self, ranks: bytes, pattern: str, template: Template):
        self.coder = bpe.encoding(ranks, pattern)
        self.template = template
        first = self.coder.max_token_value + 1
        self.strings = dict(enumerate(template.strings(), first))
        self.roles = {first + i: role for i, (role, _) in enumerate(template.openings)}
        self.openings = {role: i for i, role in self.roles.items()}
        self.other, self.body, self.closing = range(first + len(self.roles), first + len(self.roles) + 3)

    def turn(self, role: str | None, text: str | None) -> list[int]:
        """Ids of a turn; null role and text are empty."""
        role, escape = role or "", self.template.escape
        if role in self.openings:
            head = [self.openings[role]]
        else:
            head = [self.other, *bpe.encode(self.coder, escape(role)), self.body]
        return [*head, *bpe.encode(self.coder, escape(text or "")), self.closing]

    def loss_mask(self, ids: np.ndarray) -> np.ndarray:
        """Which ids of whole turns are learned."""
        opening = np.flatnonzero((ids >= min(self.strings)) & (ids <= self.other))
        learned = ids[opening] == self.openings.get(self.template.learned, -1)
        closing = np.flatnonzero(ids == self.closing)
        steps = np.zeros(len(ids) + 1, np.int32)
        steps[opening[learned] + 1] += 1
        steps[closing[learned]] -= 1
        return np.cumsum(steps[:-1]) > 0

    def text(self, ids: np.ndarray) -> str:
        return self.coder.decode_bytes(ids.tolist()).decode()

    def render(self, ids: np.ndarray) -> str:
        """The formatted text."""
        marks = np.flatnonzero(ids >= min(self.strings))
        out, at = [], 0
        for mark in marks.tolist():
            out += [self.text(ids[at:mark]), self.strings[int(ids[mark])]]
            at = mark + 1
        return "".join([*out, self.text(ids[at:])])

    def turns(self, ids: np.ndarray) -> Iterator[tuple[str, str]]:
        """Role and text of each turn."""
        at, unescape = 0, self.template.unescape
        for stop in np.flatnonzero(ids == self.closing).tolist():
            kind = int(ids[at])
            start, role = at + 1, self.roles.get(kind)
            if role is None:
                start = at + int(np.flatnonzero(ids[at:stop] == self.body)[0]) + 1
                role = unescape(self.text(ids[at + 1 : start - 1]))
            yield role, unescape(self.text(ids[start:stop]))
            at = stop + 1

    def learned(self, ids: np.ndarray, mask: np.ndarray) -> list[str]:
        """The text of each run of the mask."""
        edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
        return [self.template.unescape(self.text(ids[a:b])) for a, b in edges.reshape(-1, 2).tolist()]


def _shared(spark, rank_file: str, pattern: str, template: Template):
    """A function that gives the formatter in a worker; the vocabulary of about 1 MB is broadcast."""
    with open(rank_file, "rb") as f:
        shared = spark.sparkContext.broadcast((f.read(), pattern, template))
    return lambda: per_process(
        ("chat", hashlib.sha256(shared.value[0]).digest(), *shared.value[1:]), lambda: Formatter(*shared.value)
    )


def write_conversations(
    rows: DataFrame,
    path: str,
    rank_file: str,
    pattern: str,
    template: Template = Template(),
    piece: int = 1 << 20,
    columns: Sequence[str] = ("conv_id", "turn", "role", "text"),
) -> None:
    """Write the turns of ``rows`` as Parquet rows of whole turns, about ``piece`` ids at most (or one turn).

    Columns of the output: ``conv_id``, ``piece``, ``whole``, ``n_turns``, ``ids``, ``loss_mask``.
    Turns follow by number, then role, then a hash of the text; null numbers come first. Null
    ids are a conversation of their own; null texts and roles are empty ones; repeated rows
    are repeated turns. An empty table gives an empty output. Other columns are not read.
    """
    ship_code()
    formatter = _shared(rows.sparkSession, rank_file, pattern, template)
    conv, turn, role, text = (rows[c] for c in columns)
    rows = rows.select(
        conv.alias("conv_id"), turn.alias("turn"), role.cast("string").alias("role"), text.cast("string").alias("text")
    )
    schema = T.StructType([rows.schema["conv_id"]])
    schema = T.StructType(
        schema.fields + T.StructType.fromDDL("piece long, whole boolean, n_turns long, ids array<int>, loss_mask array<boolean>").fields
    )
    kinds = [f.type for f in to_arrow_schema(schema)]

    def run(batches):
        form, part = formatter(), TaskContext.get().partitionId()
        conv, held, n_held, first, count = None, [], 0, True, 0  # turns of the open conversation; whether it is the task's first; rows so far

        def row(whole: bool) -> tuple:
            ids = np.array([i for t in held for i in t], np.int32)
            return conv, (part << 32) + count, whole, len(held), ids, form.loss_mask(ids)

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], schema.names)

        for batch in batches:
            for rows in slices(batch, "text"):
                out = []
                for next_conv, role, text in zip(*(rows.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                    ids, ends = form.turn(role, text), bool(held) and next_conv != conv
                    if held and (ends or n_held + len(ids) > piece):
                        # Whole: not cut before, and neither the first nor (here) the last of the task.
                        out.append(row(ends and not first))
                        count, held, n_held = count + 1, [], 0
                        first = not ends  # a later row of a cut conversation is as little whole as the first
                    conv = next_conv
                    held.append(ids)
                    n_held += len(ids)
                if out:
                    yield batch_of(out)
        if held:
            yield batch_of([row(False)])

    size = F.octet_length("text")
    tie = F.xxhash64("text")
    laid_out = rows.repartitionByRange(range_count(rows, F.coalesce(size, F.lit(0))), "conv_id", "turn", "role", tie)
    laid_out.sortWithinPartitions("conv_id", "turn", "role", tie).drop("turn").mapInArrow(run, schema).write.parquet(path)


def read_digests(spark, path: str, rank_file: str, pattern: str, template: Template = Template()) -> DataFrame:
    """From the files alone: ``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``.

    Hashes run over a conversation's rows in order, one row in memory at a time; that a
    conversation is hashed by one task lies in the hash.
    """
    ship_code()
    formatter = _shared(spark, rank_file, pattern, template)
    stored = spark.read.parquet(path)
    schema = T.StructType([stored.schema["conv_id"]])
    sums = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    schema = T.StructType(schema.fields + T.StructType.fromDDL(sums).fields)
    kinds = [f.type for f in to_arrow_schema(schema)]

    def run(batches):
        form, conv, state = formatter(), None, None

        def ended() -> tuple:
            return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], schema.names)

        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                next_conv = batch.column("conv_id")[i].as_py()
                if state and next_conv != conv:
                    out.append(ended())
                    state = None
                conv = next_conv
                state = state or [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = batch.column("ids")[i].values.to_numpy(zero_copy_only=False)
                mask = batch.column("loss_mask")[i].values.to_numpy(zero_copy_only=False)
                for role, text in form.turns(ids):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for text in form.learned(ids, mask):
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(form.render(ids))
            if out:
                yield batch_of(out)
        if state:
            yield batch_of([ended()])

    columns = ["conv_id", "piece", "ids", "loss_mask"]
    whole = stored.where("whole").select(columns).mapInArrow(run, schema)
    rest = stored.where("not whole").select(columns).repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return whole.unionByName(rest.mapInArrow(run, schema))
