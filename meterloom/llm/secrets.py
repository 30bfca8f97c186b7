"""Secret scans in DataFrame functions.

Three patterns name secrets outright: assignments to a telling name, cloud access keys and
long runs of hex digits. Beside them, every run of key characters is a candidate. Its
character class sets a limit, and a window slides over it: the Shannon entropy of the
window is kept by the counts of the character that enters and the one that leaves. Windows
at the limit or above mark a secret, unless the window holds a placeholder. Identifiers,
paths and hyphenated words are no candidates.

Positions count code points. They come from the lengths of the matches and of the text
between them, summed within the row, so nothing is shuffled and no row meets another.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

_NAMES = ("password", "passwd", "secret", "token", "api_?key")


def _either_case(name: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


ASSIGN = f"({'|'.join(map(_either_case, _NAMES))})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"  # shorter runs would be dropped whole, so the length may stand in the pattern
HEX = "[0-9a-f]{24,}"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
MIN_VALUE = 6
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
# Bits for a window of 20 characters; digits alone are numbers, not secrets.
LIMITS = (("^[0-9]+$", None), ("^(?:[0-9a-f]+|[0-9A-F]+)$", 3.02), ("^[A-Za-z]+$", 4.02), ("", 3.82))
# Identifiers, paths, hyphenated words (both of lower-case or numeric parts, none with letters beside digits) and
# rules: what a run must match to be one, and what it must not hold.
NAMES_THINGS = (
    ("^(?:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9A-F]{8}(?:-[0-9A-F]{4}){3}-[0-9A-F]{12})$", ""),
    ("^[^/]*/[^/]*/", "[A-Z+]|[a-z][0-9]|[0-9][a-z]"),
    ("^[a-z]+[-_/][^-_/]+[-_/]", "[A-Z+=]|[a-z][0-9]|[0-9][a-z]|[-_/][-_/]|[-_/]$"),
    ("^[=_/+-]+$", ""),
)


def _in_order(letters: str, size: int) -> list[str]:
    return [letters[i : i + size] for i in range(len(letters) - size + 1)]


# What a window must hold to be no secret: a placeholder word, or a piece of an alphabet.
PLACEHOLDER = "(?i)" + "|".join(
    ["example", "sample", "placeholder", "changeme", "dummy", "your[_-]", "x{6,}"]
    + _in_order("abcdefghijklmnopqrstuvwxyz", 8)
    + _in_order("0123456789abcdef012345678", 10)
)
MARK = "[secret]"
_BLOCK = 512
# Code points of a text that are cut out of at once.
_PART = 4096


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once; in a lambda, an expression would be computed for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _located(text: Column, pattern: str, hits: Column) -> Column:
    """``(start, end, match)`` of all matches; sums run in blocks, so many matches stay cheap."""
    gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), 1, F.size(hits))
    steps = F.zip_with(gaps, hits, lambda gap, hit: F.struct(gap.alias("gap"), F.length(hit).alias("size"), hit.alias("match")))
    none = F.expr("cast(array() as array<struct<start:int,end:int,match:string>>)")

    def step(a: Column, s: Column) -> Column:
        start = a["at"] + s["gap"]
        end = start + s["size"]
        span = F.struct(start.alias("start"), end.alias("end"), s["match"].alias("match"))
        return F.struct(end.alias("at"), F.array_append(a["out"], span).alias("out"))

    def of_blocks(blocks: Column) -> Column:
        total = F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), lambda n, s: n + s["gap"] + s["size"]))
        tops = F.aggregate(
            total,
            F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out")),
            lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["out"], a["at"]).alias("out")),
        )["out"]
        return F.flatten(
            F.zip_with(blocks, tops, lambda x, top: F.aggregate(x, F.struct(top.alias("at"), none.alias("out")), step)["out"])
        )

    def in_blocks(steps: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int"))
        return _bound(F.transform(numbers, lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))), of_blocks)

    return F.when(F.size(hits) > 0, _bound(steps, in_blocks)).otherwise(none)


def _limit(match: Column) -> Column:
    out = F.lit(LIMITS[-1][1])
    for pattern, bits in reversed(LIMITS[:-1]):
        out = F.when(match.rlike(pattern), F.lit(bits).cast("double")).otherwise(out)
    return out


def _names_things(match: Column) -> Column:
    out = F.lit(False)
    for holds, without in NAMES_THINGS:
        out = out | (match.rlike(holds) & ~match.rlike(without) if without else match.rlike(holds))
    return out


_FIRST, _LAST = ord("+"), ord("z")  # characters of a candidate lie between them


def _set(counts: Column, at: Column, value: Column) -> Column:
    n = _LAST - _FIRST + 1
    return F.concat(F.slice(counts, 1, at - 1), F.array(value), F.slice(counts, at + 1, F.lit(n)))


def _high_windows(text: Column, limit: Column) -> Column:
    """Start of the first and end of the last window of a short run at or above ``limit``: ``(first, last)``, null if none.

    The accumulator holds how often each character stands in the window, and the sum of
    c log c over these counts; a step changes two counts and their terms.
    """
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    term = lambda n: F.element_at(weight, n + 1)

    def slide(run: Column, a: Column, i: Column) -> Column:
        enters, leaves = F.element_at(run["chars"], i), F.element_at(run["chars"], i - WINDOW)
        without = F.when(
            i > WINDOW,
            F.struct(
                _set(a["counts"], leaves, F.element_at(a["counts"], leaves) - 1).alias("counts"),
                (a["total"] - term(F.element_at(a["counts"], leaves)) + term(F.element_at(a["counts"], leaves) - 1)).alias("total"),
            ),
        ).otherwise(F.struct(a["counts"].alias("counts"), a["total"].alias("total")))

        def enter(b: Column) -> Column:
            n = F.element_at(b["counts"], enters)
            return F.struct(_set(b["counts"], enters, n + 1).alias("counts"), (b["total"] + term(n + 1) - term(n)).alias("total"))

        def judge(b: Column) -> Column:
            bits = math.log2(WINDOW) - b["total"] / WINDOW
            held = F.when(run["marked"], F.substr(run["text"], i - WINDOW + 1, F.lit(WINDOW)).rlike(PLACEHOLDER)).otherwise(False)
            return F.struct(b.alias("now"), ((i >= WINDOW) & (bits >= run["limit"]) & ~held).alias("high"))

        def result(b: Column) -> Column:
            return F.struct(
                b["now"]["counts"].alias("counts"),
                b["now"]["total"].alias("total"),
                F.when(a["first"].isNull() & b["high"], i - WINDOW).otherwise(a["first"]).alias("first"),
                F.when(b["high"], i).otherwise(a["last"]).alias("last"),
            )

        return _bound(_bound(_bound(without, enter), judge), result)

    start = F.struct(
        F.array_repeat(F.lit(0), _LAST - _FIRST + 1).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )
    run = F.struct(
        F.transform(F.split(text, ""), lambda c: F.ascii(c) - (_FIRST - 1)).alias("chars"),
        text.alias("text"),
        text.rlike(PLACEHOLDER).alias("marked"),
        limit.alias("limit"),
    )
    return _bound(run, lambda r: F.aggregate(F.sequence(F.lit(1), F.length(r["text"])), start, lambda a, i: slide(r, a, i)))


def _entropy_span(found: Column) -> Column:
    """From the first to the last window of a candidate at or above its limit: ``(first, last)``, null if none.

    Long candidates are walked in blocks that share all characters but one of a window.
    """
    lead = WINDOW - 1

    def in_blocks(run: Column) -> Column:
        def block(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.substring(F.get(run["parts"], i - 1), -lead, lead)).otherwise("")
            moved = i * _BLOCK - F.when(i > 0, lead).otherwise(0)
            high = _high_windows(F.concat(before, x), run["limit"])
            return _bound(high, lambda h: F.struct((h["first"] + moved).alias("first"), (h["last"] + moved).alias("last")))

        def ends(spans: Column) -> Column:
            return F.struct(
                F.array_min(F.transform(spans, lambda s: s["first"])).alias("first"),
                F.array_max(F.transform(spans, lambda s: s["last"])).alias("last"),
            )

        return _bound(F.transform(run["parts"], block), ends)

    parts = F.regexp_extract_all(found["match"], F.lit(".{1,%d}" % _BLOCK), F.lit(0))
    return _bound(F.struct(parts.alias("parts"), _limit(found["match"]).alias("limit")), in_blocks)


def secret_spans(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` with one more column ``name``: array of ``(start, kind, end)``, kind as a place in ``KINDS``, in that order.

    Null and empty texts have none.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    patterns = (ASSIGN, ACCESS, HEX, CANDIDATE)
    names = [free_name(docs, f"{name}_hits{i}") for i in range(len(patterns))]
    hits = {n: F.regexp_extract_all(whole, F.lit(p), F.lit(0)) for n, p in zip(names, patterns)}
    rows = docs.withColumns(hits)
    found = [_located(whole, p, F.col(n)) for n, p in zip(names, patterns)]
    value = lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= MIN_VALUE
    plain = [F.filter(found[0], value), found[1], found[2]]

    def of_kind(kind: int):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))

    spans = [F.transform(x, of_kind(kind)) for kind, x in enumerate(plain)]
    odd = F.filter(found[3], lambda x: _limit(x["match"]).isNotNull() & ~_names_things(x["match"]))
    marked = F.transform(odd, lambda x: F.struct(x["start"].alias("start"), _entropy_span(x).alias("at")))
    spans.append(
        F.transform(
            F.filter(marked, lambda x: x["at"]["first"].isNotNull()),
            lambda x: F.struct(
                (x["start"] + x["at"]["first"]).alias("start"), F.lit(3).alias("kind"), (x["start"] + x["at"]["last"]).alias("end")
            ),
        )
    )
    return rows.withColumn(name, F.array_sort(F.concat(*spans))).drop(*hits)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(x) for x in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, counts of the three plain kinds, SHA-256 of their spans, and all spans of every row.

    A span is ``kind:start:end`` in code points, end exclusive; spans stand by start, then kind.
    Null and empty texts have none (counts 0, empty strings). Repeated rows repeat; an empty
    table gives an empty result; other columns play no part.
    """
    rows = secret_spans(docs.select(docs[key].alias("doc_id"), docs[text].alias("text")), "_spans")
    base = F.filter("_spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs``, all rows and columns, with every span of a secret replaced by a mark; ``length`` (if there) follows the text.

    Overlapping spans become one mark. Null texts stay null.
    """
    name = free_name(docs, "_spans")
    rows = secret_spans(docs, name, text)
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")

    def merge(a: Column, s: Column) -> Column:
        apart = s["start"] > a["end"]
        closed = F.array_append(a["out"], F.struct(a["start"].alias("start"), a["end"].alias("end")))
        return F.struct(
            F.when(apart, closed).otherwise(a["out"]).alias("out"),
            F.when(apart, s["start"]).otherwise(a["start"]).alias("start"),
            F.when(apart, s["end"]).otherwise(F.greatest(a["end"], s["end"])).alias("end"),
        )

    first = F.get(name, F.lit(0))
    merged = F.aggregate(
        name,
        F.struct(none.alias("out"), first["start"].alias("start"), first["end"].alias("end")),
        merge,
        lambda a: F.array_append(a["out"], F.struct(a["start"].alias("start"), a["end"].alias("end"))),
    )
    rows = rows.withColumn(name, F.when(F.size(name) > 0, merged))

    def piece(whole: Column, start: Column, end: Column) -> Column:
        """Code points from ``start`` to ``end``, cut from the parts they lie in only."""
        first = F.floor(start / _PART).cast("int")
        parts = F.slice(whole["parts"], first + 1, F.floor((end - 1) / _PART).cast("int") - first + 1)
        return F.when(end > start, F.substr(F.array_join(parts, ""), start - first * _PART + 1, end - start)).otherwise("")

    def between(whole: Column) -> Column:
        spans, n = whole["spans"], F.size(whole["spans"])
        start = lambda i: F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0)
        end = lambda i: F.when(i < n, F.get(spans, i)["start"]).otherwise(whole["length"])
        return F.array_join(F.transform(F.sequence(F.lit(0), n), lambda i: piece(whole, start(i), end(i))), MARK)

    whole = F.struct(
        F.regexp_extract_all(F.col(text), F.lit("(?s).{1,%d}" % _PART), F.lit(0)).alias("parts"),
        F.col(name).alias("spans"),
        F.length(F.col(text)).alias("length"),
    )
    marked = F.when(F.col(name).isNotNull(), _bound(whole, between)).otherwise(F.col(text))
    rows = rows.withColumn(text, marked.cast(docs.schema[text].dataType)).drop(name)
    if length in docs.columns:
        rows = rows.withColumn(length, F.length(F.col(text)).cast(docs.schema[length].dataType))
    return rows.select(*docs.columns)


