"""Line-first quality rules.

Each line with a word is judged by itself: repeats of an earlier line, navigation,
symbols, shouting, boilerplate, one word over and over, and short lines without closing
punctuation fail. A boilerplate phrase counts between word borders, and only where such
phrases are a good share of the line; repetition is judged in pieces of even length, so
that neither grows with the line. Failing lines are removed; a document that loses more than the allowed
part of its words is rejected. Two measures of the whole text reject on their own: too
few words, and too many words inside repeated 8-word windows.

Null and empty texts have no words and are rejected. Texts are judged whole, whatever
their length; repeated rows are judged alike, each with its own result row. An empty table
gives an empty result, and columns other than key and text play no part.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, codes, map_texts, ship_code, slices, words_of

SYMBOLS = "#*$%&|<>"
# Marks that end a sentence or a quotation, by script.
CLOSING = (
    *(".", "!", "?", ":", ";", '"', "'", ")", "]", "…", "”", "’", "»", "›"),
    *("。", "！", "？", "：", "；", "」", "』", "）", "】", "》", "．", "｡"),  # Chinese, Japanese
    *("؟", "۔", "؛"),  # Arabic, Urdu
    *("।", "॥", "။", "។", "།", "።", "։", "׃", "᠃", "꓿", "\u037e"),  # Devanagari, Burmese, Khmer, Tibetan, Ethiopic, Armenian, Hebrew, Mongolian, Lisu, Greek
)
# Scripts written without blanks between words: kana, Han, Hangul-free East Asian blocks, Thai, Lao, Burmese, Khmer.
UNSPACED = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
# Phrases of page furniture, by language.
BOILERPLATE = (
    *("all rights reserved", "click here", "cookie policy", "enable javascript", "lorem ipsum", "privacy policy"),
    *("read more", "sign up", "subscribe to", "terms of service", "terms of use", "use cookies"),
    *("alle rechte vorbehalten", "hier klicken", "weitere informationen", "cookies verwenden"),
    *("tous droits réservés", "cliquez ici", "lire la suite", "politique de confidentialité"),
    *("todos los derechos reservados", "haga clic", "leer más", "política de privacidad"),
    *("tutti i diritti riservati", "clicca qui", "leggi tutto", "informativa sulla privacy"),
    *("todos os direitos reservados", "clique aqui", "leia mais", "política de privacidade"),
)
COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lost_words long"
)
_CLOSING = tuple(x.encode() for x in CLOSING)
_BOILERPLATE = tuple(x.encode() for x in BOILERPLATE)
# Letters beyond ASCII are word characters too: bytes from 0x80 on.
_PHRASE = re.compile(rb"(?<![0-9a-z_\x80-\xff])(?:%s)(?![0-9a-z_\x80-\xff])" % "|".join(BOILERPLATE).encode())
_SYMBOLS = tuple(x.encode() for x in SYMBOLS)
_UNSPACED = re.compile(f"[{UNSPACED}]")


@dataclass(frozen=True)
class Limits:
    min_words: int = 20
    repeat_percent: int = 30
    lost_percent: int = 50
    short_line: int = 5
    unspaced_word: int = 2
    word_run: int = 10
    word_span: int = 128
    phrase_percent: int = 20


def over_and_over(words: list[bytes], limits: Limits) -> bool:
    """Half the words or more are in pieces of ``word_span`` to twice as many words (or all) with few different ones."""
    n = len(words)
    parts = max(n // limits.word_span, 1)
    at = [i * n // parts for i in range(parts + 1)]
    return 2 * sum(b - a for a, b in zip(at, at[1:]) if len(set(words[a:b])) * 4 < b - a) >= n


def line_fails(line: bytes, words: list[bytes], limits: Limits) -> bool:
    n = len(words)
    bars = line.count(b"|")
    if bars >= 2 and bars * 3 >= n:
        return True
    if line.count(b"!!") * 2 >= n:
        return True
    if sum(map(line.count, _SYMBOLS)) >= n:
        return True
    if n >= limits.word_run and over_and_over(words, limits):
        return True
    if n < limits.short_line and not words[-1].endswith(_CLOSING):
        # Without blanks, so many characters count as a word.
        unspaced = 0 if line.isascii() else len(_UNSPACED.findall(line.decode()))
        if n + unspaced // limits.unspaced_word < limits.short_line:
            return True
    low = line.lower()
    if not any(x in low for x in _BOILERPLATE):
        return False
    phrases = sum(x.count(b" ") + 1 for x in _PHRASE.findall(low))
    return phrases > 0 and 100 * phrases >= limits.phrase_percent * n


def judge_lines(text: str, limits: Limits) -> tuple[int, int, int, list[bytes]]:
    """Words, repeated lines, words in failing lines, and the lines that pass."""
    total = repeats = lost = 0
    seen, good = set(), []
    for line in text.encode().split(b"\n"):
        words = line.split()
        total += len(words)
        if not words:
            good.append(line)
        elif line in seen:
            repeats += 1
            lost += len(words)
        else:
            seen.add(line)
            if line_fails(line, words, limits):
                lost += len(words)
            else:
                good.append(line)
    return total, repeats, lost, good


def repeated_words(texts: pa.Array, width: int = 8) -> np.ndarray:
    """Per row, words inside a window of ``width`` (a power of two) words that occurs twice or more in the row."""
    words, rows = words_of(texts)
    n = len(words)
    if n < width:
        return np.zeros(len(texts), np.int64)
    ids, many = codes(words)
    span = 1
    while span < width:  # equal windows get equal numbers, by halves
        ids, many = codes(ids[:-span] * many + ids[span:])
        span *= 2
    inside = rows[: n - width + 1] == rows[width - 1 :]
    ids, many = codes(rows[: n - width + 1] * many + ids)
    starts = np.flatnonzero(inside & (np.bincount(ids[inside], minlength=many)[ids] >= 2))
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return np.bincount(rows[np.cumsum(edges[:-1]) > 0], minlength=len(texts))


def measure(texts: pa.Array, limits: Limits, cleaned: bool = False) -> dict[str, list | np.ndarray]:
    plain = [x or "" for x in texts.to_pylist()]
    judged = [judge_lines(x, limits) for x in plain]
    n_words, dups, lost = (np.array([x[i] for x in judged], np.int64) for i in range(3))
    repeat = repeated_words(texts)
    failed = (n_words < limits.min_words) | (100 * repeat > limits.repeat_percent * n_words)
    out = {
        "n_words": n_words,
        "word_chars": [len(x) - sum(map(x.count, " \t\n\x0b\x0c\r")) for x in plain],
        "n_symbols": [sum(map(x.count, SYMBOLS)) for x in plain],
        "n_dup_lines": dups,
        "n_repeat_words": repeat,
        "base_failed": failed,
        "kept": ~failed & (100 * lost <= limits.lost_percent * n_words),
        "n_lost_words": lost,
    }
    return out | ({"text": [b"\n".join(x[3]).decode() for x in judged]} if cleaned else {})


def quality_rules(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures and verdict of every document."""

    def prepare():
        return lambda batch: {"doc_id": batch.column("doc_id")} | measure(batch.column("text"), limits)

    return map_texts(docs, prepare, COLUMNS, key, text)


def clean_documents(docs: DataFrame, limits: Limits = Limits(), text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """Kept documents with all their columns; the text loses its failing lines, and ``length`` (if there) follows it."""
    ship_code()

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for part in slices(batch, text, SLICE_BYTES):
                got = measure(part.column(at), limits, cleaned=True)
                new = pa.array(got["text"], part.schema.field(at).type)
                yield part.set_column(at, part.schema.field(at), new).filter(pa.array(got["kept"]))

    out = docs.mapInArrow(run, docs.schema)
    if length in docs.columns:
        out = out.withColumn(length, F.length(out[text]).cast(docs.schema[length].dataType))
    return out
