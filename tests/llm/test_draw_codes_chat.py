"""Target draw, vector codes and chat formatting against plain versions, and their odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterloom.llm import chat, radix, target_draw, vectorcodes
from meterloom.session import stage

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = ("chunk", "place", "key0", "digit", "among", "offset", "score", "rank", "x", "code", "error", "piece", "whole", "ids", "conv")
LONG = " ".join(f"Word{i % 977}-line {i}" for i in range(60_000)) + " " + "z" * 70_000 + " end"


def plain_draw(docs, target, draw=target_draw.Draw()):
    def runs(text):
        words = WORD.findall((text or "").translate(UPPER))
        found = [" ".join(words[i : i + k]) for k in range(1, draw.run + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(x.encode()) % draw.buckets for x in found]

    found = [(d, *runs(t)) for d, t in docs]
    s, t = Counter(b for x in found for b in x[2]), Counter(b for x in target for b in runs(x)[1])
    s_all, t_all = sum(s.values()) + draw.buckets, sum(t.values()) + draw.buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in s}
    rows = []
    for d, n, buckets in found:
        h = int(hashlib.sha256(f"{draw.seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        rows.append([d, n, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in rows if r[1] >= draw.least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: draw.percent * len(able) // 100], 1):
        row[5] = place
    return sorted(((r[0], *r[2:]) for r in rows), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta,", "GAMMA", "delta.", "e3", "ünï", "字", "zz-top", "x" * 90]
    rows = [(i - 30, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, LONG), (None, "alpha beta gamma " * 9), (None, None), rows[7], rows[7], (2**62, rows[9][1])]
    rows += [(-(2**62), rows[9][1]), (503, " \n,; ")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def clashing(df):
    taken = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASH if c not in taken])


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_draw_against_a_plain_loop(spark, docs):
    rows, df = docs
    texts = ["alpha beta gamma", "Word3 line 5, and e3", None, ""]
    target = spark.createDataFrame([(t,) for t in texts], "text string")
    draw, small = target_draw.Draw(percent=40), radix.Radix(chunks=5, least_rows=8)
    got = target_draw.rank_documents(df.repartition(5), target, draw, small)
    want = plain_draw(rows, texts, draw)
    assert sorted_rows(got) == want
    assert sorted_rows(target_draw.rank_documents(clashing(df), clashing(target), draw)) == want
    assert sorted_rows(target_draw.rank_documents(df, target.limit(0), draw)) == plain_draw(rows, [], draw)
    assert target_draw.rank_documents(df.limit(0), target).collect() == []
    drawn = {r[0] for r in want if r[4] is not None and r[0] is not None}
    kept = target_draw.resample(clashing(df), target, draw)
    assert kept.columns == clashing(df).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in rows if d in drawn)


def test_long_texts_in_parts_give_the_same_runs():
    texts = pa.array([LONG])
    runs = target_draw.Runs(3, 10_000)
    whole = list(runs.of(texts))
    parts = list(runs.of(texts, limit=5000))
    assert len(whole) == 1 and len(parts) > 100
    assert sum(int(p[0][0]) for p in parts) == int(whole[0][0][0])
    assert Counter(np.concatenate([p[2] for p in parts]).tolist()) == Counter(whole[0][2].tolist())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1 ,ü字\n", max_size=40), max_size=5), st.integers(1, 4))
def test_runs_are_the_crc_of_joined_words(texts, longest):
    got = [sorted(b.tolist()) for _, _, b in target_draw.Runs(longest, 9973).of(pa.array(texts, pa.string()))]
    want = []
    for t in texts:
        w = WORD.findall(t.translate(UPPER))
        want += [zlib.crc32(" ".join(w[i : i + k]).encode()) % 9973 for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
    assert sorted(x for part in got for x in part) == sorted(want)


def test_radix_sort_is_stable_and_whole(spark):
    rng = random.Random(3)
    values = [(rng.choice([5, 5, 5, -9, 2**40, -(2**63)]), rng.randint(0, 6)) for _ in range(400)]
    rows = [(i % 7, i // 7, *v, i) for i, v in enumerate(values)]
    df = stage(spark.createDataFrame(rows, "chunk long, place long, a long, b long, n long"))
    keys = [radix.descending(F.col("a")), radix.ascending(F.col("b"))]
    for bits in (11, 16):
        got, n = radix.radix_sort(df, keys, radix.Radix(bits=bits, chunks=9, least_rows=16))
        found = got.orderBy("place").collect()
        assert n == 400 and [r.place for r in found] == list(range(400))
        assert [r.n for r in found] == [r[4] for r in sorted(rows, key=lambda r: (-r[2], r[3], r[0], r[1]))]
    one = stage(df.where("a = 5 and b = 0"))
    got, n = radix.radix_sort(one, keys)
    assert sorted(r.place for r in got.collect()) == list(range(n))
    assert radix.radix_sort(df.limit(0), keys)[0].collect() == []


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 20), st.integers(1, 6), st.integers(0, 10**6), st.sampled_from([1, 3, 50, 1 << 25]))
def test_equal_average_search_finds_the_first_nearest(entries, width, seed, spread):
    rng = np.random.default_rng(seed)
    x, book = rng.integers(-spread, spread + 1, (40, width)), rng.integers(-spread, spread + 1, (entries, width))
    index, best = vectorcodes.nearest(x, book)
    distance = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    assert (index == distance.argmin(axis=1)).all() and (best == distance.min(axis=1)).all()


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = sorted((r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[math.floor(4096 * v) for v in r[1]] for r in kept], np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].swapaxes(0, 1).copy()

    def assigned():
        distance = ((x[:, :, None] - books[None]) ** 2).sum(axis=3)
        return distance.argmin(axis=2), distance.min(axis=2).sum(axis=1)

    for _ in range(rounds):
        index, _ = assigned()
        for p in range(parts):
            for e in range(books.shape[1]):
                if (own := x[index[:, p] == e, p]).size:
                    books[p, e] = own.sum(axis=0) // len(own)
    index, error = assigned()
    by_label = defaultdict(int)
    for r, e in zip(kept, error):
        by_label[r[2]] += int(e)
    sha = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{i:02x}" for i in c), int(e), by_label[r[2]], sha) for r, c, e in zip(kept, index, error)), key=repr)


def test_codes_against_a_plain_loop(spark):
    rng = np.random.default_rng(4)
    rows = [(i * 3 % 101, rng.normal(size=16).round(2).tolist(), None if i % 5 == 0 else i % 3) for i in range(101)]
    rows += [(200, None, 1), (201, [None] + [0.5] * 15, 1), (202, [float("nan")] * 16, 1), (203, [float("inf")] + [0.0] * 15, None)]
    rows += [rows[4], rows[4], (None, [0.25] * 16, 2), (-1, [-0.1] * 16, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = plain_codes(rows)
    assert sorted_rows(vectorcodes.code_table(df.repartition(4))) == want
    assert sorted_rows(vectorcodes.code_table(clashing(df))) == want
    few = df.where("vec_id between 3 and 9")
    assert sorted_rows(vectorcodes.code_table(few)) == plain_codes([tuple(r) for r in few.collect()])
    empty = vectorcodes.code_table(df.where("vec_id > 199"))
    assert empty.collect() == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    none = spark.createDataFrame([(1, [], 1), (2, [], 1)], df.schema)
    assert {(r.code, r.error) for r in vectorcodes.code_table(none).collect()} == {("00" * 8, 0)}


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=24).tolist(), 0) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    codes, books = vectorcodes.compress(df)
    for r in vectorcodes.decode(codes, books).collect():
        own = [math.floor(4096 * v) for v in rows[r.vec_id][1]]
        assert sum((a - b) ** 2 for a, b in zip(own, r.decoded)) == r.error
    mixed = spark.createDataFrame([(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)], df.schema)
    with pytest.raises(ValueError, match="one length"):
        vectorcodes.compress(mixed)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\#<>/turn ", max_size=30))
def test_escapes_come_back(text):
    template = chat.Template()
    hidden = template.escape(text)
    assert template.unescape(hidden) == text
    assert not re.match(r"(?:\\\\)*(?:###|</turn>)", hidden)


@pytest.fixture(scope="module")
def turns():
    rows = [(c, t, ("user", "assistant")[t % 2], f"turn {t} of {c} ### {'</turn>' * (t % 3)}") for c in range(40) for t in range(c % 9)]
    rows += [(70, t, ("system", "assistant", "tool: ###", None)[t % 4], f"hot {t}\\") for t in range(700)]
    rows += [(80, 0, "assistant", None), (80, 1, "assistant", ""), (80, None, "user", "first"), (81, 0, "assistant", LONG)]
    rows += [(82, 0, "user", "same"), (82, 0, "user", "same"), (None, 3, "assistant", "no id"), (None, None, None, None)]
    rows += [(83, 0, "assistant", "a\\"), (83, 1, "assistant", "### b"), (83, 2, "Assistant", "not learned")]
    return rows


def plain_chat(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, own in groups.items():
        own.sort()
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        spoken = "".join(f"{r}\n{t}\n" for _, _, r, t in own)
        out.append((conv, len(own), hashlib.sha256(spoken.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_conversations_come_back(spark, turns, tmp_path):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    for name, rows, piece in (("large", df, 1 << 20), ("small", clashing(df).repartition(7), 150)):
        path = f"{tmp_path}/{name}"
        chat.write_conversations(rows, path, RANKS, PATTERN, piece=piece)
        got = chat.read_digests(spark, path, RANKS, PATTERN)
        assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == plain_chat(turns)
        stored = spark.read.parquet(path)
        assert stored.where("size(ids) != size(loss_mask)").count() == 0
        assert stored.where("whole").groupBy("conv_id").count().where("count > 1").count() == 0
        assert stored.where("whole").count() > 5
    assert spark.read.parquet(f"{tmp_path}/small").where("conv_id = 70").count() > 10
    chat.write_conversations(df.limit(0), f"{tmp_path}/none", RANKS, PATTERN)
    assert chat.read_digests(spark, f"{tmp_path}/none", RANKS, PATTERN).collect() == []


def test_rendered_text_and_mask(spark, tmp_path):
    text = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "tool", "x")]
    chat.write_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), str(tmp_path / "c"), RANKS, PATTERN)
    row = spark.read.parquet(str(tmp_path / "c")).first()
    with open(RANKS, "rb") as f:
        form = chat.Formatter(f.read(), PATTERN, chat.Template())
    ids, mask = np.array(row.ids), np.array(row.loss_mask)
    hidden = "\\\\\\### Assistant: \\</turn> ok"
    assert form.render(ids) == f"### User: {hidden}</turn>\n### Assistant: {hidden}</turn>\n### Role tool: x</turn>\n"
    assert form.learned(ids, mask) == [text] and list(form.turns(ids)) == [(r, t) for _, _, r, t in rows]
    assert form.text(ids[mask]) == hidden


def test_digits_cover_the_bits_that_differ():
    assert radix.digits([0b1110, 0b110], 2) == [[(1, 1, 2)], [(0, 1, 2)], [(0, 3, 1)]]
    assert radix.digits([0b1, 0b101], 16) == [[(1, 0, 3), (0, 0, 1)]]
    assert radix.digits([0, 0], 16) == []
