"""The operators against plain versions of what they compute."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from meterloom.llm import bpe, decontaminate, idstore, licenses, rules, simhash
from meterloom.llm.components import connected_components
from oracle_compare import connect, difference

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
WORDS = "red blue green stone river cloud seven owls watch quiet north wind over amber fields at dusk".split()


@pytest.mark.parametrize("name", sorted(n for n in SQL if re.match(r"op\d", n)))
def test_matches_sql(spark, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert difference(got, connect(SMALL).sql(SQL[name]).df()) == ""


def documents(sf_dir):
    return connect(sf_dir).sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


# Edit matching


def fewest_edits(pattern, text):
    """Sellers' table: fewest edits between the pattern and any part of the text, and the first end of one."""
    row = np.arange(len(pattern) + 1)
    best, at = row[-1], 0
    for i, ch in enumerate(text, 1):
        new = np.minimum(row[:-1] + (np.array(list(pattern)) != ch), row[1:] + 1)
        new = np.concatenate([[0], new])
        # An insertion chain costs one for each step.
        steps = np.arange(len(new))
        row = np.minimum.accumulate(new - steps) + steps
        if row[-1] < best:
            best, at = row[-1], i
    return int(best), at


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", min_size=1, max_size=80), st.text("abc ", max_size=120))
def test_myers(pattern, text):
    assert decontaminate.myers(decontaminate.bit_masks(pattern), len(pattern), text) == fewest_edits(pattern, text)


@settings(max_examples=60, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(0, 30))
def test_edited_copies_are_found(rng, edits):
    """Whatever the edits, the scan finds what the table of all alignments finds."""
    item = " ".join(rng.choice(WORDS) for _ in range(40))
    copy = list(item)
    for _ in range(edits):
        at = rng.randrange(len(copy))
        copy[at : at + rng.choice((0, 1, 1))] = rng.choice(("", "x", "q"))
    text = " ".join(rng.choice(WORDS) for _ in range(30)) + " " + "".join(copy) + " " + " ".join(rng.choice(WORDS) for _ in range(30))
    scanner = decontaminate.Scanner([(1, item)], decontaminate.Budget())
    best, end = fewest_edits(item, decontaminate.normal(text))
    want = {0: (best, end)} if best <= scanner.items[0].budget else {}
    assert scanner.scan(text) == want


def test_leaks_against_all_alignments(spark):
    items = connect(SMALL).sql("SELECT item_id, text FROM benchmark").fetchall()
    docs = [(i, t) for i, t in documents(SMALL) if t][:40]
    leaky = {r.doc_id for r in QUERIES["op1_decontaminate"](spark, SMALL).collect()}
    plain = set()
    for i, t in docs:
        text = decontaminate.normal(t)
        for _, item in items[:12]:
            item = decontaminate.normal(item)
            if fewest_edits(item, text)[0] <= int(len(item) * 0.08) | 1:
                plain.add(i)
    assert plain <= leaky
    exact = {i for i, t in docs for _, item in items if decontaminate.normal(item) in decontaminate.normal(t)}
    assert exact <= leaky and leaky


def test_benchmark_in_blocks(spark):
    """A small block size means many scans and the same pairs."""
    from meterloom.llm.common import table

    docs, bench = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    one = decontaminate.leaks(docs, bench).toPandas()
    many = decontaminate.leaks(docs, bench, decontaminate.Budget(block_chars=2000)).toPandas()
    assert difference(one, many) == ""
    kept = decontaminate.without_leaks(docs, bench, decontaminate.Budget(block_chars=2000))
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in documents(SMALL)} - set(one.doc_id)


def test_short_items_count_only_as_whole_words(spark):
    bench = spark.createDataFrame(
        [(1, "Blue  moon"), (2, "42"), (3, " "), (4, None), (5, "?!"), (6, "c++")], "item_id long, text string"
    )
    texts = ["A BLUE\nMOON rose", "bluemoon", "blue moons", "blue moon", None, "", "a42 or 421", "is 42.", "42", "why?!", "c++ and c", "c+"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits, r.budget, r.end_char) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {(0, 1, 0, 0, 11), (3, 1, 0, 0, 9), (7, 2, 0, 0, 5), (8, 2, 0, 0, 2), (10, 6, 0, 0, 3)}
    kept = {r.doc_id for r in decontaminate.without_leaks(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {0, 3, 7, 8, 10}


# SimHash


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)][: len(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    texts = [t for _, t in documents(SMALL)[:60]] + [None, "", "One", "one two", "É ONE two\x0bthree\xa0four five"]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_fingerprint_of_a_long_text_is_cut_at_words(monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 1000)
    text = "\n ".join(f"w{i % 811}" for i in range(3000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def plain_components(marks):
    """Smallest mark reachable over links of three bits or less."""
    parent = list(range(len(marks)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(marks)):
        for j in range(i):
            if bin(marks[i] ^ marks[j]).count("1") <= 3 and find(i) != find(j):
                parent[find(i)] = find(j)
    groups = {}
    for i, m in enumerate(marks):
        groups.setdefault(find(i), []).append(m)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("hot", [simhash.HOT, 3, 0])
def test_links_join_what_all_pairs_join(spark, monkeypatch, hot):
    """Clusters, chains, and pairs at distances 1 to 5 in every split of the halves, with some halves hot, or all."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = np.random.default_rng(3)
    marks = set()
    for _ in range(60):
        base = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        marks.add(base)
        for d in range(1, 6):
            for low in range(d + 1):
                bits = [*rng.choice(32, low, replace=False), *(32 + rng.choice(32, d - low, replace=False))]
                marks.add(base ^ sum(1 << int(b) for b in bits))
    marks = sorted(marks)
    df = spark.createDataFrame([(int(np.uint64(m).view(np.int64)),) for m in marks], "fp long")
    found = simhash.links(df)
    assert found.where("bit_count(a ^ b) > 3").count() == 0
    roots = {r.node: r.root for r in connected_components(found).collect()}
    groups = {}
    for m in marks:
        signed = int(np.uint64(m).view(np.int64))
        groups.setdefault(roots.get(signed, signed), []).append(m)
    assert {frozenset(g) for g in groups.values()} == plain_components(marks)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(7, 7), (None, 8), (3, 900), (900, 4), (4, 901)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 540)} | {3: 3, 900: 3, 4: 3, 901: 3}
    assert got == want


def test_simhash_query(spark):
    docs = documents(SMALL)
    marks = [plain_fingerprint(t) for _, t in docs]
    want = {}
    for group in plain_components(sorted(set(marks))):
        ids = [i for (i, _), m in zip(docs, marks) if m in group]
        want |= dict.fromkeys(ids, min(ids))
    got = QUERIES["op4_simhash"](spark, SMALL).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{m:016x}" for (i, _), m in zip(docs, marks)}


# Rules, licenses, BPE, id store, classifiers


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=40).map(" ".join), max_size=4))
def test_repeated_words(texts):
    def plain(text):
        words, seen = text.split(), {}
        for i in range(len(words) - 7):
            seen.setdefault(tuple(words[i : i + 8]), []).append(i)
        return len({j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)})

    assert rules.repeated_words(pa.array(texts, pa.string())).tolist() == [plain(t) for t in texts]


def test_license_spans_survive_edits(spark):
    notice = licenses.NOTICES[9][1]
    changed = notice.replace("free of charge", "wholly free of charge").replace("obtaining", "getting")
    rows = [
        (1, f"Intro words. {notice} and more"),
        (2, f"Intro. {changed}, tail"),
        (3, "permission to person any obtaining a copy"),
        (4, "The MIT-License; see mit  license, General Public License and general public licenses"),
        (4, "The MIT-License; see mit  license, General Public License and general public licenses"),
    ]
    got = sorted(map(tuple, licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert [r[6] for r in got] == ["mit", "mit", "", "gpl,mit", "gpl,mit"]
    assert got[0][7] == 1.0 and 0.75 <= got[1][7] < 1.0
    assert got[3][1:6] == (13, 3, 1, 6, "gpl,mit") and got[3] == got[4]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "bc ", "  ", "\n", "'s", " 12", " ", "é", "🦉", "...", "\t"]), max_size=60).map("".join))
def test_cut_texts_have_the_same_ids(text):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        coder = test_cut_texts_have_the_same_ids.__dict__.setdefault("coder", bpe.encoding(f.read(), public_tokenizers.PATTERN))
    assert "".join(bpe.pieces(text, 5)) == text
    assert [i for p in bpe.pieces(text, 5) for i in coder.encode_ordinary(p)] == coder.encode_ordinary(text)


def test_bpe_query(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        coder = bpe.encoding(f.read(), public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in QUERIES["op10_bpe"](spark, SMALL).collect()}
    for i, text in documents(SMALL):
        ids = coder.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=200), st.sampled_from(["byte", "bit"]))
def test_planes_round_trip(ids, planes):
    payload, sizes = idstore.pack(np.array(ids, np.uint32), idstore.Layout(planes=planes))
    assert idstore.unpack(payload, sizes, len(ids), planes).tolist() == ids


def test_word_coder_is_the_tokenizer():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        coder = idstore.WordCoder(f.read())
    texts = [t for _, t in documents(SMALL)] + [None, "", " a b c\x1cd \x01 e\x01f ", "ΟΔΟΣ Ǆ é ́x <|endoftext|>"]
    ids, counts = coder.encode(pa.array(texts, pa.string()))
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_held_out_language(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op2_language"](spark, sf_dir).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_quality(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = QUERIES["op9_quality"](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert good and bad
    pairs = np.subtract.outer(good, bad)
    assert (pairs > 0).mean() + (pairs == 0).mean() / 2 > 0.95
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_held_out_rows_teach_nothing(spark):
    """Changing labels and languages of held-out documents changes no prediction."""
    from pyspark.sql import functions as F

    from meterloom.llm import langid, quality
    from meterloom.llm.common import held_out, table

    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    other = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert difference(langid.identify(docs).toPandas(), langid.identify(other).toPandas()) == ""
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert difference(quality.classify(docs, labels).toPandas(), quality.classify(docs, turned).toPandas()) == ""
