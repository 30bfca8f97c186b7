"""The pipeline against a plain version of each stage, fed with the same input."""

import re

import public_tokenizers
import pytest

import corpus_pipeline
from meterloom.llm import bpe, decontaminate, rules, simhash
from meterloom.session import stage
from oracle_compare import connect

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before the first and after every stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SMALL), name)
        out.append(docs)
    return out


def by_id(df):
    rows = {r.doc_id: r for r in df.collect()}
    assert len(rows) == df.count()
    return rows


def test_columns(steps):
    assert all(step.dtypes == steps[0].dtypes for step in steps[1:-1])


def test_quality_stage(steps):
    before, after = by_id(steps[0]), by_id(steps[1])
    limits = rules.Limits()
    for i, r in before.items():
        total, _, lost, good = rules.judge_lines(r.text or "", limits)
        words = (r.text or "").split()
        seen = {}
        for k in range(len(words) - 7):
            seen.setdefault(tuple(words[k : k + 8]), []).append(k)
        repeated = len({j for at in seen.values() if len(at) > 1 for k in at for j in range(k, k + 8)})
        keeps = total >= 20 and 100 * repeated <= 30 * total and 2 * lost <= total
        assert (i in after) == keeps
        if keeps:
            assert after[i].text == b"\n".join(good).decode() and after[i].n_chars == len(after[i].text)
            assert (after[i].lang, after[i].source) == (r.lang, r.source)


def test_near_duplicate_stage(steps):
    before, after = by_id(steps[1]), by_id(steps[2])
    marks = {i: simhash.fingerprint(r.text) for i, r in before.items()}
    parent = {i: i for i in marks}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in marks:
        for b in marks:
            if a < b and bin(marks[a] ^ marks[b]).count("1") <= 3 and find(a) != find(b):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    assert set(after) == {find(i) for i in marks}
    assert all(after[i] == before[i] for i in after)
    assert len(after) < len(before)


def test_decontamination_stage(steps):
    before, after = by_id(steps[2]), by_id(steps[3])
    items = [decontaminate.normal(t) for (t,) in connect(SMALL).sql("SELECT text FROM benchmark").fetchall()]
    exact = {i for i, r in before.items() if any(x in decontaminate.normal(r.text) for x in items)}
    assert exact and not exact & set(after)
    five = lambda t: {tuple(w[k : k + 5]) for w in [t.split()] for k in range(len(w) - 4)}
    shared = set().union(*map(five, items))
    clean = {i for i, r in before.items() if not five(decontaminate.normal(r.text)) & shared}
    assert clean <= set(after)
    assert all(after[i] == before[i] for i in after)


def test_secret_stage(steps):
    before, after = by_id(steps[3]), by_id(steps[4])
    assert set(before) == set(after)
    secret = re.compile(r"[0-9a-f]{24,}|AKIA[A-Z0-9]{16,}|(?i:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{6,}")
    hit = {i for i, r in before.items() if secret.search(r.text)}
    for i, r in after.items():
        assert not secret.search(r.text.replace("[secret]", ""))
        assert r.n_chars == len(r.text)
        if i not in hit:
            assert r.text == before[i].text or "[secret]" in r.text
    assert hit


def test_token_stage(steps):
    before, after = by_id(steps[4]), by_id(steps[5])
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        coder = bpe.encoding(f.read(), public_tokenizers.PATTERN)
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.exact and r.ids == coder.encode_ordinary(before[i].text) and r.n_tokens == len(r.ids)


def test_run(spark, steps):
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == {r.doc_id: r.ids for r in steps[-1].collect()}
