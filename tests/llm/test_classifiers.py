"""The two classifiers against plain loops over the same n-grams."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from meterloom.llm import langid, quality
from meterloom.llm.common import held_out, table

SMALL = "/root/testdata/sf0.001"
WORD = (1 << 64) - 1
STEP, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
TEXT = st.text(st.sampled_from("abcÄßİ中 \t\n.,1"), max_size=60)


def rolled(codes):
    code = 0
    for c in codes:
        code = (code * STEP + c) & WORD
    return code


def plain_ngrams(text, shape=langid.Shape()):
    """Buckets of the n-grams of one text."""
    low = [ch.lower() if len(ch.lower()) == 1 else ch for ch in text]
    runs = "".join(ch if ch.isalpha() else " " for ch in low).split()
    chars = " " + "".join(r + " " for r in runs)
    out = Counter()
    for n in range(1, shape.longest + 1):
        for i in range(len(chars) - n + 1):
            gram = chars[i : i + n]
            if gram != " ":
                codes = [0 if ch == " " else ord(ch) for ch in gram]
                out[((rolled(codes) + n) * MIX & WORD) >> (64 - shape.bits)] += 1
    return out


def plain_features(text, plan=quality.Settings()):
    out = Counter()
    shift = 64 - plan.bits
    spaced = "".join(" " if ch in " \t\n\v\f\r" else ch for ch in text)
    hashes = [xxhash.xxh64_intdigest(w, 0) for w in spaced.split(" ") if w]
    for h in hashes:
        out[(h * MIX & WORD) >> shift] += 1
    for a, b in zip(hashes, hashes[1:]):
        pair = 1 if a == b else (a * STEP + b) & WORD
        out[((pair + 2) * MIX & WORD) >> shift] += 1
    for n in range(plan.shortest, plan.longest + 1):
        for i in range(len(text) - n + 1):
            code = rolled(ord(ch) for ch in text[i : i + n])
            out[((code + (n << 32)) * MIX & WORD) >> shift] += 1
    return out


@settings(max_examples=100, deadline=None)
@given(TEXT, st.integers(1, 9))
def test_ngrams_of_whole_texts_and_of_pieces(text, size):
    shape = langid.Shape()
    assert Counter(langid.ngrams([text], shape)[1].tolist()) == plain_ngrams(text)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(langid, "PIECE_CHARS", size)
        pieces = langid.buckets_in_pieces(text, shape)
        assert Counter(x for part in pieces for x in part.tolist()) == plain_ngrams(text)


@settings(max_examples=100, deadline=None)
@given(TEXT, st.integers(1, 9))
def test_features_of_whole_texts_and_of_pieces(text, size):
    plan = quality.Settings()
    assert Counter(quality.features(pa.array([text]), plan)[1].tolist()) == plain_features(text)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "PIECE_CHARS", size)
        pieces = quality.buckets_in_pieces(text, plan)
        assert Counter(x for part in pieces for x in part.tolist()) == plain_features(text)


def test_language_against_plain_bayes(spark):
    docs = table(spark, SMALL, "documents")
    rows = docs.select("doc_id", "text", "lang", held_out(docs["doc_id"]).alias("held_out")).collect()
    counts, n_docs = {}, Counter()
    for r in rows:
        if r.lang is not None and not r.held_out:
            counts.setdefault(r.lang, Counter()).update(plain_ngrams(r.text or ""))
            n_docs[r.lang] += 1
    shape = langid.Shape()
    logs = {
        lang: [math.log((c[b] + shape.added) / (c.total() + shape.added * (1 << shape.bits))) for b in range(1 << shape.bits)]
        for lang, c in counts.items()
    }
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    for r in rows:
        grams = plain_ngrams(r.text or "")
        if not any(map(str.isalpha, r.text or "")):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        sums = {k: math.log(n_docs[k] / n_docs.total()) + sum(n * logs[k][b] for b, n in grams.items()) for k in sorted(logs)}
        best = max(sums, key=sums.get)
        assert got[r.doc_id].lang_pred == best
        assert got[r.doc_id].score == pytest.approx(1 / sum(math.exp(x - sums[best]) for x in sums.values()), abs=1e-3)


def test_long_texts_score_as_in_one_piece(spark, monkeypatch):
    """Scores and models with texts cut into small pieces are those of whole texts."""
    texts = [r.text or "" for r in table(spark, SMALL, "documents").select("text").limit(60).collect()]
    rng = np.random.default_rng(1)
    names = langid.Model(["aa", "bb"], np.log([0.4, 0.6]), rng.normal(0, 1e-3, (2, 1 << 16)).astype(np.float32), langid.Shape())
    plan = quality.Settings()
    model = quality.Model(rng.normal(size=1 << plan.bits).astype(np.float32), 0.1, plan)
    whole = (*langid.score(names, texts), quality.score(model, pa.array(texts)), quality._sparse(pa.array(texts), plan))
    monkeypatch.setattr(langid, "PIECE_CHARS", 50)
    monkeypatch.setattr(quality, "PIECE_CHARS", 50)
    cut = (*langid.score(names, texts), quality.score(model, pa.array(texts)), quality._sparse(pa.array(texts), plan))
    assert whole[0] == cut[0]
    assert cut[1] == pytest.approx(whole[1]) and cut[2] == pytest.approx(whole[2])
    for a, b in zip(whole[3], cut[3]):
        assert all(np.array_equal(x, y) for x, y in zip(a, b))


def test_quality_against_a_plain_loop():
    """Descent in plain loops, and the score as softmax of the mean vector through the layer."""
    plan = quality.Settings(bits=8, dimensions=3, epochs=3)
    texts = ["good plain words here", "spam spam spam", "", "other good prose", "buy buy now", "one"]
    labels = [1, 0, 1, 1, 0, 0]
    parts = quality._sparse(pa.array(texts), plan)
    model = quality.train([(b, s, y) for b, s, y in zip(*parts, labels)], plan)

    rng = np.random.default_rng(plan.seed)
    vectors = rng.uniform(-1 / 3, 1 / 3, (256, 3)).tolist()
    layer, offset, step = [[0.0, 0.0] for _ in range(3)], [0.0, 0.0], 0

    def odds(text):
        grams = plain_features(text, plan)
        mean = [sum(n * vectors[b][d] for b, n in grams.items()) / max(grams.total(), 1) for d in range(3)]
        raised = [math.exp(sum(mean[d] * layer[d][k] for d in range(3)) + offset[k]) for k in (0, 1)]
        return grams, mean, [x / sum(raised) for x in raised]

    for _ in range(plan.epochs):
        for i in rng.permutation(len(texts)):
            rate = plan.rate * (1 - step / (plan.epochs * len(texts)))
            step += 1
            grams, mean, miss = odds(texts[i])
            miss[labels[i]] -= 1
            back = [sum(layer[d][k] * miss[k] for k in (0, 1)) for d in range(3)]
            for k in (0, 1):
                offset[k] -= 0.1 * rate * miss[k]
                for d in range(3):
                    layer[d][k] -= rate * mean[d] * miss[k]
            for b, n in grams.items():
                for d in range(3):
                    vectors[b][d] -= rate * math.sqrt(len(grams)) * n / grams.total() * back[d]
    got = quality.score(model, pa.array([*texts, "words never seen", None]))
    assert got == pytest.approx([odds(x)[2][1] for x in [*texts, "words never seen", ""]], abs=1e-4)
