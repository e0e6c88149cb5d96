"""Class language model: base score by brute force, probabilities that sum to one, held-out gain."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import documents
from truerow.llm import class_lm as L


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x20\\x09-\\x0D]+", low) + [None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.fixture(scope="module")
def two_languages(odd_texts):
    """Sentences of either of two vocabularies: classes should tell them apart."""
    rng = random.Random(5)
    made = []
    for i in range(300):
        own = "ab"[i % 2]
        made.append((100 + i, " ".join(f"{own}{int(rng.paretovariate(0.7)) % 300}" for _ in range(80))))
    return odd_texts + made


@pytest.mark.parametrize("core,head", [(L.CORE, L.HEAD), (40, 90)])
def test_scores(spark, two_languages, monkeypatch, core, head):
    """With a small core and head most words take the way of the join."""
    monkeypatch.setattr(L, "CORE", core)
    monkeypatch.setattr(L, "HEAD", head)
    rows = L.train_and_score(documents(spark, two_languages).repartition(3)).collect()
    counts, total = Counter(), 0
    for i, t in two_languages:
        if not held(i):
            counts.update(words_of(t))
            total += len(words_of(t))
    log_all = math.log10(total + len(counts) + 1)
    want = Counter()
    for i, t in two_languages:
        own = words_of(t)
        base = sum(math.log10(counts[w] + 1) - log_all for w in own)
        want[i, held(i), len(own), sum(counts[w] > 0 for w in own), total, round(base, 5)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == want
    apart = [r for r in rows if r.held_out and (r.doc_id or 0) >= 100]
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart) + 0.1 * sum(r.n_tokens for r in apart)


def test_head_and_join_agree(spark, two_languages, monkeypatch):
    """The same model, scored with a full and with a small head."""
    monkeypatch.setattr(L, "CORE", 40)
    model = L.fit(documents(spark, two_languages))
    docs = documents(spark, two_languages)
    full = {(r.doc_id, r.n_tokens): r.score for r in L.score_documents(docs, model).collect()}
    model.head, model.head_n, model.head_class = model.head[:50], model.head_n[:50], model.head_class[:50]
    for r in L.score_documents(docs, model).collect():
        assert r.score == pytest.approx(full[r.doc_id, r.n_tokens], rel=1e-9)


def test_probabilities_sum_to_one(spark, two_languages, monkeypatch):
    monkeypatch.setattr(L, "CORE", 40)
    m = L.fit(documents(spark, two_languages))
    words = m.words.toPandas()
    n, c = words.n.to_numpy(), words["class"].to_numpy()
    assert n.sum() == m.tokens and len(words) == m.distinct
    per_class = m.transition * (L.MIX / (m.class_n + m.class_once))
    unigram = (1 - L.MIX) / (m.tokens + m.distinct + 1)
    for h in range(2 * L.CLASSES + 1):
        known = (per_class[h, c] * n + unigram * (n + 1)).sum()
        assert known + m.unknown()[h] * m.class_once.sum() == pytest.approx(1, abs=1e-9)


def test_exchange_finds_classes():
    """Words of two kinds that only follow each other's kind end in different classes."""
    rng = np.random.default_rng(0)
    kind = np.arange(60) % 2
    classes = rng.integers(0, 2, 60)
    follow = rng.poisson(20, (60, 60)) * (kind[:, None] != kind[None, :])
    for _ in range(10):
        onehot = np.eye(L.CLASSES + 1)[classes]
        wanted = L.exchange(np.stack([follow.T @ onehot, follow @ onehot]).astype(int), classes)
        turn = rng.random(60) < 0.5
        classes = np.where(turn, wanted, classes)
    assert len(set(zip(kind, classes))) == len(set(classes))


def test_histories():
    codes = np.array([0, 9, 1, 9, 9, 0, 1])
    got = L.histories(codes, np.array([5, 2]), np.array([3, 4]))
    none = 2 * L.CLASSES
    assert got.tolist() == [none, 6, 7, 8, 9, none, 6]


def test_nothing_to_learn_from(spark, no_documents):
    assert L.train_and_score(no_documents).count() == 0
    ids = [i for i in range(50) if held(i)]
    rows = L.train_and_score(documents(spark, [(i, "a b") for i in ids])).collect()
    assert len(rows) == len(ids) and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)


def test_words_outside_the_core_are_histories(spark, monkeypatch):
    """Three of four words are not core; each tells which words may follow it directly."""
    monkeypatch.setattr(L, "CORE", 40)
    monkeypatch.setattr(L, "HEAD", 60)
    rng = random.Random(9)
    made = []
    for i in range(300):
        pairs = ((f"{k}left{rng.randrange(40)}", f"{k}right{rng.randrange(40)}") for k in rng.choices("ab", k=40))
        made.append((i, " ".join(w for pair in pairs for w in pair)))
    rows = L.train_and_score(documents(spark, made)).where("held_out").collect()
    gain = sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)
    assert gain > 0.35  # all that can be known is 0.45
