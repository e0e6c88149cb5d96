"""Packing and SentencePiece sampling: exact round trips and brute force."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import documents
from truerow.llm import packing, segmentations as G, tokenizing
from truerow.llm.tokenizing import vocabulary_path

# -- packing -------------------------------------------------------------------------------------


def encoded(texts):
    path = vocabulary_path(packing.VOCABULARY)
    encoder = Tokenizer.from_file(path)
    return [np.array(encoder.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for t in texts]


def test_ids_equal_the_tokenizers(odd_texts, monkeypatch):
    monkeypatch.setattr(tokenizing, "MOST_REMEMBERED", 5)  # the memory is emptied again and again
    extra = ["Don't stop...  now.,", "a.b,c. 'S", "É. é, x.. ..y", "(a.)", "<|startoftext|>Ab.", "tail. "]
    texts = [t or "" for i, t in odd_texts if i != 10] + extra
    known = tokenizing.ChunkIds(vocabulary_path(packing.VOCABULARY))
    for part in (texts, texts[:1], extra, []):
        ids, sizes = known.ids_of([t.encode() for t in part], 2)
        want = encoded(part)
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w.tolist()]


def test_packing(spark, odd_documents, odd_texts, no_documents):
    rows = packing.pack(odd_documents.repartition(3), vocabulary_path(packing.VOCABULARY), length=512).collect()
    wanted = Counter((i, len(w)) for (i, _), w in zip(odd_texts, encoded(t for _, t in odd_texts)))
    ids = {(i, len(w)): w for (i, _), w in zip(odd_texts, encoded(t for _, t in odd_texts))}
    parts = {}
    for r in rows:
        own = ids[r.doc_id, r.doc_tokens]
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        parts.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
    for key, pieces in parts.items():
        assert sum(n for _, n in pieces) == key[1] * wanted[key]
        assert set(itertools.chain(*(range(s, s + n) for s, n in pieces))) == set(range(key[1]))
    assert set(parts) == set(wanted)
    at = sorted((r.sequence_id * 512 + r.offset, r.length) for r in rows)
    assert [a for a, _ in at] == [0, *np.cumsum([n for _, n in at])[:-1].tolist()]
    assert all(r.offset + r.length <= 512 for r in rows)
    assert packing.pack(no_documents, vocabulary_path(packing.VOCABULARY)).count() == 0


@pytest.mark.parametrize("few,bits", [(2, 3), (3, 2), (3, 3)])
def test_hilbert_curve_visits_neighbours(few, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=few)))
    keys = packing.hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# -- segmentations -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return G.Vocabulary(vocabulary_path(G.VOCABULARY))


def all_segmentations(vocabulary, text):
    """(ids, weight) of every way to spell a text whose characters all have pieces."""
    table = {vocabulary.text[i].decode("utf-8", "ignore").replace(" ", "▁"): i for i in np.flatnonzero(np.isfinite(vocabulary.weight))}
    spelt = "▁" + text.replace(" ", "▁")

    def ways(rest):
        if not rest:
            return [((), 0.0)]
        out = []
        for n in range(1, len(rest) + 1):
            if rest[:n] in table:
                i = table[rest[:n]]
                out += [((i, *ids), vocabulary.weight[i] + w) for ids, w in ways(rest[n:])]
        return out

    found = ways(spelt)
    total = np.logaddexp.reduce([w for _, w in found])
    return {ids: w - total for ids, w in found}


def test_samples_follow_the_lattice(vocabulary):
    """Probabilities are exact, samples are distinct, and both come out as often as they should:
    the first by its probability, the second by that among the rest."""
    text = "the cat"
    exact = all_segmentations(vocabulary, text)
    n = 6000
    keys = G.mixed(np.arange(n, dtype=np.uint64))
    rows = G.sample(vocabulary, [text] * n, keys, 3)
    first, second = Counter(), Counter()
    for own in rows:
        ids = [tuple(s["ids"].tolist()) for s in own]
        assert len(set(ids)) == 3
        assert [s["perturbed"] for s in own] == sorted((s["perturbed"] for s in own), reverse=True)
        for i, s in zip(ids, own):
            assert s["log_prob"] == pytest.approx(exact[i], abs=1e-4)
        first[ids[0]] += 1
        second[ids[1]] += 1
    p = {i: math.exp(w) for i, w in exact.items()}
    for i, w in p.items():
        assert abs(first[i] / n - w) < 5 * math.sqrt(w * (1 - w) / n) + 2e-3
        after = sum(q * w / (1 - q) for j, q in p.items() if j != i)
        assert abs(second[i] / n - after) < 5 * math.sqrt(after / n) + 2e-3


def test_inclusion_scores_are_unbiased(vocabulary):
    """Sum of f / inclusion over the samples estimates the sum of f * p over all segmentations."""
    text = "then on"
    exact = all_segmentations(vocabulary, text)
    want = sum(math.exp(w) * len(i) for i, w in exact.items())
    rows = G.sample(vocabulary, [text] * 4000, G.mixed(np.arange(4000, dtype=np.uint64) + np.uint64(77)), 2)
    got = np.mean([sum(math.exp(s["log_prob"] - s["log_inclusion"]) * len(s["ids"]) for s in own) for own in rows])
    assert got == pytest.approx(want, rel=0.05)


def test_round_trip(spark, vocabulary, odd_documents, odd_texts, no_documents):
    path = vocabulary_path(G.VOCABULARY)
    rows = G.encode(odd_documents, path, 3, keep_ids=True)
    found = rows.collect()
    assert all(r.round_trip for r in found)
    ranks = Counter((r.doc_id, r.rank) for r in found)
    assert ranks[1, 1] == 1 and ranks[2, 1] == 1 and ranks[1, 2] == 0  # null and empty: one way
    assert ranks[5, 1] == ranks[5, 3] == 2 and ranks[10, 3] == 1  # a repeated row, a very long text
    texts = dict((i, t) for i, t in odd_texts)
    for r in G.decode(rows.select("doc_id", "ids"), path).collect():
        assert r.text == (texts[r.doc_id] or "")
    again = {(r.doc_id, r.rank): r.ids_crc32 for r in G.encode(odd_documents.repartition(2), path, 3).collect()}
    assert again == {(r.doc_id, r.rank): r.ids_crc32 for r in found}
    assert G.encode(no_documents, path).count() == 0


def test_few_segmentations(vocabulary):
    rows = G.sample(vocabulary, ["", "\n", "a"], G.mixed(np.arange(3, dtype=np.uint64)), 5)
    assert [len(r) for r in rows] == [1, len(all_segmentations(vocabulary, "")), len(all_segmentations(vocabulary, "a"))]
    assert all(r["log_inclusion"] == 0 for r in rows[2])
