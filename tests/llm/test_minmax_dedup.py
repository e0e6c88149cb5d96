"""Min-max hashing groups against all pairs."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import documents, prose
from truerow.llm import minmax_dedup as M
from truerow.llm.exact_dedup import without_copies
from truerow.llm.components import components


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(rows):
    """Rows without doc_id take no part."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if None not in (rows[i][0], rows[j][0]) and both and 100 * both >= 75 * (len(x) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        own = min((rows[j][0] for j in range(len(rows)) if root(j) == root(i)), default=None) if doc is not None else None
        own = doc if not sets[i] else own
        out.append((doc, len(sets[i]), own, doc is None or own == doc))
    return Counter(out)


@pytest.fixture(scope="module")
def near_texts(odd_texts):
    rng = random.Random(11)
    texts = [t for t in odd_texts if t[0] != 10]
    for g in range(6):
        base = prose(rng, 150, 5000).split()
        for c in range(14):
            own = list(base)
            for _ in range(rng.randrange(0, 9)):
                own[rng.randrange(len(own))] = f"new{rng.random()}"
            texts.append((1000 - 20 * g - c, " ".join(own)))
    return texts


@pytest.mark.parametrize("block", [M.BLOCK, 3])
def test_groups(spark, near_texts, monkeypatch, block):
    """With blocks of three, the buckets are compared block by block."""
    monkeypatch.setattr(M, "BLOCK", block)
    got = M.near_groups(documents(spark, near_texts).repartition(3))
    assert Counter(tuple(r) for r in got.collect()) == brute(near_texts)


def test_one_document_of_each_group_stays(spark, near_texts, no_documents):
    docs = documents(spark, near_texts)
    kept = M.without_near_copies(docs)
    assert kept.schema.names == docs.schema.names
    want = {(d, k) for d, _, _, k in brute(near_texts) if k}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in want)
    assert M.near_groups(no_documents).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    x, y = np.sort(pool[:3500]), np.sort(pool[500:])
    s = M.signatures(np.concatenate([x, y]), np.array([len(x), 0, len(y)]), M.FINE)
    assert s.shape == (2, 2 * M.FINE) and abs((s[0] == s[1]).mean() - 0.75) < 0.08


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_short_sets_are_found_exactly(spark):
    """Every pair of short texts at exactly 0.75 or more is linked, whatever the permutations."""
    rng = random.Random(12)
    texts = []
    for i in range(150):
        words = [f"s{i}w{j}" for j in range(rng.randrange(7, 30))]
        other = [*words, "more"] if i % 2 else [*words[:-1], "x"]
        texts += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(other)), (3 * i + 2, " ".join(words[::-1]))]
    got = M.near_groups(documents(spark, texts))
    want = brute(texts)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert sum(n for (_, _, _, kept), n in want.items() if not kept) > 40


def test_rows_decide_not_their_doc_ids(spark):
    """A copy goes even if its doc_id belongs to another text that stays."""
    a, b = ("".join(f"{c}{i} " for i in range(40)) for c in "ab")
    rows = [(0, b), (1, a), (1, b), (1, a), (2, b + "end"), (3, None), (3, None), (3, ""), (None, "z")]
    docs = documents(spark, rows)
    exact = Counter((r.doc_id, r.text) for r in without_copies(docs).collect())
    assert exact - Counter([(None, "z")]) == Counter([(0, b), (1, a), (2, b + "end"), (3, None)]) or exact[(3, "")] == 1
    assert exact[(1, b)] == 0 and exact[(1, a)] == 1 and sum(exact.values()) == 5
    near = Counter((r.doc_id, r.text) for r in M.without_near_copies(docs).collect())
    assert near == Counter([(0, b), (1, a), (3, None), (3, ""), (None, "z")])


def test_texts_that_share_a_doc_id_are_sets_of_their_own(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(5, a), (5, b), (6, a + " x"), (7, b + " y"), (8, a)]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in M.near_groups(documents(spark, rows)).collect()}
    assert got == {(5, 36, 5), (6, 37, 5), (7, 37, 5), (8, 36, 5)}
    kept = Counter((r.doc_id, r.text) for r in M.without_near_copies(documents(spark, rows)).collect())
    assert sum(kept.values()) == 2 or kept == Counter([(5, a)]) or kept == Counter([(5, b)])


def test_signatures_need_little_memory():
    """A batch of 6 MB is worked on in parts: whole, its words and hashes took 87 MB."""
    rng = random.Random(8)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(500)) for _ in range(1800)]
    columns = [pa.array(range(1800), pa.int64()), pa.array(texts), pa.array([b"k"] * 1800)]
    batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "key"])
    tracemalloc.start()
    rows = sum(found.num_rows for found in M._describe(iter([batch])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows == 1800 and peak < 80 << 20
