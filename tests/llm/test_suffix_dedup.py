"""Deep-shallow suffix sorting against brute force."""

import hashlib
import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import documents, prose
from truerow.llm import exact_dedup, minmax_dedup
from truerow.llm import suffix_dedup as S
from truerow.llm.common import CLEAN_SHUFFLES, stored


def brute(texts, span=400):
    spans = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        marks = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if spans[t[i : i + span]] > 1:
                marks[i : i + span] = b"\1" * span
        runs = sum(m and (i == 0 or not marks[i - 1]) for i, m in enumerate(marks))
        rest = bytes(b for b, m in zip(t, marks) if not m)
        out.append((len(t), sum(marks), runs, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.fixture(scope="module")
def texts(odd_texts):
    rng = random.Random(8)
    passage, other = prose(rng, 130), prose(rng, 90)
    made = [t for t in odd_texts if t[0] != 10]
    for i in range(30):
        parts = [prose(rng, rng.randrange(20, 90)), rng.choice([passage, passage[7:], other, other[:395], "la " * 200])]
        if i % 3 == 0:
            parts.append(passage[: rng.randrange(300, len(passage))])
        made.append((100 + i, "\n".join([*parts, prose(rng, 30), "é" * (i % 5)])))
    return made


@pytest.mark.parametrize("most_kinds, lengths", [(S.MOST_KINDS, S.Lengths()), (1, S.Lengths()), (S.MOST_KINDS, S.Lengths(240, 120)), (1, S.Lengths(90, 17))])
def test_equals_brute_force(spark, texts, most_kinds, lengths):
    docs = documents(spark, texts).repartition(3)
    got = S.remove_repeats(docs, lengths, most_kinds).collect()
    mine = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)
    want = brute([(t or "").encode() for _, t in texts], lengths.span)
    assert mine == Counter((i, *w) for (i, _), w in zip(texts, want))
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed
        assert 0 <= r.n_bytes - r.n_removed - len(r.text.encode()) <= 8 * max(len(r.spans), 1)


def test_only_repeated_anchors_are_moved(spark, monkeypatch):
    """Anchors that occur once go into no table but the first."""
    rng = random.Random(12)
    passage = prose(rng, 200)
    texts = [(i, prose(rng, 900, 10**9) + (passage if i < 2 else "")) for i in range(20)]
    rows = {}

    def counted(table, name, codec=None):
        found = stored(table, name, codec)
        rows[name] = found.count()
        return found

    monkeypatch.setattr(S, "stored", counted)
    found = S.repeated_places(documents(spark, texts), S.Lengths(240, 120))
    assert 0 < found.count() <= rows["repeated"] < rows["anchors"] / 5


def test_stored_tables_give_their_shuffles_back(spark):
    def shuffles():
        return set(Path(spark.conf.get("spark.local.dir", "/tmp")).glob("blockmgr-*/*/shuffle_*.data"))

    before = shuffles()
    found = stored(spark.range(100_000).selectExpr("id % 999 AS a", "id").repartition(3, "a"), "shuffled")
    deadline = time.time() + 20
    while shuffles() - before and time.time() < deadline:
        time.sleep(0.1)
    assert not shuffles() - before and found.count() == 100_000
    assert spark.conf.get(CLEAN_SHUFFLES, "false") == "false"


def test_columns_of_any_name(spark, texts):
    """Names that the operators use inside come back unchanged."""
    docs = documents(spark, texts)
    names = ("_key", "_ranges", "_packed", "packed", "ranges", "_text_hash", "_kept_id", "c0", "doc", "place")
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}-"), F.col("doc_id").cast("string")))
    for stage in (S.without_repeats, exact_dedup.without_copies, minmax_dedup.without_near_copies):
        got = stage(docs)
        assert got.schema.names == docs.schema.names
        for r in got.where("doc_id IS NOT NULL").collect():
            assert all(r[n] == f"{n}-{r.doc_id}" for n in names) and r.key == "k"


def test_rest_of_documents(spark, texts, no_documents):
    docs = documents(spark, texts)
    got = S.without_repeats(docs)
    assert got.schema.names == docs.schema.names and got.count() == len(texts)
    removed = {(r.doc_id, r.n_bytes): r.n_removed for r in S.remove_repeats(docs).collect()}
    for r in got.where("doc_id >= 100").collect():
        size = len(dict(texts)[r.doc_id].encode())
        assert len(r.text) == r.n_chars
        assert 0 <= size - removed[r.doc_id, size] - len(r.text.encode()) <= 8
    assert S.remove_repeats(no_documents).count() == 0 and S.without_repeats(no_documents).count() == 0


def test_deep_shallow_sort():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (300, 60)).astype(np.uint8)
    rows[:, :50] = rows[rng.integers(0, 6, 300), :50]  # long common prefixes
    rows[200:] = rows[rng.integers(0, 200, 100)]
    group = np.sort(rng.integers(0, 4, 300))
    order, common = S.deep_shallow_sort(group, rows)
    keys = [(group[i], rows[i].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(300))
    for n in range(1, 300):
        a, b = order[n - 1], order[n]
        same = next((k for k in range(60) if rows[a, k] != rows[b, k]), 60)
        assert common[n] == (same if group[a] == group[b] else -1)


def test_blind_trie():
    rng = random.Random(2)
    rows = [rng.getrandbits(40) & rng.getrandbits(40) for _ in range(500)] + [0, 0, (1 << 40) - 1]
    order = S.blind_trie_order(rows, 40)
    assert sorted(order) == list(range(len(rows)))
    assert [rows[i] for i in order] == sorted(rows)


def test_anchors_do_not_depend_on_the_place():
    rng = random.Random(4)
    span = prose(rng, 200).encode()[: 400]
    found = set()
    for left, right in ((b"", b""), (b"x" * 999, b"tail" * 50), (prose(rng, 300).encode(), prose(rng, 300).encode())):
        data = left + span + right
        place, gram = S.anchors(np.frombuffer(data, np.uint8), np.array([len(data)]), S.Lengths())
        hashes = S.gram_hashes(np.frombuffer(span, np.uint8), 200)
        found.add(int(np.argmin(hashes)))
        assert len(left) + int(np.argmin(hashes)) in place
    assert len(found) == 1
    assert len(S.anchors(np.frombuffer(b"a" * 399, np.uint8), np.array([399]), S.Lengths())[0]) == 0


def test_chunks_join(monkeypatch):
    data = np.frombuffer(prose(random.Random(6), 3000).encode(), np.uint8)
    ends = np.array([5000, 5200, len(data)])
    whole = S.anchors(data, ends, S.Lengths())[0]
    monkeypatch.setattr(S, "CHUNK", 1000)
    assert S.anchors(data, ends, S.Lengths())[0].tolist() == whole.tolist()
