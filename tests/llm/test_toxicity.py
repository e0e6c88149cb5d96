"""Toxic segments: the scan against all segments, the model on held-out rows."""

import random

import numpy as np
import pytest

from conftest import documents
from truerow.llm import toxicity as T
from truerow.llm.common import table

SF = "/root/testdata/sf0.1"


def all_maximal(scores):
    """By definition: recursively the best segment, then those left and right of it."""
    if not len(scores) or max(scores) <= 0:
        return []
    sums = np.concatenate([[0], np.cumsum(scores)])
    best = max((round(sums[j] - sums[i], 9), -(j - i), -i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))
    i, j = -best[2], best[3]
    right = [(a + j, b + j, s) for a, b, s in all_maximal(scores[j:])]
    return all_maximal(scores[:i]) + [(i, j, best[0])] + right


def test_maximal_segments():
    rng = random.Random(9)
    for _ in range(200):
        scores = np.array([rng.choice([0.35, 0.77, 2.13]) if rng.random() < 0.3 else -T.DRIFT for _ in range(25)])
        scores += np.array([rng.random() * 1e-3 if s > 0 else 0 for s in scores])
        at = np.flatnonzero(scores > 0)
        got = [(a, b, round(s, 6)) for a, b, s in T.maximal_segments(at, scores[at])]
        assert got == [(a, b, round(s, 6)) for a, b, s in all_maximal(scores)]


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = T.judge(docs, labels)
    assert rows.count() == docs.count()
    found = rows.join(labels, "doc_id").where("held_out").select("predicted", "toxic", "score").collect()
    hits = sum(r.predicted == r.toxic == 1 for r in found)
    assert hits >= 0.85 * sum(r.toxic for r in found) and hits >= 0.85 * sum(r.predicted for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)


def test_score_reads_text_only(spark, odd_documents, no_documents):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = T.fit(docs, labels)
    rows = {(r.doc_id, r.n_tokens): r for r in T.score_documents(odd_documents, model).collect()}
    assert rows[1, 0].score == rows[2, 0].score == rows[3, 0].score < 0.3
    insults = [(1, "some plain words here " * 30), (2, "and you stupid idiot are a pathetic worthless moron " * 2)]
    made = {r.doc_id: r for r in T.score_documents(documents(spark, insults), model).collect()}
    assert made[1].score < 0.3 <= made[2].score and made[2].segments and not made[1].segments
    kept = T.clean_documents(documents(spark, insults), model).collect()
    assert [r.doc_id for r in kept] == [1]
    assert T.score_documents(no_documents, model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, None, None)], [(5, 1, 0), (6, 0, 0), (5, 1, 0), (None, 1, 1)]])
def test_without_labels_of_both_kinds(spark, odd_documents, labels):
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = T.judge(odd_documents, frame).collect()
    assert len(rows) == odd_documents.count() and not any(r.predicted for r in rows)
