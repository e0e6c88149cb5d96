"""Operator 12: held-out accuracy, the backoff order, odd texts."""

import zlib

import numpy as np
import pytest

from conftest import documents
from truerow.llm import language_id
from truerow.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language_id.fit(table(spark, SF, "documents"))


def test_held_out_accuracy(spark):
    found = {r.doc_id: r for r in language_id.op12_language_id(spark, SF).collect()}
    truth = table(spark, SF, "documents").select("doc_id", "lang").collect()
    assert len(found) == len(truth)
    for r in truth:
        assert found[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= found[r.doc_id].score <= 1
    judged = [r for r in truth if found[r.doc_id].held_out]
    right = sum(found[r.doc_id].lang_pred == r.lang for r in judged)
    assert len(judged) > 300 and right / len(judged) > 0.99


def test_short_texts(spark, model):
    """Single lines of held-out documents are still told apart."""
    rows = table(spark, SF, "documents").where("lang IS NOT NULL").where(language_id.held_out()).limit(200).collect()
    scorer = language_id.Scorer(model)
    right = [scorer.decide(" ".join(r.text.split()[:8]))[0] == r.lang for r in rows]
    assert np.mean(right) > 0.9


def test_nothing_is_learnt_from_held_out_rows(spark):
    """Changing text and lang of held-out rows changes no prediction of the others."""
    rows = [(i, f"uno dos tres w{i}", "es") if i % 2 else (i, f"one two three v{i}", "en") for i in range(60)]
    held = {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert 5 < len(held) < 50
    frames = [
        spark.createDataFrame([(i, *(change if i in held else (t, l))) for i, t, l in rows], "doc_id long, text string, lang string")
        for change in (("uno", "en"), ("zzz", "xx"))
    ]
    first, second = (language_id.fit(f) for f in frames)
    assert first.words == second.words and first.languages == second.languages == ["en", "es"]
    assert np.array_equal(first.word_scores, second.word_scores)


def test_word_first_then_shorter_ngrams():
    """A known word never looks at n-grams; an unseen one stops at the greatest length that is known."""
    asked = []

    class Watched(dict):
        def __init__(self, length, *args):
            super().__init__(*args)
            self.length = length

        def __contains__(self, gram):
            asked.append(self.length)
            return super().__contains__(gram)

    scores = np.array([[-1.0, -2.0]], np.float32)
    grams = [Watched(n, {"th ": 0} if n == 3 else {}) for n in range(1, language_id.LONGEST + 1)]
    model = language_id.Model(["a", "b"], np.zeros(2), {"known": 0}, grams, scores, [scores * n for n in range(1, 6)])
    scorer = language_id.Scorer(model)
    assert scorer.total("known KNOWN")[1].tolist() == [-2.0, -4.0] and not asked
    assert scorer.total("bath")[1].tolist() == [-3.0, -6.0]
    assert min(asked) == 3 and max(asked) == language_id.LONGEST
    assert scorer.total("qqq 12 _")[0] == 1


def test_odd_texts(spark, odd_texts, odd_documents, no_documents):
    """Nulls, blanks and letterless texts are undecided; any other text gets a learnt language."""
    found = language_id.identify(odd_documents, language_id.fit(odd_documents)).collect()
    assert len(found) == len(odd_texts)
    texts = dict(odd_texts[:-2])
    for r in found:
        text = texts.get(r.doc_id)
        if r.doc_id in texts:
            assert (r.lang_pred == "und") == (not any(map(str.isalpha, text or "")))
        assert r.lang_pred in ("und", "en") and 0 <= r.score <= 1
    more = spark.createDataFrame([(1, "12 34 ² _ ٣"), (2, "漢字"), (3, "́")], "doc_id long, text string")
    by_id = {r.doc_id: r.lang_pred for r in language_id.identify(more, language_id.fit(odd_documents)).collect()}
    assert by_id == {1: "und", 2: "en", 3: "und"}
    nothing = language_id.fit(no_documents)
    assert {r.lang_pred for r in language_id.identify(odd_documents, nothing).collect()} == {"und"}
    assert language_id.identify(no_documents, nothing).count() == 0


@pytest.mark.parametrize("part", [1, 5, 50])
def test_parts_do_not_matter(part, model, monkeypatch):
    text = "Und die Kinder spielen. The and of\tthere l'été " * 5
    whole = language_id.Scorer(model).total(text)
    monkeypatch.setattr(language_id, "PART", part)
    n, total = language_id.Scorer(model).total(text)
    assert n == whole[0] and np.allclose(total, whole[1])
