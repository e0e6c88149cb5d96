"""Operator 13 against plain Python over all rows."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import documents
from truerow.llm import resampling
from truerow.llm.common import table
from truerow.llm.ranking import numbered_along

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(UPPER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])], len(words)


def plain(docs, target, buckets=10_000, least=20, percent=25):
    own = [(doc_id, *features(text)) for doc_id, text in docs]
    source = Counter(crc32(f.encode()) % buckets for _, found, _ in own for f in found)
    wanted = Counter(crc32(f.encode()) % buckets for text in target for f in features(text)[0])
    s_all, t_all = sum(source.values()), sum(wanted.values())
    rows = []
    for doc_id, found, n_words in own:
        total = 0
        for f in found:
            b = crc32(f.encode()) % buckets
            total += math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))))
        weight = total // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, n_words))
    able = sorted(
        (r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[4])
    )
    drawn = Counter()
    ranks = []
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        drawn[r] += 1
        ranks.append((*r[:4], rank))
    for r in rows:
        if drawn[r]:
            drawn[r] -= 1
        else:
            ranks.append((*r[:4], None))
    return Counter(ranks)


def got(frame):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect())


def test_whole_table(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert got(resampling.op13_target_resampling(spark, SF)) == plain(docs, target)


def test_odd_rows(spark, odd_documents, odd_texts, no_documents, monkeypatch):
    """Nulls, empty and long texts (in small parts), ties, repeated rows, clashing columns, empty tables."""
    rows = odd_texts + [(5, odd_texts[4][1])] * 30
    frame = documents(spark, rows)
    target = documents(spark, [(1, "w1 w2 w3 漢字"), (2, None)])
    assert got(resampling.resample(frame, target)) == plain(rows, ["w1 w2 w3 漢字", None])
    assert got(resampling.resample(frame, no_documents)) == plain(rows, [])
    assert resampling.resample(no_documents, target).count() == 0
    everything = resampling.Draw(percent=100, least_words=0)
    assert got(resampling.resample(frame, target, everything)) == plain(rows, ["w1 w2 w3 漢字"], percent=100, least=0)


@pytest.mark.parametrize("part", [1, 7, 64])
def test_parts_do_not_matter(part, monkeypatch):
    text = ("Ab c1 été-x  " * 40).encode()
    whole = Counter(h for _, found in resampling.feature_hashes(text) for h in found.tolist())
    monkeypatch.setattr(resampling, "PART", part)
    assert Counter(h for _, found in resampling.feature_hashes(text) for h in found.tolist()) == whole
    assert whole == Counter(crc32(f.encode()) for f in features(text.decode())[0])


@pytest.mark.parametrize("accuracy", [1, 3, 50, 10_000])
def test_cutoff_whatever_the_sketch(spark, accuracy):
    """A poor sketch only widens the bracket; the k-th row is found all the same."""
    rng = random.Random(accuracy)
    rows = [(rng.choice([i, 5, None]), 30, 40, 0, rng.choice([7, 7, rng.randrange(-50, 50)])) for i in range(500)]
    frame = spark.createDataFrame(rows, resampling.SCORED)
    order = sorted(rows, key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k in (1, 2, 125, 499, 500):
        assert resampling.cutoff(frame, k, 500, accuracy) == (order[k - 1][4], order[k - 1][0])


def test_numbers_are_gapless(spark):
    rows = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(97)).alias("x"), "id").repartition(7)
    found = numbered_along(rows, [F.desc("x"), F.asc("id")], "n").orderBy("n").collect()
    assert [r.n for r in found] == list(range(1, 5001))
    assert [(r.x, r.id) for r in found] == sorted(((r.x, r.id) for r in found), key=lambda p: (-p[0], p[1]))
