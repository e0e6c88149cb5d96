"""Resampling documents towards a target distribution (operator 13).

Hashed words and word pairs are counted in the documents and in the target texts; a feature's gain
is how much more often its bucket comes in the target. A document's weight is its mean gain, and
Gumbel noise from its key turns the largest scores into a weighted draw without replacement. The
cutoff of the draw comes from a quantile sketch whose bracket is checked by exact counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import ASCII_LOWER, split_documents, stored, table, texts_of
from truerow.llm.ranking import numbered_along

#: Words are made of 0-9, a-z (A-Z lower-cased) and all bytes beyond ASCII.
_IS_WORD = re.compile(rb"[0-9a-z\x80-\xff]")
_WORDS = bytes(b if _IS_WORD.match(bytes([b])) else 32 for b in bytes(range(256)).translate(ASCII_LOWER))
#: Longer texts are taken in parts of about so many bytes, cut between words.
PART = 1 << 20

SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


@dataclass(frozen=True)
class Draw:
    """What is drawn: `percent` of the documents with `least_words`, over `buckets` hash buckets."""

    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7
    #: Rank error of the quantile sketch: one part in so many.
    accuracy: int = 10_000


def feature_hashes(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(words, CRC-32 of their features) part by part: every word, every pair of neighbours."""
    clean = text.translate(_WORDS)
    at, last = 0, None
    while at < len(clean):
        end = clean.find(b" ", at + PART)
        end = len(clean) if end < 0 else end
        words = clean[at:end].split()
        at = end
        if not words:
            continue
        single = list(map(crc32, words))
        spaced = [b" " + word for word in words]
        pairs = list(map(crc32, spaced[1:], single)) if last is None else list(map(crc32, spaced, [last, *single]))
        last = single[-1]
        yield len(words), np.array(single + pairs, np.int64)


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in split_documents(batches):
            for text in texts_of(batch):
                for _, hashes in feature_hashes(text):
                    total += np.bincount(hashes % buckets, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; a task sends one row per bucket."""
    counted = texts.select("text").mapInArrow(_count(buckets), "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1000 times the log of its smoothed share in the target over that in the source."""
    all_source, all_target, n = int(source.sum()), int(target.sum()), len(source)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_source + n) / ((s + 1) * (all_target + n))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """1000 times a Gumbel draw that depends on the key and the seed alone; a null key is empty."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gain: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_documents(batches):
            ids = batch.column(0).to_pylist()
            rows = np.zeros((4, len(ids)), np.int64)
            for i, (doc_id, text) in enumerate(zip(ids, texts_of(batch))):
                n_words = n = total = 0
                for words, hashes in feature_hashes(text):
                    n_words += words
                    n += len(hashes)
                    total += int(gain[hashes % len(gain)].sum())
                weight = total // n if n else 0
                rows[:, i] = n_words, n, weight, weight + noise(doc_id, seed)
            columns = [batch.column(0), *map(pa.array, rows)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCORED.split(", ")])

    return run


def score_documents(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """Per document the numbers of words and features, its weight and its score."""
    gain = gains(bucket_counts(docs, draw.buckets), bucket_counts(target, draw.buckets))
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_score(gain, draw.seed), SCORED)


#: Highest scores first, ties to the smaller doc_id; a null doc_id comes after all others.
def _order():
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("n_words")]


def bracket(scores: DataFrame, n: int, k: int, accuracy: int) -> tuple[int, int, int]:
    """(low, high, how many are above high) with the k-th highest of n scores in [low, high].

    The sketch's quantiles on both sides of the wanted one are only a guess: the scores above and
    inside are counted exactly, and the bracket is widened until the k-th is inside.
    """
    width = 2.0 / accuracy
    while True:
        wanted = 1 - k / n
        ends = [max(wanted - width, 0.0), min(wanted + width, 1.0)]
        low, high = scores.agg(F.percentile_approx("score", ends, accuracy)).first()[0]
        if width >= 1:
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        above, inside = scores.agg(
            F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))
        ).first()
        if above < k <= above + inside:
            return low, high, above
        width *= 8


def cutoff(eligible: DataFrame, k: int, n: int, accuracy: int) -> tuple[int, int | None]:
    """(score, doc_id) of the k-th row of n along the order; only the bracket's rows are sorted."""
    low, high, above = bracket(eligible, n, k, accuracy)
    inside = eligible.where(F.col("score").between(low, high))
    last = numbered_along(inside, _order(), "place").where(F.col("place") == k - above).first()
    return last["score"], last["doc_id"]


def resample(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """All documents with their weight and score; `rank` is 1, 2, 3, ... for the drawn ones.

    Reads `doc_id` and `text` of the documents and `text` of the target. A null or empty text has
    no features, weight 0 and too few words to be drawn. A null doc_id draws the noise of an empty
    key and comes last among equal scores. Rows that repeat share their noise and are drawn
    row by row; rows equal in every returned column are ranked in any order, exactly as many as
    there are places. An empty target makes rare features heavy; an empty table gives no rows.
    """
    scored = stored(score_documents(docs, target, draw), "scored")
    able = F.col("n_words") >= draw.least_words
    eligible = scored.where(able)
    n = eligible.count()
    k = n * draw.percent // 100
    drawn = F.lit(False)
    if k:
        score, doc_id = cutoff(eligible, k, n, draw.accuracy)
        not_after = F.lit(True) if doc_id is None else F.coalesce(F.col("doc_id") <= doc_id, F.lit(False))
        drawn = able & ((F.col("score") > score) | ((F.col("score") == score) & not_after))
    ranked = numbered_along(scored.where(drawn), _order(), "rank")
    # Rows tied with the cutoff in every column share the places that are left.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    rest = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
