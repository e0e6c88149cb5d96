"""Toxicity by maximum-scoring segments of token log-odds (operator 10).

Words and word beginnings get log-odds with a Dirichlet prior from labelled documents. A linear
scan finds every maximal toxic passage of a text; extreme-value statistics of clean documents
tell how surprising its score is for the text's length, and a logistic curve turns that into a
probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import BATCH_BYTES, crc32_of, split_documents, stored, table

PUNCTUATION = ".,;:!?\"'()[]{}#*$%&|<>-_/\\`~+=@^"
#: Word beginnings of these lengths are features beside the whole word.
PREFIXES = (4, 5, 6, 7)
#: The classifier is fitted on so many labelled rows at most, those with the smallest key hash.
TRAIN_ROWS = 20_000
#: Pseudo-documents of the Dirichlet prior, spread as the features are over all training rows.
PRIOR = 10.0
#: A feature enters the lexicon with at least so many standard deviations and documents.
LEAST_Z, LEAST_DOCS = 3.0, 3
#: Weaker log-odds tell topics apart rather than toxic words.
LEAST_ODDS = 1.0
#: What every token without a toxic feature costs a passage at least, and in multiples of what the
#: average token of a clean text gains: clean texts must lose on the whole, or no passage would end.
DRIFT, TIMES_GAIN = 0.1, 3.0
#: Passages whose expected number in a clean text of that length is lower are reported.
MOST_EXPECTED = 0.05
THRESHOLD = 0.3
#: Words whose score a task remembers; a full memory is emptied, which changes no result.
MOST_REMEMBERED = 500_000


def features(word: str) -> list[str]:
    """The word itself and its beginnings; a trailing `*` marks a beginning."""
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) > n]


class Lexicon(dict):
    """token -> score: the largest log-odds among its features, -1 without any."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> float:
        if len(self) >= MOST_REMEMBERED:
            self.clear()
        found = [self.weights[f] for f in features(token.strip(PUNCTUATION)) if f in self.weights]
        self[token] = value = max(found, default=-1.0)
        return value


def tokens(text: str) -> list[str]:
    return text.lower().split()


def maximal_segments(positions: np.ndarray, scores: np.ndarray, drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last + 1, score) of a sequence, in linear time.

    `positions` are the places with positive `scores`; all other places score minus the drift.
    """
    found: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum after
    total, at = 0.0, 0
    for place, score in zip(positions.tolist(), scores.tolist()):
        left = total - drift * (place - at)
        total, at = left + score, place + 1
        first, low, high = place, left, total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
        found.append((first, at, low, high))
    return [(first, end, high - low) for first, end, low, high in found]


@dataclass
class Model:
    """Lexicon, extreme-value parameters and the logistic curve."""

    weights: dict[str, float]
    drift: float = DRIFT
    rate: float = 1.0
    scale: float = 1.0
    curve: np.ndarray = field(default_factory=lambda: np.array([-3.0, 1.0, 0.0]))

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Minus the log of each segment's expected number in a clean text of n tokens, and the inputs
        of the curve: the best and the sum over significant ones."""
        if not segments:
            return np.zeros(0), np.zeros(2)
        surprise = self.rate * np.array([s for _, _, s in segments]) - np.log(self.scale * max(n, 1))
        strong = surprise[surprise > -np.log(MOST_EXPECTED)]
        return surprise, np.log1p(np.maximum([surprise.max(), strong.sum()], 0))

    def probability(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] + inputs @ self.curve[1:])))


def scan(text: str, lexicon: Lexicon, drift: float) -> tuple[int, list[tuple[int, int, float]], np.ndarray]:
    """Number of tokens, maximal segments, and the positive token scores."""
    words = tokens(text)
    scores = np.fromiter(map(lexicon.__getitem__, words), np.float64, len(words))
    places = np.flatnonzero(scores > 0)
    return len(words), maximal_segments(places, scores[places], drift), scores[places]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [text or "" for text in batch.column(batch.schema.get_field_index("text")).to_pylist()]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task the documents of either label that have a feature."""
    memory: dict[str, list[str]] = {}
    for batch in split_documents(batches, BATCH_BYTES):
        counts = Counter(), Counter()
        labels = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
        for text, label in zip(_texts(batch), labels):
            own: set[str] = set()
            for word in {token.strip(PUNCTUATION) for token in set(tokens(text))}:
                if word:
                    own.update(features(word))
            counts[label].update(own)
        names = list(counts[0].keys() | counts[1].keys())
        columns = [names, [counts[1][n] for n in names], [counts[0][n] for n in names]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
            names=["feature", "toxic", "clean"],
        )


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of a bounded number of labelled rows; they are sent to the documents."""
    usable = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(crc32_of(F.col("doc_id")) % 4 != 2)
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def log_odds(train: DataFrame) -> dict[str, float]:
    """The lexicon: features of toxic documents with significant log-odds, as many as the bounded rows have."""
    totals = {row["toxic"]: row["count"] for row in train.groupBy("toxic").count().collect()}
    toxic, clean = float(totals.get(1, 0)), float(totals.get(0, 0))
    if not toxic or not clean:
        return {}
    counts = train.mapInArrow(_count, "feature string, toxic long, clean long").groupBy("feature").agg(
        F.sum("toxic").alias("t"), F.sum("clean").alias("c")
    )
    alpha = (F.col("t") + F.col("c")) * F.lit(PRIOR / (toxic + clean))
    t, c = F.col("t") + F.col("alpha"), F.col("c") + F.col("alpha")
    delta = F.log(t / (F.lit(toxic + PRIOR) - t)) - F.log(c / (F.lit(clean + PRIOR) - c))
    weighed = (
        counts.where(F.col("t") >= LEAST_DOCS)
        .withColumn("alpha", alpha)
        .select("feature", delta.alias("delta"), (delta / F.sqrt(1 / t + 1 / c)).alias("z"))
        .where((F.col("z") >= LEAST_Z) & (F.col("delta") >= LEAST_ODDS))
    )
    return {row["feature"]: row["delta"] for row in weighed.select("feature", "delta").collect()}


def _scan_training(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(model.weights)
        for batch in split_documents(batches, BATCH_BYTES):
            labels = batch.column(batch.schema.get_field_index("toxic"))
            scanned = [scan(text, lexicon, model.drift) for text in _texts(batch)]
            columns = [
                labels,
                pa.array([n for n, _, _ in scanned], pa.int64()),
                pa.array([[s for _, _, s in found] for _, found, _ in scanned], pa.list_(pa.float64())),
                pa.array([list(np.round(p, 1)) for _, _, p in scanned], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "n", "segments", "positive"])

    return run


def _rate(scores: np.ndarray, shares: np.ndarray, rest: float, drift: float) -> float:
    """The positive root of sum(share * exp(rate * score)) + rest * exp(-rate * drift) = 1.

    It exists because the mean score is negative.
    """
    low, high = 1e-6, 50.0 / max(scores.max(), 1.0)

    def over(rate: float) -> bool:
        return float(shares @ np.exp(rate * scores) + rest * np.exp(-rate * drift)) > 1

    if not over(high):
        return high
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) else (middle, high)
    return high


def _logistic(inputs: np.ndarray, labels: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    x = np.column_stack([np.ones(len(inputs)), inputs])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (labels - p) - ridge * w)
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of at most TRAIN_ROWS labelled rows; the driver sees one short row of each.

    Without labels of both kinds nothing is known and every text scores alike, below 0.3.
    """
    train = stored(training_rows(docs, labels), "labelled")
    model = Model(log_odds(train))
    if not model.weights:
        model.curve = np.array([-3.0, 0.0, 0.0])
        return model

    def scanned() -> pd.DataFrame:
        schema = "toxic int, n long, segments array<double>, positive array<double>"
        return train.mapInArrow(_scan_training(model), schema).toPandas()

    rows = scanned()
    clean = rows[rows.toxic == 0]
    n_tokens = max(int(clean.n.sum()), 1)
    hits = Counter(score for own in clean.positive for score in own)
    gain = sum(score * n for score, n in hits.items()) / n_tokens
    if TIMES_GAIN * gain > DRIFT:
        model.drift = TIMES_GAIN * gain
        rows = scanned()
        clean = rows[rows.toxic == 0]
    # Every score of the lexicon is possible in clean texts, if only once in a while.
    for score in set(np.round(list(model.weights.values()), 1)):
        hits[score] += 0.5
    scores, counts = np.array(list(hits)), np.array(list(hits.values()))
    shares = counts / (n_tokens + counts.sum())
    model.rate = _rate(scores, shares, 1 - shares.sum(), model.drift)
    best = np.array([max(own, default=0.0) for own in clean.segments])
    model.scale = len(clean) / float((np.maximum(clean.n, 1) * np.exp(-model.rate * best)).sum())
    inputs = np.array(
        [model.evidence([(0, 0, s) for s in own], n)[1] for own, n in zip(rows.segments, rows.n)]
    )
    model.curve = _logistic(inputs, rows.toxic.to_numpy(float))
    return model


OUTPUT = (
    "doc_id long, score double, n_tokens long, "
    "segments array<struct<first:int,end:int,score:double,expected:double>>"
)


def _score(model: Model, schema: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.weights)
        for batch in split_documents(batches, BATCH_BYTES):
            inputs, segments, sizes = [], [], []
            for text in _texts(batch):
                n, found, _ = scan(text, lexicon, model.drift)
                surprise, own = model.evidence(found, n)
                inputs.append(own)
                sizes.append(n)
                segments.append(
                    [
                        (first, end, float(s), float(np.exp(-x)))
                        for (first, end, s), x in zip(found, surprise)
                        if np.exp(-x) < MOST_EXPECTED
                    ]
                )
            scores = model.probability(np.array(inputs).reshape(-1, 2))
            columns = [
                batch.column(batch.schema.get_field_index("doc_id")),
                pa.array(scores),
                pa.array(sizes, pa.int64()),
                pa.array(
                    [[dict(zip(("first", "end", "score", "expected"), s)) for s in own] for own in segments],
                    schema,
                ),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "n_tokens", "segments"])

    return run


_SEGMENTS = pa.list_(
    pa.struct(
        [("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]
    )
)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Every document's probability of being toxic and its significant passages (token ranges).

    Reads doc_id and text only. Null and empty texts have no passage and score like any text
    without one. Rows that repeat score alike; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_score(model, _SEGMENTS), OUTPUT)


def _keep_clean(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.weights)
        for batch in split_documents(batches, BATCH_BYTES):
            inputs = []
            for text in _texts(batch):
                n, found, _ = scan(text, lexicon, model.drift)
                inputs.append(model.evidence(found, n)[1])
            scores = model.probability(np.array(inputs).reshape(-1, 2))
            yield batch.filter(pa.array(scores < THRESHOLD))

    return run


def clean_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model does not reject, with all their columns, without a shuffle.

    Null and empty texts have no evidence and stay; rows that repeat stay or go alike; an empty table
    gives no rows.
    """
    return docs.mapInArrow(_keep_clean(model), docs.schema)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labels that may be learnt from and score all documents."""
    return score_documents(docs, fit(docs, labels)).select(
        "doc_id",
        F.coalesce(crc32_of(F.col("doc_id")) % 4 == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_tokens",
        "segments",
    )


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
