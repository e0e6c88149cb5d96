"""Language identification by known words, then ever shorter character n-grams (operator 12).

Words seen in training score with their log frequency in every language. An unseen word is scored
by its character n-grams, the longest length first of which any is known.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import crc32_of, split_documents, stored, table

#: The model is fitted on a sample of labelled rows: per language about so many rows and bytes.
TRAIN_ROWS, TRAIN_BYTES = 2_000, 3 << 20
#: Lengths of the character n-grams, word ends marked by a space.
LONGEST = 5
#: A word or n-gram is known if it came so often in the sample.
LEAST_COUNT = 2
#: What an event that a language never showed counts as, in occurrences.
PSEUDO = 0.5
#: No letter, no language.
UNDECIDED = "und"
_RUNS = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s")
PART = 1 << 19
#: Unseen words that a task remembers; results do not depend on it.
MOST_REMEMBERED = 200_000


def grams(word: str, length: int) -> list[str]:
    """All n-grams of the word with a space at both ends; single characters without the spaces."""
    if length == 1:
        return list(word)
    marked = f" {word} "
    return [marked[i : i + length] for i in range(len(marked) - length + 1)]


def word_lists(text: str) -> Iterator[list[str]]:
    """The lower-cased words (runs of letters) of a text, part by part, cut at white space."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + PART)
        end = cut.start() if cut else len(text)
        yield _RUNS.findall(text[at:end].lower())
        at = end


@dataclass
class Model:
    """Log frequencies by language of known words and n-grams, and of the languages themselves."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int] = field(default_factory=dict)
    grams: list[dict[str, int]] = field(default_factory=list)
    #: One row per word, and per n-gram of each length.
    word_scores: np.ndarray | None = None
    gram_scores: list[np.ndarray] = field(default_factory=list)


class Scorer:
    """A task's view of the model: words to rows of scores, unseen words worked out once."""

    def __init__(self, model: Model):
        self.model = model
        self.unseen: dict[str, np.ndarray | None] = {}

    def backoff(self, word: str) -> np.ndarray | None:
        """Mean score of the word's known n-grams of the greatest length that has any."""
        if len(self.unseen) >= MOST_REMEMBERED:
            self.unseen.clear()
        if word not in self.unseen:
            self.unseen[word] = None
            for length in range(LONGEST, 0, -1):
                known = self.model.grams[length - 1]
                rows = [known[g] for g in grams(word, length) if g in known]
                if rows:
                    self.unseen[word] = self.model.gram_scores[length - 1][rows].mean(axis=0, dtype=np.float64)
                    break
        return self.unseen[word]

    def total(self, text: str) -> tuple[int, np.ndarray]:
        """Number of words and the log score of the text by language."""
        n, total = 0, self.model.prior.copy()
        known = self.model.words
        for words in word_lists(text):
            for word, times in Counter(words).items():
                if not any(map(str.isalpha, word)):
                    continue
                n += times
                row = known.get(word)
                own = self.backoff(word) if row is None else self.model.word_scores[row]
                if own is not None:
                    total += times * own
        return n, total

    def decide(self, text: str | None) -> tuple[str, float, int]:
        n, total = self.total(text or "")
        if not n or not self.model.languages:
            return UNDECIDED, 0.0, n
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum()), n


def held_out(doc_id=None):
    """Documents that are only judged; a null doc_id is not among them, yet nothing is learnt from it."""
    return F.coalesce(crc32_of(F.col("doc_id") if doc_id is None else doc_id) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """(lang, text) of a bounded sample per language, equal texts once, and all rows by language.

    A row is in the sample if its hash is below a share of the hash range that makes the
    expected rows TRAIN_ROWS and the expected bytes TRAIN_BYTES at most. Texts are taken whole.
    """
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(crc32_of(F.col("doc_id")) % 3 != 1)
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()
    if not sizes:
        return usable.select("lang", "text"), {}
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).cast("double") / float(1 << 40)
    share = {r["lang"]: min(1.0, TRAIN_ROWS / r["n"], TRAIN_BYTES / max(r["bytes"], 1)) for r in sizes}
    shares = docs.sparkSession.createDataFrame(list(share.items()), "lang string, share double")
    chosen = usable.join(F.broadcast(shares), "lang").where(draw <= F.col("share"))
    once = chosen.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
    return once.select("lang", "text"), {r["lang"]: r["n"] for r in sizes}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of words (length 0) and n-grams by language, per batch."""
    for batch in split_documents(batches, 4 << 20):
        found: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for words in word_lists(text):
                for word, times in Counter(words).items():
                    if any(map(str.isalpha, word)):
                        found[lang, 0, word] += times
                        for length in range(1, LONGEST + 1):
                            for gram in grams(word, length):
                                found[lang, length, gram] += times
        keys = list(zip(*found)) or [(), (), ()]
        columns = [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int32()), pa.array(keys[2], pa.string())]
        columns.append(pa.array(list(found.values()), pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "length", "event", "n"])


def fit(docs: DataFrame) -> Model:
    """The model of a bounded sample; its size is bounded by that of the sample."""
    train, rows = training_rows(docs)
    languages = sorted(rows)
    if not languages:
        return Model([], np.zeros(0), grams=[{}] * LONGEST)
    all_rows = sum(rows.values())
    model = Model(languages, np.log([rows[lang] / all_rows for lang in languages]))
    counts = (
        train.mapInArrow(_count, "lang string, length int, event string, n long")
        .groupBy("length", "event", "lang")
        .agg(F.sum("n").alias("n"))
    )
    counts = stored(counts, "language-counts")
    totals = np.full((LONGEST + 1, len(languages)), 0.0)
    place = {lang: i for i, lang in enumerate(languages)}
    for row in counts.groupBy("length", "lang").agg(F.sum("n").alias("n")).collect():
        totals[row["length"], place[row["lang"]]] = row["n"]
    known = counts.groupBy("length", "event").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")
    )
    slots = [F.coalesce(F.col("by")[lang], F.lit(0)).cast("long").alias(f"n{i}") for i, lang in enumerate(languages)]
    wanted = known.where(F.col("n") >= LEAST_COUNT).select("length", "event", *slots)
    found = wanted.orderBy("length", "event").toArrow()
    lengths = found.column(0).to_numpy()
    table_ = np.column_stack([found.column(2 + i).to_numpy() for i in range(len(languages))]).astype(float)
    for length in range(LONGEST + 1):
        at = np.flatnonzero(lengths == length)
        events = found.column(1).take(pa.array(at)).to_pylist()
        own = table_[at]
        scores = np.log((own + PSEUDO) / (totals[length] + PSEUDO * (len(at) + 1))).astype(np.float32)
        names = {event: i for i, event in enumerate(events)}
        if length:
            model.grams.append(names)
            model.gram_scores.append(scores)
        else:
            model.words, model.word_scores = names, scores
    return model


PREDICTED = "doc_id long, lang_pred string, score double, n_words long"


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in split_documents(batches):
            found = [scorer.decide(text) for text in batch.column(1).to_pylist()]
            columns = list(zip(*found)) or [(), (), ()]
            kinds = (pa.string(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, kind) for c, kind in zip(columns, kinds))],
                names=["doc_id", "lang_pred", "score", "n_words"],
            )

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Every document's language, the share of that language among all, and its number of words.

    Reads `doc_id` and `text`. A null text and a text without a letter are `und` with score 0, and
    so is every text where nothing could be learnt. Letters without any known n-gram leave the
    most frequent language; of equal scores the language first by name wins. Rows that repeat
    are judged alike; texts of any length are read whole, part by part. No rows give no rows.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_predict(model), PREDICTED)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_words"
    )
