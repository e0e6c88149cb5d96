"""Language model scoring with Brown classes: class transitions and word emissions (operator 3).

Exchange clustering gives every word a class. Rounds among the frequent words (the core) give the
first classes; then all words take part, each with all its bigrams. The probability of a word is
that of its class after the class of the word before it, times that of the word in its class,
mixed with the smoothed unigram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import crc32_of, release, split_documents, stored, table, texts_of
from truerow.llm.words import WordHashes, hashed_words

#: Words are known by a 64-bit hash; the end of a text is a word of its own.
END = np.uint64(0x9E3779B97F4A7C15)
CLASSES = 32
#: Words whose exchange among each other gives the first classes: their counts are at most
#: CORE x CORE numbers, which the driver holds.
CORE = 1024
#: Most words (core included) whose counts and classes are sent to every task: about 5 MB. All
#: others are looked up by a join.
HEAD = 1 << 18
ROUNDS = 12
#: Rounds of all words; in each one half may move.
ALL_ROUNDS = 2
#: How a bigram names the start of a text; head words have smaller numbers.
START = 1 << 20
#: Neighbours: classes before are 0.., classes after CLASSES.., then the text's start, then no class.
AT_START, NOWHERE = 2 * CLASSES, 2 * CLASSES + 1
#: Weight of the class model beside the unigram, and pseudo-counts of a class's share.
MIX, PRIOR = 0.9, 5.0
FLUSH = 1_500_000


def with_ends(texts: list[bytes], memory: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with END after each text, and the sizes."""
    hashes, sizes = hashed_words(texts, memory)
    ends = np.cumsum(sizes)
    return np.insert(hashes, ends, END), sizes + 1


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory, kept, held = WordHashes(), [], 0
    for batch in split_documents(batches, 4 << 20):
        kept.append(with_ends(texts_of(batch), memory)[0])
        held += len(kept[-1])
        if held >= FLUSH:
            yield _counted(kept)
            kept, held = [], 0
    if kept:
        yield _counted(kept)


def _counted(kept: list[np.ndarray]) -> pa.RecordBatch:
    words, n = np.unique(np.concatenate(kept), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])


class Index:
    """Position of a hash in a fixed list of words; `missing` for all others."""

    def __init__(self, words: np.ndarray):
        self.order = np.argsort(words)
        self.sorted = words[self.order]
        self.missing = len(words)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], self.missing)


def _bigrams(index: Index):
    """Counts of (previous word, word) for all tokens, summed within a flush. Head words are
    written as their place in the head, a text's start as START, all other words as their hash."""

    def counted(befores: list[np.ndarray], words: list[np.ndarray]) -> pa.RecordBatch:
        before, word = np.concatenate(befores), np.concatenate(words)
        order = np.lexsort((word, before))
        before, word = before[order], word[order]
        first = np.ones(len(word), bool)
        first[1:] = (word[1:] != word[:-1]) | (before[1:] != before[:-1])
        at = np.flatnonzero(first)
        columns = [pa.array(before[at]), pa.array(word[at]), pa.array(np.diff(np.append(at, len(word))))]
        return pa.RecordBatch.from_arrays(columns, names=["before", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        befores, words, held = [], [], 0
        for batch in split_documents(batches, 4 << 20):
            hashes, sizes = with_ends(texts_of(batch), memory)
            codes = index(hashes)
            word = np.where(codes < index.missing, codes, hashes.view(np.int64))
            before = np.concatenate([[START], word[:-1]])
            before[np.cumsum(sizes) - sizes] = START
            befores.append(before)
            words.append(word)
            held += len(word)
            if held >= FLUSH:
                yield counted(befores, words)
                befores, words, held = [], [], 0
        if held:
            yield counted(befores, words)

    return run


def exchange(
    counts: np.ndarray, classes: np.ndarray, totals: tuple[np.ndarray, np.ndarray] | None = None
) -> np.ndarray:
    """The class of each word that adds most to the likelihood of the class bigrams.

    A word's own counts are taken out of its class first, as an exchange does; all words are
    judged against the same classes. `totals` (class x neighbour class, before and after) are
    given where the words are only some of all; a class of -1 is none yet.
    """
    before, after = counts[0][:, :CLASSES].astype(float), counts[1][:, :CLASSES].astype(float)
    placed = np.flatnonzero(classes >= 0)
    if totals is None:
        onehot = np.zeros((len(classes), CLASSES))
        onehot[placed, classes[placed]] = 1
        totals = onehot.T @ before, onehot.T @ after

    def gain(own: np.ndarray, of_class: np.ndarray) -> np.ndarray:
        neighbour = of_class.sum(axis=0) + 1.0

        def log_share(n: np.ndarray) -> np.ndarray:
            return np.log((n + 0.1) / (n.sum(axis=-1, keepdims=True) + 0.1 * CLASSES) / (neighbour / neighbour.sum()))

        all_classes = own @ log_share(of_class).T
        home = own[placed] * log_share(of_class[classes[placed]] - own[placed])
        all_classes[placed, classes[placed]] = home.sum(axis=1)
        return all_classes

    return np.argmax(gain(before, totals[0]) + gain(after, totals[1]), axis=1)


def cluster(follow: np.ndarray) -> np.ndarray:
    """First classes of the core words, most frequent first, by how often each (row) comes directly
    before each (column). In each round one half may move."""
    n_words = len(follow)
    place = np.arange(n_words)
    classes = place % CLASSES
    for step in range(ROUNDS):
        onehot = np.eye(CLASSES)[classes]
        wanted = exchange(np.stack([follow.T @ onehot, follow @ onehot]), classes)
        moved = ((place // 3 + step) % 2 == 0) & (wanted != classes)
        classes = np.where(moved, wanted, classes)
        if step % 2 and moved.sum() < n_words // 200:
            break
    return classes


def core_counts(bigrams: DataFrame, n_words: int) -> np.ndarray:
    """before x word among the core. At most CORE x CORE rows reach the driver."""
    inner = bigrams.where(F.col("before").between(0, n_words - 1) & F.col("word").between(0, n_words - 1))
    found = inner.select((F.col("before") * n_words + F.col("word")).cast("int").alias("cell"), "n").toPandas()
    follow = np.zeros(n_words * n_words)
    follow[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy()
    return follow.reshape(n_words, n_words)


def histories(codes: np.ndarray, sizes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Per token: twice the class of the last core word before it in its text, plus one if other
    words lie between; 2 * CLASSES where there is none. Stands in where the word before is unknown. `codes` >= len(classes) are not core."""
    n = len(codes)
    place = np.arange(n)
    last = np.maximum.accumulate(np.where(codes < len(classes), place, -1)) if n else place
    last = np.concatenate([[-1], last[:-1]])[:n]
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    safe = np.append(classes, [0])
    of_last = safe[np.minimum(codes[np.maximum(last, 0)], len(classes))] if n else place
    return np.where(last >= start, 2 * of_last + (last < place - 1), 2 * CLASSES)


def _in_head(word: str) -> Column:
    return F.col(word).between(0, START - 1)


def beside(bigrams: DataFrame, of_head: DataFrame, rest: DataFrame | None, after: bool = True) -> DataFrame:
    """(word, k, n) of all words, not yet summed: k is the class of the word before or AT_START, and with
    `after` also CLASSES plus the class of the word after.

    Classes of the head come by a broadcast of at most HEAD rows, all others by a join with `rest`
    (word, class). Without `rest` a word before that has no class counts as NOWHERE.
    """
    def head(name: str, own: str) -> DataFrame:
        return F.broadcast(of_head.select(F.col("word").alias(name), F.col("class").alias(own)))

    k = F.when(F.col("before") == START, AT_START).otherwise(F.col("before_class"))
    sides = [F.struct("word", (k if rest is not None else F.coalesce(k, F.lit(NOWHERE))).cast("int").alias("k"), "n")]
    rows = bigrams.join(head("before", "before_class"), "before", "left")
    if after:
        rows = rows.join(head("word", "word_class"), "word", "left")
        own = F.when(F.col("before") != START, F.col("word_class") + CLASSES).cast("int")
        sides.append(F.struct(F.col("before").alias("word"), own.alias("k"), "n"))
    found = rows.select(F.inline(F.array(*sides))).where("k IS NOT NULL")
    if rest is None:
        return found

    def tail(other: str, own: str, first: int) -> DataFrame:
        rows = bigrams.where(~_in_head(other) & (F.col("before") != START))
        return rows.select(F.col(other).alias("other"), F.col(own).alias("word"), "n", F.lit(first).alias("first"))

    outside = tail("before", "word", 0)
    if after:
        outside = outside.unionByName(tail("word", "before", CLASSES))
    joined = outside.join(rest.select(F.col("word").alias("other"), "class"), "other")
    return found.unionByName(joined.select("word", (F.col("class") + F.col("first")).cast("int").alias("k"), "n"))


def _place(totals: tuple[np.ndarray, np.ndarray], step: int | None):
    """The class of each word by its neighbours. With `step` one half of the words may move;
    without, only words that have no class get one. (word, class, seen) in, (word, class, n) out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column(0).to_numpy(zero_copy_only=False)
            old = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            seen = batch.column(2)
            k, n = (seen.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            row = np.repeat(np.arange(len(word)), np.diff(seen.offsets.to_numpy()))
            cells = np.bincount(row * (NOWHERE + 1) + k, n, minlength=len(word) * (NOWHERE + 1)).reshape(len(word), -1)
            wanted = exchange(np.stack([cells[:, :CLASSES], cells[:, CLASSES : 2 * CLASSES]]), old, totals)
            turn = old < 0 if step is None else (word // 3 + step) % 2 == 0
            own = cells[:, :CLASSES].sum(axis=1) + cells[:, AT_START] + cells[:, NOWHERE]
            columns = [batch.column(0), pa.array(np.where(turn, wanted, old), pa.int32()), pa.array(own.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "class", "n"])

    return run


def _matrix(rows: DataFrame) -> np.ndarray:
    """class x k, from rows (class, k, n)."""
    total = np.zeros((CLASSES, NOWHERE + 1))
    for row in rows.groupBy("class", "k").agg(F.sum("n").alias("n")).collect():
        total[row["class"], row["k"]] = row["n"]
    return total


@dataclass
class Classes:
    """The classes of all words: the head's as an array and as a table (word, class, n), the others' as
    the table `rest` (word, class, n) inside the stored table `placed`."""

    head_class: np.ndarray
    of_head: DataFrame
    rest: DataFrame | None = None
    placed: DataFrame | None = None


def head_table(spark: SparkSession, head_class: np.ndarray, head_n: np.ndarray) -> DataFrame:
    """At most HEAD rows; words without a class are left out."""
    rows = pd.DataFrame({"word": np.arange(len(head_class)), "class": head_class.astype(np.int32), "n": head_n})
    return spark.createDataFrame(rows[rows["class"] >= 0], "word long, class int, n long")


def place(bigrams: DataFrame, now: Classes, head_n: np.ndarray, step: int | None) -> Classes:
    """One exchange step of all words on the bigrams of all words."""
    seen = beside(bigrams, now.of_head, now.rest).groupBy("word", "k").agg(F.sum("n").alias("n"))
    lists = seen.groupBy("word").agg(F.collect_list(F.struct("k", "n")).alias("seen"))
    known = now.of_head.select("word", F.col("class").alias("head_class"))
    lists = lists.join(F.broadcast(known), "word", "left")
    if now.rest is None:
        lists = lists.select("word", F.col("head_class").alias("class"), "seen")
    else:
        lists = lists.join(now.rest.select("word", "class"), "word", "left")
        lists = lists.select("word", F.coalesce("head_class", "class").alias("class"), "seen")
    lists = stored(lists, "neighbours", "zstd")
    total = _matrix(lists.where("class IS NOT NULL").select("class", F.inline("seen")))
    totals = total[:, :CLASSES], total[:, CLASSES : 2 * CLASSES]
    placed = stored(lists.mapInArrow(_place(totals, step), "word long, class int, n long"), "classes")
    release(lists, *([now.placed] if now.placed is not None else []))
    head_class = np.array(now.head_class)
    moved = placed.where(_in_head("word")).select("word", "class").toPandas()  # at most HEAD rows
    head_class[moved["word"].to_numpy()] = moved["class"].to_numpy()
    return Classes(head_class, head_table(bigrams.sparkSession, head_class, head_n), placed.where(~_in_head("word")), placed)


def transitions(bigrams: DataFrame, now: Classes) -> tuple[np.ndarray, np.ndarray]:
    """class x k by the words before: of all words, and of the words seen once."""
    rows = beside(bigrams, now.of_head, now.rest, after=False).groupBy("word", "k").agg(F.sum("n").alias("n"))
    own = (F.col("c") == 1).alias("once")

    def classed(rows: DataFrame, of: DataFrame) -> DataFrame:
        return rows.join(of.select("word", "class", F.col("n").alias("c")), "word").select("class", "k", "n", own)

    found = classed(rows.where(_in_head("word")), F.broadcast(now.of_head))
    found = found.unionByName(classed(rows.where(~_in_head("word")), now.rest))
    total, once = np.zeros((CLASSES, NOWHERE + 1)), np.zeros((CLASSES, NOWHERE + 1))
    for row in found.groupBy("class", "k", "once").agg(F.sum("n").alias("n")).collect():
        total[row["class"], row["k"]] += row["n"]
        if row["once"]:
            once[row["class"], row["k"]] += row["n"]
    return total, once


def most_frequent(counts: DataFrame, most: int) -> pd.DataFrame:
    """The most frequent words, `most` at the most and with their counts, down to a limit of frequency.

    The limit is found from the numbers of words per size of count (eight sizes to a doubling, so
    some 500 rows), so no task sorts the vocabulary. Words as frequent as the limit are in or out
    together.
    """
    size = F.floor(F.log2("n") * 8)
    sizes = counts.groupBy(size.alias("size")).count().toPandas().sort_values("size", ascending=False)
    fits = sizes[sizes["count"].cumsum() <= most]
    if fits.empty:
        return pd.DataFrame({"word": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
    found = counts.where(size >= int(fits["size"].min())).toPandas()
    return found.sort_values(["n", "word"], ascending=[False, True], ignore_index=True)


@dataclass
class Model:
    """Counts of the head, class parameters (all of fixed size), and the table of all words."""

    words: DataFrame  # word, n, class
    head: np.ndarray
    head_n: np.ndarray
    head_class: np.ndarray
    core: np.ndarray
    core_class: np.ndarray
    tokens: int
    distinct: int
    transition: np.ndarray  # history x class
    class_n: np.ndarray
    class_once: np.ndarray

    def unknown(self) -> np.ndarray:
        """Probability of one word without training count after each history.

        A class has as many unseen words as words seen once, each with the emission of one
        count. The classes' unseen mass and the unigram's one unseen event are shared evenly
        among all unseen words, since nothing tells their classes.
        """
        new = self.transition @ (self.class_once / (self.class_n + self.class_once))
        return (MIX * new + (1 - MIX) / (self.tokens + self.distinct + 1)) / self.class_once.sum()


def _is_held_out() -> Column:
    return F.coalesce(crc32_of(F.col("doc_id")) % 7 == 2, F.lit(False))


def fit(docs: DataFrame) -> Model:
    """Train on all rows given. Words, bigrams and classes live in tables; the driver holds the
    core and head (fixed sizes) and matrices of classes by classes.

    The rounds among the core only give first classes. Then every word takes its class from its
    neighbours, and in the last rounds all words may move on the bigrams of all words. The
    transitions are counted over all bigrams with the classes that come out.
    """
    spark = docs.sparkSession
    texts = docs.select("text")
    counts = texts.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "word-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    head = most_frequent(counts, min(HEAD, START))
    words, head_n = head["word"].to_numpy(np.int64).view(np.uint64), head["n"].to_numpy(np.int64)
    core = words[:CORE]
    pairs = texts.mapInArrow(_bigrams(Index(words)), "before long, word long, n long")
    bigrams = stored(pairs.groupBy("before", "word").agg(F.sum("n").alias("n")), "bigrams", "zstd")
    release(counts)
    head_class = np.full(len(words), -1, np.int64)
    head_class[: len(core)] = cluster(core_counts(bigrams, len(core)))

    now = Classes(head_class, head_table(spark, head_class, head_n))
    for step in (None, *range(ALL_ROUNDS)):
        now = place(bigrams, now, head_n, step)
    by_word, once = transitions(bigrams, now)
    release(bigrams)
    head_class = now.head_class

    def smoothed(n: np.ndarray) -> np.ndarray:
        prior = (n.sum(axis=0) + 1) / (n.sum() + CLASSES)
        return (n + PRIOR * prior) / (n.sum(axis=1, keepdims=True) + PRIOR)

    after = smoothed(by_word[:, [*range(CLASSES), AT_START]].T)  # the start is the last row
    transition = np.empty((2 * CLASSES + 1, CLASSES))
    transition[::2] = after
    # An unknown word between is of the classes that words seen once have there.
    transition[1::2] = smoothed(once[:, :CLASSES].T) @ after[:CLASSES]

    of_head = pd.DataFrame({"word": words.view(np.int64), "class": head_class.astype(np.int32), "n": head_n})
    table_ = now.rest.unionByName(spark.createDataFrame(of_head, "word long, class int, n long"))
    sums = {r["class"]: r for r in table_.groupBy("class").agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("once")).collect()}
    class_n = np.array([sums[c]["n"] if c in sums else 0 for c in range(CLASSES)], float)
    class_once = np.array([sums[c]["once"] if c in sums else 0 for c in range(CLASSES)], float)
    # One unseen word per class at least, so that no event is impossible.
    class_once = np.maximum(class_once, 1)
    return Model(
        table_, words, head_n, head_class, core, head_class[: len(core)], int(total["n"] or 0), int(total["v"]),
        transition, class_n, class_once,
    )


_PARTS = (
    "row long, doc_id long, n_tokens long, n_known long, base double, score double, "
    "rest array<struct<word:long,before:long,h:int,class:int,n:long>>"
)


def _score_head(parameters: dict):
    """Per document the sums over head words after head words, and the other tokens: a word or a
    predecessor outside the head by its hash, a head word by its class and count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = parameters
        memory, index, core = WordHashes(), p["index"], p["core"]
        add_one = np.log10(p["head_n"] + 1.0)
        row = TaskContext.get().partitionId() << 40
        of_head, n_head = np.append(p["head_class"], 0), np.append(p["head_n"], 0)
        for batch in split_documents(batches, 4 << 20):
            hashes, sizes = with_ends(texts_of(batch), memory)
            code = index(hashes)
            first = np.zeros(len(code), bool)
            first[np.cumsum(sizes) - sizes] = True
            before = np.concatenate([[index.missing], code[:-1]])[: len(code)]
            by_join = (before == index.missing) & ~first
            # Where the join does not find the predecessor, the last core word stands for it.
            h = histories(core(hashes), sizes, p["core_class"])
            h = np.where(first | by_join, h, 2 * of_head[before])
            doc = np.repeat(np.arange(len(sizes)), sizes)
            known = code < index.missing
            here = known & ~by_join
            k, kh = code[here], h[here]
            chance = p["by_class"][kh, of_head[k]] * n_head[k] + p["unigram"] * (n_head[k] + 1)
            n = len(sizes)
            base = np.bincount(doc[known], add_one[code[known]], n) - p["log_total"] * sizes
            score = np.bincount(doc[here], np.log10(chance), n).astype(np.float64)
            other = np.flatnonzero(~here)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[other], minlength=n))]), pa.int32())
            own, prev = hashes.view(np.int64), np.concatenate([[0], hashes.view(np.int64)[:-1]])[: len(hashes)]
            rest = pa.StructArray.from_arrays(
                [
                    pa.array(own[other], mask=known[other]),
                    pa.array(prev[other], mask=~by_join[other]),
                    pa.array(h[other].astype(np.int32)),
                    pa.array(of_head[code[other]].astype(np.int32), mask=~known[other]),
                    pa.array(n_head[code[other]], mask=~known[other]),
                ],
                names=["word", "before", "h", "class", "n"],
            )
            columns = [
                pa.array(row + np.arange(n)),
                batch.column(0),
                pa.array(sizes),
                pa.array(np.bincount(doc[known], minlength=n)),
                pa.array(base),
                pa.array(score),
                pa.ListArray.from_arrays(offsets, rest),
            ]
            row += n
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_tokens", "n_known", "base", "score", "rest"])

    return run


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """log10 probabilities of all whole texts under the model and under the unigram.

    Sums over head words after head words are made where the text is read. The other tokens
    travel to the table of words, by the word before for its class and by the word itself, and
    come back as one sum per row.
    """
    m = model
    per_class = m.transition * (MIX / (m.class_n + m.class_once))
    unigram = (1 - MIX) / (m.tokens + m.distinct + 1)
    log_total = float(np.log10(m.tokens + m.distinct + 1))
    parameters = {
        "index": Index(m.head), "head_n": m.head_n, "head_class": m.head_class, "core": Index(m.core),
        "core_class": m.core_class, "by_class": per_class, "unigram": unigram, "log_total": log_total,
    }
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_score_head(parameters), _PARTS)
    rows = stored(rows, "head-scores", "zstd")
    rest = rows.select("row", F.inline("rest"))
    of_before = m.words.select(F.col("word").alias("before"), F.col("class").alias("before_class"))
    joined = rest.where("before IS NOT NULL").join(of_before, "before", "left")
    joined = joined.withColumn("h", F.coalesce(F.col("before_class") * 2, "h"))
    names = ["row", "word", "h", "class", "n"]
    rest = joined.select(*names).unionByName(rest.where("before IS NULL").select(*names))
    in_head = F.col("word").isNull()
    found = rest.where(~in_head).drop("class", "n").join(m.words, "word", "left")
    found = found.select(*names).unionByName(rest.where(in_head))
    cells = F.array(*[F.lit(float(x)) for x in per_class.ravel()])
    new = F.array(*[F.lit(float(x)) for x in m.unknown()])
    known = F.col("n").isNotNull()
    chance = F.when(
        known,
        F.element_at(cells, F.col("h") * CLASSES + F.col("class") + 1) * F.col("n") + F.lit(unigram) * (F.col("n") + 1),
    ).otherwise(F.element_at(new, F.col("h") + 1))
    sums = found.groupBy("row").agg(
        F.sum(F.log10(chance)).alias("more_score"),
        F.sum(F.when(~in_head, F.log10(F.coalesce("n", F.lit(0)) + 1))).alias("more_base"),
        F.count_if(known & ~in_head).alias("more_known"),
    )
    return rows.drop("rest").join(sums, "row", "left").select(
        "doc_id",
        _is_held_out().alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(m.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def train_and_score(docs: DataFrame) -> DataFrame:
    """Score every document with a model of those that are not held out.

    Reads doc_id and text only. A null or empty text is the end token alone. Rows that repeat
    each train and get their own score; a null doc_id is not held out. Without training rows
    every word is unknown. An empty table gives no rows. After every history the probabilities
    of the known words and of the expected number of unseen words sum to 1; two texts with
    different unseen words are different texts, so the score is no score of a mere `unknown`.
    """
    return score_documents(docs, fit(docs.where(~_is_held_out())))


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_score(table(spark, sf_dir, "documents"))
