"""Quality rules with adaptive thresholds from mergeable quantile sketches (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from truerow.llm.common import ASCII_SPACE, split_documents, stored, table, texts_of

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Whole numbers that the rules compare: the percentile at which a metric's tail starts, and how many times
#: the distance from the median to it a value may lie beyond. Junk fills up to a seventh of a source
#: and stands out by word length and symbols; repetition is a matter of degree in good texts as well.
METRICS = {"word_length": (85, 3), "symbols": (85, 3), "dup_lines": (98, 1), "repeats": (98, 1)}
#: Metrics that can also be too low.
TWO_SIDED = ("word_length",)
#: Every group's sketch is mixed with that of its language, weighed as so many rows, and the language's
#: with that of all rows in the same way: a small group leans on its parent, a large one does not.
PSEUDO = 50.0
#: Each power of two has so many bins: a quantile is exact to one part in 16.
BINS_LOG2 = 4

FEATURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15 * (2 * i + 3) & (2**64 - 1) | 1 for i in range(WINDOW)], np.uint64)


def repeated_words(words: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document, the words inside windows of five that occur again in the same document.

    `words` are 64-bit hashes in text order, `doc` the ascending document number of each.
    """
    counts = np.zeros(n_docs, np.int64)
    n = len(words) - WINDOW + 1
    if n < 1:
        return counts
    key = np.zeros(n, np.uint64)
    for i, m in enumerate(_MULTIPLIERS):
        key += words[i : i + n] * m
        key ^= key >> np.uint64(29)
    starts = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])
    order = starts[np.lexsort((key[starts], doc[starts]))]
    same = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    ends = np.zeros(len(words) + 1, np.int64)
    np.add.at(ends, order[twice], 1)
    np.add.at(ends, order[twice] + WINDOW, -1)
    covered = np.cumsum(ends[:-1]) > 0
    return np.bincount(doc[covered], minlength=n_docs).astype(np.int64)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in split_documents(batches):
        rows, hashes, sizes = [], [], []
        for text in texts_of(batch):
            words = text.split()  # of bytes: exactly the six ASCII spaces
            points = len(text) if text.isascii() else len(text.decode())
            spaces = len(text) - len(text.translate(None, ASCII_SPACE))
            symbols = len(text) - len(text.translate(None, SYMBOLS))
            lines = [line for line in text.split(b"\n") if line.strip()]
            rows.append((len(words), points - spaces, symbols, len(lines), len(lines) - len(set(lines))))
            hashes.append(np.fromiter(map(hash, words), np.int64, len(words)))
            sizes.append(len(words))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        words = np.concatenate(hashes).view(np.uint64) if hashes else np.empty(0, np.uint64)
        columns = [*np.array(rows, np.int64).reshape(-1, 5).T, repeated_words(words, doc, len(sizes))]
        names = [field.split()[0] for field in FEATURES.split(", ")]
        keep = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "lang", "source")]
        yield pa.RecordBatch.from_arrays(
            [*keep, *map(pa.array, columns)], names=["doc_id", "lang", "source", *names]
        )


def measure(docs: DataFrame) -> DataFrame:
    """Counts of each whole text; a null text is one without words."""
    rows = docs.select("doc_id", "lang", "source", "text")
    keep = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:3])
    return rows.mapInArrow(_measure, f"{keep}, {FEATURES}")


def metrics() -> Column:
    """The compared numbers, all whole, so that sums and bins are exact."""
    words, lines = F.col("n_words"), F.col("n_lines")

    def share(part: Column, whole: Column, scale: int) -> Column:
        return F.when(whole > 0, F.floor(part * scale / whole)).otherwise(0).cast("long")

    return F.struct(
        share(F.col("word_chars"), words, 100).alias("word_length"),
        share(F.col("n_symbols"), words, 1000).alias("symbols"),
        share(F.col("n_dup_lines"), lines, 1000).alias("dup_lines"),
        share(F.col("n_repeat_words"), words, 1000).alias("repeats"),
    )


def sketches(measured: DataFrame) -> DataFrame:
    """Per language, source and metric the row counts of logarithmic bins.

    Two sketches merge by adding the counts of equal bins, in any order and with the same
    result. A group has a few hundred bins at most, however many rows; partial aggregation
    sends one row per task and bin, so a source with most of the rows is no hot spot.
    """
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(f"m.{m}").alias("value")) for m in METRICS]
    )
    values = measured.where("n_words > 0").select("lang", "source", F.inline(pairs))
    # low: the bin's smallest value; numbers under 32 have bins of their own
    shift = F.greatest(F.length(F.bin("value")) - 1 - BINS_LOG2, F.lit(0))
    low = values.withColumn("shift", shift).withColumn(
        "low", F.expr("shiftleft(shiftright(value, shift), shift)")
    )
    return low.groupBy("lang", "source", "metric", "low").agg(F.count("*").alias("n"))


def mixed(sketch: DataFrame) -> DataFrame:
    """Per language, source and metric the bins of all rows, with the mixed number of rows `upto` each.

    Merged sketches of the language and of all rows are laid over the group's own bins; a group has
    a few hundred rows. `total` is the number of all rows of the mixture.
    """
    keys = ["lang", "source", "metric"]
    of_lang = sketch.groupBy("lang", "metric", "low").agg(F.sum("n").alias("n"))
    of_all = sketch.groupBy("metric", "low").agg(F.sum("n").alias("n"))
    groups = sketch.select(*keys).distinct()
    none = F.lit(0).cast("long")
    own = sketch.select(*keys, "low", F.col("n").alias("own"), none.alias("lang_n"), none.alias("all_n"))
    lang = groups.alias("g").join(
        of_lang.alias("l"),
        F.col("g.lang").eqNullSafe(F.col("l.lang")) & (F.col("g.metric") == F.col("l.metric")),
    ).select("g.*", "l.low", none.alias("own"), F.col("l.n").alias("lang_n"), none.alias("all_n"))
    whole = groups.join(of_all, "metric").select(
        *keys, "low", none.alias("own"), none.alias("lang_n"), F.col("n").alias("all_n")
    )
    numbers = ("own", "lang_n", "all_n")
    cells = own.union(lang).union(whole).groupBy(*keys, "low").agg(*[F.sum(c).alias(c) for c in numbers])
    group = W.partitionBy(*keys)
    o, l, a = (F.sum(c).over(group.orderBy("low")).cast("double") for c in numbers)
    n, ln, an = (F.sum(c).over(group).cast("double") for c in numbers)
    pseudo = F.lit(PSEUDO)
    return cells.select(
        *keys,
        "low",
        (o + pseudo * ((l + pseudo * a / an) / (ln + pseudo))).alias("upto"),
        (n + pseudo).alias("total"),
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per language and source: the fences of every metric, from quantiles of its mixed sketch."""
    percent, reach = (
        F.element_at(F.create_map(*[F.lit(x) for m, pair in METRICS.items() for x in (m, pair[i])]), F.col("metric"))
        for i in (0, 1)
    )

    def at(wanted: Column) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("total") * wanted, F.col("low")))

    q = mixed(sketch).groupBy("lang", "source", "metric").agg(
        at(F.lit(50)).alias("middle"), at(percent).alias("tail"), at(100 - percent).alias("head")
    )
    # A value anywhere in the tail's first bin is as good as that bin.
    shift = F.greatest(F.length(F.bin("tail")) - 1 - BINS_LOG2, F.lit(0))
    q = q.withColumn("shift", shift).withColumn("tail", F.expr("tail + shiftleft(CAST(1 AS BIGINT), shift) - 1"))
    fences = q.select(
        "lang",
        "source",
        "metric",
        F.struct(
            (F.col("head") - reach * (F.col("middle") - F.col("head"))).alias("low"),
            (F.col("tail") + reach * (F.col("tail") - F.col("middle"))).alias("high"),
        ).alias("f"),
    )
    return fences.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("f"))).alias(f"fence_{m}") for m in METRICS]
    )


def apply_rules(docs: DataFrame) -> DataFrame:
    """Every document with its counts, `base_failed` and the verdict `kept`.

    Reads doc_id, text, lang and source only. Null and empty texts have no words and fail the
    base rule. A null language or source is a group of its own. Equal rows are judged alike.
    The thresholds come from all rows that the base rule leaves. An empty table gives no rows.
    """
    measured = stored(measure(docs).withColumn("m", metrics()), "features")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    fences = thresholds(sketches(measured.where(~failed)))
    joined = measured.alias("d").join(
        fences.alias("t"),
        F.col("d.lang").eqNullSafe(F.col("t.lang")) & F.col("d.source").eqNullSafe(F.col("t.source")),
        "left",
    )
    inside = F.lit(True)
    for m in METRICS:
        value, fence = F.col(f"d.m.{m}"), F.col(f"t.fence_{m}")
        inside = inside & F.coalesce(value <= fence["high"], F.lit(True))
        if m in TWO_SIDED:
            inside = inside & F.coalesce(value >= fence["low"], F.lit(True))
    return joined.select(
        "d.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & inside).alias("kept"),
        *[F.col(f"t.fence_{m}.high").alias(f"most_{m}") for m in METRICS],
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"))


SQL = r"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(words[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1))) AS i FROM w)
),
twice AS (SELECT doc_id, gram FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS place FROM windows JOIN twice USING (doc_id, gram)
  ) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
f AS (
  SELECT w.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(l.dup, 0) AS n_dup_lines, coalesce(l.n, 0) AS n_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN lines l ON l.doc_id = w.doc_id LEFT JOIN covered c ON c.doc_id = w.doc_id
),
m AS (
  SELECT doc_id, lang, source, n_words, n_repeat_words, unnest([
    {metric: 'word_length', v: CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END},
    {metric: 'symbols', v: CASE WHEN n_words > 0 THEN n_symbols * 1000 // n_words ELSE 0 END},
    {metric: 'dup_lines', v: CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END},
    {metric: 'repeats', v: CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END}
  ], recursive := true) FROM f
),
low AS (
  SELECT lang, source, metric,
    (v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0) AS low
  FROM m WHERE n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words
),
own AS (SELECT lang, source, metric, low, count(*) AS c FROM low GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source, metric FROM own),
grid AS (
  SELECT lang, source, metric, low, c AS o, 0 AS l, 0 AS a FROM own
  UNION ALL SELECT g.lang, g.source, g.metric, o.low, 0, o.c, 0
  FROM groups g JOIN own o ON o.lang IS NOT DISTINCT FROM g.lang AND o.metric = g.metric
  UNION ALL SELECT g.lang, g.source, g.metric, o.low, 0, 0, o.c FROM groups g JOIN own o ON o.metric = g.metric
),
cells AS (
  SELECT lang, source, metric, low, CAST(sum(o) AS DOUBLE) AS o, CAST(sum(l) AS DOUBLE) AS l, CAST(sum(a) AS DOUBLE) AS a
  FROM grid GROUP BY ALL
),
upto AS (
  SELECT lang, source, metric, low, sum(o) OVER u AS o, sum(l) OVER u AS l, sum(a) OVER u AS a,
    sum(o) OVER g AS n, sum(l) OVER g AS ln, sum(a) OVER g AS an
  FROM cells WINDOW u AS (PARTITION BY lang, source, metric ORDER BY low), g AS (PARTITION BY lang, source, metric)
),
mixed AS (
  SELECT lang, source, metric, low, o + 50.0::DOUBLE * ((l + 50.0::DOUBLE * a / an) / (ln + 50.0::DOUBLE)) AS upto,
    n + 50.0::DOUBLE AS total,
    CASE WHEN metric IN ('word_length', 'symbols') THEN 85 ELSE 98 END AS percent,
    CASE WHEN metric IN ('word_length', 'symbols') THEN 3 ELSE 1 END AS reach
  FROM upto
),
q AS (
  SELECT lang, source, metric, any_value(reach) AS reach, min(low) FILTER (upto * 100 >= total * 50) AS middle,
    min(low) FILTER (upto * 100 >= total * percent) AS tail, min(low) FILTER (upto * 100 >= total * (100 - percent)) AS head
  FROM mixed GROUP BY lang, source, metric
),
fences AS (
  SELECT lang, source, metric, head - reach * (middle - head) AS least, top + reach * (top - middle) AS most
  FROM (SELECT *, tail + (1::BIGINT << greatest(length(bin(tail)) - 5, 0)) - 1 AS top FROM q)
),
judged AS (
  SELECT m.doc_id, bool_and(coalesce(v <= most, true)
      AND (m.metric <> 'word_length' OR coalesce(v >= least, true))) AS inside,
    max(CASE WHEN m.metric = 'word_length' THEN most END) AS most_word_length,
    max(CASE WHEN m.metric = 'symbols' THEN most END) AS most_symbols,
    max(CASE WHEN m.metric = 'dup_lines' THEN most END) AS most_dup_lines,
    max(CASE WHEN m.metric = 'repeats' THEN most END) AS most_repeats
  FROM m LEFT JOIN fences t ON t.lang IS NOT DISTINCT FROM m.lang AND t.source IS NOT DISTINCT FROM m.source
    AND t.metric = m.metric
  GROUP BY m.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND inside AS kept,
  most_word_length, most_symbols, most_dup_lines, most_repeats
FROM f JOIN judged USING (doc_id)
"""
