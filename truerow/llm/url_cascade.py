"""URL filter by a Bloom filter cascade (operator 6), in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import LOWER, UPPER, stored, table

#: verdict, host, path; a rule's key is host and path together.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
HASHES = 4
BITS_PER_KEY = 10
#: Each level's bits go to all tasks as one value, so their size is checked.
MOST_BYTES = 64 << 20


@dataclass(frozen=True)
class Level:
    words: DataFrame
    n_words: int


def with_parts(pages: DataFrame) -> DataFrame:
    """`host` and `path` of each url; both empty for a null url or one without `://`."""
    found = F.locate("://", F.col("url"))
    rest = F.when(found > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return pages.select(
        "page_id",
        F.translate(host, UPPER, LOWER).alias("host"),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def candidates(shapes: Sequence[tuple[int, int]]) -> list[Column]:
    """The keys by which a rule could fit the url, one (or null) for each shape of rules.

    A rule of so many labels and path characters can only fit by one key: the host's last
    labels with the path's first characters. Keys of no rule's shape need no test.
    """
    labels = F.size(F.split("host", r"\."))
    return [
        F.when(
            (labels >= n_labels) & (F.length("path") >= n_path),
            F.concat(F.substring_index("host", ".", -n_labels), F.substring("path", 1, n_path)),
        )
        for n_labels, n_path in shapes
    ]


def _bit(key: Column, level: int, i: int, n_words: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(64 * n_words))


def encode(keys: DataFrame, level: int) -> Level:
    """A Bloom filter of the column `key` as one row with an array of 64-bit words."""
    n_words = max(1, -(-keys.count() * BITS_PER_KEY // 64))
    if 8 * n_words > MOST_BYTES:
        raise ValueError(f"A level of {8 * n_words} bytes is over the limit of {MOST_BYTES}.")
    bits = keys.select(
        F.explode(F.array(*[_bit(F.col("key"), level, i, n_words) for i in range(HASHES)])).alias("bit")
    )
    ones = bits.select(
        F.floor(F.col("bit") / 64).alias("id"),
        F.expr("shiftleft(1L, CAST(bit % 64 AS INT))").alias("word"),
    )
    blank = keys.sparkSession.range(n_words).withColumn("word", F.lit(0).cast("long"))
    words = blank.union(ones).groupBy("id").agg(F.bit_or("word").alias("word"))
    ordered = F.sort_array(F.collect_list(F.struct("id", "word")))
    return Level(stored(words.agg(F.transform(ordered, lambda w: w["word"]).alias("words")), "bloom"), n_words)


def passes(level: Level, number: int, key: Column) -> Column:
    """Whether all bits of a key are set. The words enter the plan as a scalar subquery."""
    words = level.words.select("words").scalar()

    def is_set(i: int) -> Column:
        bit = _bit(key, number, i, level.n_words)
        word = F.element_at(words, (F.floor(bit / 64) + 1).cast("int"))
        return F.getbit(word, (bit % 64).cast("int")) == 1

    test = is_set(0)
    for i in range(1, HASHES):
        test = test & is_set(i)
    return test


def build(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels that together tell exactly which keys of the universe are listed.

    Level 1 encodes the listed keys, level 2 the other keys of the universe that level 1 lets
    pass, level 3 the listed keys that level 2 lets pass, and so on until none pass. Each level
    is a fraction of the one before. Keys outside the universe need no level: the universe
    holds every key that will be asked for.
    """
    inside = listed.select("key").distinct()
    outside = universe.select("key").distinct().join(inside, "key", "left_anti")
    levels: list[Level] = []
    while not inside.isEmpty():
        levels.append(encode(inside, len(levels)))
        wrong = stored(outside.where(passes(levels[-1], len(levels) - 1, F.col("key"))), "false-keys")
        inside, outside = wrong, inside
    return levels


def contains(levels: Sequence[Level], key: Column) -> Column:
    """Exact membership: a key is listed if the first level that stops it has an even number."""
    test = F.lit(False)
    for number in reversed(range(len(levels))):
        test = passes(levels[number], number, key) & ~test
    return test


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Every page with host, path, the rule that decides and the verdict.

    Reads `page_id` and `url` only. Rows that repeat are judged alike; very long hosts cost
    only the labels that some rule has. A page that no rule fits is allowed: its keys are not
    listed. Of rules with one host and path, block wins. An empty table, or no rules, is fine.
    """
    spark = pages.sparkSession
    shapes = sorted({(host.count(".") + 1, len(path)) for _, host, path in rules})
    keyed = with_parts(pages).select("*", F.array(*candidates(shapes)).cast("array<string>").alias("keys"))
    universe = stored(
        keyed.select(F.explode("keys").alias("key")).where("key IS NOT NULL").distinct(), "url-keys"
    )

    def levels(verdict: str) -> list[Level]:
        keys = [(host + path,) for v, host, path in rules if v == verdict]
        return build(spark.createDataFrame(keys, "key string"), universe)

    blocked, allowed = levels("block"), levels("allow")

    def hit(i: int) -> Column:
        key = F.col("keys")[i]
        block = F.coalesce(contains(blocked, key), F.lit(False))
        listed = block | contains(allowed, key)
        return F.when(listed, F.struct(F.length(key).alias("length"), key.alias("key"), block.alias("block")))

    hits = F.array_compact(F.array(*[hit(i) for i in range(len(shapes))])) if shapes else None
    best = F.array_max(hits) if shapes else F.lit(None).cast("struct<length int, key string, block boolean>")
    return keyed.select("page_id", "host", "path", best.alias("best")).select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.when(F.col("best.block"), "block").otherwise("allow").alias("verdict"),
    )


def op6_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


SQL = r"""
WITH r(verdict, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
s AS (
  SELECT page_id, CASE WHEN contains(url, '://')
    THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s
),
m AS (
  SELECT p.page_id, p.host, p.path, r.rhost || r.rpath AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rhost || r.rpath) DESC) AS k
  FROM p LEFT JOIN r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost))
    AND starts_with(p.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""
