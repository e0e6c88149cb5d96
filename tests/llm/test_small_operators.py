"""URL cascade, sharding, exact deduplication and quality rules against brute force."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import documents  # noqa: F401  (tests/llm/conftest.py)
from truerow.llm import exact_dedup, quality_rules, sharding, url_cascade

SPACE = "[\\x20\\x09-\\x0D]"


# -- URL cascade ---------------------------------------------------------------------------------

URLS = [
    "http://WWW.Example.com/en/x?q=/es/", "https://a.example.com/en/", "https://example.com/en", "ftp://com/", "x://net/es/1",
    "x://a.b.net/fr/#f", "x://net", "nothing", None, "", "x://", "x://Ünet/es/", "x://notnet/es/", "a://b://net/es/y",
    "x://a.com?/", "x://.com/", "x://www.example.com/EN/", "x://" + "l." * 2000 + "net/es/", "x://net/es/1",
]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, tail = re.match(r"(?s)([^/?#]*)(.*)", rest).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = re.match(r"(?s)[^?#]*", tail)[0]
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("rules", [url_cascade.RULES, ()])
def test_urls(spark, rules):
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string, keys string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_cascade.judge(pages, rules).collect()}
    assert got == {i: judged(u, rules) for i, u in enumerate(URLS)}
    assert url_cascade.judge(pages.limit(0), rules).count() == 0


def test_cascade_is_exact_with_tiny_filters(spark, monkeypatch):
    """Three bits per key give many false keys, which the next levels must undo."""
    monkeypatch.setattr(url_cascade, "BITS_PER_KEY", 3)
    keys = spark.range(3000).select(F.col("id").cast("string").alias("key"))
    listed = keys.where("key % 7 = 0")
    levels = url_cascade.build(listed, keys)
    assert len(levels) > 2
    got = keys.where(url_cascade.contains(levels, F.col("key")))
    assert {r.key for r in got.collect()} == {str(i) for i in range(0, 3000, 7)}


def test_filter_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(url_cascade, "MOST_BYTES", 64)
    with pytest.raises(ValueError, match="limit"):
        url_cascade.encode(spark.range(1000).select(F.col("id").cast("string").alias("key")), 0)


# -- sharding ------------------------------------------------------------------------------------


def winner(doc_id, weights):
    import math

    draws = []
    for shard, weight in enumerate(weights):
        seed = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed)
        draws.append((-weight / math.log(((h >> 11) + 0.5) / 2**53), shard))
    return max(draws)[1]


@pytest.mark.parametrize("weights", [[1.0] * 24, [1.0, 3.0, 0.5], [2.0]])
def test_shards(spark, odd_documents, weights):
    rows = sharding.shard_documents(odd_documents, weights, slices=4).collect()
    texts = {(r.doc_id, zlib.crc32((r.text or "").encode())): r.text or "" for r in odd_documents.collect()}
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert r.size == len(texts[r.doc_id, r.text_crc32].encode()) + 8 and r.law == "key"
        assert r.shard == winner(r.doc_id, weights)
        assert r.grown_shard in (r.shard, len(weights)) and r.grown_shard == winner(r.doc_id, [*weights, weights[-1]])
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_shards_follow_weights_and_need_them(spark, no_documents):
    ids = spark.range(20_000).select(sharding.rendezvous(F.col("id"), [1.0, 3.0]).alias("s"))
    share = ids.where("s = 1").count() / 20_000
    assert abs(share - 0.75) < 0.02
    assert sharding.shard_documents(no_documents, [1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [1.0, 0.0])


# -- exact deduplication -------------------------------------------------------------------------


def copies(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(SPACE, "", t or ""), []).append((-len(t or ""), i is not None, i or 0, i))
    out = []
    for i, t in rows:
        plain = re.sub(SPACE, "", t or "")
        keep = min(groups[plain])[3]
        out.append((i, keep, len(groups[plain]), i == keep, hashlib.sha256(plain.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_exact_copies(odd_documents, odd_texts, rounds):
    got = exact_dedup.mark_copies(odd_documents.repartition(5), rounds)
    assert Counter(tuple(r) for r in got.collect()) == copies(odd_texts)


def test_without_copies_keeps_one_row_each(odd_documents, odd_texts, no_documents):
    got = exact_dedup.without_copies(odd_documents)
    assert got.schema.names == odd_documents.schema.names
    plain = [re.sub(SPACE, "", r.text or "") for r in got.collect()]
    assert sorted(plain) == sorted({re.sub(SPACE, "", t or "") for _, t in odd_texts})
    assert exact_dedup.mark_copies(no_documents).count() == 0


# -- quality rules -------------------------------------------------------------------------------


def counts(text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\\x20\\x09-\\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts(spark, odd_documents, odd_texts, no_documents):
    got = quality_rules.apply_rules(odd_documents).collect()
    mine = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert mine == Counter((i, *counts(t)) for i, t in odd_texts)
    assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.apply_rules(no_documents).count() == 0


def test_thresholds_follow_the_group(spark):
    """A source that is written in other words has its own fences; an outlier in it goes."""
    rows = []
    for i in range(600):
        word = "abcd" if i % 2 else "abcdefghijklmnop"
        rows.append((i, " ".join(f"{word}{j}" for j in range(40)), "en", "short" if i % 2 else "long", 0))
    rows += [(1000, " ".join(f"abcdefghijklmnop{j}" for j in range(40)), "en", "short", 0)]
    rows += [(1001, " ".join(f"###abcd{j}" for j in range(40)), "en", "short", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs).collect()}
    assert not out.pop(1000) and not out.pop(1001) and all(out.values())


def test_mixed_sketches(spark):
    """A group's mixed counts are its own, plus its language's, plus all rows', each by its weight."""
    rng = random.Random(5)
    rows = [(rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", None]), rng.choice([3, 7, 900])) for _ in range(400)]
    names = list(quality_rules.METRICS)
    frame = spark.createDataFrame(rows, "lang string, source string, v long").select(
        "lang", "source", F.lit(50).alias("n_words"), F.struct(*[F.col("v").alias(m) for m in names]).alias("m")
    )
    k, low = quality_rules.PSEUDO, {3: 3, 7: 7, 900: 896}

    def share(chosen, upto):
        return sum(low[v] <= upto for v in chosen), len(chosen)

    for r in quality_rules.mixed(quality_rules.sketches(frame)).where(F.col("metric") == names[0]).collect():
        own, n = share([v for l, s, v in rows if (l, s) == (r.lang, r.source)], r.low)
        of_lang, n_lang = share([v for l, _, v in rows if l == r.lang], r.low)
        of_all, n_all = share([v for _, _, v in rows], r.low)
        assert r.total == n + k
        assert abs(r.upto - (own + k * (of_lang + k * of_all / n_all) / (n_lang + k))) < 1e-9


def test_every_fence_moves_with_its_group(spark):
    """Groups that differ in one metric get different fences for it; a large group hardly feels the others."""
    rows = []
    for i in range(3000):
        loud = i % 2
        words = [f"w{i}x{j}" + ("#" if loud and j < i % 9 + 3 else "") + ("yy" * (i % 4) if loud else "") for j in range(40)]
        lines = [" ".join(words[j : j + 4]) for j in range(0, 40, 4)]
        repeated = (i % 11) // 4 if loud else 0
        lines += lines[:repeated]
        rows.append((i, "\n".join(lines), "en", "loud" if loud else "calm", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    of = {r.source: r for r in quality_rules.thresholds(quality_rules.sketches(quality_rules.measure(docs).withColumn("m", quality_rules.metrics()))).collect()}
    for m in quality_rules.METRICS:
        assert of["loud"][f"fence_{m}"].high > of["calm"][f"fence_{m}"].high, m
