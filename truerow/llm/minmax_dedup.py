"""Near-duplicate groups by min-max hashing (operator 5).

Each permutation gives two signature values, its minimum and its maximum over the shingles, so
64 multiplications make 128 values. Bands of four values find candidates; every link is
confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import BATCH_BYTES, only, row_key, split_documents, stored, table, texts_of
from truerow.llm.components import components
from truerow.llm.words import WordHashes, hashed_words, mixed, shingle_sets

WIDTH = 5
PERMUTATIONS = 64
#: Values in a band. A pair at 0.75 shares none of the 32 bands with probability 0.684^32 = 5e-6.
ROWS = 4
BANDS = 2 * PERMUTATIONS // ROWS
#: A link needs 100 * intersection >= 75 * union.
PERCENT = 75
#: Sets up to SHORT shingles find each other exactly: the bands of few shingles depend on each other. A
#: set of at most SHORT * 100 / PERCENT shingles also enters the buckets of its first shingles.
SHORT = 24
#: Candidates are told apart by a finer signature of 512 values, one byte each. At 0.75 its share of
#: equal values has a standard deviation of 0.019; pairs over four of them below (3e-5) are not confirmed.
FINE = 256
LEAST_EQUAL = 0.67
#: Members of a bucket that are compared with each other at once.
BLOCK = 2048

_ODD = mixed(np.arange(1, FINE + 1, dtype=np.uint64)) | np.uint64(1)


def signatures(values: np.ndarray, sizes: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Per non-empty set two values (uint32) of each permutation: in columns 2i and 2i+1 its min and max."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[sizes > 0]
    out = np.empty((len(starts), 2 * permutations), np.uint32)
    if len(starts):
        for i, odd in enumerate(_ODD[:permutations]):
            permuted = values * odd
            out[:, 2 * i] = np.minimum.reduceat(permuted, starts) >> np.uint64(32)
            out[:, 2 * i + 1] = np.maximum.reduceat(permuted, starts) >> np.uint64(32)
    return out


def _sets(batch: pa.RecordBatch, memory: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(*hashed_words(texts_of(batch), memory), WIDTH)


def _digests(values: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    ends = np.cumsum(sizes)
    return [
        xxhash.xxh3_128_digest(values[end - size : end].tobytes()) if size else None
        for end, size in zip(ends, sizes)
    ]


def first_shingles(own: np.ndarray) -> bytes | None:
    """Of a short set, the shingles of which every linked set has one among its own first.

    In any one order of all shingles, two sets that share at least PERCENT of their union share one
    of the first n - ceil(n * PERCENT / 100) + 1 shingles of each.
    """
    n = len(own)
    if not 0 < n * PERCENT <= SHORT * 100:
        return None
    return np.sort(own)[: n + (-n * PERCENT // 100) + 1].tobytes()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = WordHashes()
    for batch in split_documents(batches, BATCH_BYTES):
        values, sizes = _sets(batch, memory)
        rows = iter(signatures(values, sizes))
        signature = [next(rows).tobytes() if size else None for size in sizes]
        ends = np.cumsum(sizes)
        columns = [
            batch.column(0),
            batch.column(2),
            pa.array(sizes.astype(np.int64)),
            pa.array(_digests(values, sizes), pa.binary()),
            pa.array(signature, pa.binary()),
            pa.array([first_shingles(values[end - size : end]) for end, size in zip(ends, sizes)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "n_shingles", "digest", "signature", "firsts"])


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    values = signature[:, : 2 * PERMUTATIONS].astype(np.uint64)
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(values), 1))
    for i in range(ROWS):
        keys = mixed(keys + values[:, i::ROWS])
    return keys


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its whole set, the fine signature, and short band keys."""
    memory = WordHashes()
    for batch in split_documents(batches, BATCH_BYTES):
        values, sizes = _sets(batch, memory)
        ends = np.cumsum(sizes)
        full = [values[end - size : end].tobytes() for end, size in zip(ends, sizes)]
        signature = signatures(values, sizes, FINE)
        fine, short = iter(signature.astype(np.uint8)), iter(band_keys(signature).astype(np.uint32))
        columns = [
            batch.column(0),
            pa.array(_digests(values, sizes), pa.binary()),
            pa.array(full, pa.binary()),
            pa.array([next(fine).tobytes() if size else None for size in sizes], pa.binary()),
            pa.array([next(short).tobytes() if size else None for size in sizes], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "digest", "full", "fine", "keys"])


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            keys = band_keys(_matrix(part.column(1), np.uint32))
            rep = np.repeat(part.column(0).to_numpy(zero_copy_only=False), BANDS)
            band = np.tile(np.arange(BANDS, dtype=np.int32), len(keys))
            columns = [pa.array(keys.view(np.int64).ravel()), pa.array(band), pa.array(rep)]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "band", "rep"])
            firsts = [np.frombuffer(f or b"", np.uint64) for f in part.column(2).to_pylist()]
            sizes = [len(f) for f in firsts]
            # Shingles are hashes already; mixed again they are no keys of bands.
            shingles = mixed(np.concatenate(firsts) + np.uint64(BANDS)).view(np.int64)
            rep = np.repeat(part.column(0).to_numpy(zero_copy_only=False), sizes)
            columns = [pa.array(shingles), pa.array(np.full(len(rep), BANDS, np.int32)), pa.array(rep)]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "band", "rep"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough to be worth a look at the full sets."""
    for batch in batches:
        if batch.num_rows:
            equal = (_matrix(batch.column(2), np.uint8) == _matrix(batch.column(3), np.uint8)).mean(axis=1)
            yield batch.select([0, 1]).filter(pa.array(equal >= LEAST_EQUAL))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        links = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            links.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select([0, 1]).filter(pa.array(links, pa.bool_()))


def _pair_up(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """(a, b) with both sides' values. Values are unique per rep, so a hot side may be split."""
    first = values.select(F.col("rep").alias("a"), F.col(column).alias("of_a"))
    second = values.select(F.col("rep").alias("b"), F.col(column).alias("of_b"))
    return pairs.join(second, "b").join(first, "a").select("a", "b", "of_a", "of_b")


def _likely_pairs(band: int, rep, component, side, fine, keys) -> list[tuple[int, int]]:
    """The likely pairs between different components of one pair of blocks.

    A pair is looked at in the first band that it shares, and in every bucket of first shingles. Side 1
    is empty where a block meets itself.
    """
    out = []
    firsts = np.flatnonzero(side == 0)
    others = np.flatnonzero(side == 1)
    for place, x in enumerate(firsts):
        near = others if len(others) else firsts[place + 1 :]
        near = near[component[near] != component[x]]
        if len(near) and band < BANDS:
            near = near[(keys[near] == keys[x]).argmax(axis=1) == band]
        if len(near):
            near = near[(fine[near] == fine[x]).mean(axis=1) >= LEAST_EQUAL]
            out += [(min(rep[x], y), max(rep[x], y)) for y in rep[near]]
    return out


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (bucket, block, other) -> likely pairs. A group is at most two blocks."""

    def pairs_of(rows: pa.Table) -> pa.RecordBatch:
        ids = [rows.column(i).to_numpy() for i in range(7)]
        group = np.stack(ids[:3])
        rep, component, side, band = ids[4], ids[5], ids[3], ids[6]
        fine, keys = (_matrix(rows.column(i).combine_chunks(), t) for i, t in ((7, np.uint8), (8, np.uint32)))
        edges = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
        out = []
        for low, high in zip([0, *edges], [*edges, len(rep)]):
            at = slice(low, high)
            out += _likely_pairs(band[low], rep[at], component[at], side[at], fine[at], keys[at])
        a, b = zip(*out) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = np.stack([batch.column(i).to_numpy() for i in range(3)])
        changes = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
        if held and [c[-1].as_py() for c in held[-1].columns[:3]] != group[:, 0].tolist():
            yield pairs_of(pa.Table.from_batches(held))
            held = []
        if len(changes):  # the last group may go on in the next batch
            yield pairs_of(pa.Table.from_batches([*held, batch.slice(0, changes[-1])]))
            held = [batch.slice(changes[-1])]
        else:
            held.append(batch)
    if held:
        yield pairs_of(pa.Table.from_batches(held))


class Links:
    """Confirmed links between distinct shingle sets, found bucket by bucket."""

    def __init__(self, reps: DataFrame, docs: DataFrame):
        bands = reps.select("rep", "signature", "firsts").mapInArrow(_bands, "bucket long, band int, rep long")
        bands = stored(bands, "bands")
        shared = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        self.members = stored(bands.join(shared, "bucket"), "members")
        known = self.members.groupBy("rep").agg(F.sum("n").alias("degree"))
        self.known = stored(reps.join(known, "rep").select("rep", "doc", "digest", "degree"), "members-of-buckets")
        texts = docs.select(F.col("doc_id").alias("doc"), "text").join(self.known.select("doc"), "doc", "left_semi")
        full = texts.mapInArrow(
            _full_sets, "doc long, digest binary, full binary, fine binary, keys binary"
        ).join(self.known.select("doc", "digest", "rep"), ["doc", "digest"]).drop("doc")
        self.sets = stored(full.dropDuplicates(["rep"]).drop("digest"), "sets")
        self.links: DataFrame | None = None

    def confirm(self, pairs: DataFrame) -> None:
        """Confirm pairs (a < b) on full sets and keep the links."""
        links = stored(_pair_up(pairs, self.sets, "full").mapInArrow(_linked, "a long, b long"), "links")
        self.links = links if self.links is None else self.links.union(links)

    def with_leaders(self) -> None:
        """Everyone in a bucket against one leader: one pair per member.

        The leader is the member that shares most buckets with others. Of the copies of a text that
        is the text itself rather than one of its copies, which are less like each other.
        """
        members = self.members.join(self.known.select("rep", "degree"), "rep")
        best = members.groupBy("bucket").agg(F.max(F.struct("degree", -F.col("rep"))).alias("best"))
        leaders = best.select("bucket", (-F.col("best.col2")).alias("leader"))
        pairs = self.members.join(leaders, "bucket").where("leader <> rep").select(
            F.least("leader", "rep").alias("a"), F.greatest("leader", "rep").alias("b")
        )
        likely = _pair_up(pairs.distinct(), self.sets, "fine").mapInArrow(_similar, "a long, b long")
        self.confirm(stored(likely, "pairs"))

    def between_components(self) -> None:
        """All pairs of a bucket that no component joins yet, block by block.

        Only pairs with a member outside the bucket's largest component can be missing. The outsiders
        are cut into blocks of about BLOCK members, and so is the largest component; each pair of
        two blocks of outsiders, or of one and one of the largest, is a small group of its own. So a
        million near copies with one straggler are copied once. Every pair in every bucket is then
        either in one component, or unlikely, or tested on its full sets.
        """
        found = components(self.links).select(F.col("node").alias("rep"), "component")
        members = self.members.join(found, "rep", "left").select(
            "bucket", "band", "rep", F.coalesce("component", "rep").alias("component")
        )
        sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        open_ = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
        outer, inner = (F.floor(n / BLOCK).cast("long") + 1 for n in (F.col("all") - F.col("top.n"), F.col("top.n")))
        open_ = open_.where(F.col("all") > F.col("top.n")).select(
            "bucket", F.col("top.component").alias("largest"), outer.alias("outer"), inner.alias("inner")
        )
        outside = F.col("component") != F.col("largest")
        place = F.xxhash64("rep")
        block = F.when(outside, F.pmod(place, "outer")).otherwise(F.col("outer") + F.pmod(place, "inner"))
        cut = members.join(open_, "bucket").withColumn("block", block)
        cut = cut.join(self.sets.select("rep", "fine", "keys"), "rep")
        last = F.col("outer") + F.col("inner") - 1
        first = cut.where(outside).withColumn("other", F.explode(F.sequence("block", last))).withColumn("side", F.lit(0))
        second = cut.where("block > 0").withColumn("other", F.col("block")).withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("block"), F.col("outer")) - 1))
        ).withColumn("side", F.lit(1))
        columns = ["bucket", "block", "other", "side", "rep", "component", "band", "fine", "keys"]
        group = columns[:3]
        rows = first.select(columns).union(second.select(columns)).repartition(*group).sortWithinPartitions(*group)
        self.confirm(stored(rows.mapInArrow(_across, "a long, b long").distinct(), "pairs"))


def _grouped(docs: DataFrame) -> DataFrame:
    """Row by row: doc_id, the row's key, n_shingles, component, and whether it is linked with nothing by definition."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    described = "doc_id long, key binary, n_shingles long, digest binary, signature binary, firsts binary"
    rows = stored(docs.select("doc_id", "text", row_key().alias("key")).mapInArrow(_describe, described), "minmax")
    sets = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("doc"), F.first("signature").alias("signature"), F.first("firsts").alias("firsts")
    )
    # A set goes by its smallest doc_id. Where several texts have that doc_id, all but one go by a hash.
    named = stored(sets, "distinct-sets")
    owners = named.groupBy(F.col("doc").alias("owner")).agg(F.min("digest").alias("first"))
    by_hash = -F.shiftrightunsigned(F.xxhash64("digest"), 2) - (1 << 62)
    reps = named.join(owners, F.col("doc") == F.col("owner")).select(
        F.when(F.col("digest") == F.col("first"), F.col("doc")).otherwise(by_hash).alias("rep"),
        "doc", "digest", "signature", "firsts",
    )
    reps = stored(reps, "named-sets")
    found = Links(reps, docs)
    found.with_leaders()
    found.between_components()
    labels = components(found.links).select(F.col("node").alias("rep"), "component")
    of_set = reps.select("digest", "doc", "rep").join(labels, "rep", "left").select(
        "digest", "doc", F.coalesce("component", "rep").alias("label")
    )
    least = of_set.groupBy("label").agg(F.min("doc").alias("component"))
    of_set = of_set.join(least, "label").select("digest", "component")
    alone = F.col("digest").isNull() | F.col("doc_id").isNull()
    return rows.join(of_set, "digest", "left").select(
        "doc_id", "key", "n_shingles", "component", alone.alias("alone")
    )


def near_groups(docs: DataFrame) -> DataFrame:
    """Every document with its shingle count and the smallest doc_id of its near-duplicate group.

    Reads `doc_id` (long) and `text`. Equal sets are one row until the end, so thousands of
    copies cost no comparisons. A null or empty text, or one of spaces, has no shingles and is
    linked with nothing; a row without doc_id is a group of its own (component null, kept).
    Repeated rows get the same answer. An empty table gives no rows.
    """
    return _grouped(docs).select(
        "doc_id",
        "n_shingles",
        F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        (F.col("alone") | (F.col("doc_id") == F.col("component"))).alias("kept"),
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each near-duplicate group, with all its columns, whatever their names.

    Of a group the row with its smallest doc_id stays, of several such rows one (by the hash of the
    text). Rows without a shingle or a doc_id stay, repeated ones once. An empty table gives no rows.
    """
    rows = _grouped(docs)
    best = rows.where("NOT alone").groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("best"))
    return only(docs, rows.where("alone").select("key").union(best.select("best.key")))


def op5_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * common >= 75 * (p.n + q.n - common)
),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT r.a AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""
