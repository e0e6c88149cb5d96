"""Removal of repeated passages by deep-shallow suffix sorting (operator 1).

Every string of `span` bytes that starts in two places is removed from both. Sorting the suffixes
of all bytes would move hundreds of bytes per byte; a sparse set of suffixes is enough. Of the
positions in a span at which `gram` bytes can start (201 for 200 in 400), the one whose hash is smallest
is the span's anchor. Equal spans have their anchor at the same place, so all copies of a
repeated span meet among the suffixes (and the reversed prefixes) of equal anchors. Those are
sorted within their group: multikey quicksort to a shallow depth, blind tries below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import BATCH_BYTES, plain_names, release, row_key, split_documents, stored, table, texts_of
from truerow.llm.words import mixed


@dataclass(frozen=True)
class Lengths:
    """Bytes of a span, the shortest passage that is removed, and of an anchor inside it."""

    span: int = 400
    gram: int = 200

    def __post_init__(self):
        if not 0 < self.gram <= self.span <= LONGEST:
            raise ValueError(f"0 < gram <= span <= {LONGEST} is needed.")

    @property
    def places(self) -> int:
        """Anchor positions in a span."""
        return self.span - self.gram + 1

    @property
    def before(self) -> int:
        """Bytes before an anchor that a span can hold."""
        return self.span - self.gram


LONGEST = 4096
#: Words of eight bytes that multikey quicksort looks at before blind tries take over.
SHALLOW = 4
#: Groups with more different surroundings are split by their spans instead.
MOST_KINDS = 50_000
#: Window starts handled at once.
CHUNK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_FORTH = _powers(int(_BASE), CHUNK + LONGEST + 1)
_BACK = _powers(pow(int(_BASE), -1, 1 << 64), CHUNK + LONGEST + 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A rolling hash of the `gram` bytes from each position."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * _FORTH[: len(data)], out=sums[1:])
    n = len(data) - gram + 1
    return mixed((sums[gram:] - sums[:n]) * _BACK[:n])


def sliding_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours, from block-wise minima to the left and right."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, ~np.uint64(0), np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, ends: np.ndarray, lengths: Lengths) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all spans that lie in one text.

    `data` holds texts end to end, `ends` where each stops. Equal hashes in a span are told
    apart by position, leftmost first, so the choice depends on the span's bytes alone.
    """
    span = lengths.span
    inside = np.ones(max(len(data) - span + 1, 0), bool)
    start = 0
    for end in ends.tolist():
        inside[max(start, end - span + 1) : end] = False
        start = end
    places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    low = np.uint64((1 << 24) - 1)
    for first in range(0, len(inside), CHUNK):
        n = min(CHUNK, len(inside) - first)
        if not inside[first : first + n].any():
            continue
        found = gram_hashes(data[first : first + n + span - 1], lengths.gram)
        keys = (found & ~low) | np.arange(len(found), dtype=np.uint64)
        chosen = (sliding_minima(keys, lengths.places)[inside[first : first + n]] & low).astype(np.int64)
        new = np.ones(len(chosen), bool)
        new[1:] = chosen[1:] != chosen[:-1]
        chosen = chosen[new]
        places.append(first + chosen)
        hashes.append(found[chosen])
    place, found = np.concatenate(places), np.concatenate(hashes)
    place, once = np.unique(place, return_index=True)
    return place, found[once]


def _anchor_rows(lengths: Lengths):
    """key, text -> key, gram, around, place: anchors and the hash of all bytes around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_documents(batches, BATCH_BYTES):
            texts = texts_of(batch)
            data = b"".join(texts)
            ends = np.cumsum([len(t) for t in texts])
            starts = ends - [len(t) for t in texts]
            place, gram = anchors(np.frombuffer(data, np.uint8), ends, lengths)
            doc = np.searchsorted(ends, place, side="right")
            lows = np.maximum(place - lengths.before, starts[doc])
            highs = np.minimum(place + lengths.span, ends[doc])
            around = np.fromiter(
                (
                    xxhash.xxh3_64_intdigest(data[low:high], at - low)
                    for low, high, at in zip(lows.tolist(), highs.tolist(), place.tolist())
                ),
                np.uint64,
                len(place),
            )
            columns = [
                batch.column(0).take(pa.array(doc)),
                pa.array(gram.view(np.int64)),
                pa.array(around.view(np.int64)),
                pa.array((place - starts[doc]).astype(np.int32) if len(place) else np.empty(0, np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "gram", "around", "place"])

    return run


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd, so that their shuffle is a third of their size. The first columns stay."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in split_documents(batches):
        at = batch.schema.get_field_index("text")
        column = pa.array([squeeze.compress(t) for t in texts_of(batch)], pa.binary())
        yield batch.set_column(at, "packed", column)


def _surroundings(lengths: Lengths):
    """packed, kinds -> one row per kind: its bytes before and after the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in range(batch.num_rows):
                text = open_.decompress(batch.column(1)[row].as_py())
                rows = []
                for kind in batch.column(2)[row].as_py():
                    at = kind["place"]
                    rows.append((kind["gram"], kind["around"], text[max(0, at - lengths.before) : at], text[at : at + lengths.span]))
                gram, around, before, after = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram, pa.int64()), pa.array(around, pa.int64()), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                    names=["gram", "around", "before", "after"],
                )

    return run


def blind_trie_order(rows: list[int], bits: int) -> list[int]:
    """The sorted order of equally long bit strings by a blind trie.

    A node only knows the bit at which its two halves part. A new string walks down without
    comparing the bits in between, meets some leaf, and one comparison with that leaf tells the
    true branching bit. Long common prefixes are thus looked at once per string.
    """
    root: list | int = 0
    same: dict[int, list[int]] = {0: [0]}
    for i in range(1, len(rows)):
        own, node = rows[i], root
        while isinstance(node, list):
            node = node[1 + (own >> (bits - 1 - node[0]) & 1)]
        differing = own ^ rows[node]
        if not differing:
            same[node].append(i)
            continue
        bit = bits - differing.bit_length()
        same[i] = [i]
        parent, side, node = None, 0, root
        while isinstance(node, list) and node[0] < bit:
            parent, side = node, 1 + (own >> (bits - 1 - node[0]) & 1)
            node = node[side]
        one = own >> (bits - 1 - bit) & 1
        branch = [bit, node, i] if one else [bit, i, node]
        if parent is None:
            root = branch
        else:
            parent[side] = branch
    order: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack += [node[2], node[1]]
        else:
            order += same[node]
    return order


def deep_shallow_sort(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of byte rows within ascending groups, and each one's common prefix with the row
    before it (-1 for the first of a group).

    All groups are partitioned at once: a round splits every run of so far equal rows by its next
    eight bytes, and only runs of several rows stay. After SHALLOW rounds the runs left
    share a long prefix; each is ordered by a blind trie.
    """
    n, width = rows.shape
    words = np.zeros((n, -(-width // 8) * 8), np.uint8)
    words[:, :width] = rows
    words = words.view(">u8")
    order = np.argsort(group, kind="stable")
    run = np.cumsum(np.concatenate([[0], (np.diff(group[order]) != 0).astype(np.int64)]))[:n]
    open_ = np.arange(n)  # places in `order` whose run has several rows
    for depth in range(min(SHALLOW, words.shape[1])):
        sizes = np.bincount(run)
        open_ = open_[sizes[run[open_]] > 1]
        if not len(open_):
            break
        chosen = order[open_]
        by = np.lexsort((words[chosen, depth], run[open_]))
        order[open_] = chosen[by]
        value = words[order[open_], depth].astype(np.uint64)
        apart = np.zeros(n, np.int64)
        apart[open_[1:]] = (value[1:] != value[:-1]) & (run[open_[1:]] == run[open_[:-1]])
        starts = np.zeros(n, np.int64)
        starts[1:] = run[1:] != run[:-1]
        run = np.cumsum(starts | apart)
    sizes = np.bincount(run, minlength=1)
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for first, size in zip(firsts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        chosen = order[first : first + size]
        tails = [int.from_bytes(rows[i, 8 * SHALLOW :].tobytes()) for i in chosen]
        order[first : first + size] = chosen[blind_trie_order(tails, 8 * max(width - 8 * SHALLOW, 0))]
    common = np.full(n, -1)
    if n > 1:
        one, two = rows[order[1:]], rows[order[:-1]]
        differ = one != two
        length = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        common[1:] = np.where(group[order[1:]] == group[order[:-1]], length, -1)
    return order, common


def repeated_range(
    group: np.ndarray, before: list[bytes], after: list[bytes], lengths: Lengths
) -> tuple[np.ndarray, np.ndarray]:
    """For each kind the first and last byte offset, from the anchor, of spans that another kind of
    its group also has; first > last if there is none.

    Spans begin 0 to `lengths.before` bytes left of the anchor. At each such distance two kinds share a
    span if they are neighbours, without a shorter common prefix between, in the order of
    reversed prefixes to that distance and in the order of suffixes to the rest of the span.
    """
    n, span, gram, reach = len(group), lengths.span, lengths.gram, lengths.before
    left = np.zeros((n, reach), np.uint8)
    right = np.zeros((n, reach), np.uint8)
    for i, (b, a) in enumerate(zip(before, after)):
        left[i, : len(b)] = np.frombuffer(b, np.uint8)[::-1]
        right[i, : max(len(a) - gram, 0)] = np.frombuffer(a, np.uint8)[gram:]
    n_left = np.fromiter(map(len, before), np.int64, n)
    n_right = np.fromiter(map(len, after), np.int64, n)
    # All of a group share the anchor's `gram` bytes; a false group is told apart by its hash.
    same = np.fromiter((xxhash.xxh3_64_intdigest(a[:gram]) for a in after), np.uint64, n)
    group = np.unique(np.stack([group.astype(np.uint64), same]), axis=1, return_inverse=True)[1].ravel()
    by_left, common_left = deep_shallow_sort(group, left)
    by_right, common_right = deep_shallow_sort(group, right)
    first, last = np.full(n, reach + 1), np.full(n, -1)
    class_left, class_right = np.empty(n, np.int64), np.empty(n, np.int64)
    for distance in range(reach + 1):
        class_left[by_left] = np.cumsum(common_left < distance)
        class_right[by_right] = np.cumsum(common_right < span - distance - gram)
        usable = np.flatnonzero((n_left >= distance) & (n_right >= span - distance))
        key = class_left[usable] * (n + 1) + class_right[usable]
        order = np.argsort(key, kind="stable")
        equal = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(usable), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        hit = usable[twice]
        first[hit] = np.minimum(first[hit], distance)
        last[hit] = distance
    return -last, np.where(last < 0, -last - 1, span - first)


def _sorted_groups(lengths: Lengths):
    """gram, around, before, after, in order of gram -> gram, around, start, stop."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish(rows: pa.Table) -> pa.RecordBatch:
            group = rows.column(0).to_numpy().view(np.uint64)
            start, stop = repeated_range(group, rows.column(2).to_pylist(), rows.column(3).to_pylist(), lengths)
            found = pa.array(start < stop)
            columns = [rows.column(0).combine_chunks(), rows.column(1).combine_chunks(), pa.array(start, pa.int32()), pa.array(stop, pa.int32())]
            return pa.RecordBatch.from_arrays(columns, names=["gram", "around", "start", "stop"]).filter(found)

        for batch in batches:
            if not batch.num_rows:
                continue
            grams = batch.column(0).to_numpy()
            edge = np.searchsorted(grams, grams[-1])  # the last group may go on in the next batch
            if edge:
                yield finish(pa.Table.from_batches([*held, batch.slice(0, edge)]))
                held = []
            elif held and held[-1].column(0)[-1].as_py() != grams[0]:
                yield finish(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(edge))
        if held:
            yield finish(pa.Table.from_batches(held))

    return run


def _spans_of(lengths: Lengths):
    """The way for very large groups: one row per span instead of one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                whole, at = row["before"] + row["after"], len(row["before"])
                distances = range(max(0, lengths.span - len(row["after"])), at + 1)
                spans = [xxhash.xxh3_64_intdigest(whole[at - d : at - d + lengths.span]) - (1 << 63) for d in distances]
                n = len(spans)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["gram"]] * n, pa.int64()), pa.array([row["around"]] * n, pa.int64()), pa.array(list(distances), pa.int32()), pa.array(spans, pa.int64())],
                    names=["gram", "around", "distance", "span"],
                )

    return run


def _by_spans(kinds: DataFrame, lengths: Lengths) -> DataFrame:
    spans = stored(kinds.mapInArrow(_spans_of(lengths), "gram long, around long, distance int, span long"), "spans")
    # At one distance: the same span seen from two anchors of one text is no second occurrence.
    twice = spans.groupBy("gram", "distance", "span").count().where("count > 1").drop("count")
    return spans.join(twice, ["gram", "distance", "span"]).groupBy("gram", "around").agg(
        (-F.max("distance")).alias("start"), (lengths.span - F.min("distance")).alias("stop")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows that repeat share a key, and also the answer."""
    return docs.select(row_key().alias("key"), "doc_id", "text")


def repeated_places(docs: DataFrame, lengths: Lengths = Lengths(), most_kinds: int = MOST_KINDS) -> DataFrame:
    """(key, place, start, stop): anchors whose spans also stand elsewhere, and the byte range
    around each that these spans cover (beyond the text's ends where it is short)."""
    keyed = _keyed(docs)
    found = stored(
        keyed.select("key", "text").mapInArrow(_anchor_rows(lengths), "key binary, gram long, around long, place int"), "anchors"
    )
    kinds = found.groupBy("gram", "around").agg(F.count("*").alias("n"))
    kinds = stored(kinds.join(_repeated_grams(kinds), "gram"), "kinds")
    # Most anchors occur once; from here on only the others are moved.
    own = kinds.select("gram", "around", F.expr("n_kinds > 1 AND singles > 0").alias("compared"))
    repeated = stored(found.join(own, ["gram", "around"]), "repeated")
    release(found)
    # Equal surroundings: every span around the anchor stands elsewhere.
    twice = kinds.where("n > 1").select(
        "gram", "around", F.lit(-lengths.before).alias("start"), F.lit(lengths.span).alias("stop")
    )
    # Groups with single surroundings: compare all different surroundings of the anchor.
    one = repeated.where("compared").groupBy("gram", "around").agg(F.min(F.struct("key", "place")).alias("one"))
    wanted = one.groupBy("one.key").agg(
        F.collect_list(F.struct("gram", "around", "one.place")).alias("kinds")
    )
    packed = keyed.select("key", "text").mapInArrow(_compressed, "key binary, packed binary").dropDuplicates(["key"])
    around = packed.join(wanted, "key").mapInArrow(
        _surroundings(lengths), "gram long, around long, before binary, after binary"
    )
    sizes = kinds.select("gram", "around", "n", "n_kinds")
    around = stored(around.join(sizes, ["gram", "around"]), "surroundings")
    small = around.where(F.col("n_kinds") <= most_kinds).drop("n", "n_kinds").repartition("gram").sortWithinPartitions("gram")
    single = small.mapInArrow(_sorted_groups(lengths), "gram long, around long, start int, stop int")
    single = single.union(_by_spans(around.where(F.col("n_kinds") > most_kinds).drop("n", "n_kinds"), lengths))
    single = single.join(kinds.where("n = 1").select("gram", "around"), ["gram", "around"], "left_semi")
    single = stored(single, "single-ranges")
    release(around)
    ranges = repeated.join(twice.union(single), ["gram", "around"]).select("key", "place", "start", "stop")
    ranges = stored(ranges, "ranges")
    release(repeated, kinds, single)
    return ranges


def _repeated_grams(kinds: DataFrame) -> DataFrame:
    per_gram = kinds.groupBy("gram").agg(
        F.sum("n").alias("all"), F.count("*").alias("n_kinds"), F.count_if(F.col("n") == 1).alias("singles")
    )
    return per_gram.where(F.col("all") > 1).select("gram", "n_kinds", "singles")


def merged(ranges: np.ndarray) -> np.ndarray:
    """Disjoint, not touching ranges [start, stop) with the same bytes, in order."""
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.ones(len(ranges), bool)
    new[1:] = ranges[1:, 0] > reach[:-1]
    return np.column_stack([ranges[new, 0], np.append(reach[:-1][new[1:]], reach[-1:])])


CUT = (
    "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>, text string"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[list[int]], bytes]]:
    """The text, its removed ranges, and the rest, of each row with `packed` and `ranges`."""
    open_ = zstandard.ZstdDecompressor()
    packed, ranges = (batch.column(batch.schema.get_field_index(c)) for c in ("packed", "ranges"))
    for row in range(batch.num_rows):
        text = open_.decompress(packed[row].as_py())
        spans = []
        if ranges[row].as_py():
            found = ranges[row].values
            start, stop = (found.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            spans = merged(np.clip(np.column_stack([start, stop]), 0, len(text))).tolist()
        kept, at = [], 0
        for start, stop in spans:
            kept.append(text[at:start])
            at = stop
        yield text, spans, b"".join([*kept, text[at:]])


def _measure_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, packed, ranges -> what is removed, and what is left."""
    for batch in batches:
        rows = [
            (len(text), len(text) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(),
             [{"start": a, "stop": b} for a, b in spans], rest.decode("utf-8", "ignore"))
            for text, spans, rest in _pieces(batch)
        ]
        types = [pa.int64()] * 3 + [pa.string(), _SPANS, pa.string()]
        columns = [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, types)]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "text"]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)


def _take_cuts(names: list[str], length: str | None):
    """The columns of the documents, with what is left of the text, and its length in characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [rest.decode("utf-8", "ignore") for _, _, rest in _pieces(batch)]
            columns = []
            for at, name in enumerate(names):
                if name == "text":
                    columns.append(pa.array(rest, pa.string()))
                elif name == length:
                    columns.append(pa.array([len(t) for t in rest]).cast(batch.column(at).type))
                else:
                    columns.append(batch.column(at))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _with_ranges(docs: DataFrame, columns: list[str], lengths: Lengths, most_kinds: int) -> DataFrame:
    """The columns, `text` packed, and the ranges to remove; the texts are shuffled once.

    The columns beside doc_id and text must not be named key, packed or ranges.
    """
    ranges = repeated_places(docs, lengths, most_kinds).select(
        "key",
        F.struct(
            (F.col("place") + F.col("start")).cast("long").alias("start"),
            (F.col("place") + F.col("stop")).cast("long").alias("stop"),
        ).alias("r"),
    )
    per_key = ranges.groupBy("key").agg(F.collect_set("r").alias("ranges"))
    keyed = docs.select(row_key().alias("key"), *columns)
    fields = ", ".join(
        "packed binary" if f.name == "text" else f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema
    )
    return keyed.mapInArrow(_compressed, fields).join(per_key, "key", "left").drop("key")


def remove_repeats(docs: DataFrame, lengths: Lengths = Lengths(), most_kinds: int = MOST_KINDS) -> DataFrame:
    """Every document with what is removed of it: sizes, spans, the hash of what is left, and the text left.

    Reads `doc_id` and `text`. A null text is empty; texts shorter than a span lose nothing. A
    row that repeats another (same doc_id and text) is a second document, so both lose all spans.
    Of a character that a span's end cuts in two nothing stays in the text; sizes and hash are of
    the bytes. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return _with_ranges(docs, ["doc_id", "text"], lengths, most_kinds).mapInArrow(_measure_cuts, f"doc_id long, {CUT}")


def without_repeats(docs: DataFrame, lengths: Lengths = Lengths(), most_kinds: int = MOST_KINDS) -> DataFrame:
    """The documents with all their columns and what is left of their texts; n_chars follows.

    Null texts become empty. Of a character that a span's end cuts in two nothing stays. No row is
    dropped; rows that repeat lose the same. Columns may have any names.
    """
    own = plain_names(docs)
    rows = _with_ranges(docs.toDF(*own), own, lengths, most_kinds)
    length = own[docs.columns.index("n_chars")] if "n_chars" in docs.columns else None
    schema = docs.toDF(*own).schema
    return rows.mapInArrow(_take_cuts(own, length), schema).toDF(*docs.columns)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
