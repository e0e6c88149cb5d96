"""Packing documents along a Hilbert curve into sequences of fixed length (operator 9)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import split_documents, stored, table, texts_of
from truerow.llm.tokenizing import known_chunks, vocabulary_path
from truerow.llm.words import mixed

VOCABULARY = "word_bpe_49k.json"
END = 2
LENGTH = 4096
#: Token ids are hashed with signs into so many dimensions, then projected to a few.
HASHED, FEW, BITS = 64, 3, 10


def hashed_vectors(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One unit vector per document of signed token counts (a zero vector without tokens)."""
    h = mixed(ids.astype(np.uint64) + np.uint64(1))
    place = (h % np.uint64(HASHED)).astype(np.int64) + HASHED * np.repeat(np.arange(len(sizes)), sizes)
    sign = np.where(h >> np.uint64(63), 1.0, -1.0)
    vectors = np.bincount(place, sign, HASHED * len(sizes)).reshape(-1, HASHED)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def cells(vectors: np.ndarray) -> np.ndarray:
    """Each vector's cell in a grid of few dimensions, about evenly filled."""
    from math import erf

    random = np.random.default_rng(7).standard_normal((HASHED, FEW))
    near = vectors @ (random / np.linalg.norm(random, axis=0)) * np.sqrt(HASHED)
    even = (1 + np.vectorize(erf, otypes=[float])(near / np.sqrt(2))) / 2
    return np.minimum((even * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The position of each grid cell along the Hilbert curve.

    Neighbours on the curve are neighbours in the grid. Works on all rows at once: from the
    highest bit down, the axes are exchanged or inverted as the curve turns, then the bits of
    all axes are interleaved (Gray code).
    """
    axes = [cells[:, i].copy() for i in range(cells.shape[1])]
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(len(axes)):
            on = (axes[i] & bit) != 0
            swapped = np.where(on, 0, (axes[0] ^ axes[i]) & low)
            if i:
                axes[i] = axes[i] ^ swapped
            axes[0] = axes[0] ^ np.where(on, low, swapped)
        bit >>= 1
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros_like(axes[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip = np.where(axes[-1] & bit, flip ^ (bit - 1), flip)
        bit >>= 1
    axes = [a ^ flip for a in axes]
    key = np.zeros_like(axes[0])
    for b in range(bits - 1, -1, -1):
        for a in axes:
            key = (key << 1) | ((a >> b) & 1)
    return key


def _tokenize(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_chunks(path)
        for batch in split_documents(batches, 2 << 20):
            ids, sizes = known.ids_of(texts_of(batch), END)
            keys = hilbert_keys(cells(hashed_vectors(ids, sizes)))
            ends = np.cumsum(sizes)
            # Two bytes an id where the vocabulary allows it: the ids are shuffled once.
            narrow = ids.astype("<u2") if known.tokenizer.get_vocab_size() <= 1 << 16 else ids
            packed = [narrow[e - n : e].tobytes() for e, n in zip(ends, sizes)]
            columns = [batch.column(0), pa.array(keys), pa.array(sizes), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "hilbert", "n", "ids"])

    return run


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's number of tokens before it in its partition; the rows come in order."""
    at, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        n = batch.column(1).to_numpy(zero_copy_only=False)
        before = at + np.cumsum(n) - n
        at += int(n.sum())
        columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(np.full(len(n), part)), pa.array(before)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "ids", "part", "before"])


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def _cut(bases: dict[int, int], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, n, ids, part, before in zip(*(c.to_pylist() for c in batch.columns)):
                at = bases[part] + before
                ids = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    offset = (at + start) % length
                    size = min(n - start, length - offset)
                    crc = zlib.crc32(ids[start : start + size].tobytes())
                    rows.append((doc, start, size, crc, n, (at + start) // length, offset))
                    start += size
            columns = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=[c.split()[0] for c in PIECES.split(", ")],
            )

    return run


def pack(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """The pieces of all documents, laid end to end along the curve and cut every `length` ids.

    Only the very last sequence may be unfilled. Reads `doc_id` and `text`; a null or empty text
    is the end id alone. Documents of any length are cut as often as needed; rows that repeat
    are packed as often as they come, side by side. An empty table gives no pieces.

    Rows are range-sorted by (Hilbert key, doc_id), so copies with one key are spread as well.
    A partition's first token number is the sum of the partitions before it: one number per
    partition passes the driver.
    """
    tokens = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _tokenize(path), "doc_id long, hilbert long, n long, ids binary"
    )
    order = ["hilbert", "doc_id"]
    ordered = stored(tokens, "token-ids").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(
        ordered.select("doc_id", "n", "ids").mapInArrow(_place, "doc_id long, n long, ids binary, part long, before long"),
        "placed",
    )
    bases, at = {}, 0
    for row in placed.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        bases[row["part"]] = at
        at += row["n"]
    return placed.mapInArrow(_cut(bases, length), PIECES)


def op9_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary_path(VOCABULARY))
