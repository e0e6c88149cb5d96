"""What the operators share: input tables, stored intermediate tables, byte helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.session import scratch_dir

#: A-Z and a-z, for lower-casing that leaves all other letters alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
ASCII_SPACE = b" \t\n\x0b\x0c\r"


#: Rows that go to a Python worker at once: at some kilobytes of text each, a few megabytes.
BATCH_ROWS = 2000
#: Bytes of text that a task works on at once where words or hashes take many times their text.
BATCH_BYTES = 1 << 20
#: Whether a finished execution deletes its shuffle files.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Keep the batches between Spark and its Python workers small; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The rows, written once below the cluster's shared folder and read back.

    Cuts the lineage and survives the loss of executors; used where a result is read twice.
    What was shuffled for it is given back once it is written, not when the driver next collects garbage.
    """
    spark = bounded_batches(rows.sparkSession)
    path = scratch_dir(spark, name)
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        rows.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    found = spark.read.schema(rows.schema).parquet(path)
    found.stored_at = path
    return found


def release(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: all that was made of them must be stored as well."""
    for found in tables:
        jvm = found.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(found.stored_at)
        path.getFileSystem(found.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def row_key() -> Column:
    """128 bits of a SHA-256 of doc_id and text: equal for rows that repeat each other, null apart from empty."""
    doc, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text"))
    whole = F.concat(doc, F.when(F.col("text").isNull(), "-").otherwise("+"), text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def plain_names(docs: DataFrame) -> list[str]:
    """Names for the columns of documents that cannot clash with an operator's own: doc_id, text, c0, c1, ..."""
    return [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]


def only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose `row_key` is among `key`, with all their columns; of rows that repeat, one.

    Rows that repeat meet within their task first, so a row with many copies is shuffled once per
    task; the distinct rows are then filtered where they are.
    """
    own = docs.toDF(*plain_names(docs))
    once = own.withColumn("key", row_key()).dropDuplicates(["key"])
    return once.join(keys.select("key"), "key", "left_semi").select(*own.columns).toDF(*docs.columns)


def crc32_of(column: Column) -> Column:
    """The unsigned CRC-32 of a value written as text."""
    return F.crc32(column.cast("string").cast("binary"))


def split_documents(batches: Iterator[pa.RecordBatch], most_bytes: int = 8 << 20):
    """Arrow batches of documents in smaller ones with at most so many bytes of text each.

    A single longer document makes a batch of its own: texts are never cut. `text` must be
    the column of that name; lengths come from the offsets, without copying.
    """
    for batch in batches:
        text = batch.column(batch.schema.get_field_index("text"))
        start, size = 0, 0
        for row, length in enumerate(byte_lengths(text)):
            if row > start and size + length > most_bytes:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += int(length)
        if batch.num_rows > start:
            yield batch.slice(start)


def byte_lengths(text: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)


def texts_of(batch: pa.RecordBatch) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    column = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
    return [text or b"" for text in column.to_pylist()]
