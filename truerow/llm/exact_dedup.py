"""Exact deduplication by a tree-merge of sorted digest runs (operator 8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import only, row_key, stored, table

#: Deleted before texts are compared.
SPACES = " \t\n\x0b\x0c\r"
#: Bits by which a node's digest range narrows in a round: eight runs meet in each merge.
RADIX_BITS = 3
#: Texts are equal only if all of these agree: SHA-256, an independent hash and the length.
IDENTITY = ["digest", "other_hash", "n_bytes"]


def digests(docs: DataFrame) -> DataFrame:
    """One short row per document; the texts are read once and go no further."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", F.length(text).alias("n_points"), F.translate(text, SPACES, "").alias("t"), row_key().alias("key")
    )
    return rows.select(
        "doc_id",
        "n_points",
        "key",
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.xxhash64("t").alias("other_hash"),
        F.octet_length("t").alias("n_bytes"),
    )


def _top_bits(bits: int) -> Column:
    head = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    return F.shiftright(head, 32 - bits)


def tree_merge(runs: DataFrame, rounds: int) -> DataFrame:
    """One row per distinct text: its size and the row that stays.

    A run is what one input partition holds, sorted by digest. In round r, nodes that share
    the first r digits of their digest range exchange their runs, each taking one eighth of the
    range, so after the last round node d holds all rows of range d. Each node sorts the
    up to eight runs it receives and merges equal neighbours. A text meets at most eight rows
    per node and round, however many copies it has, and no node ever sees more than its range.
    """
    nodes = 1 << (RADIX_BITS * rounds)
    best = F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").alias("keep_id"), F.col("key").alias("keep_key"))
    # The first merge is a run's own: partial aggregation leaves one row per text and partition.
    run = F.pmod(F.spark_partition_id(), F.lit(nodes)).cast("long")
    level = (
        runs.withColumn("run", run)
        .groupBy("run", *IDENTITY)
        .agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
    )
    for r in range(1, rounds + 1):
        left = nodes >> (RADIX_BITS * r)
        node = _top_bits(RADIX_BITS * r) * F.lit(left) + F.col("run") % F.lit(left)
        level = (
            level.withColumn("node", node)
            .repartition(nodes, "node")
            .sortWithinPartitions("node", *IDENTITY)
            .groupBy("node", *IDENTITY)
            .agg(
                F.min("best").alias("best"),
                F.sum("group_size").alias("group_size"),
                F.min("run").alias("run"),
            )
            .drop("node")
        )
    return level.select(*IDENTITY, "best.keep_id", "best.keep_key", "group_size")


def mark_copies(docs: DataFrame, rounds: int = 2) -> DataFrame:
    """Every document with the row that stays of its group of equal texts.

    Reads `doc_id` and `text` only. Null and empty texts, and texts of spaces only, are equal
    to each other. Of equal texts the one with the most code points stays, then the smallest
    doc_id (a null doc_id is the smallest); rows that repeat both are all marked as kept. An
    empty table gives no rows. `rounds` r serves 8^r merge nodes.
    """
    rows = stored(digests(docs), "digests")
    groups = tree_merge(rows, rounds)
    # A group's rows all meet one row here; adaptive execution splits a hot group's side.
    return rows.join(groups, IDENTITY).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, rounds: int = 2) -> DataFrame:
    """One row of each group of equal texts, with all its columns, whatever their names.

    Decided row by row: of rows that share the doc_id and the most code points, one text stays (by
    its hash), and a copy goes even if its doc_id also belongs to a row that stays. Null and
    empty texts are one group. An empty table gives no rows.
    """
    kept = tree_merge(stored(digests(docs), "digests"), rounds)
    return only(docs, kept.select(F.col("keep_key").alias("key")))


def op8_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents"))


SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  first_value(doc_id) OVER w = doc_id AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
