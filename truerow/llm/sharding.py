"""Sharding by weighted rendezvous hashing of stable record keys (operator 7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from truerow.llm.common import table

#: A hash's upper 53 bits fill a double exactly.
_STEP = 1.0 / (1 << 53)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 to len(weights) - 1) that wins the key.

    Every shard draws -weight / ln(u) with u in (0, 1) hashed from key and shard; the largest
    draw wins, of equal draws the larger shard number. A shard's draws do not depend on the
    others, so a shard that is added takes keys only into itself and one that is removed gives
    away only its own. A null key is a key like any other. Weights must be positive.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("Every shard needs a positive weight.")

    def draw(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
        score = -F.lit(float(weight)) / F.ln((bits + 0.5) * F.lit(_STEP))
        return F.struct(score.alias("score"), F.lit(shard).alias("shard"))

    draws = [draw(shard, weight) for shard, weight in enumerate(weights)]
    return F.greatest(*draws)["shard"] if len(draws) > 1 else draws[0]["shard"]


def numbered(rows: DataFrame, group: str, order: Sequence[str], slices: int) -> DataFrame:
    """`slot`: the gapless number from 0 of each row within its group.

    A group is numbered slice by slice, so even a group with all rows is spread over `slices`
    tasks; a slice's first number comes from the counts of the slices before it (at most
    groups x slices rows). Rows with equal order columns are numbered in any order.
    """
    cut = rows.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    counts = cut.groupBy(group, "_slice").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    within = W.partitionBy(group, "_slice").orderBy(*order)
    return (
        cut.join(starts, [group, "_slice"])
        .withColumn("slot", F.col("_start") + F.row_number().over(within) - 1)
        .drop("_slice", "_start")
    )


def shard_documents(docs: DataFrame, weights: Sequence[float], slices: int = 256) -> DataFrame:
    """Documents with their shard, slot and the shard with one more of the last weight.

    Reads `doc_id` and `text` only, so other columns cannot clash. A null text has 8 bytes and
    checksum 0. Rows that repeat a doc_id go to the same shard, each with a slot of its own. An
    empty table gives no rows. The text itself is not shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, weights[-1]]).alias("grown_shard"),
    )
    return numbered(rows, "shard", ["doc_id", "text_crc32", "size"], slices).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op7_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), [1.0] * 24)
