"""From raw documents to packed training sequences: five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; between
stages the documents are written as Parquet and read again, so no stage recomputes another.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm import exact_dedup, minmax_dedup, packing, suffix_dedup, toxicity
from truerow.llm.common import stored, table
from truerow.llm.tokenizing import vocabulary_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents scored as toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean_documents(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one row of each group of equal texts stays."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group of near-duplicates stays."""
    return minmax_dedup.without_near_copies(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: passages that stand elsewhere as well are cut out of the texts.

    A document stays even if nothing is left of its text; null texts become empty.
    """
    return suffix_dedup.without_repeats(docs, PASSAGE)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the pieces of all documents in training sequences."""
    return packing.pack(docs, vocabulary_path(packing.VOCABULARY))


#: A passage of over 50 words is some 300 bytes long: shorter spans than operator 1's own are cut here.
PASSAGE = suffix_dedup.Lengths(span=240, gram=120)

STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: Fitted models, signatures and tokenizers have no counterpart in SQL; the tests run planted
#: documents through all stages and compare them with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
