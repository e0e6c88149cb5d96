"""JSON and JSONL documents in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from truerow.config.naming import Naming
from truerow.operators.check import check_schema, from_json_payloads
from truerow.operators.readiness import document_schema


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSONL (``.jsonl``, splittable) or files that hold one array or one object.

    The schema is explicit, so the files are read once and only for the wanted fields. A file
    with other content fails.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if not path.rstrip("/").endswith(".jsonl"):
        reader = reader.option("multiLine", "true")
    return reader.json(path)


def read_documents(spark: SparkSession, path: str, naming: Naming | None = None) -> DataFrame:
    return read_json(spark, path, document_schema(naming))


def read_check_payloads(spark: SparkSession, path: str) -> DataFrame:
    return from_json_payloads(read_json(spark, path, check_schema()))


def write_jsonl(rows: DataFrame, path: str) -> None:
    """One JSON object per line without NULL fields, in as many files as there are tasks."""
    rows.write.mode("overwrite").option("ignoreNullFields", "true").json(path)
