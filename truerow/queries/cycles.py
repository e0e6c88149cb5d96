"""Streaming and cycle queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.plans import cycles
from truerow.queries.state import CURRENT_SQL, SCHEMAS
from truerow.queries.tables import iso, table
from truerow.session import scratch_dir
from truerow.sources.store import MasterStore
from truerow.streaming.ingest_stream import ingest_records_stream


def stream_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream into the state tables, then the current state."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    payload = F.struct(
        F.col("user_id").cast("string").alias("id"),
        iso(F.col("ts")).alias("_modified_at"),
        (F.col("value") >= 5).alias("active"),
        "event_id",
        "props",
    )
    lines = events.select(
        F.col("event_type").alias("endpoint"), F.to_json(payload).alias("payload"), "event_id"
    )
    root = scratch_dir(spark, "stream")
    store = MasterStore(spark, f"{root}/store", buckets=1)
    query = ingest_records_stream(
        store, lines, SCHEMAS, f"{root}/checkpoint", "events", ["event_id"]
    )
    query.awaitTermination()
    return store.current_records().select(
        "endpoint",
        "record_id",
        "modified_at",
        "modified_at_ts",
        F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object("payload", "$.props").alias("props"),
    )


def cycle_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSONL result records, per day."""
    value = F.col("value")
    record = F.struct(
        F.when(value >= 20, "ok").when(value >= 5, "failed").alias("status"),
        F.floor(value).alias("items_fetched"),
        F.when(F.col("event_type") == "click", "many").otherwise("7").alias("pages_fetched"),
        value.alias("duration"),
    )
    lines = table(spark, sf_dir, "events").select(
        F.to_date("ts").cast("string").alias("day"), F.to_json(record).alias("payload")
    )
    return cycles.cycle_totals(lines, ["day"])


def cycle_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: one cycle per user and day, one pipeline per event of it."""
    value = F.col("value")
    keyed = table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.to_date("ts").cast("string"), "user_id").alias("cycle_id"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("OK").alias("fetch"),
        F.when(value < 20, "FAILED").otherwise("OK").alias("pipeline_status"),
    )
    failed = keyed.groupBy("cycle_id").agg(F.min("fetch").alias("fetch_status"))
    return cycles.cycle_status(keyed.join(failed, "cycle_id"))


QUERIES = {
    "stream_current_state": (stream_current_state, CURRENT_SQL),
    "cycle_totals": (
        cycle_totals,
        """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) FILTER (value >= 20) AS endpoints_ok,
  count(*) FILTER (value >= 5 AND value < 20) AS endpoints_failed,
  CAST(sum(floor(value)) AS BIGINT) AS items_fetched, 0 AS pages_fetched
FROM events GROUP BY 1""",
    ),
    "cycle_status": (
        cycle_status,
        """
WITH c AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) || '/' || user_id AS cycle_id,
    CASE WHEN bool_or(event_type = 'error') THEN 'FAILED' ELSE 'OK' END AS fetch_status,
    count(*) AS pipelines, count(*) FILTER (value < 20) AS failed_pipelines
  FROM events GROUP BY 1
)
SELECT *, CASE WHEN fetch_status <> 'OK' THEN fetch_status
  WHEN failed_pipelines > 0 THEN 'PARTIAL_FAILURE' ELSE 'OK' END AS status FROM c""",
    ),
}
