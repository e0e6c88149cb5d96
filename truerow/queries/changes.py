"""Changelog queries over the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.config import TrackingConfig
from truerow.operators import changelog
from truerow.queries.tables import coded, spread, table

TRACKING = TrackingConfig.load(
    {
        "defaults": {"sort_arrays": True},
        "endpoints": {
            "orders": ["id", "status", "amount.cents", "amount.priority", "tags", "note"]
        },
    }
)
EARLY, LATE = "1995-07-01", "2000-07-01"


def _payload(status, keep_nulls: bool):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    fields = F.struct(
        coded("O", "o_orderkey").alias("id"),
        status.alias("status"),
        F.struct(
            F.col("o_orderpriority").alias("priority"), cents.alias("cents"), F.lit(1).alias("x")
        ).alias("amount"),
        F.array(F.lit("a"), status, F.col("o_orderpriority")).alias("tags"),
        F.when(F.col("o_orderstatus") != "P", "n").alias("note"),
        F.col("o_custkey").alias("customer"),
    )
    return F.to_json(fields, {"ignoreNullFields": "false" if keep_nulls else "true"})


def _state(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    """Orders as they were before and as they are now.

    Before, high priority orders were pending and empty notes were missing instead of null.
    """
    orders = spread(table(spark, sf_dir, "orders"))
    status, day = F.col("o_orderstatus"), F.col("o_orderdate")
    if current:
        orders = orders.where(day >= F.lit(EARLY).cast("timestamp_ntz"))
    else:
        orders = orders.where(day < F.lit(LATE).cast("timestamp_ntz"))
        status = F.when(F.col("o_orderpriority") == "2-HIGH", "P").otherwise(status)
    return _orders(orders, status, current)


def _orders(orders: DataFrame, status, keep_nulls: bool) -> DataFrame:
    return orders.select(
        F.lit("orders").alias("endpoint"),
        coded("O", "o_orderkey").alias("record_id"),
        _payload(status, keep_nulls).alias("payload"),
        "o_orderpriority",
    )


def _index(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    return changelog.index(_state(spark, sf_dir, current), TRACKING.endpoints)


def tracked_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders."""
    orders = _orders(table(spark, sf_dir, "orders"), F.col("o_orderstatus"), True)
    return changelog.index(orders, TRACKING.endpoints)


def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.diff(_index(spark, sf_dir, False), _index(spark, sf_dir, True))


def changelog_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8, C9."""
    fields = F.array_join("changed_fields", ",")
    return _diff(spark, sf_dir).withColumn("changed_fields", fields)


def changed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each field changed."""
    named = _diff(spark, sf_dir).select(
        "change_type", F.explode_outer("changed_fields").alias("field")
    )
    return named.groupBy("change_type", "field").agg(F.count("*").alias("count"))


def changelog_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only high priority orders were touched, and some early ones deleted."""
    state = _state(spark, sf_dir, True)
    keys = ["endpoint", "record_id"]
    previous = _state(spark, sf_dir, False)
    high = F.col("o_orderpriority") == "2-HIGH"
    touched = state.where(high).select(*keys).unionByName(previous.where(high).select(*keys))
    gone = previous.join(state, keys, "left_anti").where("o_orderpriority = '5-LOW'").select(*keys)
    current = changelog.index(
        state.join(touched.distinct(), keys, "left_semi"), TRACKING.endpoints
    )
    stored = changelog.index(previous, TRACKING.endpoints)
    changes = changelog.diff(changelog.scoped_previous(stored, current, gone), current)
    return changes.select("record_id", "change_type", "previous_hash", "current_hash")


def _stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _diff(spark, sf_dir).withColumns(
        {
            "run_id": F.lit("r1"),
            "changed_at": F.lit(datetime(2026, 1, 1)).cast("timestamp_ntz"),
        }
    )


def changelog_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12."""
    return changelog.change_summary(_stamped(spark, sf_dir), since=datetime(2025, 1, 1))


def changelog_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C13."""
    listed = changelog.list_changes(_stamped(spark, sf_dir), "orders")
    return listed.withColumn("changed_fields", F.array_join("changed_fields", ","))


def record_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14: the history of one order."""
    return changelog.record_history(_stamped(spark, sf_dir), "orders", "O4")


def _text(status: str, note: str) -> str:
    return (
        "'{\"amount\":{\"cents\":' || CAST(round(o_totalprice * 100) AS BIGINT) || "
        "',\"priority\":\"' || o_orderpriority || '\"},\"id\":\"O' || o_orderkey || '\"' || "
        f"{note} || ',\"status\":\"' || {status} || '\",\"tags\":[\"' || o_orderpriority || "
        f"'\",\"' || {status} || '\",\"a\"]}}'"
    )


_WAS = "CASE WHEN o_orderpriority = '2-HIGH' THEN 'P' ELSE o_orderstatus END"
_NOTE_WAS = "CASE WHEN o_orderstatus = 'P' THEN '' ELSE ',\"note\":\"n\"' END"
_NOTE_IS = "CASE WHEN o_orderstatus = 'P' THEN ',\"note\":null' ELSE ',\"note\":\"n\"' END"

INDEX_SQL = f"""
WITH states AS (
  SELECT *, 'O' || o_orderkey AS record_id,
    CASE WHEN o_orderdate < TIMESTAMP '{LATE}' THEN {_text(_WAS, _NOTE_WAS)} END AS was,
    CASE WHEN o_orderdate >= TIMESTAMP '{EARLY}' THEN {_text("o_orderstatus", _NOTE_IS)} END
      AS now,
    {_text("o_orderstatus", _NOTE_IS)} AS whole
  FROM orders
),
events AS (
  SELECT 'orders' AS endpoint, record_id, o_orderpriority,
    CASE WHEN was IS NULL THEN 'added' WHEN now IS NULL THEN 'removed' ELSE 'changed' END
      AS change_type,
    sha256(was) AS previous_hash, sha256(now) AS current_hash,
    CASE WHEN was IS NOT NULL AND now IS NOT NULL
      THEN CASE WHEN {_WAS} <> o_orderstatus THEN 'status,tags' ELSE '' END
      ELSE 'amount,id,' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'note,' END
        || 'status,tags' END AS changed_fields,
    was AS previous_payload_json, now AS current_payload_json
  FROM states WHERE was IS DISTINCT FROM now
)
"""

QUERIES = {
    "tracked_payload": (
        tracked_payload,
        INDEX_SQL
        + """
SELECT 'orders' AS endpoint, record_id, whole AS tracked_payload_json,
  sha256(whole) AS payload_hash FROM states""",
    ),
    "changelog_events": (
        changelog_events,
        INDEX_SQL + " SELECT * EXCLUDE (o_orderpriority) FROM events",
    ),
    "changed_fields": (
        changed_fields,
        INDEX_SQL
        + """
SELECT change_type, field, count(*) AS count FROM (
  SELECT change_type, unnest(string_split(changed_fields, ',')) AS field FROM events
  WHERE changed_fields <> ''
  UNION ALL SELECT change_type, NULL FROM events WHERE changed_fields = ''
) GROUP BY change_type, field""",
    ),
    "changelog_scoped": (
        changelog_scoped,
        INDEX_SQL
        + """
SELECT record_id, change_type, previous_hash, current_hash FROM events
WHERE (o_orderpriority = '2-HIGH' AND change_type <> 'removed')
  OR (o_orderpriority = '5-LOW' AND change_type = 'removed')""",
    ),
    "changelog_summary": (
        changelog_summary,
        INDEX_SQL
        + """
SELECT endpoint, change_type, count(*) AS count FROM events GROUP BY endpoint, change_type""",
    ),
    "changelog_listing": (
        changelog_listing,
        INDEX_SQL
        + """
SELECT 'r1' AS run_id, endpoint, record_id, TIMESTAMP '2026-01-01' AS changed_at, change_type,
  changed_fields, previous_payload_json, current_payload_json
FROM events ORDER BY record_id LIMIT 50""",
    ),
    "record_history": (
        record_history,
        INDEX_SQL
        + """
SELECT TIMESTAMP '2026-01-01' AS changed_at, change_type, previous_payload_json,
  current_payload_json FROM events WHERE record_id = 'O4'""",
    ),
}
