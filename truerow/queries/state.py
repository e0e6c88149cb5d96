"""Ingest, integrity and incremental queries over the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.config import EndpointSchema
from truerow.functions.times import window_start
from truerow.operators import incremental as inc
from truerow.operators import integrity
from truerow.operators.ingest import (
    actions_of,
    changes_of,
    current_state,
    extract,
    file_counts,
    fold,
    latest_per_key,
)
from truerow.queries.tables import event_lines, iso, spread, table

SCHEMAS: dict[str, EndpointSchema] = {}


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest change record per (event type, user), deletions dropped."""
    records = extract(event_lines(spark, sf_dir), SCHEMAS)
    state = current_state(records, ["event_id"])
    return state.select(
        "endpoint",
        "record_id",
        "modified_at",
        "modified_at_ts",
        "event_id",
        F.get_json_object("payload", "$.props").alias("props"),
    )


CURRENT_SQL = """
SELECT event_type AS endpoint, CAST(user_id AS VARCHAR) AS record_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS modified_at, ts AS modified_at_ts, event_id, props
FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id
    ORDER BY ts DESC, event_id DESC) AS n
  FROM events
) WHERE n = 1 AND value >= 5
"""


# -- the ordered fold ------------------------------------------------------------------------
# Three files by size of the value, so that times overlap and records arrive late; values from
# 20 to 30 are deletions; sign-ups above 100 carry no time.


def file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(endpoint, payload, event_id, file_ord): the lines of three files per event type."""
    events = spread(table(spark, sf_dir, "events"))
    value = F.col("value")
    timed = ~((F.col("event_type") == "signup") & (value > 100))
    payload = F.struct(
        F.col("user_id").alias("id"),
        F.when(timed, iso(F.col("ts"))).alias("_modified_at"),
        (~value.between(20, 30)).alias("active"),
        "event_id",
    )
    return events.select(
        F.col("event_type").alias("endpoint"),
        F.to_json(payload).alias("payload"),
        "event_id",
        F.when(value < 25, 0).when(value < 60, 1).otherwise(2).alias("file_ord"),
    )


def _file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = file_lines(spark, sf_dir)
    winners = latest_per_key(
        extract(lines, SCHEMAS),
        ["endpoint", "record_id", "file_ord"],
        ["event_id"],
        ["is_delete", "payload"],
    )
    text = F.lit(None).cast("string")
    return winners.withColumns(
        {
            "source_file": F.col("file_ord").cast("string"),
            "source_run_id": text,
            "ingested_at": text,
            "ingested_at_ts": F.lit(None).cast("timestamp_ntz"),
        }
    )


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold(_file_events(spark, sf_dir))


def ingest_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after three files in order."""
    return (
        _folded(spark, sf_dir)
        .where("live")
        .select(
            "endpoint",
            "record_id",
            "modified_at_ts",
            "source_file",
            F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id"),
        )
    )


def ingest_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each file did to each record it named."""
    actions = actions_of(_folded(spark, sf_dir))
    return actions.select("endpoint", "record_id", "file_ord", "action", "lines")


def ingest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed keys over all files, upserted and deleted ones."""
    return changes_of(_folded(spark, sf_dir))


def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines read, upserts and deletes per file."""
    return file_counts(actions_of(_folded(spark, sf_dir)))


def _fold_sql() -> str:
    parts = [
        """
WITH source AS (
  SELECT event_type AS endpoint, CAST(user_id AS VARCHAR) AS record_id, event_id,
    CASE WHEN event_type = 'signup' AND value > 100 THEN NULL ELSE ts END AS ts,
    value BETWEEN 20 AND 30 AS is_delete,
    CASE WHEN value < 25 THEN 0 WHEN value < 60 THEN 1 ELSE 2 END AS file_ord
  FROM events
),
winners AS (
  SELECT * FROM (
    SELECT *, count(*) OVER (PARTITION BY endpoint, record_id, file_ord) AS lines,
      row_number() OVER (PARTITION BY endpoint, record_id, file_ord
        ORDER BY ts DESC NULLS LAST, event_id DESC) AS n
    FROM source
  ) WHERE n = 1
),
s0 AS (SELECT endpoint, record_id, event_id, ts, file_ord FROM winners WHERE false)"""
    ]
    for n in range(3):
        parts.append(f"""
j{n} AS (
  SELECT coalesce(w.endpoint, s.endpoint) AS endpoint,
    coalesce(w.record_id, s.record_id) AS record_id, w.lines, w.is_delete,
    w.record_id IS NOT NULL AS incoming, s.record_id IS NOT NULL AS existing,
    w.event_id AS new_event, s.event_id AS old_event, w.ts AS new_ts, s.ts AS old_ts,
    s.file_ord AS old_file,
    CASE WHEN w.record_id IS NULL THEN false
      WHEN w.is_delete THEN s.record_id IS NOT NULL
        AND (w.ts IS NULL OR s.ts IS NULL OR w.ts >= s.ts)
      ELSE s.record_id IS NULL OR coalesce(w.ts > s.ts, false)
        OR ((w.ts IS NULL OR s.ts IS NULL OR w.ts >= s.ts)
          AND w.event_id IS DISTINCT FROM s.event_id) END AS applied
  FROM (SELECT * FROM winners WHERE file_ord = {n}) w
  FULL JOIN s{n} s ON s.endpoint = w.endpoint AND s.record_id = w.record_id
),
a{n} AS (
  SELECT endpoint, record_id, {n} AS file_ord, lines,
    CASE WHEN NOT applied THEN 'none' WHEN is_delete THEN 'delete' ELSE 'upsert' END AS action
  FROM j{n} WHERE incoming
),
s{n + 1} AS (
  SELECT endpoint, record_id, CASE WHEN applied THEN new_event ELSE old_event END AS event_id,
    CASE WHEN applied THEN new_ts ELSE old_ts END AS ts,
    CASE WHEN applied THEN {n} ELSE old_file END AS file_ord
  FROM j{n} WHERE (applied AND NOT is_delete) OR (NOT applied AND existing)
)""")
    parts.append("""
actions AS (SELECT * FROM a0 UNION ALL SELECT * FROM a1 UNION ALL SELECT * FROM a2)""")
    return ",".join(parts)


FOLD_SQL = _fold_sql()


# -- integrity -------------------------------------------------------------------------------


def id_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys of lines checked as if they were ids, per return flag."""
    lines = spread(table(spark, sf_dir, "lineitem"))
    own = F.struct(
        F.when(F.col("l_tax") > 0, F.col("l_orderkey").cast("string")).alias("id"),
    )
    payload = F.to_json(own, {"ignoreNullFields": "false"})
    ids = integrity.payload_ids(
        lines.select(F.col("l_returnflag").alias("endpoint"), payload.alias("payload"))
    )
    checked = integrity.with_id_status(integrity.id_integrity(ids), F.col("endpoint") != "N")
    sample = F.array_join("duplicate_sample", ",")
    return checked.withColumn("duplicate_sample", sample)


ID_INTEGRITY_SQL = """
WITH ids AS (
  SELECT l_returnflag AS endpoint,
    CASE WHEN l_tax > 0 THEN CAST(l_orderkey AS VARCHAR) END AS id FROM lineitem
),
counted AS (SELECT endpoint, id, count(*) AS n FROM ids GROUP BY endpoint, id),
ranked AS (
  SELECT endpoint, id, row_number() OVER (PARTITION BY endpoint ORDER BY id) AS k
  FROM counted WHERE n > 1 AND id IS NOT NULL
),
samples AS (
  SELECT endpoint, string_agg(id, ',' ORDER BY id) AS duplicate_sample
  FROM ranked WHERE k <= 5 GROUP BY endpoint
),
totals AS (
  SELECT endpoint, CAST(sum(n) AS BIGINT) AS records,
    CAST(coalesce(sum(n) FILTER (id IS NULL), 0) AS BIGINT) AS invalid_ids,
    count(*) FILTER (id IS NOT NULL) AS unique_ids,
    count(*) FILTER (id IS NOT NULL AND n > 1) AS duplicate_ids
  FROM counted GROUP BY endpoint
)
SELECT totals.*, coalesce(duplicate_sample, '') AS duplicate_sample,
  CASE WHEN totals.endpoint = 'N' THEN 'skipped'
    WHEN invalid_ids = 0 AND duplicate_ids = 0 THEN 'passed' ELSE 'failed'
  END AS id_validation_status
FROM totals LEFT JOIN samples ON samples.endpoint = totals.endpoint
"""


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread(table(spark, sf_dir, "lineitem"))
    per_order = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_linenumber").cast("bigint").alias("expected_count"),
        F.count("*").alias("items_fetched"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    expected = orders.join(per_order.select("o_orderkey", "expected_count"), "o_orderkey", "left")
    fetched = per_order.select("o_orderkey", "items_fetched")
    return integrity.reconcile_counts(expected, fetched, "o_orderkey")


def count_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last line number of an order is the number of lines it should have."""
    return _reconciled(spark, sf_dir)


def validation_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U8."""
    return integrity.status_counts(_reconciled(spark, sf_dir), "count_validation_status")


RECONCILED_SQL = """
WITH per_order AS (
  SELECT l_orderkey, CAST(max(l_linenumber) AS BIGINT) AS expected_count, count(*) AS n
  FROM lineitem GROUP BY l_orderkey
),
reconciled AS (
  SELECT o_orderkey, expected_count, coalesce(n, 0) AS items_fetched,
    CASE WHEN expected_count IS NULL THEN 'skipped' WHEN expected_count = n THEN 'passed'
      ELSE 'failed' END AS count_validation_status,
    CASE WHEN expected_count IS NULL THEN 'expected_count_unavailable' END
      AS count_validation_reason
  FROM orders LEFT JOIN per_order ON l_orderkey = o_orderkey
)
"""


# -- incremental -----------------------------------------------------------------------------


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as fetch attempts: failed below 60 and always for sign-ups, with warnings below 100."""
    value, ts = F.col("value"), F.col("ts")
    failed = (F.col("event_type") == "signup") | (value < 60)
    error = F.when(failed, F.concat(F.lit("value "), F.col("event_id").cast("string")))
    status = inc.fetch_status(error, F.lit(False), F.when(value < 100, 1).otherwise(0))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("endpoint"),
        ts.alias("attempt_start"),
        (ts + F.expr("INTERVAL 5 MINUTES")).alias("attempt_end"),
        status.alias("status"),
        error.alias("error"),
        F.floor(value).alias("items_fetched"),
        F.to_date(ts).cast("string").alias("run_id"),
    )


def _no_state(spark: SparkSession) -> DataFrame:
    from truerow.sources.store import FETCH_STATE

    return spark.createDataFrame([], FETCH_STATE.schema)


def fetch_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state all attempts leave behind."""
    return inc.update_fetch_state(_no_state(spark), _attempts(spark, sf_dir))


def incremental_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events at or above the floor of their type, with the default overlap and a day."""
    floors = inc.delta_floors(fetch_state(spark, sf_dir), 60, 1)
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("endpoint"), "event_id", F.col("ts").alias("modified_at_ts")
    )
    return inc.above_floor(events, floors)


ATTEMPTS_SQL = """
WITH attempts AS (
  SELECT event_type AS endpoint, ts AS attempt_start, ts + INTERVAL 5 MINUTE AS attempt_end,
    CASE WHEN event_type = 'signup' OR value < 60 THEN 'FAILED' WHEN value < 100 THEN 'PARTIAL'
      ELSE 'OK' END AS status,
    CASE WHEN event_type = 'signup' OR value < 60 THEN 'value ' || event_id END AS error,
    CAST(floor(value) AS BIGINT) AS items_fetched, CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id
  FROM events
),
state AS (
  SELECT endpoint, max(attempt_start) AS last_attempted_fetch_start,
    max_by(attempt_end, attempt_start) AS last_attempted_fetch_end,
    max_by(status, attempt_start) AS last_attempted_status,
    arg_max_null(error, attempt_start) AS last_attempted_error,
    max(attempt_start) FILTER (status <> 'FAILED') AS last_successful_fetch_start,
    max(attempt_end) FILTER (status <> 'FAILED') AS last_successful_fetch_end
  FROM attempts GROUP BY endpoint
)
"""


def window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the last six calendar months before the end of August 2001."""
    start = window_start(datetime(2001, 8, 31), months=6)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return inc.since(orders, start, "o_orderdate")


PARAMS = {
    "o_totalprice=ge": 100000,
    "o_totalprice=lt": 400000,
    "o_orderpriority=!": "1-URGENT",
    "o_orderstatus=": "F",
    "_modified_at=ge": "1990-01-01",
    "decoded": True,
}


def config_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base parameters, an overlay, and the time bound stripped."""
    base = {"orders": {**PARAMS, "o_totalprice=gt": 1}}
    merged = inc.overlay_params(base, {"orders": {"o_totalprice=gt": 150000}})["orders"]
    orders = table(spark, sf_dir, "orders")
    return inc.read_filtered(orders, inc.without_modified_at(merged)).select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per day; its entries are that day's attempts."""
    manifest = inc.run_manifest(_attempts(spark, sf_dir))
    return manifest.select(
        "run_id",
        "endpoints_total",
        "endpoints_succeeded",
        "endpoints_failed",
        "endpoints_partial",
        "total_items",
        "started_at",
        "finished_at",
        "status",
    )


RUN_MANIFEST_SQL = ATTEMPTS_SQL + """
SELECT run_id, count(*) AS endpoints_total,
  count(*) FILTER (status <> 'FAILED') AS endpoints_succeeded,
  count(*) FILTER (status = 'FAILED') AS endpoints_failed,
  count(*) FILTER (status = 'PARTIAL') AS endpoints_partial,
  CAST(sum(items_fetched) AS BIGINT) AS total_items,
  min(attempt_start) AS started_at, max(attempt_end) AS finished_at,
  CASE WHEN bool_and(status = 'FAILED') THEN 'FAILED' WHEN bool_or(status <> 'OK') THEN 'PARTIAL'
    ELSE 'OK' END AS status
FROM attempts GROUP BY run_id
"""


QUERIES = {
    "current_state": (current, CURRENT_SQL),
    "ingest_fold": (
        ingest_fold,
        FOLD_SQL
        + """
SELECT endpoint, record_id, ts AS modified_at_ts, CAST(file_ord AS VARCHAR) AS source_file,
  event_id FROM s3""",
    ),
    "ingest_actions": (
        ingest_actions,
        FOLD_SQL + " SELECT endpoint, record_id, file_ord, action, lines FROM actions",
    ),
    "ingest_changes": (
        ingest_changes,
        FOLD_SQL
        + " SELECT DISTINCT endpoint, record_id, action FROM actions WHERE action <> 'none'",
    ),
    "merge_counts": (
        merge_counts,
        FOLD_SQL
        + """
SELECT file_ord, CAST(sum(lines) AS BIGINT) AS record_count,
  count(*) FILTER (action = 'upsert') AS upserted,
  count(*) FILTER (action = 'delete') AS deleted
FROM actions GROUP BY file_ord""",
    ),
    "id_integrity": (id_integrity, ID_INTEGRITY_SQL),
    "count_reconciliation": (count_reconciliation, RECONCILED_SQL + " SELECT * FROM reconciled"),
    "validation_status_counts": (
        validation_status_counts,
        RECONCILED_SQL
        + """
SELECT count_validation_status AS status, count(*) AS count
FROM reconciled GROUP BY count_validation_status""",
    ),
    "fetch_state": (fetch_state, ATTEMPTS_SQL + " SELECT * FROM state"),
    "incremental_floor": (
        incremental_floor,
        ATTEMPTS_SQL
        + """
SELECT event_type AS endpoint, event_id, ts AS modified_at_ts
FROM events JOIN state ON endpoint = event_type
WHERE last_successful_fetch_start IS NULL
  OR ts >= last_successful_fetch_start - INTERVAL 60 MINUTE - INTERVAL 1 DAY""",
    ),
    "window_filter": (
        window_filter,
        """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-08-31' - INTERVAL 6 MONTH""",
    ),
    "config_predicates": (
        config_predicates,
        """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_totalprice > 150000 AND o_totalprice >= 100000 AND o_totalprice < 400000
  AND o_orderpriority <> '1-URGENT' AND o_orderstatus = 'F'""",
    ),
    "run_manifest": (run_manifest, RUN_MANIFEST_SQL),
}
