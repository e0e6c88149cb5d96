"""Validation history queries over the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.operators import history
from truerow.operators.snapshots import latest
from truerow.queries.tables import coded, iso, spread, table

CUT = datetime(2024, 1, 16)
TARGET = "click"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(table(spark, sf_dir, "events"))
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _results(events: DataFrame) -> DataFrame:
    """The newest event per (type, user) as the validation result of a product."""
    keyed = events.withColumn(
        "order", F.struct("ts", "event_id")
    )
    newest = latest(keyed, ["event_type", "user_id"], "order")
    value, k = F.col("value"), F.col("k")

    def issue(when, code, severity, level=None):
        fields = F.struct(
            F.lit(code).alias("code"),
            F.lit(severity).alias("severity"),
            F.lit(level).cast("string").alias("warning_level"),
        )
        return F.when(when, fields)

    issues = F.array(
        issue(value < 5, "TINY", "error"),
        issue(k > 90, "KMAX", "warning", "hard"),
        issue(value < 20, "LOW", "error"),
        issue(k > 50, "KHIGH", "warning", "soft"),
    )
    return newest.select(
        F.concat_ws("-", "event_type", "user_id").alias("style_id"),
        coded("User ", "user_id").alias("style_name"),
        F.col("event_type").alias("brand"),
        F.concat(F.lit(" AW"), F.date_format("ts", "dd"), F.lit(" ")).alias("season"),
        (value >= 20).alias("ready"),
        value.alias("score"),
        iso(F.col("ts")).alias("source_updated_at"),
        F.filter(issues, lambda i: i.isNotNull()).alias("issues"),
    )


def _before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.validation_index(_results(_events(spark, sf_dir).where(F.col("ts") < F.lit(CUT))))


def _after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.validation_index(_results(_events(spark, sf_dir).where(F.col("ts") >= F.lit(CUT))))


def _whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.validation_index(_results(_events(spark, sf_dir)))


def validation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1-H7."""
    index = _whole(spark, sf_dir)
    entries = F.array_sort(F.map_entries("issue_severities"))
    severities = F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"]))
    return index.withColumns(
        {
            "issue_codes": F.array_join("issue_codes", ","),
            "issue_severities": F.array_join(severities, ","),
        }
    ).drop("issue_hash")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.product_changes(_before(spark, sf_dir), _after(spark, sf_dir))


def _flat(changes: DataFrame) -> DataFrame:
    return changes.select(
        "product_id",
        "change_type",
        "previous_ready",
        "current_ready",
        "previous_status",
        "current_status",
        F.array_join("previous_issue_codes", ",").alias("previous_issue_codes"),
        F.array_join("current_issue_codes", ",").alias("current_issue_codes"),
    )


def validation_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3, H8."""
    return _flat(_changes(spark, sf_dir))


def issue_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9."""
    return history.issue_changes(_changes(spark, sf_dir))


def _scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "signup"))
    return events.select(F.concat_ws("-", "event_type", "user_id").alias("product_id")).distinct()


def scoped_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only products of two event types take part."""
    scope = _scope(spark, sf_dir)
    before = _before(spark, sf_dir).join(scope, "product_id", "left_semi")
    after = _after(spark, sf_dir).join(scope, "product_id", "left_semi")
    return _flat(history.product_changes(before, after))


def scoped_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals when only the scope is replaced."""
    scope = _scope(spark, sf_dir)
    after = _after(spark, sf_dir).join(scope, "product_id", "left_semi")
    counts = history.merged_counts(_before(spark, sf_dir), after, scope)
    return history.readiness_percent(counts)


def index_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H17."""
    return history.index_counts(_whole(spark, sf_dir))


def _stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole(spark, sf_dir).withColumn("target", F.lit(TARGET))


def failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H20."""
    return history.failing(_stored_index(spark, sf_dir), TARGET)


def completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H21."""
    return history.completion(_stored_index(spark, sf_dir), TARGET)


INDEX_SQL = """
WITH e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    ts < TIMESTAMP '2024-01-16' AS early FROM events
),
newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY early, event_type, user_id
      ORDER BY ts DESC, event_id DESC) AS n FROM e
  ) WHERE n = 1
),
indexed AS (
  SELECT early, concat_ws('-', event_type, user_id) AS product_id, value >= 20 AS ready,
    CASE WHEN value >= 20 THEN 'ready' ELSE 'failed' END AS status,
    concat_ws(',', CASE WHEN k > 50 THEN 'KHIGH' END, CASE WHEN k > 90 THEN 'KMAX' END,
      CASE WHEN value < 20 THEN 'LOW' END, CASE WHEN value < 5 THEN 'TINY' END) AS issue_codes,
    concat_ws(',', CASE WHEN k > 50 THEN 'KHIGH=warning' END,
      CASE WHEN k > 90 THEN 'KMAX=warning' END, CASE WHEN value < 20 THEN 'LOW=error' END,
      CASE WHEN value < 5 THEN 'TINY=error' END) AS issue_severities,
    'User ' || user_id AS display_name, event_type AS brand,
    'AW' || strftime(ts, '%d') AS season, CAST(strftime(ts, '%d') AS INTEGER) AS season_year,
    event_type || '|AW' || strftime(ts, '%d') AS group_key, value AS score,
    CAST((k > 50)::INT + (k > 90)::INT + (value < 20)::INT + (value < 5)::INT AS BIGINT)
      AS issue_count,
    CAST((value < 20)::INT + (value < 5)::INT AS BIGINT) AS failure_count,
    CAST((k > 90)::INT AS BIGINT) AS hard_warning_count,
    CAST((k > 50)::INT AS BIGINT) AS soft_warning_count, ts AS updated_source_at
  FROM newest
),
before AS (SELECT * FROM indexed WHERE early),
after AS (SELECT * EXCLUDE (early) FROM indexed WHERE NOT early),
changes AS (
  SELECT coalesce(b.product_id, a.product_id) AS product_id,
    CASE WHEN b.product_id IS NULL THEN 'added' WHEN a.product_id IS NULL THEN 'removed'
      ELSE 'changed' END AS change_type,
    b.ready AS previous_ready, a.ready AS current_ready, b.status AS previous_status,
    a.status AS current_status, coalesce(b.issue_codes, '') AS previous_issue_codes,
    coalesce(a.issue_codes, '') AS current_issue_codes
  FROM before b FULL JOIN after a ON a.product_id = b.product_id
  WHERE b.product_id IS NULL OR a.product_id IS NULL OR a.ready <> b.ready
    OR a.issue_codes <> b.issue_codes
),
scope AS (
  SELECT DISTINCT concat_ws('-', event_type, user_id) AS product_id FROM events
  WHERE event_type IN ('view', 'signup')
)
"""

# The same index over all events.
WHOLE_SQL = INDEX_SQL.replace("ts < TIMESTAMP '2024-01-16' AS early", "FALSE AS early")

ISSUE_CHANGES_SQL = """,
codes AS (
  SELECT product_id, 'previous' AS side, unnest(string_split(previous_issue_codes, ',')) AS code
  FROM changes WHERE previous_issue_codes <> ''
  UNION ALL SELECT product_id, 'current', unnest(string_split(current_issue_codes, ','))
  FROM changes WHERE current_issue_codes <> ''
)
SELECT product_id, code AS issue_code,
  CASE min(side) WHEN 'current' THEN 'added' ELSE 'resolved' END AS change_type,
  CASE WHEN code LIKE 'K%' THEN 'warning' ELSE 'error' END AS severity
FROM codes GROUP BY product_id, code HAVING count(*) = 1
"""


# -- stored runs and events ------------------------------------------------------------------


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event type and day."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    totals = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("target"), day.alias("created_at")
    ).agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("value") >= 20).alias("ready_records"),
    )
    run_id = F.concat_ws("-", "target", F.date_format("created_at", "yyyyMMdd"))
    return history.readiness_percent(totals.withColumn("run_id", run_id))


def _stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        F.concat_ws("-", "event_type", F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.col("event_type").alias("target"),
        F.col("ts").alias("changed_at"),
        coded("u", "user_id").alias("product_id"),
        "value",
        "k",
    )


def _product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, k = F.col("value"), F.col("k")
    kind = F.when(value >= 60, "added").when(value >= 20, "changed").otherwise("removed")
    none = F.array().cast("array<string>")
    return _stamped(spark, sf_dir).select(
        "run_id",
        "target",
        "changed_at",
        "product_id",
        kind.alias("change_type"),
        (k > 50).alias("previous_ready"),
        (value >= 20).alias("current_ready"),
        F.when(k > 50, "ready").otherwise("failed").alias("previous_status"),
        F.when(value >= 20, "ready").otherwise("failed").alias("current_status"),
        none.alias("previous_issue_codes"),
        none.alias("current_issue_codes"),
    )


def _issue_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return _stamped(spark, sf_dir).where(value < 30).select(
        "run_id",
        "target",
        "changed_at",
        "product_id",
        F.when(value < 5, "TINY").when(value < 20, "LOW").otherwise("MID").alias("issue_code"),
        F.when(F.col("k") > 50, "added").otherwise("resolved").alias("change_type"),
        F.when(value < 20, "error").otherwise("warning").alias("severity"),
    )


def history_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H14, P6, P7."""
    return history.list_runs(
        _runs(spark, sf_dir),
        _product_events(spark, sf_dir),
        _issue_events(spark, sf_dir),
        TARGET,
        datetime(2024, 1, 5),
    )


def history_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H15."""
    listed = history.list_changes(_product_events(spark, sf_dir), TARGET)
    return listed.drop("previous_issue_codes", "current_issue_codes")


def history_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the listed (limited) rows."""
    return history.totals_by_type(history.list_changes(_product_events(spark, sf_dir), TARGET))


def issue_change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H16."""
    return history.issue_counts(_issue_events(spark, sf_dir), since=datetime(2024, 1, 10))


def _turned(events: DataFrame) -> DataFrame:
    return events.select("product_id", "changed_at", "previous_status", "current_status")


def became_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H18."""
    return _turned(history.became_ready(_product_events(spark, sf_dir), TARGET))


def regressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H18."""
    return _turned(history.regressed(_product_events(spark, sf_dir), TARGET))


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H19."""
    return history.latest_runs(_runs(spark, sf_dir))


RUNS_SQL = """
WITH runs AS (
  SELECT event_type AS target, date_trunc('day', ts) AS created_at, count(*) AS total_records,
    count(*) FILTER (value >= 20) AS ready_records,
    round_even(count(*) FILTER (value >= 20) / count(*) * 100, 2) AS readiness_percent,
    event_type || '-' || strftime(date_trunc('day', ts), '%Y%m%d') AS run_id
  FROM events GROUP BY event_type, date_trunc('day', ts)
),
e AS (
  SELECT *, event_type || '-' || strftime(ts, '%Y%m%d') AS run_id,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
product_events AS (
  SELECT run_id, event_type AS target, ts AS changed_at, 'u' || user_id AS product_id,
    CASE WHEN value >= 60 THEN 'added' WHEN value >= 20 THEN 'changed' ELSE 'removed' END
      AS change_type,
    k > 50 AS previous_ready, value >= 20 AS current_ready,
    CASE WHEN k > 50 THEN 'ready' ELSE 'failed' END AS previous_status,
    CASE WHEN value >= 20 THEN 'ready' ELSE 'failed' END AS current_status
  FROM e
),
issue_events AS (
  SELECT run_id, event_type AS target, ts AS changed_at,
    CASE WHEN value < 5 THEN 'TINY' WHEN value < 20 THEN 'LOW' ELSE 'MID' END AS issue_code,
    CASE WHEN k > 50 THEN 'added' ELSE 'resolved' END AS change_type,
    CASE WHEN value < 20 THEN 'error' ELSE 'warning' END AS severity
  FROM e WHERE value < 30
),
listed AS (
  SELECT run_id, target, changed_at, product_id, change_type, previous_status, current_status
  FROM product_events WHERE target = 'click' ORDER BY changed_at DESC, product_id LIMIT 50
)
"""

QUERIES = {
    "validation_index": (validation_index, WHOLE_SQL + " SELECT * FROM after"),
    "validation_changes": (validation_changes, INDEX_SQL + " SELECT * FROM changes"),
    "issue_changes": (issue_changes, INDEX_SQL + ISSUE_CHANGES_SQL),
    "scoped_changes": (
        scoped_changes,
        INDEX_SQL + " SELECT changes.* FROM changes JOIN scope USING (product_id)",
    ),
    "scoped_totals": (
        scoped_totals,
        INDEX_SQL
        + """,
merged AS (
  SELECT ready FROM before WHERE product_id NOT IN (SELECT product_id FROM scope)
  UNION ALL SELECT ready FROM after WHERE product_id IN (SELECT product_id FROM scope)
)
SELECT count(*) AS total_records, count(*) FILTER (ready) AS ready_records,
  round_even(count(*) FILTER (ready) / count(*) * 100, 2) AS readiness_percent FROM merged""",
    ),
    "index_counts": (
        index_counts,
        WHOLE_SQL
        + " SELECT count(*) AS total_records, count(*) FILTER (ready) AS ready_records FROM after",
    ),
    "failing": (
        failing,
        WHOLE_SQL
        + """
SELECT product_id, display_name, brand, season, score, failure_count, hard_warning_count,
  soft_warning_count FROM after WHERE NOT ready""",
    ),
    "completion": (
        completion,
        WHOLE_SQL
        + """
SELECT brand, season, count(*) AS records, count(*) FILTER (ready) AS ready_records,
  round(avg(score), 2) AS average_score, CAST(sum(failure_count) AS BIGINT) AS failures,
  CAST(sum(hard_warning_count) AS BIGINT) AS hard_warnings,
  CAST(sum(soft_warning_count) AS BIGINT) AS soft_warnings
FROM after GROUP BY brand, season""",
    ),
    "history_runs": (
        history_runs,
        RUNS_SQL
        + """
SELECT run_id, target, created_at, total_records, ready_records, readiness_percent,
  (SELECT count(*) FROM product_events p WHERE p.run_id = runs.run_id) AS product_changes,
  (SELECT count(*) FROM issue_events i WHERE i.run_id = runs.run_id) AS issue_changes
FROM runs WHERE target = 'click' AND created_at >= TIMESTAMP '2024-01-05'
ORDER BY created_at DESC LIMIT 20""",
    ),
    "history_changes": (history_changes, RUNS_SQL + " SELECT * FROM listed"),
    "history_totals": (
        history_totals,
        RUNS_SQL + " SELECT change_type, count(*) AS total FROM listed GROUP BY change_type",
    ),
    "issue_change_counts": (
        issue_change_counts,
        RUNS_SQL
        + """
SELECT target, issue_code, change_type, severity, count(*) AS count
FROM issue_events WHERE changed_at >= TIMESTAMP '2024-01-10'
GROUP BY ALL ORDER BY count DESC, issue_code, change_type LIMIT 50""",
    ),
    "became_ready": (
        became_ready,
        RUNS_SQL
        + """
SELECT product_id, changed_at, previous_status, current_status FROM product_events
WHERE target = 'click' AND NOT previous_ready AND current_ready""",
    ),
    "regressed": (
        regressed,
        RUNS_SQL
        + """
SELECT product_id, changed_at, previous_status, current_status FROM product_events
WHERE target = 'click' AND previous_ready AND NOT current_ready""",
    ),
    "latest_run": (
        latest_run,
        RUNS_SQL
        + """
SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY target ORDER BY created_at DESC) = 1""",
    ),
}
