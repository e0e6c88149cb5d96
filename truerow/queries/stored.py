"""Two stored runs each of the validation history and the changelog, and the ten default relationships."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.config.tracking import TrackingConfig
from truerow.functions.issues import ISSUES_TYPE, issue, present
from truerow.operators import affected, changelog, history, refs
from truerow.operators.apply import ingest
from truerow.queries.files import RawFolder
from truerow.queries.state import FOLD_SQL, SCHEMAS
from truerow.queries.tables import _records, coded, table, union
from truerow.session import scratch_dir
from truerow.sources.store import CHANGELOG_EVENTS, CHANGELOG_RUNS, VALIDATION_EVENTS, VALIDATION_INDEX, VALIDATION_RUNS, MasterStore

# -- validation history ----------------------------------------------------------------------

AT = datetime(2026, 3, 1, 12, 0, 0)


def _results(spark: SparkSession, sf_dir: str, least: int) -> DataFrame:
    """Parts as validated products: small ones have an error."""
    small = F.col("p_size") < least
    error = issue("TOO_SMALL", "The part is too small.", "error", "PLM", "size", "part.size")
    return table(spark, sf_dir, "part").select(
        coded("P", "p_partkey").alias("plm_style_id"),
        F.col("p_name").alias("style_name"),
        (~small).alias("ready"),
        F.when(small, 80).otherwise(100).alias("score"),
        present([F.when(small, error)]).cast(ISSUES_TYPE).alias("issues"),
        F.col("p_partkey").alias("position"),
    )


def _history(spark: SparkSession, sf_dir: str) -> MasterStore:
    """A full run, then one of the even parts only, both in the same second."""
    store = MasterStore(spark, scratch_dir(spark, "history"), buckets=3)
    history.record(store, "Part Check", _results(spark, sf_dir, 10), position="position", created_at=AT)
    parts = table(spark, sf_dir, "part")
    scope = parts.where("p_partkey % 2 = 0").select(coded("P", "p_partkey").alias("product_id"))
    stricter = _results(spark, sf_dir, 25).where("position % 10 <> 0")
    history.record(store, "Part Check", stricter, scope=scope, position="position", created_at=AT)
    return store


def history_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored index after a full and a scoped run."""
    return _history(spark, sf_dir).read(VALIDATION_INDEX.name).select(
        "product_id", "ready", "status", F.array_join("issue_codes", ",").alias("codes"), "run_id"
    )


def history_stored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run rows; the second id is taken, so it gets a number."""
    return _history(spark, sf_dir).read(VALIDATION_RUNS.name).select(
        "run_id", "target", "total_records", "ready_records", "readiness_percent"
    )


def history_stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored events of both runs, counted by kind."""
    return _history(spark, sf_dir).read(VALIDATION_EVENTS.name).groupBy("run_id", "change_type").agg(
        F.count("*").alias("n")
    )


_ID = "2026-03-01T120000Z-Part-Check"
HISTORY_SQL = f"""
WITH first AS (SELECT p_partkey AS k, p_size >= 10 AS ready FROM part),
second AS (SELECT p_partkey AS k, p_size >= 25 AS ready FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 10 <> 0),
idx AS (
  SELECT k, ready, '{_ID}' AS run_id FROM first WHERE k % 2 <> 0
  UNION ALL SELECT k, ready, '{_ID}-2' FROM second
)
"""


# -- endpoint changelog ----------------------------------------------------------------------

TRACKED = TrackingConfig.load({"endpoints": {"click": ["event_id"], "signup": ["event_id", "_modified_at"], "view": ["event_id"]}})


def _changelog(spark: SparkSession, sf_dir: str) -> MasterStore:
    """A full run on the first two raw runs, then the run chained to the ingest of the third."""
    folder = RawFolder(spark, sf_dir).put(0, 1)
    store = MasterStore(spark, scratch_dir(spark, "changelog"), buckets=2)
    first = ingest(store, folder.path, SCHEMAS)
    changelog.record_after_ingest(store, TRACKED, first)
    folder.put(2)
    changelog.record_after_ingest(store, TRACKED, ingest(store, folder.path, SCHEMAS))
    return store


def changelog_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run rebuilds the empty index, the second looks at the changes only."""
    listed = changelog.list_runs(_changelog(spark, sf_dir).read(CHANGELOG_RUNS.name))
    return listed.select("endpoint_count", "record_count", "event_count", "full_refresh", "scoped_record_count")


def changelog_stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored events of both runs."""
    events = _changelog(spark, sf_dir).read(CHANGELOG_EVENTS.name)
    return events.select(
        "endpoint", "record_id", "change_type",
        F.get_json_object("previous_payload_json", "$.event_id").cast("bigint").alias("old_event"),
        F.get_json_object("current_payload_json", "$.event_id").cast("bigint").alias("new_event"),
    )


CHANGELOG_SQL = (
    FOLD_SQL
    + """,
tracked AS (SELECT * FROM source WHERE endpoint IN ('click', 'signup', 'view')),
before AS (SELECT * FROM s2 WHERE endpoint IN (SELECT endpoint FROM tracked)),
after AS (SELECT * FROM s3 WHERE endpoint IN (SELECT endpoint FROM tracked)),
moved AS (SELECT * FROM a2 WHERE action <> 'none' AND endpoint IN (SELECT endpoint FROM tracked)),
touched AS (SELECT DISTINCT endpoint, record_id FROM (
  SELECT * FROM a0 UNION ALL SELECT * FROM a1) WHERE action <> 'none' AND endpoint IN (SELECT endpoint FROM tracked)),
events AS (
  SELECT endpoint, record_id, 'added' AS change_type, CAST(NULL AS BIGINT) AS old_event, event_id AS new_event FROM before
  UNION ALL
  SELECT coalesce(b.endpoint, a.endpoint), coalesce(b.record_id, a.record_id),
    CASE WHEN b.record_id IS NULL THEN 'added' WHEN a.record_id IS NULL THEN 'removed' ELSE 'changed' END,
    b.event_id, a.event_id
  FROM before b FULL JOIN after a ON a.endpoint = b.endpoint AND a.record_id = b.record_id
  WHERE a.event_id IS DISTINCT FROM b.event_id
)"""
)


# -- the default relationships ---------------------------------------------------------------


def default_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver tables under the endpoints and field names of the default relationships."""
    part, order = table(spark, sf_dir, "part"), table(spark, sf_dir, "orders")
    line, customer = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "customer")
    supplier, nation, region = (table(spark, sf_dir, n) for n in ("supplier", "nation", "region"))

    def c(key):
        return F.concat(F.lit("C"), key.cast("string"))

    styles = F.struct(
        c(F.col("p_partkey")).alias("id"),
        F.create_map(F.lit("0"), c(F.col("p_size") % 30)).alias("product_colors"),
        F.array(c(F.col("p_size") % 30), c(F.col("p_size") % 7)).alias("active_colorways"),
        F.array(c(F.col("p_size") % 6)).alias("product_sizes"),
        c(F.col("p_size") % 20 + 100).alias("parent_season"),
        F.when(F.col("p_size") > 40, "FA23").alias("original_season"),
        c(F.col("p_partkey") * 2).alias("authority_bom"),
    )
    # An order's line is one record, whatever rows it has.
    line = line.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_suppkey").alias("l_suppkey"), F.max("l_partkey").alias("l_partkey"))
    row_id = F.concat(c(F.col("l_orderkey")), F.lit("-"), F.col("l_linenumber").cast("string"))
    quote = F.struct(c(F.col("s_suppkey")).alias("id"), c(F.col("s_nationkey")).alias("quote_factory"))
    factory = F.struct(c(F.col("n_nationkey")).alias("id"), F.array(c(F.col("n_nationkey") * 5)).alias("suppliers"))
    made = [
        _records(part, "styles", c(F.col("p_partkey")), styles),
        _records(nation, "colorways", c(F.col("n_nationkey")), F.struct(c(F.col("n_nationkey")).alias("id"))),
        _records(region, "sizes", c(F.col("r_regionkey")), F.struct(c(F.col("r_regionkey")).alias("id"))),
        _records(
            nation, "seasons", F.concat(F.lit("S"), "n_nationkey"),
            F.struct(F.lit("C9").alias("id"), c(F.col("n_nationkey") + 100).alias("code")),
        ),
        _records(
            order, "boms", c(F.col("o_orderkey")),
            F.struct(
                c(F.col("o_orderkey")).alias("id"),
                F.array(F.concat(c(F.col("o_orderkey")), F.lit("-1"))).alias("items"),
                F.array(F.struct(c(F.col("o_custkey")).alias("x"))).alias("bom_materials"),
            ),
        ),
        _records(
            line, "bomrows", row_id,
            F.struct(row_id.alias("id"), c(F.col("l_suppkey")).alias("actual"), c(F.col("l_partkey")).alias("original")),
        ),
        _records(
            customer, "materials", c(F.col("c_custkey")),
            F.struct(c(F.col("c_custkey")).alias("id"), c(F.col("c_nationkey")).alias("default_quote")),
        ),
        _records(supplier, "supplierquotes", c(F.col("s_suppkey")), quote),
        _records(nation, "factories", c(F.col("n_nationkey")), factory),
        _records(supplier, "suppliers", c(F.col("s_suppkey")), F.struct(c(F.col("s_suppkey")).alias("id"))),
    ]
    return union(made)


def default_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten default relationships in one pass over the records."""
    found = refs.coverage(default_records(spark, sf_dir))
    return found.select(
        "relationship", "source_endpoint", "target_endpoint", "source_records", "source_records_with_refs",
        "source_records_with_missing_refs", "declared_refs", "seen_refs", "missing_refs", "invalid_refs",
    )


def default_affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The styles behind changed factories, up to five relationships away."""
    changed = table(spark, sf_dir, "nation").where("n_regionkey = 2").select(
        F.lit("factories").alias("endpoint"), coded("C", "n_nationkey").alias("record_id")
    )
    return affected.affected_records(changed, [default_records(spark, sf_dir)])


_DEFAULT_SQL = """
WITH rows_ AS (
  SELECT l_orderkey, l_linenumber, max(l_suppkey) AS l_suppkey, max(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL
),
refs AS (
  SELECT DISTINCT * FROM (
    SELECT 'style_colorways' AS relationship, 'C' || p_partkey AS record_id, 'C' || (p_size % 30) AS ref FROM part
    UNION ALL SELECT 'style_colorways', 'C' || p_partkey, 'C' || (p_size % 7) FROM part
    UNION ALL SELECT 'style_sizes', 'C' || p_partkey, 'C' || (p_size % 6) FROM part
    UNION ALL SELECT 'style_seasons', 'C' || p_partkey, 'C' || (p_size % 20 + 100) FROM part
    UNION ALL SELECT 'style_seasons', 'C' || p_partkey, 'FA23' FROM part WHERE p_size > 40
    UNION ALL SELECT 'style_bom_master', 'C' || p_partkey, 'C' || (p_partkey * 2) FROM part
    UNION ALL SELECT 'bom_rows', 'C' || o_orderkey, 'C' || o_orderkey || '-1' FROM orders
    UNION ALL SELECT 'bom_materials', 'C' || o_orderkey, 'C' || o_custkey FROM orders
    UNION ALL SELECT 'bomrow_materials', 'C' || l_orderkey || '-' || l_linenumber, 'C' || l_suppkey FROM rows_
    UNION ALL SELECT 'bomrow_materials', 'C' || l_orderkey || '-' || l_linenumber, 'C' || l_partkey FROM rows_
    UNION ALL SELECT 'material_default_quotes', 'C' || c_custkey, 'C' || c_nationkey FROM customer
    UNION ALL SELECT 'supplier_quote_factories', 'C' || s_suppkey, 'C' || s_nationkey FROM supplier
    UNION ALL SELECT 'factory_suppliers', 'C' || n_nationkey, 'C' || (n_nationkey * 5) FROM nation
  )
),
ids AS (
  SELECT 'colorways' AS endpoint, 'C' || n_nationkey AS ref FROM nation
  UNION ALL SELECT 'sizes', 'C' || r_regionkey FROM region
  UNION ALL SELECT DISTINCT 'seasons', 'C9' FROM nation
  UNION ALL SELECT 'seasons', 'C' || (n_nationkey + 100) FROM nation
  UNION ALL SELECT 'boms', 'C' || o_orderkey FROM orders
  UNION SELECT 'bomrows', 'C' || l_orderkey || '-' || l_linenumber FROM rows_
  UNION ALL SELECT 'materials', 'C' || c_custkey FROM customer
  UNION ALL SELECT 'supplierquotes', 'C' || s_suppkey FROM supplier
  UNION ALL SELECT 'factories', 'C' || n_nationkey FROM nation
  UNION ALL SELECT 'suppliers', 'C' || s_suppkey FROM supplier
),
rules(relationship, source_endpoint, target_endpoint) AS (VALUES
  ('style_colorways', 'styles', 'colorways'), ('style_sizes', 'styles', 'sizes'),
  ('style_seasons', 'styles', 'seasons'), ('style_bom_master', 'styles', 'boms'),
  ('bom_rows', 'boms', 'bomrows'), ('bom_materials', 'boms', 'materials'),
  ('bomrow_materials', 'bomrows', 'materials'), ('material_default_quotes', 'materials', 'supplierquotes'),
  ('supplier_quote_factories', 'supplierquotes', 'factories'), ('factory_suppliers', 'factories', 'suppliers')),
counts AS (
  SELECT 'styles' AS source_endpoint, count(*) AS n FROM part UNION ALL SELECT 'boms', count(*) FROM orders
  UNION ALL SELECT 'bomrows', count(*) FROM rows_ UNION ALL SELECT 'materials', count(*) FROM customer
  UNION ALL SELECT 'supplierquotes', count(*) FROM supplier UNION ALL SELECT 'factories', count(*) FROM nation
),
statuses AS (
  SELECT r.*, u.source_endpoint, u.target_endpoint,
    CASE WHEN NOT regexp_matches(r.ref, '^C[0-9]') THEN 'invalid' WHEN i.ref IS NULL THEN 'missing' ELSE 'seen' END AS status
  FROM refs r JOIN rules u USING (relationship)
  LEFT JOIN (SELECT DISTINCT * FROM ids) i ON i.endpoint = u.target_endpoint AND i.ref = r.ref
)
"""

QUERIES = {
    "history_index": (
        history_index,
        HISTORY_SQL
        + """
SELECT 'P' || k AS product_id, ready, CASE WHEN ready THEN 'ready' ELSE 'failed' END AS status,
  CASE WHEN ready THEN '' ELSE 'TOO_SMALL' END AS codes, run_id FROM idx""",
    ),
    "history_stored_runs": (
        history_stored_runs,
        HISTORY_SQL
        + f"""
SELECT '{_ID}' AS run_id, 'Part Check' AS target, count(*) AS total_records, count(*) FILTER (ready) AS ready_records,
  round_even(count(*) FILTER (ready) / count(*) * 100, 2) AS readiness_percent FROM first
UNION ALL SELECT '{_ID}-2', 'Part Check', count(*), count(*) FILTER (ready),
  round_even(count(*) FILTER (ready) / count(*) * 100, 2) FROM idx""",
    ),
    "history_stored_events": (
        history_stored_events,
        HISTORY_SQL
        + f"""
SELECT '{_ID}' AS run_id, 'added' AS change_type, count(*) AS n FROM first
UNION ALL SELECT '{_ID}-2', 'changed', count(*) FROM first f JOIN second s USING (k) WHERE f.ready <> s.ready
UNION ALL SELECT '{_ID}-2', 'removed', count(*) FROM part WHERE p_partkey % 10 = 0""",
    ),
    "changelog_runs": (
        changelog_runs,
        CHANGELOG_SQL
        + """
SELECT (SELECT count(DISTINCT endpoint) FROM touched) AS endpoint_count, count(*) AS record_count, count(*) AS event_count,
  true AS full_refresh, (SELECT count(*) FROM touched) AS scoped_record_count FROM before
UNION ALL SELECT count(DISTINCT endpoint), count(*) FILTER (action = 'upsert'), count(*), false, count(*) FROM moved""",
    ),
    "changelog_stored_events": (changelog_stored_events, CHANGELOG_SQL + " SELECT * FROM events"),
    "default_coverage": (
        default_coverage,
        _DEFAULT_SQL
        + """
SELECT relationship, source_endpoint, target_endpoint, any_value(c.n) AS source_records,
  count(DISTINCT record_id) AS source_records_with_refs,
  count(DISTINCT record_id) FILTER (status <> 'seen') AS source_records_with_missing_refs,
  count(*) AS declared_refs, count(*) FILTER (status = 'seen') AS seen_refs,
  count(*) FILTER (status = 'missing') AS missing_refs, count(*) FILTER (status = 'invalid') AS invalid_refs
FROM statuses JOIN counts c USING (source_endpoint) GROUP BY ALL""",
    ),
    "default_affected": (
        default_affected,
        """
WITH quotes AS (SELECT 'C' || s_suppkey AS id FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 2),
materials AS (SELECT 'C' || c_custkey AS id FROM customer WHERE 'C' || c_nationkey IN (SELECT id FROM quotes)),
bomrows AS (SELECT 'C' || l_orderkey || '-' || l_linenumber AS id FROM (
    SELECT l_orderkey, l_linenumber, max(l_suppkey) AS l_suppkey, max(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL)
  WHERE 'C' || l_suppkey IN (SELECT id FROM materials) OR 'C' || l_partkey IN (SELECT id FROM materials)),
boms AS (SELECT 'C' || o_orderkey AS id FROM orders
  WHERE 'C' || o_orderkey || '-1' IN (SELECT id FROM bomrows) OR 'C' || o_custkey IN (SELECT id FROM materials))
SELECT 'C' || p_partkey AS record_id FROM part WHERE 'C' || (p_partkey * 2) IN (SELECT id FROM boms)""",
    ),
}
