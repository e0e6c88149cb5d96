"""Raw files made of the events, from discovery to the stored state, and files written and read back."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.config import load_endpoint_schemas
from truerow.functions.jsons import is_malformed, line_fields
from truerow.operators.apply import ingest
from truerow.operators.ingest import current_state, extract
from truerow.queries.state import FOLD_SQL, SCHEMAS, file_lines
from truerow.queries.tables import coded, iso, table
from truerow.session import scratch_dir
from truerow.sources import documents, rawfiles, sinks
from truerow.sources.store import LEDGER, RECORDS, MasterStore
from truerow.streaming.ingest_stream import apply_record_batch, ingest_files_stream

#: The folders of the three runs; the manifest of the last one gives its run another name.
FOLDERS = ("2026-01-01", "2026-01-02", "2026-01-03")
MANIFEST_RUN = "9-third"
RUNS = (*FOLDERS[:2], MANIFEST_RUN)


class RawFolder:
    """Three runs with one JSONL file per event type below a new folder.

    Spark writes the lines, in order, one file per run and type; the files are then renamed to
    what a raw folder calls them. Runs may be put in place one after the other.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, broken: tuple[int, str] | None = None) -> None:
        """The file of the run and type ``broken`` has a line that is no JSON."""
        self.spark = spark
        root = scratch_dir(spark, "raw")
        self.path, self.written = f"{root}/raw", f"{root}/written"
        # Blanks around a line and blank lines are no part of the records.
        value = F.concat(F.when(F.col("event_id") % 3 == 0, "  \n ").otherwise(""), "payload", F.lit(" "))
        lines = file_lines(spark, sf_dir).select("file_ord", "endpoint", "event_id", value.alias("value"))
        if broken:
            bad = spark.createDataFrame([(*broken, "{broken")], "file_ord INT, endpoint STRING, value STRING")
            lines = lines.unionByName(bad, allowMissingColumns=True)
        lines = lines.repartition("file_ord", "endpoint").sortWithinPartitions("file_ord", "endpoint", "event_id")
        lines.drop("event_id").write.partitionBy("file_ord", "endpoint").text(self.written)

    def _system(self):
        jvm = self.spark.sparkContext._jvm
        of = jvm.org.apache.hadoop.fs.Path
        return of, of(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def put(self, *runs: int) -> RawFolder:
        of, system = self._system()
        for run in runs:
            folder = f"{self.path}/{FOLDERS[run]}"
            system.mkdirs(of(folder))
            manifest = {}
            for status in system.globStatus(of(f"{self.written}/file_ord={run}/endpoint=*/part-*.txt")) or []:
                endpoint = status.getPath().getParent().getName().partition("=")[2]
                # The last run's names say nothing of a delta; its manifest does.
                name = f"{endpoint}.jsonl" if run == 2 else f"{endpoint}.delta.jsonl"
                system.rename(status.getPath(), of(f"{folder}/{name}"))
                manifest[endpoint] = {"file": name, "is_delta": True}
            if run == 2:
                out = system.create(of(f"{folder}/manifest.json"))
                text = json.dumps({"run_id": MANIFEST_RUN, "mode": "delta", "endpoints": manifest})
                out.write(bytearray(text.encode()))
                out.close()
        return self


def _store(spark: SparkSession, name: str) -> MasterStore:
    return MasterStore(spark, scratch_dir(spark, name), buckets=2)


def _state(store: MasterStore) -> DataFrame:
    return store.current_records().select(
        "endpoint",
        "record_id",
        "modified_at_ts",
        F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id"),
    )


STATE_SQL = FOLD_SQL + " SELECT endpoint, record_id, ts AS modified_at_ts, event_id FROM s3"


def _run_sql(expression: str = "file_ord") -> str:
    return f"CASE {expression} WHEN 0 THEN '{RUNS[0]}' WHEN 1 THEN '{RUNS[1]}' ELSE '{RUNS[2]}' END"


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files found, in order, with what names and manifests tell."""
    folder = RawFolder(spark, sf_dir).put(2, 0, 1)
    found = rawfiles.in_order(rawfiles.discover(spark, folder.path))
    return found.select(
        "endpoint", "is_delta", "source_run_id", F.coalesce("run_mode", F.lit("-")).alias("run_mode"), "file_ord",
        F.col("manifest_path").isNotNull().alias("has_manifest"),
    )


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every file, without blank ones, in their exact order."""
    folder = RawFolder(spark, sf_dir).put(0, 1, 2)
    store = _store(spark, "staged")
    files = rawfiles.pending(spark, rawfiles.discover(spark, folder.path), store.read(LEDGER.name)).files
    lines = rawfiles.read_lines(spark, files)
    event = F.get_json_object("payload", "$.event_id").cast("bigint")
    place = F.struct("block", "row_id")
    names = F.substring_index("file_path", "/", -1)
    return lines.groupBy("file_path").agg(
        F.count("*").alias("n_lines"),
        F.min_by(event, place).alias("first_event"),
        F.max_by(event, place).alias("last_event"),
        F.count_if(F.col("payload").startswith(" ") | F.col("payload").endswith(" ")).alias("with_blanks"),
    ).select(
        F.regexp_replace(names, r"(\.delta)?\.jsonl$", "").alias("endpoint"),
        F.element_at(F.split("file_path", "/"), -2).alias("folder"),
        "n_lines", "first_event", "last_event", "with_blanks",
    )


#: Later overlays win; a list of conditions replaces the one before, `_add` extends it.
OVERLAYS = (
    {"endpoints": {"click": {"primary_key": "event_id", "delete_when_any": [{"field": "id", "equals": "1"}]}}},
    {"endpoints": {"click": {"primary_key": "id", "delete_when_any": [{"field": "active", "equals": "no"}]}}},
    {"endpoints": {"click": {"delete_when_any_add": [{"field": "active", "equals": False}]}}},
)


def ingested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs that arrive in two steps, folded into the stored state."""
    folder, store = RawFolder(spark, sf_dir).put(0), _store(spark, "ingested")
    schemas = load_endpoint_schemas(*OVERLAYS)
    ingest(store, folder.path, schemas)
    folder.put(1, 2)
    ingest(store, folder.path, schemas, max_files_per_batch=4)
    return _state(store)


def applied_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after the same folder was ingested three times, once by content."""
    folder, store = RawFolder(spark, sf_dir).put(0, 1, 2), _store(spark, "applied")
    ingest(store, folder.path, SCHEMAS)
    again = ingest(store, folder.path, SCHEMAS)
    verified = ingest(store, folder.path, SCHEMAS, verify_content=True)
    return store.read(LEDGER.name).select(
        "endpoint", "source_run_id", "is_delta", "record_count", "upserted", "deleted",
        F.lit(again.applied_files + verified.applied_files).alias("applied_again"),
        F.lit(again.skipped_files).alias("skipped"),
    )


def current_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views on the state, one for all endpoints and one for each."""
    folder, store = RawFolder(spark, sf_dir).put(0, 1, 2), _store(spark, "views")
    ingest(store, folder.path, SCHEMAS)
    store.create_views(load_endpoint_schemas(*OVERLAYS))
    return spark.sql(
        """
SELECT endpoint, count(*) AS records, count(payload_json) AS parsed,
  sum(variant_get(payload_json, '$.event_id', 'bigint')) AS events
FROM current_endpoint_records GROUP BY endpoint
UNION ALL SELECT 'current_click', count(*), count(payload_json),
  sum(variant_get(payload_json, '$.event_id', 'bigint')) FROM current_click"""
    )


def stream_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file stream announces the files over several triggers; the state is that of ``ingest``."""
    folder = RawFolder(spark, sf_dir).put(0, 1, 2)
    root = scratch_dir(spark, "file-stream")
    store = MasterStore(spark, f"{root}/store", buckets=2)
    ingest_files_stream(store, folder.path, SCHEMAS, f"{root}/checkpoint", max_files_per_trigger=4).awaitTermination()
    return _state(store)


def _in_batches(spark: SparkSession, sf_dir: str, name: str, numbers: Sequence[int]) -> DataFrame:
    store = _store(spark, name)
    lines = file_lines(spark, sf_dir)
    for number in numbers:
        batch = lines.where(F.col("file_ord") == number).drop("file_ord")
        apply_record_batch(store, batch, SCHEMAS, f"{name}/{number}", ["event_id"])
    return _state(store)


def late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three micro-batches whose times overlap, so that many records come late."""
    return _in_batches(spark, sf_dir, "late", (0, 1, 2))


def replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that run again, right after themselves and after later ones, change nothing."""
    return _in_batches(spark, sf_dir, "replayed", (0, 0, 1, 0, 2, 1, 2, 0))


#: The second run's clicks lie in a malformed file.
WITHOUT_CLICKS_SQL = STATE_SQL.replace(
    "  FROM events\n", "  FROM events WHERE NOT (event_type = 'click' AND value >= 25 AND value < 60)\n", 1
)


def malformed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: a stream over files of which one is malformed; all others are applied, in several triggers."""
    folder = RawFolder(spark, sf_dir, broken=(1, "click")).put(0, 1, 2)
    root = scratch_dir(spark, "file-stream")
    store = MasterStore(spark, f"{root}/store", buckets=2)
    ingest_files_stream(
        store, folder.path, SCHEMAS, f"{root}/checkpoint", max_files_per_trigger=4, on_malformed="fail_file"
    ).awaitTermination()
    return _state(store)


def typed_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State files of an older producer, without the typed times and later columns, beside new ones.

    The stored times count only as far as their texts are typed when read: records of the later
    runs that are older must lose against them.
    """
    folder, store = RawFolder(spark, sf_dir).put(0), _store(spark, "backfill")
    ingest(store, folder.path, SCHEMAS)
    older = store.read(RECORDS.name).drop("modified_at_ts", "ingested_at_ts", "actions", "previous", "batch_id")
    writer = older.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*RECORDS.partition_by).parquet(f"{store.root}/{RECORDS.name}")
    ingest(store, folder.put(1, 2).path, SCHEMAS)
    return _state(store)


def change_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every changed record was before the third run, as the ingest hands it on."""
    folder, store = RawFolder(spark, sf_dir).put(0, 1), _store(spark, "changes")
    ingest(store, folder.path, SCHEMAS)
    changes = ingest(store, folder.put(2).path, SCHEMAS).changes
    return changes.select(
        "endpoint", "record_id", "action", F.get_json_object("previous", "$.event_id").cast("bigint").alias("old_event")
    )


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose objects repeat the id, the time and the deletion field; the first ones count."""
    first = F.to_json(
        F.struct(
            F.struct(F.lit("inner").alias("id")).alias("in"),
            F.col("user_id").alias("id"),
            iso(F.col("ts")).alias("_modified_at"),
            (F.col("value") >= 5).alias("active"),
            "event_id",
        )
    )
    again = F.lit(', "id": "later", "_modified_at": "2099-01-01", "active": false, "in": {"id": 1, "id": 2}}')
    lines = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("endpoint"),
        F.concat(F.regexp_replace(first, r"\}$", ""), again).alias("payload"),
        "event_id",
    )
    state = current_state(extract(lines, SCHEMAS), ["event_id"])
    return state.select("endpoint", "record_id", "modified_at_ts", "event_id")


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines are malformed, of seven kinds; JSON that is no object is no record, but well formed."""
    good = F.to_json(F.struct("event_id", F.struct("props").alias("in")))
    kinds = (
        good, F.concat(good, F.lit(" x")), F.concat(good, F.lit("}")), F.concat(good, F.lit(", "), good),
        F.concat(F.lit("["), good, F.lit("]")), F.concat(F.lit('{"a": "}", "b": '), good, F.lit("}")), F.lit("7"),
    )
    kind = F.col("event_id") % len(kinds)
    lines = table(spark, sf_dir, "events").select(
        kind.alias("kind"), F.element_at(F.array(*kinds), (kind + 1).cast("int")).alias("payload")
    )
    parsed = lines.withColumn("parsed", line_fields(F.col("payload"), ["event_id"]))
    bad = F.count_if(is_malformed(F.col("payload"), F.col("parsed")))
    return parsed.groupBy("kind").agg(F.count("*").alias("lines"), bad.alias("malformed"))


# -- files written and read back -------------------------------------------------------------


def csv_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets with quotes, commas, line ends and nested values, read back from their folders."""
    part = table(spark, sf_dir, "part")
    odd = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"\nnext'))
    sheet = part.select("p_partkey", odd.alias("label"), F.array("p_size", F.length("p_type")).alias("sizes"))
    kinds = part.groupBy("p_type").agg(F.count("*").alias("n"))
    paths = sinks.write_sheets({"Parts": sheet, "Types": kinds}, scratch_dir(spark, "sheets"))
    reader = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
    quoted = spark.read.option("header", "true").option("multiLine", "true")
    return (
        quoted.schema("p_partkey LONG, label STRING, sizes STRING").csv(paths["Parts"])
        .unionByName(
            reader.schema("p_type STRING, n LONG").csv(paths["Types"]).select(
                F.col("n").alias("p_partkey"), F.col("p_type").alias("label"), F.lit("type").alias("sizes")
            )
        )
    )


CSV_SQL = """
SELECT p_partkey, p_name || ', "' || p_brand || '"' || chr(10) || 'next' AS label,
  '[' || p_size || ',' || length(p_type) || ']' AS sizes FROM part
UNION ALL SELECT count(*), p_type, 'type' FROM part GROUP BY p_type"""


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without their nulls as JSON lines, read back with a schema."""
    customer = table(spark, sf_dir, "customer")
    debt = F.when(F.col("c_acctbal") < 0, F.col("c_acctbal"))
    nested = F.struct(coded("N", "c_nationkey").alias("nation"), debt.alias("debt"))
    path = f"{scratch_dir(spark, 'lines')}/customers.jsonl"
    documents.write_jsonl(customer.select(F.col("c_custkey").alias("id"), debt.alias("debt"), nested.alias("more")), path)
    text = spark.read.text(path).select(F.count_if(F.col("value").contains("null")).alias("nulls"))
    read = documents.read_json(spark, path, "id LONG, debt DOUBLE, more STRUCT<nation: STRING, debt: DOUBLE>, other STRING")
    rows = read.select(
        "id", "debt", F.col("more.nation").alias("nation"), F.col("more.debt").eqNullSafe(F.col("debt")).alias("same"), "other"
    )
    return rows.unionByName(text.select(F.col("nulls").alias("id")), allowMissingColumns=True)


JSON_SQL = """
SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN c_acctbal END AS debt, 'N' || c_nationkey AS nation,
  true AS same, CAST(NULL AS VARCHAR) AS other FROM customer
UNION ALL SELECT 0, NULL, NULL, NULL, NULL"""


QUERIES = {
    "raw_files": (
        raw_files,
        FOLD_SQL
        + f"""
SELECT endpoint, true AS is_delta, {_run_sql()} AS source_run_id,
  CASE WHEN file_ord = 2 THEN 'delta' ELSE '-' END AS run_mode,
  row_number() OVER (ORDER BY file_ord, endpoint) - 1 AS file_ord, file_ord = 2 AS has_manifest
FROM (SELECT DISTINCT endpoint, file_ord FROM source)""",
    ),
    "staged_lines": (
        staged_lines,
        FOLD_SQL
        + f"""
SELECT endpoint, CASE file_ord WHEN 0 THEN '{FOLDERS[0]}' WHEN 1 THEN '{FOLDERS[1]}' ELSE '{FOLDERS[2]}' END AS folder,
  count(*) AS n_lines, min(event_id) AS first_event, max(event_id) AS last_event, 0 AS with_blanks
FROM source GROUP BY endpoint, file_ord""",
    ),
    "ingested_files": (ingested_files, STATE_SQL),
    "applied_files": (
        applied_files,
        FOLD_SQL
        + f"""
SELECT endpoint, {_run_sql()} AS source_run_id, true AS is_delta,
  CAST(sum(lines) AS BIGINT) AS record_count, count(*) FILTER (action = 'upsert') AS upserted,
  count(*) FILTER (action = 'delete') AS deleted, 0 AS applied_again, count(*) OVER () AS skipped
FROM actions GROUP BY endpoint, file_ord""",
    ),
    "current_views": (
        current_views,
        FOLD_SQL
        + """
SELECT endpoint, count(*) AS records, count(*) AS parsed, CAST(sum(event_id) AS BIGINT) AS events FROM s3 GROUP BY endpoint
UNION ALL SELECT 'current_click', count(*), count(*), CAST(sum(event_id) AS BIGINT) FROM s3 WHERE endpoint = 'click'""",
    ),
    "stream_file_order": (stream_file_order, STATE_SQL),
    "late_records": (late_records, STATE_SQL),
    "malformed_files": (malformed_files, WITHOUT_CLICKS_SQL),
    "typed_backfill": (typed_backfill, STATE_SQL),
    "change_payloads": (
        change_payloads,
        FOLD_SQL
        + """
SELECT a2.endpoint, a2.record_id, a2.action, s2.event_id AS old_event
FROM a2 LEFT JOIN s2 ON s2.endpoint = a2.endpoint AND s2.record_id = a2.record_id WHERE a2.action <> 'none'""",
    ),
    "duplicate_keys": (
        duplicate_keys,
        """
SELECT event_type AS endpoint, CAST(user_id AS VARCHAR) AS record_id, ts AS modified_at_ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS n FROM events
) WHERE n = 1 AND value >= 5""",
    ),
    "malformed_lines": (
        malformed_lines,
        """
SELECT event_id % 7 AS kind, count(*) AS lines, CASE WHEN event_id % 7 IN (1, 2, 3) THEN count(*) ELSE 0 END AS malformed
FROM events GROUP BY event_id % 7""",
    ),
    "replayed_batch": (replayed_batch, STATE_SQL),
    "csv_sheets": (csv_sheets, CSV_SQL),
    "json_lines": (json_lines, JSON_SQL),
}
