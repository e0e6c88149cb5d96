"""The tables of one installation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.config.endpoints import EndpointSchema
from truerow.functions.times import utc_timestamp
from truerow.sources.tables import Partition, TableSpec, TableStore

RECORDS = TableSpec(
    "endpoint_records",
    # live = false keeps the trace of a deletion until the bucket is written again; actions tells
    # what each file of the bucket's last batch did to the record, previous what it was before.
    (
        "endpoint STRING, bucket INT, record_id STRING, payload STRING, modified_at STRING, "
        "modified_at_ts TIMESTAMP_NTZ, source_file STRING, source_run_id STRING, "
        "ingested_at STRING, ingested_at_ts TIMESTAMP_NTZ, live BOOLEAN, "
        "actions ARRAY<STRUCT<file_ord: INT, action: STRING, lines: LONG>>, "
        "previous STRING, batch_id STRING"
    ),
    ("endpoint", "bucket"),
    key="record_id",
)
LEDGER = TableSpec(
    "applied_raw_files",
    (
        "file_path STRING, endpoint STRING, source_run_id STRING, is_delta BOOLEAN, "
        "record_count LONG, content_sha256 STRING, manifest_path STRING, "
        "manifest_sha256 STRING, run_mode STRING, ingested_at STRING, "
        "ingested_at_ts TIMESTAMP_NTZ, full_snapshot_mode STRING, length LONG, "
        "modified TIMESTAMP, batch_id STRING, file_ord INT, upserted LONG, deleted LONG"
    ),
)
#: The files of every batch, written before its first change of the state; the ledger follows last.
BATCHES = TableSpec(
    "ingest_batches", "batch_id STRING, file_path STRING, started_at TIMESTAMP_NTZ"
)
CHANGES = TableSpec(
    "ingest_changes",
    "batch_id STRING, endpoint STRING, record_id STRING, action STRING, previous STRING",
    ("batch_id",),
)
PRODUCTS = TableSpec(
    "reconstructed_products",
    (
        "product_id STRING, style_id STRING, brand_code STRING, season STRING, "
        "product_type_code STRING, graph_json STRING, warning_count INT, "
        "reconstructed_at_ts TIMESTAMP_NTZ"
    ),
)
SOURCE_REFS = TableSpec(
    "reconstruction_source_refs",
    (
        "product_id STRING, source_endpoint STRING, source_record_id STRING, relation_type STRING"
    ),
)
PRODUCT_WARNINGS = TableSpec(
    "reconstruction_warnings",
    (
        "product_id STRING, severity STRING, code STRING, message STRING, "
        "source_endpoint STRING, source_record_id STRING"
    ),
)
VALIDATION_RUNS = TableSpec(
    "validation_runs",
    (
        "run_id STRING, target STRING, created_at TIMESTAMP_NTZ, input_path STRING, "
        "input_sha256 STRING, latest_result_path STRING, latest_result_sha256 STRING, "
        "rule_set_version STRING, total_records LONG, ready_records LONG, "
        "readiness_percent DOUBLE"
    ),
)
VALIDATION_INDEX = TableSpec(
    "validation_result_index_current",
    (
        "target STRING, bucket INT, product_id STRING, ready BOOLEAN, status STRING, "
        "issue_hash STRING, "
        "issue_codes ARRAY<STRING>, issue_severities MAP<STRING, STRING>, display_name STRING, "
        "brand STRING, season STRING, season_year INT, group_key STRING, score DOUBLE, "
        "issue_count LONG, failure_count LONG, hard_warning_count LONG, "
        "soft_warning_count LONG, updated_source_at TIMESTAMP_NTZ, "
        "updated_at TIMESTAMP_NTZ, run_id STRING"
    ),
    ("target", "bucket"),
    key="product_id",
)
VALIDATION_EVENTS = TableSpec(
    "validation_change_events",
    (
        "run_id STRING, target STRING, changed_at TIMESTAMP_NTZ, product_id STRING, "
        "change_type STRING, previous_ready BOOLEAN, current_ready BOOLEAN, "
        "previous_status STRING, current_status STRING, previous_issue_hash STRING, "
        "current_issue_hash STRING, previous_issue_codes ARRAY<STRING>, "
        "current_issue_codes ARRAY<STRING>, previous_issue_severities MAP<STRING, STRING>, "
        "current_issue_severities MAP<STRING, STRING>"
    ),
    ("target", "run_id"),
)
ISSUE_EVENTS = TableSpec(
    "validation_issue_change_events",
    (
        "run_id STRING, target STRING, changed_at TIMESTAMP_NTZ, product_id STRING, "
        "issue_code STRING, change_type STRING, severity STRING"
    ),
    ("target", "run_id"),
)
CHANGELOG_RUNS = TableSpec(
    "endpoint_changelog_runs",
    (
        "run_id STRING, created_at TIMESTAMP_NTZ, config_path STRING, config_sha256 STRING, "
        "endpoint_count LONG, record_count LONG, event_count LONG, full_refresh BOOLEAN, "
        "scoped_record_count LONG"
    ),
)
CHANGELOG_INDEX = TableSpec(
    "endpoint_changelog_index_current",
    (
        "endpoint STRING, bucket INT, record_id STRING, payload_hash STRING, "
        "tracked_payload_json STRING, config_sha256 STRING, updated_at TIMESTAMP_NTZ, "
        "run_id STRING"
    ),
    ("endpoint", "bucket"),
    key="record_id",
)
CHANGELOG_EVENTS = TableSpec(
    "endpoint_change_events",
    (
        "run_id STRING, endpoint STRING, record_id STRING, changed_at TIMESTAMP_NTZ, "
        "change_type STRING, previous_hash STRING, current_hash STRING, "
        "changed_fields ARRAY<STRING>, previous_payload_json STRING, current_payload_json STRING"
    ),
    ("endpoint", "run_id"),
)
FETCH_STATE = TableSpec(
    "fetch_state",
    (
        "endpoint STRING, last_attempted_fetch_start TIMESTAMP_NTZ, "
        "last_attempted_fetch_end TIMESTAMP_NTZ, last_attempted_status STRING, "
        "last_attempted_error STRING, last_successful_fetch_start TIMESTAMP_NTZ, "
        "last_successful_fetch_end TIMESTAMP_NTZ"
    ),
)
CYCLES = TableSpec(
    "cycle_log",
    (
        "cycle_id STRING, started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, "
        "fetch_status STRING, target STRING, pipeline_status STRING, error STRING"
    ),
)

ALL_TABLES = (
    RECORDS,
    LEDGER,
    BATCHES,
    CHANGES,
    PRODUCTS,
    SOURCE_REFS,
    PRODUCT_WARNINGS,
    VALIDATION_RUNS,
    VALIDATION_INDEX,
    VALIDATION_EVENTS,
    ISSUE_EVENTS,
    CHANGELOG_RUNS,
    CHANGELOG_INDEX,
    CHANGELOG_EVENTS,
    FETCH_STATE,
    CYCLES,
)


class MasterStore(TableStore):
    """Current state, ledger, indexes and event tables below one root folder.

    ``buckets`` is the number of folders an endpoint's records are spread over by a hash of
    their id. A batch rewrites only the buckets it touches, so choose it such that a bucket
    holds one or a few input splits; ``endpoint_buckets`` gives big endpoints more.
    ``tasks_per_bucket`` tasks fold and write the parts of one bucket. The bucket
    numbers must not change once records are stored; a store opened with others refuses to read.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = 16,
        endpoint_buckets: Mapping[str, int] | None = None,
        tasks_per_bucket: int = 4,
    ) -> None:
        super().__init__(spark, root, ALL_TABLES)
        self.tasks_per_bucket = tasks_per_bucket
        self.buckets = buckets
        self.endpoint_buckets = dict(endpoint_buckets or {})

    def settings(self) -> dict:
        return {"buckets": self.buckets, "endpoint_buckets": self.endpoint_buckets}

    def bucket_count(self, endpoint: str) -> int:
        return self.endpoint_buckets.get(endpoint, self.buckets)

    def bucket(self, endpoint: Column, record_id: Column) -> Column:
        count = F.lit(self.buckets)
        for name, number in self.endpoint_buckets.items():
            count = F.when(endpoint == name, F.lit(number)).otherwise(count)
        return F.pmod(F.xxhash64(record_id), count).cast("int")

    # -- S7, S8: the current state ---------------------------------------------------------

    def current_records(self) -> DataFrame:
        """Live records of all endpoints; a filter on endpoint prunes the scan."""
        return self.bucketed_records().drop("bucket")

    def bucketed_records(self, partitions: Iterable[Partition] | None = None) -> DataFrame:
        rows = self.read(RECORDS.name, partitions)
        # Rows of older producers may have the time only as text.
        typed = {
            f"{name}_ts": F.coalesce(f"{name}_ts", utc_timestamp(F.col(name)))
            for name in ("modified_at", "ingested_at")
        }
        return rows.where("live").drop("live", "actions", "previous", "batch_id").withColumns(typed)

    def create_views(self, schemas: Mapping[str, EndpointSchema]) -> None:
        """``current_endpoint_records`` and one ``current_<endpoint>`` per schema."""
        records = self.current_records().select(
            "endpoint",
            "record_id",
            "payload",
            F.try_parse_json("payload").alias("payload_json"),
            F.col("modified_at").alias("modified_at_raw"),
            "modified_at_ts",
            "source_file",
            "source_run_id",
            F.col("ingested_at").alias("ingested_at_raw"),
            "ingested_at_ts",
        )
        records.createOrReplaceTempView("current_endpoint_records")
        for name in schemas:
            records.where(F.col("endpoint") == name).createOrReplaceTempView(f"current_{name}")
