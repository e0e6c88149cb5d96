"""Apply raw files to the stored state in bounded batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truerow.config.endpoints import EndpointSchema
from truerow.functions.jsons import is_malformed, line_fields
from truerow.functions.times import utc_now, utc_text
from truerow.operators.ingest import (
    DELETE,
    SEED,
    UPSERT,
    actions_of,
    changes_of,
    extract,
    file_counts,
    fold,
    latest_per_key,
)
from truerow.session import delete_folder, staged
from truerow.sources.rawfiles import (
    RawFile,
    check_snapshot_modes,
    discover,
    pending,
    read_lines,
)
from truerow.sources.store import BATCHES, CHANGES, LEDGER, RECORDS, MasterStore
from truerow.sources.tables import within

_FILE_FIELDS = "file_ord INT, file_path STRING, endpoint STRING, source_run_id STRING"


@dataclass(frozen=True)
class IngestResult:
    """Counts of one ingest; the changed ids stay in a DataFrame.

    ``changes`` has the payload that a record had before the batch as ``previous``.
    """

    applied_files: int
    skipped_files: int
    records_read: int
    records_upserted: int
    records_deleted: int
    endpoints: dict[str, int]
    changed_endpoints: tuple[str, ...]
    failed_files: tuple[str, ...]
    changes: DataFrame

    @property
    def upserted_ids(self) -> DataFrame:
        return self._ids(self.changes.where(F.col("action") == UPSERT))

    @property
    def deleted_ids(self) -> DataFrame:
        return self._ids(self.changes.where(F.col("action") == DELETE))

    @property
    def changed_ids(self) -> DataFrame:
        return self._ids(self.changes)

    @staticmethod
    def _ids(changes: DataFrame) -> DataFrame:
        return changes.select("endpoint", "record_id").distinct()


def ingest(
    store: MasterStore,
    raw_dir: str,
    schemas: Mapping[str, EndpointSchema],
    on_malformed: str = "fail",
    max_files_per_batch: int = 500,
    verify_content: bool = False,
) -> IngestResult:
    """Apply all new files below ``raw_dir`` in order.

    Files are taken in batches of ``max_files_per_batch``. A batch writes its list of files, the
    touched buckets of the state, the changes and, last, the ledger; one that died in between is
    finished first by the next ingest, which leaves the buckets it had written as they are.
    ``on_malformed='fail_file'`` leaves files with a malformed line out of the batch and names
    them in the result, ``'fail'`` stops.
    """
    spark = store.spark
    found = pending(spark, discover(spark, raw_dir), store.read(LEDGER.name), verify_content)
    return apply_files(
        store, found.files, schemas, found.skipped, on_malformed, max_files_per_batch
    )


def apply_files(
    store: MasterStore,
    files: Sequence[RawFile],
    schemas: Mapping[str, EndpointSchema],
    skipped: int = 0,
    on_malformed: str = "fail",
    max_files_per_batch: int = 500,
) -> IngestResult:
    if on_malformed not in ("fail", "fail_file"):
        raise ValueError("on_malformed is 'fail' or 'fail_file'.")
    check_snapshot_modes(files, schemas)
    failed: list[str] = []
    batches: list[str] = []
    for batch_id, batch in _batches(store, files, max_files_per_batch):
        if on_malformed == "fail_file":
            bad = _malformed_files(read_lines(store.spark, batch))
            failed += sorted(bad)
            batch = [f for f in batch if f.file_path not in bad]
        if batch:
            batch = [replace(f, file_ord=number) for number, f in enumerate(batch)]
            lines = _with_file(store, read_lines(store.spark, batch), batch)
            records = extract(lines, schemas, fail_on_malformed=on_malformed == "fail")
            batches.append(_apply_batch(store, records, batch, schemas, batch_id))
    return _result(store, batches, skipped, failed)


def _batches(
    store: MasterStore, files: Sequence[RawFile], most: int
) -> Iterator[tuple[str | None, list[RawFile]]]:
    """The files in batches; one that was begun and not finished comes first, with its id and files."""
    done = store.read(LEDGER.name).select("batch_id").distinct()
    # Only the last batch of a job can be open, so this is at most one batch of file names.
    begun = store.read(BATCHES.name).join(done, "batch_id", "left_anti").collect()
    rest = list(files)
    for batch_id in sorted({row["batch_id"] for row in begun}):
        names = {row["file_path"] for row in begun if row["batch_id"] == batch_id}
        again = [f for f in rest if f.file_path in names]
        if len(again) < len(names):
            gone = sorted(names - {f.file_path for f in again})
            raise ValueError(f"Files of the unfinished batch {batch_id} are gone: {', '.join(gone[:5])}")
        rest = [f for f in rest if f.file_path not in names]
        yield batch_id, again
    for start in range(0, len(rest), most):
        yield None, rest[start : start + most]


def _with_file(store: MasterStore, lines: DataFrame, files: Sequence[RawFile]) -> DataFrame:
    # At most max_files_per_batch rows, so the broadcast is bounded.
    rows = [(f.file_ord, f.file_path, f.endpoint, f.source_run_id) for f in files]
    table = store.spark.createDataFrame(rows, _FILE_FIELDS)
    return lines.join(F.broadcast(table), "file_path")


def _malformed_files(lines: DataFrame) -> set[str]:
    parsed = lines.withColumn("parsed", line_fields(F.col("payload"), []))
    bad = parsed.where(is_malformed(F.col("payload"), F.col("parsed")))
    return {row["file_path"] for row in bad.select("file_path").distinct().collect()}


def merge_winners(store: MasterStore, winners: DataFrame, batch_id: str) -> DataFrame:
    """Fold one row per record and file into the state, and store the changes.

    ``winners`` is stored, with endpoint, bucket, record_id, the stored record fields, file_ord,
    is_delete and lines. Every row of a bucket carries the id of the batch that wrote it last, so
    a batch that runs again leaves the buckets it has written already. Returns the actions.
    """
    touched = store.partitions_of(winners, "endpoint", "bucket")
    state = store.read(RECORDS.name, touched)
    settled = store.partitions_of(state.where(F.col("batch_id") == batch_id), "endpoint", "bucket")
    if settled:
        winners = winners.where(~within(RECORDS.partition_by, settled))
    left = sorted(set(touched) - set(settled))
    stored = store.bucketed_records(left).withColumns(
        {"file_ord": F.lit(SEED), "is_delete": F.lit(False), "lines": F.lit(0).cast("long")}
    )
    # Shuffled once, by bucket and by a part of the bucket that the record id chooses: the fold
    # groups inside these partitions, and several tasks write the files of one bucket.
    part = F.pmod(F.xxhash64(F.lit("part"), "record_id"), F.lit(store.tasks_per_bucket))
    events = stored.unionByName(winners).withColumn("part", part)
    events = events.repartition("endpoint", "bucket", "part")
    if left:
        folded = fold(events, ["endpoint", "bucket", "part", "record_id"])
        store.replace(RECORDS.name, folded.withColumn("batch_id", F.lit(batch_id)))
    written = store.read(RECORDS.name, touched).where("size(actions) > 0")
    changes = changes_of(written, "previous").withColumn("batch_id", F.lit(batch_id))
    store.replace(CHANGES.name, changes)
    return actions_of(written)


def _apply_batch(
    store: MasterStore,
    records: DataFrame,
    files: Sequence[RawFile],
    schemas: Mapping[str, EndpointSchema],
    batch_id: str | None,
) -> str:
    now = utc_now()
    incoming = records.withColumn(
        "bucket", store.bucket(F.col("endpoint"), F.col("record_id"))
    )
    winners = latest_per_key(
        incoming,
        ["endpoint", "bucket", "record_id", "file_ord", "file_path", "source_run_id"],
        ["block", "row_id"],
        ["is_delete", "payload"],
    ).select(
        "endpoint",
        "bucket",
        "record_id",
        "file_ord",
        F.col("file_path").alias("source_file"),
        "source_run_id",
        "modified_at",
        "modified_at_ts",
        "payload",
        "is_delete",
        "lines",
        F.lit(utc_text(now)).alias("ingested_at"),
        F.lit(now).cast("timestamp_ntz").alias("ingested_at_ts"),
    )
    # Stored once: the lines are read a single time, and the winners name the buckets they touch.
    winners, path = staged(winners, "winners")
    if batch_id is None:
        batch_id = f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        begun = [(batch_id, f.file_path, now) for f in files]
        store.append(BATCHES.name, store.spark.createDataFrame(begun, BATCHES.schema).coalesce(1))
    actions = merge_winners(store, winners, batch_id)
    store.append(LEDGER.name, _ledger_rows(store, actions, files, schemas, batch_id, now))
    delete_folder(store.spark, path)
    return batch_id


def _ledger_rows(
    store: MasterStore,
    actions: DataFrame,
    files: Sequence[RawFile],
    schemas: Mapping[str, EndpointSchema],
    batch_id: str,
    now,
) -> DataFrame:
    """One row per applied file, files without records included."""
    rows = [
        (
            f.file_ord,
            f.file_path,
            f.endpoint,
            f.source_run_id,
            f.is_delta,
            f.content_sha256,
            f.manifest_path,
            f.manifest_sha256,
            f.run_mode,
            schemas.get(f.endpoint, EndpointSchema(f.endpoint)).full_snapshot_mode,
            f.length,
            f.modified,
        )
        for f in files
    ]
    table = store.spark.createDataFrame(
        rows,
        "file_ord INT, file_path STRING, endpoint STRING, source_run_id STRING, "
        "is_delta BOOLEAN, content_sha256 STRING, manifest_path STRING, "
        "manifest_sha256 STRING, run_mode STRING, full_snapshot_mode STRING, length LONG, "
        "modified TIMESTAMP",
    )
    counts = file_counts(actions)
    return (
        table.join(counts, "file_ord", "left")
        .fillna(0, ["record_count", "upserted", "deleted"])
        .withColumns(
            {
                "batch_id": F.lit(batch_id),
                "ingested_at": F.lit(utc_text(now)),
                "ingested_at_ts": F.lit(now).cast("timestamp_ntz"),
            }
        )
        .coalesce(1)
    )


def _result(
    store: MasterStore, batches: Sequence[str], skipped: int, failed: Sequence[str]
) -> IngestResult:
    applied = store.read(LEDGER.name).where(F.col("batch_id").isin(list(batches)))
    rows = (
        applied.groupBy("endpoint")
        .agg(
            F.count("*").alias("files"),
            F.sum("record_count").alias("records"),
            F.sum("upserted").alias("upserted"),
            F.sum("deleted").alias("deleted"),
        )
        .orderBy("endpoint")
        .collect()
    )
    changes = store.read(CHANGES.name, [(batch,) for batch in batches])
    return IngestResult(
        applied_files=sum(r["files"] for r in rows),
        skipped_files=skipped,
        records_read=sum(r["records"] for r in rows),
        records_upserted=sum(r["upserted"] for r in rows),
        records_deleted=sum(r["deleted"] for r in rows),
        endpoints={r["endpoint"]: r["records"] for r in rows},
        changed_endpoints=tuple(
            r["endpoint"] for r in rows if r["upserted"] or r["deleted"]
        ),
        failed_files=tuple(failed),
        changes=changes,
    )
