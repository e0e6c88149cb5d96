"""The same ordered fold as a stream of micro-batches.

Late records are not dropped by a watermark: the state table compares event times, so a late
older record loses and a late correction wins whenever it arrives. The stream checkpoint
says which input was read; the ledger, written after the state, says which input was applied. A
batch that runs again after a crash goes on where it stopped, or changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from truerow.config.endpoints import EndpointSchema
from truerow.functions.times import utc_now, utc_text
from truerow.operators.apply import IngestResult, apply_files, merge_winners
from truerow.operators.ingest import (
    extract,
    file_counts,
    latest_per_key,
)
from truerow.session import delete_folder, staged
from truerow.sources.rawfiles import discover, pending
from truerow.sources.store import LEDGER, MasterStore

AfterBatch = Callable[[MasterStore, IngestResult], None]


def _start(
    stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def ingest_files_stream(
    store: MasterStore,
    raw_dir: str,
    schemas: Mapping[str, EndpointSchema],
    checkpoint: str,
    every: str | None = None,
    max_files_per_trigger: int = 500,
    after_batch: AfterBatch | None = None,
    on_malformed: str = "fail",
) -> StreamingQuery:
    """Apply raw JSONL files as they arrive; without ``every`` it stops when all are read.

    The stream only announces that there are new files; every micro-batch applies all pending
    files of the folder in the order of S2, as ``ingest`` does, so ``max_files_per_trigger``
    changes no result: it bounds how many files are announced and applied in one commit. Files
    that arrive later come after those applied before, also as in ``ingest``. ``after_batch`` is
    called with the result, for instance to run the pipelines of several targets; the result
    has no files where an earlier batch has applied them. With ``on_malformed='fail_file'`` a file
    with a malformed line stops neither the stream nor the other files: the result names it, and
    it stays pending until it is mended.
    """
    stream = (
        store.spark.readStream.format("text")
        .option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.jsonl")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(raw_dir)
    )

    def apply(batch: DataFrame, _: int) -> None:
        found = pending(store.spark, discover(store.spark, raw_dir), store.read(LEDGER.name))
        result = apply_files(
            store, found.files, schemas, found.skipped, on_malformed, max_files_per_trigger
        )
        if after_batch is not None:
            after_batch(store, result)

    return _start(stream, apply, checkpoint, every)


def ingest_records_stream(
    store: MasterStore,
    stream: DataFrame,
    schemas: Mapping[str, EndpointSchema],
    checkpoint: str,
    name: str,
    order: Sequence[str],
    every: str | None = None,
) -> StreamingQuery:
    """Apply a stream of (endpoint, payload) rows; ``order`` columns stand for the line order.

    A micro-batch counts as one file called ``<name>/<batch number>``.
    """

    def apply(batch: DataFrame, number: int) -> None:
        apply_record_batch(store, batch, schemas, f"{name}/{number}", order)

    return _start(stream, apply, checkpoint, every)


def apply_record_batch(
    store: MasterStore,
    rows: DataFrame,
    schemas: Mapping[str, EndpointSchema],
    source: str,
    order: Sequence[str],
) -> bool:
    """One micro-batch; False when the ledger already has it."""
    ledger = store.read(LEDGER.name)
    if not ledger.where(F.col("file_path") == source).isEmpty():
        return False
    now = utc_now()
    records = extract(rows, schemas).withColumn(
        "bucket", store.bucket(F.col("endpoint"), F.col("record_id"))
    )
    winners = latest_per_key(
        records, ["endpoint", "bucket", "record_id"], order, ["is_delete", "payload"]
    ).withColumns(
        {
            "file_ord": F.lit(0),
            "source_file": F.lit(source),
            "source_run_id": F.lit(source),
            "ingested_at": F.lit(utc_text(now)),
            "ingested_at_ts": F.lit(now).cast("timestamp_ntz"),
        }
    )
    winners, path = staged(winners.drop(*order), "winners")
    # The same micro-batch has the same id when it runs again.
    batch_id = hashlib.sha256(source.encode()).hexdigest()[:24]
    actions = merge_winners(store, winners, batch_id)
    row = file_counts(actions).withColumns(
        {
            "file_path": F.lit(source),
            "endpoint": F.lit("*"),
            "source_run_id": F.lit(source),
            "is_delta": F.lit(True),
            "batch_id": F.lit(batch_id),
            "ingested_at": F.lit(utc_text(now)),
            "ingested_at_ts": F.lit(now).cast("timestamp_ntz"),
        }
    )
    store.append(LEDGER.name, row.coalesce(1))
    delete_folder(store.spark, path)
    return True


def for_each_target(
    targets: Iterable[str], run: Callable[[MasterStore, IngestResult, str], object]
) -> AfterBatch:
    """L3: run every target on its own; one that fails does not stop the others."""
    names = list(targets)

    def after(store: MasterStore, result: IngestResult) -> None:
        from truerow.plans.cycles import record_cycle

        record_cycle(store, result, names, run)

    return after
