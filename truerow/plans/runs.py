"""L1, L2: full and scoped runs of a target."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truerow.config.naming import Naming
from truerow.operators import history
from truerow.operators.apply import IngestResult
from truerow.operators.readiness import run_result
from truerow.plans import targets
from truerow.session import delete_folder
from truerow.sources.store import VALIDATION_INDEX, MasterStore


@dataclass(frozen=True)
class TargetRun:
    """``mode`` is full, scoped, or why nothing ran: unchanged or unaffected."""

    target: str
    mode: str
    total_records: int
    ready_records: int
    run_id: str | None = None
    product_changes: int = 0
    issue_changes: int = 0
    results_path: str | None = None


#: Where a stored result lies: its file, and its row there.
_PLACE = "place_in_results"


def _new_path(store: MasterStore, kind: str, target: str) -> str:
    """A fresh folder, so that rows another run may be reading are never overwritten."""
    return f"{store.root}/_{kind}/{history.slug(target)}/{uuid.uuid4().hex}"


def run_full(
    store: MasterStore,
    target: str,
    report_folder: str | None = None,
    template: str = "default",
    naming: Naming | None = None,
) -> TargetRun:
    """L1 after ingest: reconstruct, validate, store the latest results, history, report.

    The results are stored once and everything after that reads them back, so documents are
    reconstructed and checked a single time. The run row names the folder of the latest ones.
    """
    docs = targets.documents(target, store.current_records())
    path = _new_path(store, "results", target)
    targets.results(target, docs, naming).write.parquet(path)
    results = store.spark.read.parquet(path)
    totals = run_result(results).first()
    # Of a repeated id the last one stored counts, however the files are split among tasks.
    place = F.struct("_metadata.file_name", "_metadata.row_index").alias(_PLACE)
    run = history.record(
        store,
        target,
        results.select("*", place),
        rule_set_version=targets.target(target).rule_set_version,
        latest_result_path=path,
        naming=naming,
        position=_PLACE,
        totals=(totals["total_products"], totals["ready_products"]),
    )
    if report_folder is not None:
        targets.report(target, results, report_folder, template)
    return TargetRun(
        target,
        "full",
        run.total_records,
        run.ready_records,
        run.run_id,
        run.product_change_count,
        run.issue_change_count,
        path,
    )


def run_after_ingest(
    store: MasterStore,
    target: str,
    ingested: IngestResult,
    naming: Naming | None = None,
) -> TargetRun:
    """L2: validate only the products behind changed records.

    Falls back to a full run without a baseline or without a way to find affected products.
    The latest stored results are left as they are by a scoped run. The old keys and references
    of changed and deleted records come with the ingest, so products that only they led to are
    found as well.
    """
    index = store.read(VALIDATION_INDEX.name).where(F.col("target") == target)
    chosen = targets.target(target)
    if not history.has_baseline(index) or (ingested.changed_endpoints and not chosen.affected):
        return run_full(store, target, naming=naming)

    def nothing(mode: str) -> TargetRun:
        total, ready = history.index_counts(index).first()
        return TargetRun(target, mode, total, ready)

    if not ingested.changed_endpoints:
        return nothing("unchanged")
    scope, path = _stored_scope(store, chosen, ingested)
    if scope.isEmpty():
        return nothing("unaffected")
    docs = targets.documents(target, store.current_records(), scope)
    run = history.record(
        store,
        target,
        targets.results(target, docs, naming),
        scope=scope,
        rule_set_version=chosen.rule_set_version,
        naming=naming,
    )
    delete_folder(store.spark, path)
    return TargetRun(
        target,
        "scoped",
        run.total_records,
        run.ready_records,
        run.run_id,
        run.product_change_count,
        run.issue_change_count,
    )


def _stored_scope(
    store: MasterStore, chosen: targets.Target, ingested: IngestResult
) -> tuple[DataFrame, str]:
    """The affected product ids, stored once because several joins read them, and their folder."""
    before = ingested.changes.where(F.col("previous").isNotNull())
    before = before.select("endpoint", "record_id", F.col("previous").alias("payload"))
    states = [store.current_records(), before]
    found = targets.scope_of(chosen.affected(ingested.changed_ids, states))
    path = _new_path(store, "scopes", chosen.name)
    found.write.parquet(path)
    return store.spark.read.parquet(path), path
