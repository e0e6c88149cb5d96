"""The built-in report runs."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame

from truerow.config.naming import Naming
from truerow.config.relationships import DEFAULT_RELATIONSHIPS, Relationship
from truerow.operators import check, refs, reports
from truerow.session import delete_folder, staged
from truerow.sources.sinks import write_sheets, write_text
from truerow.sources.store import MasterStore


def write_coverage_report(
    store: MasterStore,
    folder: str,
    relationships: Iterable[Relationship] = DEFAULT_RELATIONSHIPS,
    naming: Naming | None = None,
    expected_endpoints: Iterable[str] = (),
    file_format: str = "csv",
) -> dict[str, str]:
    """Measure all references of the current state and write the report tables and summary.

    The measured rows, one per relationship and endpoint, are stored once and all sheets are
    made from them, so the records are read a single time.
    """
    work = f"{store.root}/_work/coverage-{uuid.uuid4().hex}"
    found = refs.References.of(store.current_records(), relationships, naming, f"{work}/references")
    counts = _stored(found.counts(expected_endpoints), f"{work}/counts")
    rows = _stored(refs.relationship_coverage(found.statuses(), counts, found.relationships), f"{work}/rows")
    present = counts.where("records > 0")
    sheets = reports.coverage_sheets(
        refs.coverage_summary(rows, present),
        rows,
        counts,
        refs.coverage_issues(rows, counts),
        refs.unresolved_counts(rows),
        refs.COVERAGE_VERSION,
        naming,
    )
    paths = write_sheets(sheets, folder, file_format)
    paths["markdown"] = f"{folder.rstrip('/')}/markdown"
    write_text(reports.coverage_markdown(sheets), paths["markdown"], store.spark)
    return paths


def write_readiness_report(
    results: DataFrame,
    folder: str,
    version: str,
    naming: Naming | None = None,
    file_format: str = "csv",
) -> dict[str, str]:
    """Write the report tables and summary of stored validation results."""
    sheets = reports.readiness_sheets(results, version, naming)
    paths = write_sheets(sheets, folder, file_format)
    paths["markdown"] = f"{folder.rstrip('/')}/markdown"
    write_text(reports.readiness_markdown(results, version), paths["markdown"], results.sparkSession)
    return paths


def write_check_report(results: DataFrame, folder: str, file_format: str = "csv") -> dict[str, str]:
    """The coverage report of check results: summary, issue and reference tables and text.

    The results are read once, stored or not: their counts are written, and all sheets are made from them.
    """
    counted, path = staged(reports.tally(results), "check-tally")
    sheets = reports.coverage_from_tally(counted, check.RULE_SET_VERSION)
    paths = write_sheets(sheets, folder, file_format)
    paths["markdown"] = f"{folder.rstrip('/')}/markdown"
    write_text(reports.coverage_markdown(sheets), paths["markdown"], results.sparkSession)
    delete_folder(results.sparkSession, path)
    return paths


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)
