from datetime import datetime, timedelta, timezone

import pytest

from truerow.functions.times import parse_since, window_start
from truerow.operators import history
from truerow.sources.store import (
    ISSUE_EVENTS,
    VALIDATION_EVENTS,
    VALIDATION_INDEX,
    VALIDATION_RUNS,
    MasterStore,
)

SCHEMA = (
    "style_id STRING, style_name STRING, brand STRING, season STRING, ready BOOLEAN, "
    "status STRING, score DOUBLE, updated_source_at STRING, "
    "issues ARRAY<STRUCT<code: STRING, severity: STRING, source_field: STRING, "
    "rule_id: STRING, blocking: BOOLEAN, warning_level: STRING>>"
)


def _issue(code, severity, level=None):
    return (code, severity, "records.style", f"rule.{code}", severity == "error", level)


def _results(spark, *rows):
    data = [
        (i, f"Style {i}", "CRAFT", "AW27", ready, None, 82.5, "2026-05-08T07:30:00Z", issues)
        for i, ready, issues in rows
    ]
    return spark.createDataFrame(data, SCHEMA)


def _at(minute):
    return datetime(2026, 5, 8, 8, minute)


def test_runs_events_and_index(spark, tmp_path):
    store = MasterStore(spark, str(tmp_path / "s"), buckets=3)
    color, size = _issue("COLOR", "error"), _issue("SIZE", "warning", "soft")

    def run(minute, *rows, **options):
        return history.record(
            store, "md", _results(spark, *rows), created_at=_at(minute), **options
        )

    first = run(0, ("S1", False, [color, size]), ("S2", True, []))
    assert (first.product_change_count, first.issue_change_count) == (2, 2)
    reordered = run(1, ("S1", False, [size, color]), ("S2", True, []))
    assert (reordered.product_change_count, reordered.issue_change_count) == (0, 0)
    scope = spark.createDataFrame([("S1",)], "product_id STRING")
    scoped = run(2, ("S1", True, []), ("S3", True, []), scope=scope)
    assert (scoped.product_change_count, scoped.issue_change_count) == (1, 2)
    assert (scoped.total_records, scoped.ready_records) == (2, 2)
    index = store.read(VALIDATION_INDEX.name)
    rows = {r["product_id"]: r for r in index.collect()}
    assert {i: r["ready"] for i, r in rows.items()} == {"S1": True, "S2": True}
    s1 = rows["S1"]
    assert (s1["display_name"], s1["season_year"], s1["group_key"]) == (
        "Style S1",
        27,
        "CRAFT|AW27",
    )
    assert s1["updated_source_at"] == datetime(2026, 5, 8, 7, 30) and s1["score"] == 82.5
    last = run(2, ("S2", False, [color]))
    assert last.run_id == "2026-05-08T080200Z-md-2"

    events = store.read(VALIDATION_EVENTS.name)
    listed = history.list_changes(events, "md", limit=3).collect()
    found = [(r["product_id"], r["change_type"]) for r in listed]
    # The two events of S1 have the same time, so either may come first.
    assert sorted(found[:2]) == [("S1", "changed"), ("S1", "removed")]
    assert found[2] == ("S2", "changed")
    issues = store.read(ISSUE_EVENTS.name)
    counts = history.issue_counts(issues, "md").collect()
    assert {(r["issue_code"], r["change_type"]): (r["severity"], r["count"]) for r in counts} == {
        ("COLOR", "added"): ("error", 2),
        ("COLOR", "resolved"): ("error", 1),
        ("SIZE", "added"): ("warning", 1),
        ("SIZE", "resolved"): ("warning", 1),
    }
    runs = store.read(VALIDATION_RUNS.name)
    page = history.list_runs(runs, events, issues, "md", since=_at(1)).collect()
    assert {(r["run_id"], r["product_changes"], r["issue_changes"]) for r in page} == {
        (last.run_id, 2, 1),
        (scoped.run_id, 1, 2),
        (reordered.run_id, 0, 0),
    }
    assert [r["product_id"] for r in history.became_ready(events, "md").collect()] == ["S1"]
    assert [r["product_id"] for r in history.regressed(events, "md").collect()] == ["S2"]
    assert history.latest_runs(runs).first()["created_at"] == _at(2)
    assert [r["product_id"] for r in history.failing(store.read(VALIDATION_INDEX.name), "md").collect()] == ["S2"]
    done = history.completion(store.read(VALIDATION_INDEX.name), "md").first()
    assert (done["records"], done["ready_records"], done["failures"]) == (1, 0, 1)


def test_index_of_odd_results(spark):
    data = [
        ("", "P1", "soon", "x", 9, None, 2, [("R1", "error"), (None, "warning"), ("R1", "warning")]),
        ("", "P1", "2026-01-01", "7", None, 5, 2, None),
        (None, "", "2026-01-01", "7", 1, 1, 1, []),
    ]
    schema = (
        "style_id STRING, id STRING, latest_modified_at STRING, score STRING, error_count INT, "
        "warning_count INT, hard_warning_count INT, "
        "issues ARRAY<STRUCT<report_code: STRING, severity: STRING>>"
    )
    df = spark.createDataFrame(data, schema).coalesce(1)
    row = history.validation_index(df).first()
    assert (row["product_id"], row["status"], row["score"]) == ("P1", "unknown", 7.0)
    assert (row["failure_count"], row["soft_warning_count"], row["issue_count"]) == (0, 3, 0)
    first = history.validation_index(df.limit(1)).first()
    assert first["issue_codes"] == ["R1"] and first["issue_severities"] == {"R1": "error"}
    assert (first["failure_count"], first["soft_warning_count"]) == (9, 0)
    assert first["updated_source_at"] is None and first["group_key"] is None


def test_since_and_windows():
    now = datetime(2026, 5, 8, 13, 30, tzinfo=timezone(timedelta(hours=7)))
    assert parse_since("2026-05-08T12:45+07:00") == datetime(2026, 5, 8, 5, 45)
    assert parse_since("10h", now) == datetime(2026, 5, 7, 20, 30)
    assert parse_since("2d", now) == datetime(2026, 5, 6, 6, 30)
    assert parse_since("3m", now) == datetime(2026, 2, 8, 6, 30)
    assert parse_since("1y", now) == datetime(2025, 5, 8, 6, 30)
    assert parse_since("1m", datetime(2026, 3, 31, tzinfo=timezone.utc)) == datetime(2026, 2, 28)
    assert parse_since("  ") is None
    with pytest.raises(ValueError):
        parse_since("10s")
    assert window_start(datetime(2026, 3, 31), months=1) == datetime(2026, 2, 28)
    with pytest.raises(ValueError):
        window_start(datetime(2026, 3, 31), days=1, months=1)
