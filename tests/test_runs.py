import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from truerow.config import Naming, Relationship, RuleSet, TrackingConfig, load_endpoint_schemas
from truerow.operators import affected, changelog, readiness, reports
from truerow.operators.apply import ingest
from truerow.operators.incremental import batch_manifest, run_manifest
from truerow.plans import cycles, targets
from truerow.plans.runs import run_after_ingest, run_full
from truerow.sources.store import (
    CHANGELOG_EVENTS,
    CYCLES,
    LEDGER,
    VALIDATION_INDEX,
    VALIDATION_RUNS,
    MasterStore,
)
from truerow.streaming.ingest_stream import for_each_target, ingest_files_stream

SCHEMAS = load_endpoint_schemas()
RULES = (Relationship("style_sizes", "styles", ("sizes",), "sizes", ("id", "code")),)


def _documents(records, scope):
    styles = records.where("endpoint = 'styles'").select(
        F.col("record_id").alias("style_id"),
        F.get_json_object("payload", "$.name").alias("style_name"),
    )
    if scope is None:
        return styles
    return styles.join(scope, styles["style_id"] == scope["product_id"], "left_semi")


def _validate(documents):
    named = F.col("style_name").isNotNull()
    no_name = F.array(F.struct(F.lit("NO_NAME").alias("code"), F.lit("error").alias("severity")))
    return documents.withColumns(
        {"ready": named, "issues": F.when(~named, no_name).otherwise(F.slice(no_name, 1, 0))}
    )


@pytest.fixture
def names():
    targets.register_target(
        "names",
        reconstruct=_documents,
        affected=lambda changed, states: affected.affected_records(
            changed, states, "styles", RULES
        ),
        validate=_validate,
        rule_set_version="n1",
    )
    return "names"


def _index(store):
    rows = store.read(VALIDATION_INDEX.name).collect()
    return {r["product_id"]: r["ready"] for r in rows}


def test_full_scoped_and_skipped_runs(spark, tmp_path, write_jsonl, names):
    store = MasterStore(spark, str(tmp_path / "store"), buckets=2)
    raw = tmp_path / "raw"
    write_jsonl(
        raw / "styles.jsonl",
        [{"id": "S1", "name": "A", "sizes": ["Z"]}, {"id": "S2", "sizes": {"0": "M"}}, {"id": "S3"}],
    )
    write_jsonl(raw / "sizes.jsonl", [{"id": "X", "code": "Z"}, {"id": "M"}])
    first = run_after_ingest(store, names, ingest(store, str(raw), SCHEMAS))
    assert (first.mode, first.total_records, first.ready_records) == ("full", 3, 1)
    row = store.read(VALIDATION_RUNS.name).first()
    assert (row["rule_set_version"], row["readiness_percent"]) == ("n1", 33.33)
    assert spark.read.parquet(row["latest_result_path"]).count() == 3

    assert run_after_ingest(store, names, ingest(store, str(raw), SCHEMAS)).mode == "unchanged"

    write_jsonl(raw / "runs" / "r1" / "colorways.delta.jsonl", [{"id": "C"}])
    other = run_after_ingest(store, names, ingest(store, str(raw), SCHEMAS))
    assert (other.mode, other.total_records) == ("unaffected", 3)

    write_jsonl(raw / "runs" / "r2" / "sizes.delta.jsonl", [{"id": "X", "active": False}])
    write_jsonl(raw / "runs" / "r2" / "styles.delta.jsonl", [{"id": "S3", "active": False}])
    changed = ingest(store, str(raw), SCHEMAS)
    scoped = run_after_ingest(store, names, changed)
    assert (scoped.mode, scoped.total_records, scoped.ready_records) == ("scoped", 2, 1)
    assert scoped.product_changes == 1 and _index(store) == {"S1": True, "S2": False}

    tracking = TrackingConfig.load({"endpoints": {"styles": ["id", "name"]}})
    baseline = changelog.record_after_ingest(store, tracking, changed)
    assert baseline.full_refresh and baseline.event_count == 2
    write_jsonl(raw / "runs" / "r3" / "styles.delta.jsonl", [{"id": "S2", "name": "B"}])
    chained = changelog.record_after_ingest(store, tracking, ingest(store, str(raw), SCHEMAS))
    assert not chained.full_refresh and (chained.scoped_record_count, chained.event_count) == (1, 1)
    events = store.read(CHANGELOG_EVENTS.name)
    assert changelog.with_parsed_payloads(changelog.list_changes(events, "styles")).count() == 3

    manifests = batch_manifest(store.read(LEDGER.name))
    runs = {r["run_id"]: r for r in run_manifest(manifests).collect()}
    assert runs["r2"]["endpoints_total"] == 2 and runs["r2"]["total_items"] == 2


def test_targets_describe_themselves_and_the_check_is_built_in(spark, tmp_path, write_jsonl, names):
    store = MasterStore(spark, str(tmp_path / "store"), buckets=2)
    write_jsonl(tmp_path / "raw" / "styles.jsonl", [{"id": "S1"}])
    ingest(store, str(tmp_path / "raw"), SCHEMAS)
    run = run_full(store, "check")
    assert (run.total_records, run.ready_records) == (1, 1)
    assert targets.describe_target("check")["validate"] == "built-in check"
    assert targets.describe_target(names)["reconstruct"] == "registered function"
    with pytest.raises(ValueError, match="reconstruct"):
        run_full(store, "unknown")
    with pytest.raises(ValueError, match="report"):
        targets.report("unknown", spark.range(1), str(tmp_path / "r"))


def test_the_check_writes_its_report(spark, tmp_path, write_jsonl):
    store = MasterStore(spark, str(tmp_path / "store"), buckets=2)
    write_jsonl(tmp_path / "raw" / "styles.jsonl", [{"id": "S1"}, {"id": "S2"}])
    ingest(store, str(tmp_path / "raw"), SCHEMAS)
    folder = tmp_path / "report"
    run = run_full(store, "check", report_folder=str(folder))
    summary = spark.read.option("header", "true").csv(str(folder / "summary"))
    values = {r["metric"]: r["value"] for r in summary.collect()}
    assert (values["styles_in_store"], values["reference_coverage_percent"]) == ("2", "100.0")
    results = spark.read.parquet(run.results_path)
    issues = spark.read.option("header", "true").csv(str(folder / "issues")).collect()
    want = {(r["code"], r["bucket"]): str(r["count"]) for r in reports.issue_counts(results).collect()}
    assert want and {(r["code"], r["bucket"]): r["count"] for r in issues} == want
    text = "\n".join(r["value"] for r in spark.read.text(str(folder / "markdown")).collect())
    assert "Styles in store: `2`" in text


def test_a_rule_set_is_a_target(spark, tmp_path, write_jsonl):
    """Documents come from the target's own function, checks, scores and report from the rule set."""
    rules = RuleSet.load(Path(__file__).parent / "fixtures" / "rules.yml")
    naming = Naming(system="src", label="SRC")

    def reconstruct(records, scope):
        docs = records.where("endpoint = 'styles'")
        return docs.select(F.from_json("payload", readiness.document_schema(naming)).alias("d")).select("d.*")

    targets.register_rules("rules", rules, naming, reconstruct=reconstruct)
    store = MasterStore(spark, str(tmp_path / "store"), buckets=2)
    own = [
        {"id": "A", "src_style_id": "A", "brand_code": "NORD", "global_style_id": "G"},
        {"id": "B", "src_style_id": "B", "brand_code": "SOUTH"},
    ]
    write_jsonl(tmp_path / "raw" / "styles.jsonl", own)
    ingest(store, str(tmp_path / "raw"), SCHEMAS)
    run = run_full(store, "rules", report_folder=str(tmp_path / "report"), naming=naming)
    row = store.read(VALIDATION_RUNS.name).first()
    assert (run.total_records, row["rule_set_version"]) == (2, rules.version)
    products = spark.read.option("header", "true").csv(str(tmp_path / "report" / "products")).collect()
    results = {r["src_style_id"]: r for r in spark.read.parquet(run.results_path).collect()}
    assert {r["src_style_id"]: int(r["score"]) for r in products} == {k: r["score"] for k, r in results.items()}
    codes = {k: {i["code"] for i in r["issues"]} for k, r in results.items()}
    assert "GLOBAL_STYLE_ID_MISSING" in codes["B"] and "GLOBAL_STYLE_ID_MISSING" not in codes["A"]


def test_file_stream_applies_each_file_once_and_isolates_targets(spark, tmp_path, write_jsonl, names):
    store = MasterStore(spark, str(tmp_path / "store"), buckets=2)
    raw = tmp_path / "raw"
    write_jsonl(raw / "styles.jsonl", [{"id": "S1", "name": "A"}])
    seen = []

    def run(state, result, name):
        seen.append((name, result.applied_files))
        if name == "broken":
            raise RuntimeError("no")
        return run_after_ingest(state, name, result)

    def stream():
        query = ingest_files_stream(
            store,
            str(raw),
            SCHEMAS,
            str(tmp_path / "checkpoint"),
            after_batch=for_each_target(["broken", names], run),
        )
        query.awaitTermination()

    stream()
    write_jsonl(raw / "runs" / "r1" / "styles.delta.jsonl", [{"id": "S1"}, {"id": "S2", "name": "B"}])
    stream()
    stream()
    assert seen == [("broken", 1), (names, 1), ("broken", 1), (names, 1)]
    assert _index(store)["S2"] is True
    status = cycles.cycle_status(store.read(CYCLES.name)).collect()
    assert [r["status"] for r in status] == ["PARTIAL_FAILURE"] * 2
    # A batch that is applied again, as after a crash, finds its files in the ledger.
    assert ingest(store, str(raw), SCHEMAS).skipped_files == 2


def test_a_malformed_file_does_not_stop_a_file_stream(spark, tmp_path, write_jsonl):
    store = MasterStore(spark, str(tmp_path / "store"), buckets=2)
    raw, results = tmp_path / "raw", []
    write_jsonl(raw / "r1" / "styles.jsonl", [{"id": "S1"}])
    write_jsonl(raw / "r2" / "styles.jsonl", [{"id": "S2"}, "{broken"])
    write_jsonl(raw / "r3" / "styles.jsonl", [{"id": "S3"}])

    def stream(on_malformed):
        ingest_files_stream(
            store, str(raw), SCHEMAS, str(tmp_path / "checkpoint"), max_files_per_trigger=1,
            after_batch=lambda _, result: results.append(result), on_malformed=on_malformed,
        ).awaitTermination()
        return {r["record_id"] for r in store.current_records().collect()}

    assert stream("fail_file") == {"S1", "S3"}
    assert all(len(r.failed_files) == 1 and r.failed_files[0].endswith("r2/styles.jsonl") for r in results)
    # Mended, it is applied with the next file that arrives.
    write_jsonl(raw / "r2" / "styles.jsonl", [{"id": "S2"}])
    write_jsonl(raw / "r4" / "styles.jsonl", [{"id": "S4"}])
    assert stream("fail") == {"S1", "S2", "S3", "S4"}


def test_deleted_records_are_followed_by_their_old_references(spark, tmp_path, write_jsonl):
    """Each target of a stream finds the products of deleted records, with no state kept by the caller."""
    seen = {}

    def reconstruct(records, scope):
        if scope is not None:
            seen["scope"] = {r["product_id"] for r in scope.collect()}
        return _documents(records, scope)

    targets.register_target(
        "old", reconstruct=reconstruct, validate=_validate,
        affected=lambda changed, states: affected.affected_records(changed, states, "styles", RULES),
    )
    store = MasterStore(spark, str(tmp_path / "store"), buckets=2)
    raw = tmp_path / "raw"
    write_jsonl(raw / "styles.jsonl", [{"id": f"S{n}", "name": "A", "sizes": [z]} for n, z in enumerate("XYZ")])
    write_jsonl(raw / "sizes.jsonl", [{"id": "1", "code": "X"}, {"id": "2", "code": "Y"}, {"id": "3", "code": "Z"}])
    after = for_each_target(["old"], lambda state, result, name: run_after_ingest(state, name, result))
    after(store, ingest(store, str(raw), SCHEMAS))
    delta = [{"id": "1", "active": False}, {"id": "2", "code": "V"}]
    write_jsonl(raw / "r1" / "sizes.delta.jsonl", delta)
    after(store, ingest(store, str(raw), SCHEMAS))
    assert seen["scope"] == {"S0", "S1"}
    assert cycles.cycle_status(store.read(CYCLES.name)).where("status <> 'OK'").count() == 0


def test_of_repeated_results_the_last_stored_one_counts(spark, tmp_path):
    def reconstruct(records, scope):
        rows = [(f"P{n % 40}", f"name {n:03}") for n in range(400)]
        return spark.createDataFrame(rows, "style_id STRING, style_name STRING").repartitionByRange(7, "style_name")

    targets.register_target("repeated", reconstruct=reconstruct, validate=lambda docs: docs.withColumn("ready", F.lit(True)))
    store = MasterStore(spark, str(tmp_path / "store"), buckets=2)
    for split in ("1k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            run_full(store, "repeated")
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        names = {r["product_id"]: r["display_name"] for r in store.read(VALIDATION_INDEX.name).collect()}
        assert names == {f"P{n % 40}": f"name {n:03}" for n in range(360, 400)}


def test_file_stream_over_more_files_than_a_trigger_equals_ingest(spark, tmp_path, write_jsonl):
    """Runs are applied in the order of their names, though the files were written the other way."""
    raw = tmp_path / "raw"
    lines = [{"name": "A"}, {"active": False}, {"name": "B"}, {"name": "C"}, {"active": False}, {"name": "D"}]
    for n, line in enumerate(lines):
        path = raw / "runs" / f"r{n}" / "styles.delta.jsonl"
        write_jsonl(path, [{"id": f"S{i}", **line} for i in range(n, 6)])
        os.utime(path, (1_700_000_000 - n, 1_700_000_000 - n))
    states = []
    for name, most in (("batch", None), ("one", 1), ("four", 4), ("all", 500)):
        store = MasterStore(spark, str(tmp_path / name), buckets=2)
        if most is None:
            ingest(store, str(raw), SCHEMAS)
        else:
            ingest_files_stream(
                store, str(raw), SCHEMAS, str(tmp_path / f"{name}-checkpoint"), max_files_per_trigger=most
            ).awaitTermination()
        rows = store.current_records().select("endpoint", "record_id", "payload", "source_run_id").collect()
        states.append(sorted(map(tuple, rows)))
    assert states[0] and states == [states[0]] * 4


def test_cycle_totals_pass_over_other_lines(spark):
    lines = [
        {"status": "ok", "items_fetched": 3, "pages_fetched": True},
        {"status": "failed", "items_fetched": "3", "pages_fetched": 2},
    ]
    texts = [(json.dumps(x),) for x in lines] + [("noise",), ("[1]",)]
    row = cycles.cycle_totals(spark.createDataFrame(texts, "payload STRING")).first()
    assert tuple(row) == (1, 1, 3, 2)
