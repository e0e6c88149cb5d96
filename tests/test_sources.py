import json

import pytest
from pyspark.sql import functions as F

from truerow.config import DeleteCondition, RuleSet, load_endpoint_schemas
from truerow.operators import incremental as inc
from truerow.operators import integrity, readiness
from truerow.sources import documents, rawfiles, sinks
from truerow.sources.store import FETCH_STATE, VALIDATION_INDEX, MasterStore


def test_endpoint_schema_overlays(tmp_path):
    path = tmp_path / "schema.yml"
    path.write_text(
        "endpoints:\n  styles: {delete_when_any_add: [{field: state, equals: GONE}]}\n"
        "  extra: {primary_key: code, modified_at_field: changed}\n"
    )
    schemas = load_endpoint_schemas({"styles": {"primary_key": "sid"}}, path)
    assert schemas["styles"].primary_key == "sid"
    assert schemas["styles"].delete_when_any == (
        DeleteCondition("active", False),
        DeleteCondition("state", "GONE"),
    )
    assert schemas["extra"].modified_at_fields == ("changed",)
    replaced = load_endpoint_schemas({"styles": {"delete_when_any": []}})
    assert replaced["styles"].delete_when_any == ()
    for bad in ({"delete_when": 1}, {"delete_when_any": [{"field": "x"}]}, {"modified_at_fields": 1}):
        with pytest.raises(ValueError):
            load_endpoint_schemas({"styles": bad})
    with pytest.raises(ValueError, match="not found"):
        load_endpoint_schemas(tmp_path / "none.yml")


def test_files_are_ordered_by_run_endpoint_and_path(spark, tmp_path, write_jsonl):
    for name in ("b/styles.jsonl", "a/styles.jsonl", "a/sizes.delta.jsonl", "zeta.jsonl", "a/.x.jsonl"):
        write_jsonl(tmp_path / "raw" / name, [{"id": 1}])
    files = rawfiles.in_order(rawfiles.discover(spark, str(tmp_path / "raw"))).orderBy("file_ord")
    found = [(r["source_run_id"], r["endpoint"], r["is_delta"]) for r in files.collect()]
    assert found == [
        ("root", "zeta", False),
        ("a", "sizes", True),
        ("a", "styles", False),
        ("b", "styles", False),
    ]
    assert rawfiles.discover(spark, str(tmp_path / "nothing")).count() == 0


def test_fingerprint_depends_on_content_alone(spark, tmp_path):
    lines = [json.dumps({"id": n, "text": "x" * 50}) for n in range(2000)]

    def digest(name, text, split):
        (tmp_path / name).write_text(text)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            row = (str(tmp_path / name), f"file:{tmp_path / name}", len(text))
            files = spark.createDataFrame([row], "path STRING, file_path STRING, length LONG")
            return rawfiles.fingerprints(spark, files).first()["content_sha256"]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    text = "\n".join(lines) + "\n"
    whole = digest("a.jsonl", text, "100m")
    assert digest("b.jsonl", text, "7k") == whole
    assert digest("c.jsonl", "\n".join([lines[1], lines[0], *lines[2:]]) + "\n", "7k") != whole
    assert digest("d.jsonl", text[:-1], "100m") != whole
    assert digest("e.jsonl", "", "100m") == digest("f.jsonl", "", "7k") not in (None, whole)


def test_tables_are_appended_to_or_replaced_by_partition(spark, tmp_path):
    store = MasterStore(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([("e", "OK")], "endpoint STRING, last_attempted_status STRING")
    assert store.read(FETCH_STATE.name).count() == 0
    store.append(FETCH_STATE.name, rows)
    store.append(FETCH_STATE.name, rows)
    assert store.read(FETCH_STATE.name).count() == 2
    store.replace(FETCH_STATE.name, rows)
    assert [r["last_attempted_status"] for r in store.read(FETCH_STATE.name).collect()] == ["OK"]

    def put(*keys, **named):
        made = spark.createDataFrame([("a b", b, i) for b, i in keys], "target STRING, bucket INT, product_id STRING")
        store.replace(VALIDATION_INDEX.name, made, **named)
        found = store.read(VALIDATION_INDEX.name).select("target", "bucket", "product_id").collect()
        return sorted((r["bucket"], r["product_id"]) for r in found)

    assert put((0, "A"), (1, "B"), (2, "C")) == [(0, "A"), (1, "B"), (2, "C")]
    # Only the partitions of the rows change, and those that are named though no row is left.
    assert put((1, "D"), (1, "E"), partitions=[("a b", 2)], parts=2) == [(0, "A"), (1, "D"), (1, "E")]
    assert [r["product_id"] for r in store.read(VALIDATION_INDEX.name, [("a b", 0), ("a b", 2)]).collect()] == ["A"]
    assert store.read(VALIDATION_INDEX.name, []).count() == 0
    # A table may be rewritten from its own rows.
    store.replace(VALIDATION_INDEX.name, store.read(VALIDATION_INDEX.name).withColumn("ready", F.lit(True)))
    assert store.read(VALIDATION_INDEX.name).where("ready").count() == 3


def test_documents_and_reports_round_trip(spark, tmp_path):
    docs = [{"plm_style_id": "P1", "attributes": {"A": 1, "B": "1"}}, {"plm_style_id": "P2"}]
    (tmp_path / "many.json").write_text(json.dumps(docs))
    (tmp_path / "one.json").write_text(json.dumps(docs[0], indent=1))
    (tmp_path / "lines.jsonl").write_text("\n".join(map(json.dumps, docs)))
    counts = {n: documents.read_documents(spark, str(tmp_path / n)).count() for n in ("many.json", "one.json", "lines.jsonl")}
    assert counts == {"many.json": 2, "one.json": 1, "lines.jsonl": 2}
    read = documents.read_documents(spark, str(tmp_path / "many.json"))
    documents.write_jsonl(read, str(tmp_path / "out"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(lines, key=lambda d: d["plm_style_id"]) == docs
    results = readiness.validate(read, RuleSet("v"))
    paths = sinks.write_sheets({"results": results}, str(tmp_path / "report"))
    back = spark.read.option("header", True).csv(paths["results"])
    assert back.count() == 2 and "issues" in back.columns
    sinks.write_sheets({"results": results}, str(tmp_path / "parquet"), "parquet")
    sinks.write_text("# Title\n\ntext", str(tmp_path / "md"), spark)
    assert spark.read.text(str(tmp_path / "md"), wholetext=True).first()["value"].startswith("# Title")


def test_ids_that_are_no_ids(spark):
    payloads = ['{"id": 1}', '{"id": "1"}', '{"id": null}', "{}", '{"id": [1]}', "x", '{"id": "2"}']
    lines = spark.createDataFrame([("e", p) for p in payloads], "endpoint STRING, payload STRING")
    row = integrity.id_integrity(integrity.payload_ids(lines)).first()
    assert (row["records"], row["invalid_ids"], row["unique_ids"], row["duplicate_ids"]) == (7, 4, 2, 1)
    assert row["duplicate_sample"] == ["1"]


def test_incremental_settings():
    assert inc.overlap() == (60, 0) and inc.overlap(-1, 1001) == (60, 0)
    assert inc.overlap(True, 5) == (60, 5)
    params = {"_modified_at=ge": 1, "_modified_at": 2, "x=gt": 3, "sort": "name"}
    assert inc.with_floor(params, None) == params
    assert inc.with_floor(params, 9) == {"x=gt": 3, "_modified_at=ge": 9, "sort": "_modified_at"}
    assert inc.with_sort({"sort": "a"}, "b", "if_missing") == {"sort": "a"}
    assert inc.with_sort({}, "b", "if_missing") == {"sort": "b"}
    assert inc.with_sort({}, "b", "preserve") == {}
    with pytest.raises(ValueError):
        inc.overlay_params({"a": {}}, {"b": {}})


def test_predicates_reach_the_scan(spark, tmp_path):
    spark.range(100).withColumn("s", F.lit("a")).write.parquet(str(tmp_path / "t"))
    rows = inc.read_filtered(spark.read.parquet(str(tmp_path / "t")), {"id=ge": 90, "s": "a", "decoded": True})
    assert rows.count() == 10
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,90)" in plan and "EqualTo(s,a)" in plan
    with pytest.raises(ValueError, match="Unknown endpoints"):
        inc.select_endpoints(spark.range(1).withColumn("endpoint", F.lit("a")), ["b"], ["a"])
