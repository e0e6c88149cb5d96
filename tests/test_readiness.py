import json
from pathlib import Path

import pytest

from truerow.config import Naming, RuleSet
from truerow.operators import check, readiness, reports

RULES = RuleSet.load(Path(__file__).parent / "fixtures" / "rules.yml")
NAMING = Naming(system="src", label="SRC")

GOOD = {
    "src_style_id": "P1",
    "brand_code": "NORD",
    "global_style_id": "G1",
    "product_type_code": "SHELL",
    "attributes": {
        "OWNER": "me",
        "MEMBRANE": "M",
        "WATERPROOF": 28000,
        "BREATHABILITY": 2.5,
        "COMPOSITION": "wool",
        "CARE": "wash",
        "ORIGIN": "VN",
        "FACILITY": "F",
    },
    "variants": [{"src_variant_id": "V", "global_variant_id": "GV", "sku": "K", "gtin": "07"}],
}
BLOCKED = {
    **GOOD,
    "src_style_id": "P2",
    "global_style_id": None,
    "attributes": {"MEMBRANE": "H", "WATERPROOF": "20000", "COMPOSITION": "", "CARE": "w", "ORIGIN": "CN"},
    "variants": [{"src_variant_id": "V2", "global_variant_id": None, "sku": "K2", "gtin": None}],
}
FLEECE = {
    **GOOD,
    "src_style_id": "P3",
    "brand_code": "SOUTH",
    "product_type_code": "FLEECE",
    "attributes": {"COMPOSITION": "x", "CARE": " ", "ORIGIN": "PT"},
    "variants": [{"global_variant_id": "GV", "sku": "K", "gtin": ""}],
}
ODD = {
    "src_style_id": "P4",
    "brand_code": "",
    "global_style_id": "G",
    "product_type_code": "ODD",
    "attributes": {"LAYERS": {}, "VEGAN": 0, "WATERPROOF": True},
    "variants": [{"sku": ""}, {"src_variant_id": "W", "global_variant_id": ""}],
}
UNKNOWN = {"src_style_id": "P5", "brand_code": "EAST", "global_style_id": "G", "product_type_code": "ZZ"}


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("docs") / "docs.json"
    path.write_text(json.dumps([GOOD, BLOCKED, FLEECE, ODD, UNKNOWN]))
    reader = spark.read.schema(readiness.document_schema(NAMING)).option("multiLine", "true")
    return readiness.validate(reader.json(str(path)), RULES, NAMING).cache()


def _codes(row):
    return [i["code"] for i in row["issues"]]


def test_documents(results):
    rows = {r["src_style_id"]: r for r in results.collect()}
    assert (rows["P1"]["ready"], rows["P1"]["score"], rows["P1"]["issue_count"]) == (True, 100, 0)
    assert (rows["P2"]["ready"], rows["P2"]["score"]) == (False, 0)
    assert _codes(rows["P2"]) == [
        "GLOBAL_STYLE_ID_MISSING",
        "GLOBAL_VARIANT_ID_MISSING",
        "DPP_REQUIRED_ATTRIBUTE_MISSING",
        "DPP_REQUIRED_ATTRIBUTE_MISSING",
        "DPP_REQUIRED_ATTRIBUTE_MISSING",
        "DPP_REQUIRED_ATTRIBUTE_MISSING",
        "ATTRIBUTE_TYPE_INVALID",
        "DPP_GTIN_OR_RESOLVER_ID_MISSING",
    ]
    fields = [i["source_field"] for i in rows["P2"]["issues"]]
    assert fields[1] == "variants[0].global_variant_id"
    assert fields[2:7] == [
        f"attributes.{a}" for a in ("BREATHABILITY", "COMPOSITION", "FACILITY", "OWNER", "WATERPROOF")
    ]
    assert rows["P2"]["issues"][1]["message"] == "Variant K2 is missing a global variant ID."
    fleece = rows["P3"]
    assert (fleece["ready"], fleece["warning_count"], fleece["score"]) == (True, 2, 90)
    odd = rows["P4"]
    assert _codes(odd) == [
        "BRAND_MISSING",
        "GLOBAL_VARIANT_ID_MISSING",
        "SKU_MISSING",
        "GLOBAL_VARIANT_ID_MISSING",
        "SKU_MISSING",
        "DPP_TEMPLATE_MAPPING_MISSING",
        "ATTRIBUTE_TYPE_INVALID",
        "ATTRIBUTE_TYPE_INVALID",
        "ATTRIBUTE_TYPE_INVALID",
        "DPP_GTIN_OR_RESOLVER_ID_MISSING",
    ]
    messages = [i["message"] for i in odd["issues"]]
    assert messages[1] == "Variant 0 is missing a global variant ID."
    assert messages[4] == "Variant W is missing SKU."
    assert messages[6:9] == ["LAYERS must be a list.", "VEGAN must be a boolean.", "WATERPROOF must be a number."]
    assert _codes(rows["P5"])[:2] == ["BRAND_UNKNOWN", "PRODUCT_TYPE_UNKNOWN"]
    assert rows["P5"]["issues"][0]["fix_location"] == "MDM"


def test_reports(results):
    run = readiness.run_result(results).first()
    assert tuple(run) == (5, 2, 40.0)
    brands = {r["brand"]: tuple(r)[1:] for r in reports.readiness_by_brand(results).collect()}
    assert brands["NORD"] == (2, 1, 50.0, 50.0) and "UNKNOWN" in brands
    missing = [tuple(r) for r in reports.missing_attributes(results).collect()]
    assert missing == [(a, 1) for a in ("BREATHABILITY", "COMPOSITION", "FACILITY", "INSULATION", "OWNER")]
    text = reports.readiness_markdown(results, RULES.version)
    assert "Readiness: `40.0%`" in text and "| COMPOSITION | 1 |" in text
    assert reports.issue_table(results, NAMING).count() == sum(r["issue_count"] for r in results.collect())
    summary = {r["metric"]: r["value"] for r in reports.readiness_summary(results, "v").collect()}
    assert summary == {"Rule set": "v", "Products checked": "5", "Ready products": "2", "Readiness percent": "40.0"}


def test_check_payloads(spark, tmp_path):
    payload = {
        "style_id": "S1",
        "counts": {
            "relationship_ids": {"style_size_ids": 3, "material_ids": "7", "season_ids": 1.9},
            "resolved_records": {"sizes": 1, "boms": True},
        },
        "unresolved_refs": [
            {"relation": "style.colors", "record_id": "C0", "status": "not_seen"},
            {"relation": "style.season", "record_id": "FA23", "status": "invalid_ref"},
            {"relation_type": "x", "endpoint": "boms"},
        ],
        "warnings": [{"code": "LATE", "message": ""}, {"message": "m"}],
    }
    path = tmp_path / "check.json"
    path.write_text(json.dumps(payload))
    payloads = check.from_json_payloads(spark.read.schema(check.check_schema()).json(str(path)))
    row = check.validate(payloads, NAMING).first()
    issues = {(i["code"], i["message"]) for i in row["issues"]}
    assert ("RELATIONSHIP_RECORDS_UNRESOLVED", "style_size_ids declares 3 ids, but only 1 matching sizes records were resolved.") in issues
    assert ("RELATIONSHIP_RECORDS_UNRESOLVED", "season_ids declares 1 ids, but only 0 matching seasons records were resolved.") in issues
    assert ("REFERENCED_RECORD_NOT_SEEN", "style.colors references endpoint record C0, but that record was not seen in the current ingested data store.") in issues
    assert ("INVALID_REFERENCE_VALUE", "Invalid style.season reference value FA23; it is not a SRC record id.") in issues
    assert ("UNRESOLVED_RECONSTRUCTION_REF", "Unresolved x reference to boms.") in issues
    assert ("LATE", "LATE") in issues and ("RECONSTRUCTION_WARNING", "m") in issues
    codes = [c for c, _ in issues]
    assert "SIZES_MISSING" not in codes and "BOMS_MISSING" not in codes and "COLORWAYS_MISSING" in codes
    assert (row["blocking_issue_count"], row["warning_count"], row["score"]) == (5, 8, 0)
    frame = check.validate(payloads, NAMING)
    sheets = reports.coverage_from_results(frame, check.RULE_SET_VERSION)
    assert sheets["unresolved_refs"].count() == 3
    assert "Invalid refs: `0`" in reports.coverage_markdown(sheets)


def test_check_report_reads_its_results_once(spark, tmp_path):
    """Results of a costly plan are computed a single time for all sheets and the text."""
    from truerow.functions.issues import ISSUES_TYPE
    from truerow.plans.reporting import write_check_report

    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    issue = "struct('A', 'm', 'error', 'MDM', 'unresolved_refs', 'r', true)"
    rows = spark.range(6).selectExpr(
        "id > 3 AS ready", f"CAST(IF(id > 3, array(), array({issue}, {issue})) AS {ISSUES_TYPE}) AS issues"
    )
    paths = write_check_report(rows.mapInArrow(counted, rows.schema), str(tmp_path / "report"))
    assert made.value == 6
    sheet = {name: spark.read.option("header", "true").csv(paths[name]).collect() for name in ("summary", "issues")}
    assert [r["count"] for r in sheet["issues"]] == ["8"]
    facts = {r["metric"]: r["value"] for r in sheet["summary"]}
    assert (facts["styles_in_store"], facts["reference_coverage_percent"]) == ("6", "33.33")


def test_check_reads_an_unresolved_reference_once(spark):
    """Lambdas are not compiled, so a read that is named again would run again for every reference."""
    counts = "struct(map('a', 1) AS relationship_ids, map('a', 1) AS resolved_records) AS counts"
    ref = """parse_json('{"status": "", "relation_type": "r", "id": 7}')"""
    rows = spark.sql(
        f"SELECT 'S' AS style_id, {counts}, array({ref}) AS unresolved_refs, "
        "CAST(NULL AS array<struct<code:string,message:string>>) AS warnings"
    )
    found = check.validate(rows).select("issues")
    assert found._jdf.queryExecution().analyzed().toString().count("try_variant_get") == 1
    last = found.first()["issues"][-1]
    assert (last["message"], last["rule_id"]) == (
        "Unresolved r reference to endpoint record 7.", "reconstruction.refs.unresolved",
    )


def test_rules_are_compiled_but_for_their_lambdas(spark):
    """A generator that holds a lambda is interpreted as a whole; the kind of a value is read once per attribute."""
    docs = spark.createDataFrame([], readiness.document_schema())
    query = readiness.validate(docs, RULES).select("issues")._jdf.queryExecution()
    generators = [line for line in query.optimizedPlan().toString().splitlines() if "Generate explode" in line]
    assert len(generators) == 1 and "lambda" not in generators[0]
    assert query.analyzed().toString().count("schema_of_variant") == 2


def test_odd_values_and_overlapping_rules(spark, tmp_path):
    rules = RuleSet.load(
        {
            "version": "v",
            "attributes": [{"code": c, "data_type": "list"} for c in "abcdefgh"] + [{"code": "n", "data_type": "number"}],
            "brands": [{"code": "B", "required_attributes": ["n", "c", "a"]}, {"code": "C"}],
            "product_types": [
                {"code": "T", "dpp_template_code": "t", "required_attributes": ["h", "c", "b"],
                 "warning_attributes": ["n", "g", "b", "f", "e", "d"]},
                {"code": "W", "dpp_template_code": "t", "warning_attributes": ["n", "a"]},
            ],
        }
    )
    values = {"a": [], "b": [None], "c": None, "d": "", "e": {}, "f": 0, "g": [[]], "h": "x", "n": 1.5}
    good = {"global_style_id": "G", "attributes": values, "variants": [{"global_variant_id": "V", "sku": "K", "gtin": "0"}]}
    docs = [
        {**good, "plm_style_id": style, "brand_code": brand, "product_type_code": kind}
        for style, brand, kind in (("1", "B", "T"), ("2", "C", "T"), ("3", "B", "W"), ("4", "B", None), ("5", "B", "?"))
    ]
    path = tmp_path / "docs.json"
    path.write_text(json.dumps(docs))
    read = spark.read.schema(readiness.document_schema()).option("multiLine", "true").json(str(path))
    rows = {r["plm_style_id"]: r["issues"] for r in readiness.validate(read, rules).collect()}

    def found(style):
        short = {"DPP_REQUIRED_ATTRIBUTE_MISSING": "!", "DPP_RECOMMENDED_ATTRIBUTE_MISSING": "?", "ATTRIBUTE_TYPE_INVALID": "t"}
        return [short.get(i["code"], i["code"]) + i["source_field"].removeprefix("attributes.") for i in rows[style]]

    assert found("1") == ["!a", "!c", "th", "?d", "te", "tf"]
    assert found("2") == ["!c", "th", "?d", "te", "tf"]
    assert found("3") == ["!a", "!c"]
    assert found("4") == ["PRODUCT_TYPE_MISSINGproduct_type_code", "!a", "!c"]
    assert found("5") == ["PRODUCT_TYPE_UNKNOWNproduct_type_code", "!a", "!c"]
