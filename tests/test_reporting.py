from truerow.config import RuleSet, load_endpoint_schemas
from truerow.operators import readiness
from truerow.operators.apply import ingest
from truerow.plans.reporting import write_coverage_report, write_readiness_report
from truerow.sources.store import MasterStore


def test_coverage_report_of_a_store(spark, tmp_path, write_jsonl):
    raw = tmp_path / "raw"
    write_jsonl(
        raw / "styles.jsonl",
        [{"id": "S1", "active_colorways": {"0": "C1"}, "product_sizes": {"0": "C2"}}],
    )
    write_jsonl(raw / "sizes.jsonl", [{"id": "C2"}])
    store = MasterStore(spark, str(tmp_path / "store"), buckets=1)
    ingest(store, str(raw), load_endpoint_schemas())
    paths = write_coverage_report(store, str(tmp_path / "report"), expected_endpoints=["colorways"])
    assert set(paths) == {
        "summary",
        "issues",
        "unresolved_refs",
        "relationship_coverage",
        "endpoint_coverage",
        "definitions",
        "markdown",
    }

    def sheet(name):
        return spark.read.option("header", True).csv(paths[name]).collect()

    assert {r["code"] for r in sheet("issues")} == {"REFERENCED_RECORD_NOT_SEEN", "ENDPOINT_EMPTY"}
    assert {r["status"] for r in sheet("unresolved_refs")} == {"not_seen"}
    summary = {r["metric"]: r["value"] for r in sheet("summary")}
    assert summary["styles_in_store"] == "1" and summary["endpoints_in_store"] == "2"
    text = spark.read.text(paths["markdown"], wholetext=True).first()["value"]
    assert "- Reference coverage: `50.0%`" in text and "| style_sizes | styles | sizes |" in text


def test_readiness_report(spark, tmp_path):
    docs = spark.createDataFrame([("P1", "B")], "plm_style_id STRING, brand_code STRING")
    from pyspark.sql import functions as F

    missing = ("global_style_id", "brand_name", "product_type_code")
    docs = docs.withColumns(
        {
            **{name: F.lit(None).cast("string") for name in missing},
            "attributes": F.lit(None).cast("map<string,variant>"),
            "variants": F.lit(None).cast(
                "array<struct<plm_variant_id:string,global_variant_id:string,sku:string,gtin:string>>"
            ),
        }
    )
    results = readiness.validate(docs, RuleSet("v9"))
    paths = write_readiness_report(results, str(tmp_path / "r"), "v9", file_format="parquet")
    assert spark.read.parquet(paths["issues"]).count() == 3
    assert spark.read.parquet(paths["by_brand"]).first()["average_score"] == 55.0
