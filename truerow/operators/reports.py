"""Report tables over validation results and coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truerow.config.naming import Naming
from truerow.functions.numbers import mean2, percent
from truerow.functions.text import non_empty
from truerow.operators.readiness import run_result

# Issue codes the rankings look for.
MISSING_CODES = ("DPP_REQUIRED_ATTRIBUTE_MISSING", "DPP_RECOMMENDED_ATTRIBUTE_MISSING")
UNRESOLVED_CODES = (
    "INVALID_REFERENCE_VALUE",
    "REFERENCED_RECORD_NOT_SEEN",
    "UNRESOLVED_RECONSTRUCTION_REF",
)
UNKNOWN = "UNKNOWN"


def readiness_by_brand(results: DataFrame) -> DataFrame:
    """G1."""
    brand = F.coalesce(non_empty(F.col("brand_code")), F.lit(UNKNOWN))
    grouped = results.groupBy(brand.alias("brand")).agg(
        F.count("*").alias("products"),
        F.count_if("ready").alias("ready"),
        mean2(F.col("score")).alias("average_score"),
    )
    return grouped.select(
        "brand",
        "products",
        "ready",
        percent(F.col("ready"), F.col("products"), 0.0).alias("readiness_percent"),
        "average_score",
    ).orderBy("brand")


def exploded_issues(results: DataFrame, *columns: str) -> DataFrame:
    """One row per issue with the given columns of its product.

    The outer form of inline: with the plain one the optimizer would test the array's size
    below, and so check every product twice.
    """
    return results.select(*columns, F.inline_outer("issues")).where(F.col("code").isNotNull())


def missing_attributes(results: DataFrame) -> DataFrame:
    """How often each attribute is missing; ties by name."""
    found = exploded_issues(results).where(F.col("code").isin(*MISSING_CODES))
    attribute = F.regexp_replace("source_field", r"^attributes\.", "")
    return (
        found.groupBy(attribute.alias("attribute"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "attribute")
    )


def product_table(results: DataFrame, naming: Naming | None = None) -> DataFrame:
    """G3."""
    naming = naming or Naming()
    return results.select(
        naming.style_id,
        "brand_code",
        "brand_name",
        "product_type_code",
        "ready",
        "score",
        "issue_count",
        "blocking_issue_count",
        "warning_count",
    )


def issue_table(results: DataFrame, naming: Naming | None = None) -> DataFrame:
    """G4."""
    naming = naming or Naming()
    return exploded_issues(results, naming.style_id, "brand_code", "product_type_code").select(
        naming.style_id,
        "brand_code",
        "product_type_code",
        "code",
        "severity",
        "blocking",
        "fix_location",
        "source_field",
        "rule_id",
        "message",
    )


def issue_counts(results: DataFrame) -> DataFrame:
    """(code, severity, bucket, count), sorted."""
    found = exploded_issues(results)
    return (
        found.groupBy("code", "severity", F.col("source_field").alias("bucket"))
        .agg(F.count("*").alias("count"))
        .orderBy("code", "severity", "bucket")
    )


def unresolved_counts(results: DataFrame) -> DataFrame:
    """Unresolved references named by the results."""
    return _unresolved(exploded_issues(results), F.count("*"))


def _unresolved(issues: DataFrame, count: Column) -> DataFrame:
    field = F.col("source_field")
    found = issues.where((field == "unresolved_refs") | F.col("code").isin(*UNRESOLVED_CODES))
    return (
        found.groupBy(
            field.alias("relationship"),
            field.alias("target_endpoint"),
            F.col("code").alias("status"),
        )
        .agg(count.alias("count"))
        .orderBy("relationship", "target_endpoint", "status")
    )


def key_values(row: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """A one-row DataFrame as (metric, value) text rows, in the given order."""
    pairs = [
        F.struct(F.lit(metric).alias("metric"), F.col(column).cast("string").alias("value"))
        for metric, column in names.items()
    ]
    return row.select(F.inline(F.array(*pairs)))


# Metric names of the two summary sheets and their columns.
READINESS_METRICS = {
    "Rule set": "rule_set_version",
    "Products checked": "total_products",
    "Ready products": "ready_products",
    "Readiness percent": "readiness_percent",
}
COVERAGE_METRICS = {
    "rule_set": "rule_set_version",
    "styles_in_store": "styles",
    "endpoints_in_store": "endpoints",
    "relationships_checked": "relationships_checked",
    "declared_refs": "declared_refs",
    "seen_refs": "seen_refs",
    "missing_refs": "missing_refs",
    "invalid_refs": "invalid_refs",
    "reference_coverage_percent": "coverage_percent",
}


def readiness_summary(results: DataFrame, version: str) -> DataFrame:
    run = run_result(results).withColumn("rule_set_version", F.lit(version))
    return key_values(run, READINESS_METRICS)


def readiness_sheets(
    results: DataFrame, version: str, naming: Naming | None = None
) -> dict[str, DataFrame]:
    """One table per sheet of the readiness report."""
    return {
        "summary": readiness_summary(results, version),
        "by_brand": readiness_by_brand(results),
        "products": product_table(results, naming),
        "issues": issue_table(results, naming),
    }


def coverage_sheets(
    summary: DataFrame,
    coverage_rows: DataFrame,
    counts: DataFrame,
    issues: DataFrame,
    unresolved: DataFrame,
    version: str,
    naming: Naming | None = None,
) -> dict[str, DataFrame]:
    """One table per sheet of the coverage report."""
    naming = naming or Naming()
    named = summary.withColumn("rule_set_version", F.lit(version))
    # The glossary of the report.
    definitions = [
        ("Declared ref", "A non-empty relationship reference selected in an endpoint payload."),
        ("Seen ref", "A declared reference found in the expected endpoint snapshot."),
        (
            "Missing ref",
            f"A valid-looking {naming.label} ref that is not present in the expected "
            "endpoint snapshot.",
        ),
        (
            "Invalid ref",
            f"A non-empty value that does not look like a {naming.label} object ref.",
        ),
        (
            "Endpoint coverage",
            "Current record counts and relationship coverage across the store.",
        ),
    ]
    return {
        "summary": key_values(named, COVERAGE_METRICS),
        "issues": issues,
        "unresolved_refs": unresolved,
        "relationship_coverage": coverage_rows,
        "endpoint_coverage": counts,
        "definitions": summary.sparkSession.createDataFrame(
            definitions, "term STRING, definition STRING"
        ),
    }


def tally(results: DataFrame) -> DataFrame:
    """All that the report of single results counts, in one pass: one row per kind of issue.

    A product counts with its first issue, or in the row without a code if it has none.
    """
    rows = results.select("ready", F.posexplode_outer("issues").alias("pos", "issue"))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    kinds = [F.col("issue")[name].alias(name) for name in ("code", "severity", "source_field")]
    return rows.groupBy(*kinds).agg(
        F.count("issue").alias("count"),
        F.count_if(first).alias("products"),
        F.count_if(first & F.col("ready")).alias("ready"),
    )


def coverage_from_results(results: DataFrame, version: str) -> dict[str, DataFrame]:
    """The coverage report of results that were validated one product at a time."""
    return coverage_from_tally(tally(results), version)


def coverage_from_tally(counted: DataFrame, version: str) -> dict[str, DataFrame]:
    """The same from what ``tally`` counted, which may have been stored.

    There is no endpoint or relationship information in them; these parts stay empty.
    """
    total = [F.coalesce(F.sum(name), F.lit(0)) for name in ("products", "ready")]
    run = counted.agg(total[0].alias("total_products"), total[1].alias("ready_products")).withColumn(
        "readiness_percent", percent(F.col("ready_products"), F.col("total_products"), 0.0)
    )
    found, field = counted.where(F.col("code").isNotNull()), F.col("source_field")
    zero = F.lit(0).cast("long")
    summary = run.select(
        F.col("total_products").alias("styles"),
        *[
            zero.alias(name)
            for name in (
                "endpoints",
                "relationships_checked",
                "declared_refs",
                "seen_refs",
                "missing_refs",
                "invalid_refs",
            )
        ],
        F.col("readiness_percent").alias("coverage_percent"),
        F.lit(version).alias("rule_set_version"),
    )
    return {
        "summary": key_values(summary, COVERAGE_METRICS),
        "issues": found.select("code", "severity", field.alias("bucket"), "count").orderBy(
            "code", "severity", "bucket"
        ),
        "unresolved_refs": _unresolved(found, F.sum("count")),
    }


def markdown_table(
    rows: DataFrame, headers: Sequence[str], columns: Sequence[Column | str]
) -> str:
    """A Markdown table of an aggregated report table, all rows.

    Report tables have one row per brand, relationship or code; the rows come to the driver
    partition by partition.
    """
    chosen = rows.select(*columns)
    numeric = [t in ("int", "bigint", "double") for _, t in chosen.dtypes]
    lines = [
        "| " + " | ".join(headers) + " |",
        "| " + " | ".join("---:" if n else "---" for n in numeric) + " |",
    ]
    lines += ["| " + " | ".join(str(value) for value in row) + " |" for row in chosen.toLocalIterator()]
    return "\n".join(lines)


def readiness_markdown(results: DataFrame, version: str) -> str:
    """G9."""
    run = run_result(results).first()
    brands = readiness_by_brand(results).withColumn(
        "readiness", F.concat(F.col("readiness_percent").cast("string"), F.lit("%"))
    )
    return "\n".join(
        [
            "# DPP Readiness Summary",
            "",
            f"- Rule set: `{version}`",
            f"- Products checked: `{run['total_products']}`",
            f"- Ready products: `{run['ready_products']}`",
            f"- Readiness: `{run['readiness_percent']}%`",
            "",
            "## Readiness By Brand",
            "",
            markdown_table(
                brands,
                ["Brand", "Products", "Ready", "Readiness", "Avg Score"],
                ["brand", "products", "ready", "readiness", "average_score"],
            ),
            "",
            "## Most Common Missing Attributes",
            "",
            markdown_table(
                missing_attributes(results), ["Attribute", "Count"], ["attribute", "count"]
            ),
            "",
        ]
    )


def coverage_markdown(sheets: Mapping[str, DataFrame]) -> str:
    """The coverage summary from the tables of ``coverage_sheets``."""
    facts = {row["metric"]: row["value"] for row in sheets["summary"].collect()}
    # The lines of the summary.
    labels = {
        "Rule set": "rule_set",
        "Styles in store": "styles_in_store",
        "Endpoints in store": "endpoints_in_store",
        "Relationships checked": "relationships_checked",
        "Declared refs": "declared_refs",
        "Seen refs": "seen_refs",
        "Missing refs": "missing_refs",
        "Invalid refs": "invalid_refs",
    }
    parts = ["# Reconstruction Check Summary", ""]
    parts += [f"- {label}: `{facts[metric]}`" for label, metric in labels.items()]
    parts.append(f"- Reference coverage: `{facts['reference_coverage_percent']}%`")
    tables = (
        (
            "Relationship Coverage",
            "relationship_coverage",
            {
                "Relationship": "relationship",
                "Source": "source_endpoint",
                "Target": "target_endpoint",
                "Declared": "declared_refs",
                "Seen": "seen_refs",
                "Missing": "missing_refs",
                "Invalid": "invalid_refs",
                "Coverage": "coverage_percent",
                "Source Records With Missing Refs": "source_records_with_missing_refs",
            },
        ),
        (
            "Issue Counts",
            "issues",
            {"Code": "code", "Severity": "severity", "Bucket": "bucket", "Count": "count"},
        ),
        (
            "Unresolved Ref Counts",
            "unresolved_refs",
            {
                "Relationship": "relationship",
                "Target": "target_endpoint",
                "Status": "status",
                "Count": "count",
            },
        ),
        ("Endpoint Coverage", "endpoint_coverage", {"Endpoint": "endpoint", "Records": "records"}),
    )
    for title, sheet, columns in tables:
        if sheet in sheets:
            table = markdown_table(sheets[sheet], list(columns), list(columns.values()))
            parts += ["", f"## {title}", "", table]
    return "\n".join([*parts, ""])
