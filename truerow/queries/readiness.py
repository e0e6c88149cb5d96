"""Rule validation and report queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.config import RuleSet
from truerow.operators import readiness, reports
from truerow.queries.tables import LINE_ID_SQL, coded, line_id, spread, table

RULES = RuleSet.load(
    {
        "version": "v1",
        "brands": [
            {
                "code": f"Brand#{n}",
                "name": f"Brand {n}",
                "required_attributes": ["OWNER"] if n <= 5 else [],
            }
            for n in range(1, 21)
        ],
        "attributes": [
            {"code": "SIZE", "data_type": "number"},
            {"code": "NAME"},
            {"code": "ORIGIN", "data_type": "list"},
            {"code": "WEIGHT", "data_type": "number"},
        ],
        "product_types": [
            {"code": "ECONOMY", "required_attributes": []},
            {
                "code": "PROMO",
                "dpp_template_code": "T",
                "required_attributes": ["SIZE", "NAME"],
                "warning_attributes": ["ORIGIN", "SIZE"],
            },
            {
                "code": "SMALL",
                "dpp_template_code": "T",
                "required_attributes": ["NAME", "SIZE"],
                "warning_attributes": ["WEIGHT"],
            },
            {
                "code": "LARGE",
                "dpp_template_code": "T",
                "required_attributes": ["NAME"],
                "warning_attributes": ["WEIGHT", "ORIGIN"],
            },
            {"code": "STANDARD", "dpp_template_code": "T", "required_attributes": ["NAME"]},
        ],
    }
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their part as product documents with two variants."""
    flag, status, quantity = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    size = F.col("p_size")
    attributes = F.create_map(
        F.lit("SIZE"),
        F.when(F.col("l_linenumber") <= 3, size.cast("variant")).otherwise(
            size.cast("string").cast("variant")
        ),
        F.lit("NAME"),
        F.when(F.col("p_retailprice") >= 995, "").otherwise(F.col("p_name")).cast("variant"),
        F.lit("ORIGIN"),
        F.when(flag == "A", F.parse_json(F.lit("[]"))).otherwise(F.parse_json(F.lit('["x"]'))),
        F.lit("WEIGHT"),
        F.when(status == "F", F.lit(True).cast("variant")).otherwise(quantity.cast("variant")),
        F.lit("OWNER"),
        F.when(flag != "R", F.lit("me")).cast("variant"),
    )
    first = F.struct(
        coded("V", "l_linenumber").alias("plm_variant_id"),
        F.when(quantity <= 40, "G").alias("global_variant_id"),
        F.when(quantity < 5, "").otherwise(coded("K", "l_partkey")).alias("sku"),
        F.lit(None).cast("string").alias("gtin"),
    )
    second = F.struct(
        F.lit("").alias("plm_variant_id"),
        F.lit("G1").alias("global_variant_id"),
        F.when(flag != "R", "K2").alias("sku"),
        F.when(status == "F", "07").alias("gtin"),
    )
    lines = spread(table(spark, sf_dir, "lineitem"))
    part = table(spark, sf_dir, "part")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        line_id().alias("plm_style_id"),
        F.when((flag == "N") & (status == "F"), "").otherwise(F.col("p_brand")).alias("brand_code"),
        F.col("p_brand").alias("brand_name"),
        F.when(F.col("l_discount") > 0, coded("G", "l_orderkey")).alias("global_style_id"),
        F.when(F.col("l_tax") > 0, F.col("p_type")).alias("product_type_code"),
        attributes.alias("attributes"),
        F.array(first, second).alias("variants"),
    )


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readiness.validate(documents(spark, sf_dir), RULES)


def readiness_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2-V11, G3."""
    return reports.product_table(_results(spark, sf_dir))


def readiness_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2-V9, G4."""
    return reports.issue_table(_results(spark, sf_dir))


def readiness_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V12."""
    return readiness.run_result(_results(spark, sf_dir))


def readiness_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1."""
    return reports.readiness_by_brand(_results(spark, sf_dir))


def missing_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2."""
    return reports.missing_attributes(_results(spark, sf_dir))


def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5."""
    return reports.issue_counts(_results(spark, sf_dir))


def summary_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7."""
    return reports.readiness_summary(_results(spark, sf_dir), RULES.version)


def _issue(where, code, message, location, field, rule, severity="error", blocking=True):
    return f"""
  SELECT plm_style_id, '{code}' AS code, {message} AS message, '{severity}' AS severity,
    '{location}' AS fix_location, '{field}' AS source_field, '{rule}' AS rule_id,
    {str(blocking).lower()} AS blocking
  FROM base WHERE {where}"""


def _missing(where: str, code: str, required: bool) -> str:
    need = "required" if required else "recommended"
    return _issue(
        where,
        f"DPP_{need.upper()}_ATTRIBUTE_MISSING",
        f"'{code} is {need} for DPP readiness.'",
        "PLM",
        f"attributes.{code}",
        f"readiness.dpp.attribute.{code}.required",
        "error" if required else "warning",
        required,
    )


def _wrong(where: str, code: str, kind: str) -> str:
    return _issue(
        where,
        "ATTRIBUTE_TYPE_INVALID",
        f"'{code} must be a {kind}.'",
        "PLM",
        f"attributes.{code}",
        f"attribute.{code}.data_type",
    )


def _results_sql() -> str:
    brand_no = "CAST(replace(brand_name, 'Brand#', '') AS INTEGER)"
    issues = [
        _issue("global_style_id IS NULL", "GLOBAL_STYLE_ID_MISSING",
               "'PLM payload is missing the global style ID.'", "PLM", "global_style_id",
               "identity.global_style_id.required"),
        _issue("brand_code = ''", "BRAND_MISSING", "'PLM payload is missing brand_code.'", "PLM",
               "brand_code", "taxonomy.brand.required"),
        _issue(f"brand_code <> '' AND {brand_no} NOT BETWEEN 1 AND 20", "BRAND_UNKNOWN",
               "'Brand ' || brand_code || ' is not governed in the DPP rule set.'", "MDM",
               "brand_code", "taxonomy.brand.known"),
        _issue("l_quantity > 40", "GLOBAL_VARIANT_ID_MISSING",
               "'Variant K' || l_partkey || ' is missing a global variant ID.'", "PLM",
               "variants[0].global_variant_id", "identity.global_variant_id.required"),
        _issue("l_quantity < 5", "SKU_MISSING",
               "'Variant V' || l_linenumber || ' is missing SKU.'", "PLM", "variants[0].sku",
               "identity.sku.required"),
        _issue("l_returnflag = 'R'", "SKU_MISSING", "'Variant 1 is missing SKU.'", "PLM",
               "variants[1].sku", "identity.sku.required"),
        _issue("product_type_code IS NULL", "PRODUCT_TYPE_MISSING",
               "'PLM payload is missing product_type_code.'", "PLM", "product_type_code",
               "taxonomy.product_type.required"),
        _issue("product_type_code = 'MEDIUM'", "PRODUCT_TYPE_UNKNOWN",
               "'Product type MEDIUM is not governed for DPP.'", "MDM", "product_type_code",
               "taxonomy.product_type.known"),
        _issue("product_type_code = 'ECONOMY'", "DPP_TEMPLATE_MAPPING_MISSING",
               "'Product type ECONOMY has no DPP template mapping.'", "MDM", "product_type_code",
               "mapping.dpp.template.required"),
        _wrong("product_type_code IN ('PROMO', 'SMALL') AND l_linenumber > 3", "SIZE", "number"),
        _missing("product_type_code IN ('PROMO', 'SMALL', 'LARGE', 'STANDARD') "
                 "AND p_retailprice >= 995", "NAME", True),
        _missing(f"brand_code <> '' AND {brand_no} BETWEEN 1 AND 5 AND l_returnflag = 'R'",
                 "OWNER", True),
        _missing("product_type_code IN ('PROMO', 'LARGE') AND l_returnflag = 'A'", "ORIGIN", False),
        _wrong("product_type_code IN ('SMALL', 'LARGE') AND l_linestatus = 'F'", "WEIGHT",
               "number"),
        _issue("l_linestatus = 'O'", "DPP_GTIN_OR_RESOLVER_ID_MISSING",
               "'DPP readiness requires at least one GTIN or resolver identifier candidate.'",
               "PLM", "variants[].gtin", "readiness.dpp.identifier.present", "warning", False),
    ]
    return f"""
WITH base AS (
  SELECT *, {LINE_ID_SQL} AS plm_style_id,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN '' ELSE p_brand END AS brand_code,
    p_brand AS brand_name, CASE WHEN l_discount > 0 THEN 'G' || l_orderkey END AS global_style_id,
    CASE WHEN l_tax > 0 THEN p_type END AS product_type_code
  FROM lineitem JOIN part ON p_partkey = l_partkey
),
issues AS ({" UNION ALL ".join(issues)}),
tallies AS (
  SELECT plm_style_id, count(*) AS n, count(*) FILTER (blocking) AS b,
    count(*) FILTER (severity = 'warning') AS w
  FROM issues GROUP BY plm_style_id
),
results AS (
  SELECT base.plm_style_id, brand_code, brand_name, product_type_code,
    coalesce(b, 0) = 0 AS ready,
    greatest(0, 100 - 20 * coalesce(b, 0) - 5 * coalesce(w, 0)) AS score,
    coalesce(n, 0) AS issue_count, coalesce(b, 0) AS blocking_issue_count,
    coalesce(w, 0) AS warning_count
  FROM base LEFT JOIN tallies ON tallies.plm_style_id = base.plm_style_id
)
"""


RESULTS_SQL = _results_sql()
RUN_SQL = """
run AS (SELECT count(*) AS total_products, count(*) FILTER (ready) AS ready_products,
  round_even(count(*) FILTER (ready) / count(*) * 100, 2) AS readiness_percent FROM results)
"""

QUERIES = {
    "readiness_results": (readiness_results, RESULTS_SQL + " SELECT * FROM results"),
    "readiness_issues": (
        readiness_issues,
        RESULTS_SQL
        + """
SELECT issues.*, brand_code, product_type_code
FROM issues JOIN base ON base.plm_style_id = issues.plm_style_id""",
    ),
    "readiness_run": (readiness_run, RESULTS_SQL + "," + RUN_SQL + " SELECT * FROM run"),
    "readiness_by_brand": (
        readiness_by_brand,
        RESULTS_SQL
        + """
SELECT CASE WHEN brand_code = '' THEN 'UNKNOWN' ELSE brand_code END AS brand,
  count(*) AS products, count(*) FILTER (ready) AS ready,
  round_even(count(*) FILTER (ready) / count(*) * 100, 2) AS readiness_percent,
  round_even(avg(score), 2) AS average_score
FROM results GROUP BY 1""",
    ),
    "missing_attributes": (
        missing_attributes,
        RESULTS_SQL
        + """
SELECT replace(source_field, 'attributes.', '') AS attribute, count(*) AS count
FROM issues WHERE code LIKE 'DPP_%_ATTRIBUTE_MISSING' GROUP BY 1""",
    ),
    "issue_counts": (
        issue_counts,
        RESULTS_SQL
        + """
SELECT code, severity, source_field AS bucket, count(*) AS count FROM issues GROUP BY ALL""",
    ),
    "summary_kv": (
        summary_kv,
        RESULTS_SQL
        + ","
        + RUN_SQL
        + """
SELECT 'Rule set' AS metric, 'v1' AS value
UNION ALL SELECT 'Products checked', CAST(total_products AS VARCHAR) FROM run
UNION ALL SELECT 'Ready products', CAST(ready_products AS VARCHAR) FROM run
UNION ALL SELECT 'Readiness percent', CAST(readiness_percent AS VARCHAR) FROM run""",
    ),
}
