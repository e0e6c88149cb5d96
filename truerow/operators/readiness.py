"""Check product documents against the rule set.

Every rule is an expression over one document, so a document is checked in one pass without
a shuffle. The rules themselves are a few small tables made from configuration; they are
broadcast because their size is that of a file somebody wrote by hand.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.config.naming import Naming
from truerow.config.rules import RuleSet
from truerow.functions.issues import (
    ERROR,
    ISSUES_TYPE,
    WARNING,
    count_where,
    is_blocking,
    is_warning,
    issue,
    joined,
    listed,
    present,
)
from truerow.functions.jsons import bound, computed_once, variant_kind
from truerow.functions.numbers import percent
from truerow.functions.text import is_blank, non_empty

CONTEXT = "dpp"

_TYPED_CODES = "array<struct<code:string,data_type:string>>"
_VARIANT_FIELDS = ("global_variant_id", "sku", "gtin", "color_name", "size_value")


def document_schema(naming: Naming | None = None) -> str:
    """Schema to read product documents with; attribute values keep their JSON type."""
    naming = naming or Naming()
    variant = ", ".join(
        f"{name}: STRING" for name in (naming.variant_id, *_VARIANT_FIELDS)
    )
    return (
        f"{naming.style_id} STRING, brand_code STRING, brand_name STRING, "
        "global_style_id STRING, style_name STRING, product_type_code STRING, "
        "lifecycle_status STRING, season STRING, attributes MAP<STRING, VARIANT>, "
        f"variants ARRAY<STRUCT<{variant}, external_ids: MAP<STRING, STRING>>>"
    )


def attributes_of(values: Column) -> Column:
    """Attribute map from a struct of typed columns, keeping the type of each value."""
    return F.try_variant_get(F.to_variant_object(values), "$", "map<string,variant>")


def _rule_tables(spark: SparkSession, rules: RuleSet) -> tuple[DataFrame, DataFrame]:
    def typed(codes: Iterable[str]) -> list[tuple[str, str]]:
        return [(code, rules.data_type(code)) for code in sorted(set(codes))]

    types = spark.createDataFrame(
        [
            (t.code, bool(t.template_code), typed(t.required), typed({*t.recommended} - {*t.required}))
            for t in rules.product_types.values()
        ],
        f"type_code STRING, has_template BOOLEAN, type_required {_TYPED_CODES}, "
        f"type_recommended {_TYPED_CODES}",
    )
    brands = spark.createDataFrame(
        [(b.code, typed(b.required)) for b in rules.brands.values()],
        f"governed_brand STRING, brand_required {_TYPED_CODES}",
    )
    return types, brands


def validate(documents: DataFrame, rules: RuleSet, naming: Naming | None = None) -> DataFrame:
    """One result row per document, with its issues in the order of the checks."""
    naming = naming or Naming()
    types, brands = _rule_tables(documents.sparkSession, rules)
    ruled = documents.join(
        F.broadcast(types), documents["product_type_code"] == types["type_code"], "left"
    ).join(F.broadcast(brands), documents["brand_code"] == brands["governed_brand"], "left")
    required, recommended = _wanted_attributes()
    wanted = ruled.withColumns({"type_required": required, "type_recommended": recommended})
    # Lambdas are not compiled, and neither is a generator that holds one: they come first, as columns.
    found = wanted.withColumns(
        {
            "variant_issues": _variant_issues(naming),
            "attribute_issues": _attribute_issues(naming),
            "has_gtin": F.exists("variants", lambda v: ~is_blank(v["gtin"])),
        }
    )
    checked = computed_once(
        found,
        "issues",
        joined(
            listed(_identity_issues(rules, naming)),
            F.col("variant_issues"),
            listed(_product_type_issues(naming)),
            F.col("attribute_issues"),
            listed([_identifier_issue(naming)]),
        ),
    )
    issues = F.col("issues")
    blocking = count_where(issues, is_blocking)
    return checked.select(
        naming.style_id,
        "brand_code",
        "brand_name",
        "product_type_code",
        F.lit(CONTEXT).alias("context"),
        (blocking == 0).alias("ready"),
        _score(issues, rules).alias("score"),
        F.lit(rules.version).alias("rule_set_version"),
        F.size(issues).alias("issue_count"),
        blocking.alias("blocking_issue_count"),
        count_where(issues, is_warning).alias("warning_count"),
        "issues",
    )


# Fixed values below: issue codes, message texts, source fields and rule ids.


def _identity_issues(rules: RuleSet, naming: Naming) -> list[tuple[Column, Column]]:
    """V2, V3."""
    brand = F.col("brand_code")
    unknown = F.lit(bool(rules.brands)) & F.col("governed_brand").isNull()
    return [
        (
            is_blank(F.col("global_style_id")),
            issue(
                "GLOBAL_STYLE_ID_MISSING",
                f"{naming.label} payload is missing the global style ID.",
                ERROR,
                naming.label,
                "global_style_id",
                "identity.global_style_id.required",
            ),
        ),
        (
            is_blank(brand),
            issue(
                "BRAND_MISSING",
                f"{naming.label} payload is missing brand_code.",
                ERROR,
                naming.label,
                "brand_code",
                "taxonomy.brand.required",
            ),
        ),
        (
            ~is_blank(brand) & unknown,
            issue(
                "BRAND_UNKNOWN",
                F.concat(F.lit("Brand "), brand, F.lit(" is not governed in the DPP rule set.")),
                ERROR,
                naming.hub,
                "brand_code",
                "taxonomy.brand.known",
            ),
        ),
    ]


def _variant_issues(naming: Naming) -> Column:
    """V4: issues of all variants, in the order of the variants."""
    none = F.array().cast(ISSUES_TYPE)

    def of_variant(v: Column, n: Column) -> Column:
        index = n.cast("string")
        own_id = non_empty(v[naming.variant_id])
        field = F.concat(F.lit("variants["), index, F.lit("]."))
        label = F.coalesce(non_empty(v["sku"]), own_id, index)
        no_global_id, no_sku = is_blank(v["global_variant_id"]), is_blank(v["sku"])
        global_id_issue = F.when(
            no_global_id,
            issue(
                "GLOBAL_VARIANT_ID_MISSING",
                F.concat(F.lit("Variant "), label, F.lit(" is missing a global variant ID.")),
                ERROR,
                naming.label,
                F.concat(field, F.lit("global_variant_id")),
                "identity.global_variant_id.required",
            ),
        )
        sku_issue = F.when(
            no_sku,
            issue(
                "SKU_MISSING",
                F.concat(F.lit("Variant "), F.coalesce(own_id, index), F.lit(" is missing SKU.")),
                ERROR,
                naming.label,
                F.concat(field, F.lit("sku")),
                "identity.sku.required",
            ),
        )
        found = present([global_id_issue, sku_issue]).cast(ISSUES_TYPE)
        return F.when(no_global_id | no_sku, found).otherwise(none)

    return F.coalesce(F.flatten(F.transform("variants", of_variant)), none)


def _product_type_issues(naming: Naming) -> list[tuple[Column, Column]]:
    """V5: at most one applies."""
    code = F.col("product_type_code")
    given, known = ~is_blank(code), F.col("type_code").isNotNull()

    def of(issue_code: str, message: Column | str, where: str, rule: str) -> Column:
        return issue(issue_code, message, ERROR, where, "product_type_code", rule)

    return [
        (
            ~given,
            of(
                "PRODUCT_TYPE_MISSING",
                f"{naming.label} payload is missing product_type_code.",
                naming.label,
                "taxonomy.product_type.required",
            ),
        ),
        (
            given & ~known,
            of(
                "PRODUCT_TYPE_UNKNOWN",
                F.concat(F.lit("Product type "), code, F.lit(" is not governed for DPP.")),
                naming.hub,
                "taxonomy.product_type.known",
            ),
        ),
        (
            given & known & ~F.col("has_template"),
            of(
                "DPP_TEMPLATE_MAPPING_MISSING",
                F.concat(F.lit("Product type "), code, F.lit(" has no DPP template mapping.")),
                naming.hub,
                "mapping.dpp.template.required",
            ),
        ),
    ]


def _wanted_attributes() -> tuple[Column, Column]:
    """V6: required attributes of type and brand, and the recommended ones left, both in order.

    The lists of the rules are sorted, so they are sorted again only where both have some.
    """
    none = F.array().cast(_TYPED_CODES)
    by_type, recommended, by_brand = (
        F.coalesce(F.col(name), none) for name in ("type_required", "type_recommended", "brand_required")
    )
    required = (
        F.when(F.size(by_brand) == 0, by_type)
        .when(F.size(by_type) == 0, by_brand)
        .otherwise(F.array_sort(F.array_union(by_type, by_brand)))
    )
    left = F.when(F.size(by_brand) == 0, recommended).otherwise(F.array_except(recommended, by_brand))
    return required, left


def _attribute_issues(naming: Naming) -> Column:
    """V6-V8: required attributes, then recommended ones."""
    found = F.concat(
        F.transform("type_required", lambda a: _attribute_issue(a, True, naming)),
        F.transform("type_recommended", lambda a: _attribute_issue(a, False, naming)),
    )
    return F.filter(found, lambda i: i.isNotNull()).cast(ISSUES_TYPE)


def is_missing(value: Column, kind: Column) -> Column:
    """V7: absent, null, '' or []; 0, false, {} and ' ' are present."""
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit(True))
        .when(kind == "STRING", F.try_variant_get(value, "$", "string") == "")
        .when(kind == "ARRAY<VOID>", F.size(F.try_variant_get(value, "$", "array<variant>")) == 0)
        .otherwise(F.lit(False))
    )


_NUMBERS = ("BIGINT", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")


def has_wrong_type(kind: Column, expected: Column) -> Column:
    """V8: names other than these four never fail."""
    return (
        F.when(expected == "string", kind != "STRING")
        .when(expected == "number", ~(kind.isin(*_NUMBERS) | kind.startswith("DECIMAL")))
        .when(expected == "boolean", kind != "BOOLEAN")
        .when(expected == "list", ~kind.startswith("ARRAY"))
        .otherwise(F.lit(False))
    )


def _attribute_issue(attribute: Column, required: bool, naming: Naming) -> Column:
    code, expected = attribute["code"], attribute["data_type"]
    field = F.concat(F.lit("attributes."), code)
    need_kind, need = ("REQUIRED", "required") if required else ("RECOMMENDED", "recommended")
    missing = issue(
        f"DPP_{need_kind}_ATTRIBUTE_MISSING",
        F.concat(code, F.lit(f" is {need} for DPP readiness.")),
        ERROR if required else WARNING,
        naming.label,
        field,
        F.concat(F.lit("readiness.dpp.attribute."), code, F.lit(".required")),
        required,
    )
    wrong = issue(
        "ATTRIBUTE_TYPE_INVALID",
        F.concat(code, F.lit(" must be a "), expected, F.lit(".")),
        ERROR,
        naming.label,
        field,
        F.concat(F.lit("attribute."), code, F.lit(".data_type")),
    )

    def judged(value: Column) -> Column:
        def of_kind(kind: Column) -> Column:
            return F.when(is_missing(value, kind), missing).when(has_wrong_type(kind, expected), wrong)

        return bound(variant_kind(value), of_kind)

    return bound(F.try_element_at("attributes", code), judged)


def _identifier_issue(naming: Naming) -> tuple[Column, Column]:
    """V9."""
    return (
        ~F.coalesce(F.col("has_gtin"), F.lit(False)),
        issue(
            "DPP_GTIN_OR_RESOLVER_ID_MISSING",
            "DPP readiness requires at least one GTIN or resolver identifier candidate.",
            WARNING,
            naming.label,
            "variants[].gtin",
            "readiness.dpp.identifier.present",
            False,
        ),
    )


def _score(issues: Column, rules: RuleSet) -> Column:
    """V10."""
    penalties = count_where(issues, is_blocking) * rules.penalty("blocking_error")
    penalties = penalties + count_where(issues, is_warning) * rules.penalty("warning")
    return F.greatest(F.lit(0), F.lit(100) - penalties)


def run_result(results: DataFrame) -> DataFrame:
    """One row of totals."""
    totals = results.agg(
        F.count("*").alias("total_products"), F.count_if("ready").alias("ready_products")
    )
    ratio = percent(F.col("ready_products"), F.col("total_products"), 0.0)
    return totals.withColumn("readiness_percent", ratio)
