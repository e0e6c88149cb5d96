"""Check the relationship state of reconstructed products."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truerow.config.naming import Naming
from truerow.functions.issues import (
    ERROR,
    ISSUES_TYPE,
    WARNING,
    issue,
    joined,
    listed,
)
from truerow.functions.jsons import bound, variant_kind
from truerow.functions.text import non_empty

# Version, buckets with their messages, declared ids with their bucket, codes.
CONTEXT = "reconstruction_check"
RULE_SET_VERSION = "reconstruction-check-v1"
EXPECTED_BUCKETS = {
    "colorways": "Style has no resolved colorway records.",
    "sizes": "Style has no resolved size records.",
    "boms": "Style has no resolved BOM revision records.",
    "bom_rows": "Style has no resolved BOM row records.",
    "materials": "Style has no resolved material records.",
    "supplier_quotes": "Style has no resolved supplier quote records.",
    "factories": "Style has no resolved factory records.",
    "suppliers": "Style has no resolved supplier records.",
}
DECLARED_BUCKETS = {
    "style_colorway_ids": "colorways",
    "style_size_ids": "sizes",
    "bom_revision_ids": "boms",
    "bom_row_ids": "bom_rows",
    "material_ids": "materials",
    "supplier_quote_revision_ids": "supplier_quotes",
    "factory_ids": "factories",
    "supplier_ids": "suppliers",
    "season_ids": "seasons",
}
_REF_TEXTS = (
    "struct<status:string,relation:string,relation_type:string,endpoint:string,source_endpoint:string,"
    "record_id:string,source_record_id:string,id:string>"
)
ERROR_PENALTY = 20
OTHER_PENALTY = 5


def numeric_counts(counts: Column) -> Column:
    """The numeric entries of a variant as MAP<STRING, INT>; no object, no entries."""
    entries = F.try_variant_get(counts, "$", "map<string,variant>")
    numbers = F.map_filter(
        entries,
        lambda _, v: variant_kind(v).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|BOOLEAN)"),
    )
    whole = F.transform_values(numbers, lambda _, v: F.try_variant_get(v, "$", "double").cast("int"))
    return F.coalesce(whole, F.create_map().cast("map<string,int>"))


def check_schema() -> str:
    """Schema to read check payloads from JSON with; see ``from_json_payloads``."""
    return (
        "style_id STRING, counts STRUCT<relationship_ids: VARIANT, resolved_records: VARIANT>, "
        "unresolved_refs ARRAY<VARIANT>, "
        "warnings ARRAY<STRUCT<code: STRING, message: STRING, severity: STRING, "
        "source_endpoint: STRING, source_record_id: STRING>>"
    )


def from_json_payloads(payloads: DataFrame) -> DataFrame:
    """Check payloads read with ``check_schema``, their counts reduced to numbers."""
    counts = F.struct(
        numeric_counts(F.col("counts.relationship_ids")).alias("relationship_ids"),
        numeric_counts(F.col("counts.resolved_records")).alias("resolved_records"),
    )
    return payloads.withColumn("counts", counts)


def tallies(payloads: DataFrame, naming: Naming | None = None) -> DataFrame:
    """One result row per check payload, its issues only counted, no shuffle.

    The counts follow from the payload's numbers alone: every absent bucket and carried warning is
    a warning, every declared id without a record and every unresolved reference an error.
    No issue, and none of its texts, is built.
    """
    naming = naming or Naming()
    absent = _number_of(_count("resolved_records", bucket) == 0 for bucket in EXPECTED_BUCKETS)
    short = _number_of(
        _count("relationship_ids", key) > _count("resolved_records", bucket)
        for key, bucket in DECLARED_BUCKETS.items()
    )
    errors = short + F.coalesce(F.size("unresolved_refs"), F.lit(0))
    others = absent + F.coalesce(F.size("warnings"), F.lit(0))
    counted = payloads.withColumns({"errors_": errors, "others_": others})
    errors, others = F.col("errors_"), F.col("others_")
    return counted.select(
        F.col("style_id").alias(naming.style_id),
        F.lit(None).cast("string").alias("brand_code"),
        F.lit(None).cast("string").alias("brand_name"),
        F.lit(None).cast("string").alias("product_type_code"),
        F.lit(CONTEXT).alias("context"),
        (errors == 0).alias("ready"),
        F.greatest(F.lit(0), F.lit(100) - errors * ERROR_PENALTY - others * OTHER_PENALTY).alias("score"),
        F.lit(RULE_SET_VERSION).alias("rule_set_version"),
        (errors + others).alias("issue_count"),
        errors.alias("blocking_issue_count"),
        others.alias("warning_count"),
        *payloads.columns,
    )


def validate(payloads: DataFrame, naming: Naming | None = None) -> DataFrame:
    """``tallies`` with the issues themselves, no shuffle.

    A table that does not ask for the issues does not compute them.
    """
    naming = naming or Naming()
    counted = tallies(payloads.select("style_id", "counts", "unresolved_refs", "warnings"), naming)
    issues = joined(
        listed(_absent_buckets(naming)),
        listed(_unresolved_counts(naming)),
        _unresolved_refs(naming),
        _carried_warnings(naming),
    )
    inputs = {"counts", "unresolved_refs", "warnings", "style_id"} - {naming.style_id}
    return counted.withColumn("issues", issues).drop(*inputs)


def _number_of(tests: Iterable[Column]) -> Column:
    return reduce(Column.__add__, [F.when(test, 1).otherwise(0) for test in tests])


def _count(of: str, key: str) -> Column:
    return F.coalesce(F.try_element_at(F.col(f"counts.{of}"), F.lit(key)), F.lit(0))


def _absent_buckets(naming: Naming) -> list[tuple[Column, Column]]:
    """V13."""
    return [
        (
            _count("resolved_records", bucket) == 0,
            issue(
                f"{bucket.upper()}_MISSING",
                message,
                WARNING,
                naming.label,
                f"counts.resolved_records.{bucket}",
                f"reconstruction.relationship.{bucket}.present",
                False,
            ),
        )
        for bucket, message in EXPECTED_BUCKETS.items()
    ]


def _unresolved_counts(naming: Naming) -> list[tuple[Column, Column]]:
    """V14."""
    found = []
    for key, bucket in DECLARED_BUCKETS.items():
        declared = _count("relationship_ids", key)
        resolved = _count("resolved_records", bucket)
        text = F.format_string(
            f"{key} declares %d ids, but only %d matching {bucket} records were resolved.",
            declared,
            resolved,
        )
        found.append(
            (
                declared > resolved,
                issue(
                    "RELATIONSHIP_RECORDS_UNRESOLVED",
                    text,
                    ERROR,
                    naming.hub,
                    f"relationship_ids.{key}",
                    f"reconstruction.relationship.{key}.resolved",
                ),
            )
        )
    return found


def _unresolved_refs(naming: Naming) -> Column:
    """Code, message and rule id depend on the status of the reference."""

    def texts(ref: Column) -> Column:
        """All that the issue is made of, read at once."""
        read = F.try_variant_get(ref, "$", _REF_TEXTS)

        def text(of: Column, *names: str) -> Column:
            return F.coalesce(*[non_empty(of[name]) for name in names])

        return bound(
            read,
            lambda of: F.struct(
                F.coalesce(text(of, "status"), F.lit("unresolved")).alias("status"),
                F.coalesce(text(of, "relation", "relation_type"), F.lit("relationship")).alias("relation"),
                F.coalesce(text(of, "endpoint", "source_endpoint"), F.lit("endpoint")).alias("endpoint"),
                text(of, "record_id", "source_record_id", "id").alias("record_id"),
            ),
        )

    def of_ref(ref: Column) -> Column:
        status, relation, endpoint, record_id = (ref[n] for n in ("status", "relation", "endpoint", "record_id"))
        not_an_id = F.concat(
            F.lit("Invalid "),
            relation,
            F.lit(" reference value"),
            F.coalesce(F.concat(F.lit(" "), record_id), F.lit("")),
            F.lit(f"; it is not a {naming.label} record id."),
        )
        target = F.concat(
            endpoint, F.coalesce(F.concat(F.lit(" record "), record_id), F.lit(""))
        )
        not_seen = F.concat(
            relation,
            F.lit(" references "),
            target,
            F.lit(", but that record was not seen in the current ingested data store."),
        )
        other = F.concat(
            F.lit("Unresolved "), relation, F.lit(" reference to "), target, F.lit(".")
        )
        invalid, unseen = status == "invalid_ref", status == "not_seen"
        return issue(
            F.when(invalid, "INVALID_REFERENCE_VALUE")
            .when(unseen, "REFERENCED_RECORD_NOT_SEEN")
            .otherwise("UNRESOLVED_RECONSTRUCTION_REF"),
            F.when(invalid, not_an_id).when(unseen, not_seen).otherwise(other),
            ERROR,
            naming.hub,
            "unresolved_refs",
            F.concat(F.lit("reconstruction.refs."), status),
        )

    found = F.transform(F.transform("unresolved_refs", texts), of_ref)
    return F.coalesce(found, F.array().cast(ISSUES_TYPE))


def _carried_warnings(naming: Naming) -> Column:
    """V16."""

    def of_warning(w: Column) -> Column:
        code = F.coalesce(non_empty(w["code"]), F.lit("RECONSTRUCTION_WARNING"))
        return issue(
            code,
            F.coalesce(non_empty(w["message"]), code),
            WARNING,
            naming.hub,
            "warnings",
            F.concat(F.lit("reconstruction.warning."), F.lower(code)),
            False,
        )

    found = F.transform("warnings", of_warning)
    return F.coalesce(found, F.array().cast(ISSUES_TYPE))
