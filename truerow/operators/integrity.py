"""Are the ids of a delivery sound and is it complete?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truerow.functions.jsons import computed_once, is_json_null, payload_fields, variant_kind

# Statuses, the reason of a skipped check, the number of sampled ids.
PASSED = "passed"
FAILED = "failed"
SKIPPED = "skipped"
NO_EXPECTATION = "expected_count_unavailable"
SAMPLES = 5


def payload_ids(lines: DataFrame, primary_key: str = "id") -> DataFrame:
    """(endpoint, id) of JSON lines; a missing, null or nested id is NULL."""
    field = payload_fields(F.col("payload"), [primary_key], "VARIANT")[primary_key]
    parsed = F.col("parsed_id")
    scalar = ~is_json_null(parsed) & ~variant_kind(parsed).rlike("^(ARRAY|OBJECT)")
    opened = computed_once(lines.select("endpoint", "payload"), "parsed_id", field)
    return opened.select(
        "endpoint",
        F.when(scalar, F.try_variant_get(parsed, "$", "string")).alias("id"),
    )


def id_integrity(ids: DataFrame) -> DataFrame:
    """Per endpoint the checked, invalid, unique and repeated ids, with a small sample.

    Equal ids are counted on the map side. The sample is the smallest repeated ids, cut to
    five per endpoint before they are shuffled.
    """
    counted = ids.groupBy("endpoint", "id").agg(F.count("*").alias("n"))
    n, known = F.col("n"), F.col("id").isNotNull()
    totals = counted.groupBy("endpoint").agg(
        F.sum("n").alias("records"),
        F.coalesce(F.sum(F.when(~known, n)), F.lit(0)).alias("invalid_ids"),
        F.count_if(known).alias("unique_ids"),
        F.count_if(known & (n > 1)).alias("duplicate_ids"),
    )
    by_id = Window.partitionBy("endpoint").orderBy(F.asc_nulls_last("id"))
    # NULL comes last and is not collected. No filter on the id itself, so that both uses of
    # the counts read the same shuffle.
    sampled = (
        counted.where(n > 1)
        .withColumn("rank", F.row_number().over(by_id))
        .where(F.col("rank") <= SAMPLES)
        .groupBy("endpoint")
        .agg(F.array_sort(F.collect_list("id")).alias("duplicate_sample"))
    )
    joined = totals.join(sampled, "endpoint", "left")
    return joined.withColumn(
        "duplicate_sample",
        F.coalesce("duplicate_sample", F.array().cast("array<string>")),
    )


def with_id_status(checked: DataFrame, expected_known: Column) -> DataFrame:
    """Ids are only judged where the expected count is known."""
    sound = (F.col("invalid_ids") == 0) & (F.col("duplicate_ids") == 0)
    status = F.when(~expected_known, SKIPPED).when(sound, PASSED).otherwise(FAILED)
    return checked.withColumn("id_validation_status", status)


def reconcile_counts(expected: DataFrame, fetched: DataFrame, key: str) -> DataFrame:
    """``expected`` (key, expected_count) against ``fetched`` (key, items_fetched)."""
    joined = expected.join(fetched, key, "left").fillna(0, ["items_fetched"])
    unknown = F.col("expected_count").isNull()
    equal = F.col("expected_count") == F.col("items_fetched")
    return joined.withColumns(
        {
            "count_validation_status": F.when(unknown, SKIPPED)
            .when(equal, PASSED)
            .otherwise(FAILED),
            "count_validation_reason": F.when(unknown, NO_EXPECTATION),
        }
    )


def status_counts(rows: DataFrame, status: str) -> DataFrame:
    """U8."""
    return rows.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("count"))
