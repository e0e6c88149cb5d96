"""Recurring delta cycles, their status and totals."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truerow.functions.jsons import payload_fields, variant_kind
from truerow.functions.times import utc_now
from truerow.operators.apply import IngestResult
from truerow.sources.store import CYCLES, MasterStore

# Statuses of a cycle.
OK = "OK"
FAILED = "FAILED"
PARTIAL_FAILURE = "PARTIAL_FAILURE"


def record_cycle(
    store: MasterStore,
    ingested: IngestResult,
    targets: Sequence[str],
    run: Callable[[MasterStore, IngestResult, str], object],
) -> DataFrame:
    """L3: run each target after a successful ingest and log how it went."""
    started = utc_now()
    rows = []
    for name in targets:
        error = None
        try:
            run(store, ingested, name)
        except Exception as problem:  # one target must not stop the others
            error = str(problem)
        rows.append((name, OK if error is None else FAILED, error))
    cycle_id = f"{started:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    stamp = {
        "cycle_id": F.lit(cycle_id),
        "started_at": F.lit(started).cast("timestamp_ntz"),
        "finished_at": F.lit(utc_now()).cast("timestamp_ntz"),
        "fetch_status": F.lit(FAILED if ingested.failed_files else OK),
    }
    log = store.spark.createDataFrame(
        rows or [(None, None, None)], "target STRING, pipeline_status STRING, error STRING"
    ).withColumns(stamp)
    store.append(CYCLES.name, log.coalesce(1))
    return store.read(CYCLES.name).where(F.col("cycle_id") == cycle_id)


def cycle_status(log: DataFrame) -> DataFrame:
    """L4: the fetch status; with a good fetch, PARTIAL_FAILURE when any target failed."""
    totals = log.groupBy("cycle_id").agg(
        F.max("fetch_status").alias("fetch_status"),
        F.count("pipeline_status").alias("pipelines"),
        F.count_if(F.col("pipeline_status") != OK).alias("failed_pipelines"),
    )
    status = (
        F.when(F.col("fetch_status") != OK, F.col("fetch_status"))
        .when(F.col("failed_pipelines") > 0, PARTIAL_FAILURE)
        .otherwise(OK)
    )
    return totals.withColumn("status", status)


def _whole_number(value: Column) -> Column:
    """The integer itself; anything that is no JSON integer counts as 0."""
    whole = variant_kind(value).isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    return F.coalesce(F.when(whole, F.try_variant_get(value, "$", "bigint")), F.lit(0))


def cycle_totals(lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals over JSONL result records in ``payload``; other lines are passed over."""
    names = ["status", "items_fetched", "pages_fetched"]
    parsed = lines.select(*by, payload_fields(F.col("payload"), names, "VARIANT").alias("p"))
    status = F.try_variant_get("p.status", "$", "string")
    return parsed.groupBy(*by).agg(
        F.count_if(status == "ok").alias("endpoints_ok"),
        F.count_if(status == "failed").alias("endpoints_failed"),
        F.coalesce(F.sum(_whole_number(F.col("p.items_fetched"))), F.lit(0)).alias("items_fetched"),
        F.coalesce(F.sum(_whole_number(F.col("p.pages_fetched"))), F.lit(0)).alias("pages_fetched"),
    )
