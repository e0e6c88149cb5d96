"""Which records a delta run asks for, and what it remembers afterwards."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truerow.operators.snapshots import latest

# Overlap defaults and bounds, statuses, operator suffixes, field and sort names.
DEFAULT_OVERLAP_MINUTES = 60
DEFAULT_OVERLAP_DAYS = 0
MAX_OVERLAP_DAYS = 1000
OK = "OK"
PARTIAL = "PARTIAL"
FAILED = "FAILED"
OPERATORS = ("!", "ge", "gt", "le", "lt")
MODIFIED_AT = "_modified_at"
SORT = "sort"
CONTROL_PARAMS = ("decoded", SORT)


def overlap(minutes: Any = None, days: Any = None) -> tuple[int, int]:
    """Valid overlaps, defaults in place of anything else."""

    def valid(value: Any, default: int, most: float) -> int:
        whole = isinstance(value, int) and not isinstance(value, bool)
        return value if whole and 0 <= value <= most else default

    return (
        valid(minutes, DEFAULT_OVERLAP_MINUTES, float("inf")),
        valid(days, DEFAULT_OVERLAP_DAYS, MAX_OVERLAP_DAYS),
    )


def delta_floors(state: DataFrame, minutes: Any = None, days: Any = None) -> DataFrame:
    """(endpoint, floor): the last successful start minus the overlap, NULL without one."""
    back_minutes, back_days = overlap(minutes, days)
    back = F.make_dt_interval(days=F.lit(back_days), mins=F.lit(back_minutes))
    floor = F.col("last_successful_fetch_start") - back
    return state.select("endpoint", floor.alias("floor"))


def above_floor(records: DataFrame, floors: DataFrame) -> DataFrame:
    """Records at or above the floor of their endpoint; without a floor all of them.

    ``floors`` has one row per endpoint, so the join side is as small as the configuration;
    it is left to the optimizer to broadcast it by its size.
    """
    joined = records.join(floors, "endpoint", "left")
    return joined.where(F.col("floor").isNull() | (F.col("modified_at_ts") >= F.col("floor"))).drop(
        "floor"
    )


def since(records: DataFrame, start: datetime, column: str = "modified_at_ts") -> DataFrame:
    """A literal bound, so it reaches the file scan."""
    return records.where(F.col(column) >= F.lit(start).cast("timestamp_ntz"))


def select_endpoints(records: DataFrame, names: Iterable[str], known: Iterable[str]) -> DataFrame:
    """Only the named endpoints (all, when none is named); unknown names are an error."""
    wanted = sorted(set(names))
    unknown = sorted(set(wanted) - set(known))
    if unknown:
        raise ValueError(f"Unknown endpoints: {', '.join(unknown)}")
    return records.where(F.col("endpoint").isin(wanted)) if wanted else records


# -- P10, P11: predicates from configuration -------------------------------------------------


def split_param(key: str) -> tuple[str, str]:
    """``price=ge`` is (price, ge); a name alone, or one that ends in ``=``, asks for equality."""
    field, separator, suffix = key.rpartition("=")
    if separator and field and suffix in ("", *OPERATORS):
        return field, suffix
    return key, ""


def predicate(params: Mapping[str, Any]) -> Column:
    """P10: all conditions joined by AND; sort and display parameters are no conditions."""

    def condition(key: str, value: Any) -> Column:
        field, operator = split_param(key)
        column = F.col(field)
        return {
            "": column == value,
            "!": column != value,
            "ge": column >= value,
            "gt": column > value,
            "le": column <= value,
            "lt": column < value,
        }[operator]

    tests = [
        condition(str(key), value)
        for key, value in params.items()
        if split_param(str(key))[0] not in CONTROL_PARAMS
    ]
    return reduce(and_, tests, F.lit(True))


def without_modified_at(params: Mapping[str, Any]) -> dict[str, Any]:
    """P10: the parameters without any bound on the modification time."""
    return {k: v for k, v in params.items() if split_param(str(k))[0] != MODIFIED_AT}


def with_floor(params: Mapping[str, Any], floor: Any | None) -> dict[str, Any]:
    """P10: replace the bound on the modification time; with a floor, sort by that time."""
    if floor is None:
        return dict(params)
    bound = {**without_modified_at(params), f"{MODIFIED_AT}=ge": floor}
    return with_sort(bound, MODIFIED_AT, "force")


def with_sort(params: Mapping[str, Any], value: str, policy: str) -> dict[str, Any]:
    """P10: ``preserve`` keeps the sort as it is, ``if_missing`` adds one, ``force`` sets it."""
    if policy not in ("preserve", "if_missing", "force"):
        raise ValueError(f"Unknown sort policy {policy!r}.")
    replace = policy == "force" or (policy == "if_missing" and SORT not in params)
    return {**params, SORT: value} if replace else dict(params)


def read_filtered(source: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """P10: the rows of a columnar source the parameters ask for; conditions are pushed down."""
    rows = source.where(predicate(params))
    return rows.orderBy(params[SORT]) if params.get(SORT) else rows


def overlay_params(
    base: Mapping[str, Mapping[str, Any]], overlays: Mapping[str, Mapping[str, Any]]
) -> dict[str, dict[str, Any]]:
    """Per-endpoint parameters over the base ones; an unknown endpoint is an error."""
    unknown = sorted(set(overlays) - set(base))
    if unknown:
        raise ValueError(f"Parameters for unknown endpoints: {', '.join(unknown)}")
    return {name: {**params, **overlays.get(name, {})} for name, params in base.items()}


# -- P12: the state of delta runs ------------------------------------------------------------


def fetch_status(error: Column, completed_before: Column, warnings: Column) -> Column:
    """FAILED with an error; OK when there was nothing left to do; PARTIAL with warnings."""
    return (
        F.when(error.isNotNull(), FAILED)
        .when(completed_before, OK)
        .when(warnings > 0, PARTIAL)
        .otherwise(OK)
    )


def update_fetch_state(state: DataFrame, attempts: DataFrame) -> DataFrame:
    """The last attempt per endpoint, and the last one that succeeded.

    ``attempts`` has endpoint, attempt_start, attempt_end, status and error. Both maxima come
    from one aggregation without sorting the attempts.
    """
    tried = attempts.select(
        "endpoint",
        F.col("attempt_start").alias("start"),
        F.struct("attempt_start", "attempt_end", "status", "error").alias("attempt"),
        F.when(
            F.col("status").isin(OK, PARTIAL), F.struct("attempt_start", "attempt_end")
        ).alias("success"),
    )
    newest = tried.groupBy("endpoint").agg(
        F.max_by("attempt", "start").alias("attempt"), F.max("success").alias("success")
    )
    old = state.select(
        "endpoint",
        F.struct(*[c for c in state.columns if c != "endpoint"]).alias("old"),
    )
    joined = old.join(newest, "endpoint", "full_outer")
    attempt = {
        "last_attempted_fetch_start": "attempt_start",
        "last_attempted_fetch_end": "attempt_end",
        "last_attempted_status": "status",
        "last_attempted_error": "error",
    }
    tried_now = F.col("attempt").isNotNull()
    columns = [
        F.when(tried_now, F.col(f"attempt.{new}")).otherwise(F.col(f"old.{name}")).alias(name)
        for name, new in attempt.items()
    ]
    columns += [
        F.coalesce(f"success.attempt_{part}", f"old.last_successful_fetch_{part}").alias(
            f"last_successful_fetch_{part}"
        )
        for part in ("start", "end")
    ]
    return joined.select("endpoint", *columns)


# -- S13: run manifests ----------------------------------------------------------------------


def run_manifest(endpoint_rows: DataFrame) -> DataFrame:
    """One row per run from its endpoints' rows (run_id, endpoint, status, counts).

    A run is FAILED only if all of its endpoints are, PARTIAL if some endpoint is not OK.
    """
    status = F.col("status")
    totals = endpoint_rows.groupBy("run_id").agg(
        F.count("*").alias("endpoints_total"),
        F.count_if(status != FAILED).alias("endpoints_succeeded"),
        F.count_if(status == FAILED).alias("endpoints_failed"),
        F.count_if(status == PARTIAL).alias("endpoints_partial"),
        F.coalesce(F.sum("items_fetched"), F.lit(0)).alias("total_items"),
        F.min("attempt_start").alias("started_at"),
        F.max("attempt_end").alias("finished_at"),
    )
    failed, partial = F.col("endpoints_failed"), F.col("endpoints_partial")
    return totals.withColumn(
        "status",
        F.when(failed == F.col("endpoints_total"), FAILED)
        .when((failed > 0) | (partial > 0), PARTIAL)
        .otherwise(OK),
    )


def batch_manifest(ledger: DataFrame) -> DataFrame:
    """S13 for the batches this library applied itself, one row per run and endpoint."""
    return ledger.groupBy(F.col("source_run_id").alias("run_id"), "endpoint").agg(
        F.count("*").alias("files"),
        F.max("run_mode").alias("mode"),
        F.bool_or("is_delta").alias("is_delta"),
        F.sum("record_count").alias("items_fetched"),
        F.sum("upserted").alias("upserted"),
        F.sum("deleted").alias("deleted"),
        F.lit(OK).alias("status"),
        F.min("ingested_at_ts").alias("attempt_start"),
        F.max("ingested_at_ts").alias("attempt_end"),
    )


def newest_state(rows: DataFrame) -> DataFrame:
    """The newest row per endpoint of an append-only state table."""
    return latest(rows, ["endpoint"], "last_attempted_fetch_start")
