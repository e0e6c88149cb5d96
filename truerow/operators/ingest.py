"""From JSON lines to one current row per (endpoint, record id).

A batch of files is folded in one pass. Duplicates inside a file are reduced on the map
side first, so a record id that fills a third of a file reaches the shuffle as one row per
task. After that a record has at most one row per file, and the files of a batch are
bounded, so the per-record list that the ordered fold needs stays small.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truerow.config.endpoints import EndpointSchema
from truerow.functions.jsons import first_value, is_malformed, with_line_fields
from truerow.functions.times import utc_timestamp

UPSERT = "upsert"
DELETE = "delete"
NONE = "none"
SEED = -1


def _by_schema(
    endpoint: Column, schemas: Mapping[str, EndpointSchema], build, default: EndpointSchema
) -> Column:
    """One expression per distinct configuration instead of one per endpoint."""
    groups: dict[tuple, list[str]] = {}
    for name, schema in schemas.items():
        key = (schema.primary_key, schema.modified_at_fields, schema.delete_when_any)
        groups.setdefault(key, []).append(name)
    usual = (default.primary_key, default.modified_at_fields, default.delete_when_any)
    result = build(default)
    for key, names in groups.items():
        if key != usual:
            result = F.when(endpoint.isin(names), build(schemas[names[0]])).otherwise(result)
    return result


def extract(
    lines: DataFrame, schemas: Mapping[str, EndpointSchema], fail_on_malformed: bool = True
) -> DataFrame:
    """P2-P4 on lines with columns (endpoint, payload, ...).

    Adds record_id, modified_at, modified_at_ts and is_delete; rows without an id go away. A
    key that an object repeats counts with its first value; text after the object is malformed.
    """
    default = EndpointSchema("")
    wanted = {default.primary_key, *default.modified_at_fields}
    for schema in (default, *schemas.values()):
        wanted |= {schema.primary_key, *schema.modified_at_fields}
        wanted |= {condition.field for condition in schema.delete_when_any}
    endpoint = F.col("endpoint")
    parsed = F.col("parsed")

    def field(name: str) -> Column:
        return first_value(F.col("payload"), parsed, name)

    def deleted(schema: EndpointSchema) -> Column:
        tests = [
            F.coalesce(field(c.field) == c.text, F.lit(False)) for c in schema.delete_when_any
        ]
        return reduce(or_, tests, F.lit(False))

    def modified(schema: EndpointSchema) -> Column:
        texts = [field(name) for name in schema.modified_at_fields]
        return F.coalesce(*texts) if texts else F.lit(None).cast("string")

    record_id = _by_schema(endpoint, schemas, lambda s: field(s.primary_key), default)
    if fail_on_malformed:
        where = F.col("file_path") if "file_path" in lines.columns else endpoint
        problem = F.raise_error(F.concat(F.lit("Malformed JSON line in "), where))
        malformed = is_malformed(F.col("payload"), parsed)
        record_id = F.when(parsed.isNotNull(), record_id).when(malformed, problem)
    modified_at = _by_schema(endpoint, schemas, modified, default)
    return (
        with_line_fields(lines, wanted)
        .select(
            *lines.columns,
            record_id.alias("record_id"),
            modified_at.alias("modified_at"),
            utc_timestamp(modified_at).alias("modified_at_ts"),
            _by_schema(endpoint, schemas, deleted, default).alias("is_delete"),
        )
        .where(F.trim("record_id") != "")
    )


def latest_per_key(
    records: DataFrame, keys: Iterable[str], line_order: Iterable[str], carry: Iterable[str]
) -> DataFrame:
    """The newest row per key, by typed time, then its text, then the later line.

    A struct compares field by field with NULL lowest, so its maximum is the winner and the
    partial maximum runs before the shuffle. ``lines`` counts the rows that competed.
    """
    order = ["modified_at_ts", "modified_at", *line_order]
    rest = [name for name in carry if name not in order]
    best = records.groupBy(*keys).agg(
        F.max(F.struct(*order, *rest)).alias("best"), F.count("*").alias("lines")
    )
    return best.select(*keys, "lines", *[F.col(f"best.{name}") for name in [*order, *rest]])


_RECORD = (
    "STRUCT<payload: STRING, modified_at: STRING, modified_at_ts: TIMESTAMP_NTZ, "
    "file_ord: INT, source_file: STRING, source_run_id: STRING, ingested_at: STRING, "
    "ingested_at_ts: TIMESTAMP_NTZ>"
)
_ACTIONS = "ARRAY<STRUCT<file_ord: INT, action: STRING, lines: LONG>>"
_RECORD_FIELDS = (
    "payload",
    "modified_at",
    "modified_at_ts",
    "file_ord",
    "source_file",
    "source_run_id",
    "ingested_at",
    "ingested_at_ts",
)


def _applies(state: Column, event: Column) -> Column:
    """Does the event change the record as it stands?"""
    old, new = state["record"], event["record"]
    not_older = (
        new["modified_at_ts"].isNull()
        | old["modified_at_ts"].isNull()
        | (new["modified_at_ts"] >= old["modified_at_ts"])
    )
    newer = F.coalesce(new["modified_at_ts"] > old["modified_at_ts"], F.lit(False))
    differs = ~new["payload"].eqNullSafe(old["payload"])
    return F.when(event["is_delete"], state["live"] & not_older).otherwise(
        ~state["live"] | newer | (not_older & differs)
    )


def fold(events: DataFrame, keys: Iterable[str] = ("endpoint", "record_id")) -> DataFrame:
    """Apply the events of each record in file order.

    ``events`` holds one row per record and file_ord with the fields of ``_RECORD_FIELDS``,
    is_delete and lines; the stored row comes in as file_ord -1. The result has one row per
    record: the fields it ends with, ``live``, ``actions`` with what each file did and, if one
    changed the record, ``previous``, its payload in the stored row. No trace of a deletion takes part in later comparisons: an older record in a later file
    creates the record again.
    """
    keys = list(keys)
    event = F.struct(
        F.col("file_ord").alias("order"),
        "is_delete",
        "lines",
        F.struct(*_RECORD_FIELDS).cast(_RECORD).alias("record"),
    )
    start = F.struct(
        F.lit(False).alias("live"),
        F.lit(None).cast(_RECORD).alias("record"),
        F.array().cast(_ACTIONS).alias("actions"),
        F.lit(None).cast("string").alias("previous"),
    )

    def step(state: Column, e: Column) -> Column:
        applies = _applies(state, e)
        action = F.when(~applies, NONE).when(e["is_delete"], DELETE).otherwise(UPSERT)
        done = F.struct(e["order"].alias("file_ord"), action.alias("action"), e["lines"])
        next_state = F.struct(
            F.when(applies, ~e["is_delete"]).otherwise(state["live"]).alias("live"),
            F.when(applies & ~e["is_delete"], e["record"])
            .otherwise(state["record"])
            .alias("record"),
            F.concat(state["actions"], F.array(done).cast(_ACTIONS)).alias("actions"),
            state["previous"].alias("previous"),
        )
        seeded = F.struct(
            F.lit(True).alias("live"),
            e["record"].alias("record"),
            state["actions"],
            e["record"]["payload"].alias("previous"),
        )
        return F.when(e["order"] == SEED, seeded).otherwise(next_state)

    ordered = F.array_sort(
        F.collect_list(event), lambda a, b: (a["order"] - b["order"]).cast("int")
    )
    folded = events.groupBy(*keys).agg(F.aggregate(ordered, start, step).alias("end"))
    changed = F.exists("end.actions", lambda a: a["action"] != NONE)
    previous = F.when(changed, F.col("end.previous")).alias("previous")
    return folded.select(*keys, "end.record.*", "end.live", "end.actions", previous)


def actions_of(folded: DataFrame) -> DataFrame:
    """One row per record and file of the batch that read it."""
    return folded.select("endpoint", "record_id", F.inline("actions"))


def changes_of(folded: DataFrame, *carry: str) -> DataFrame:
    """The changed keys, each action once; a folded record is one row, so nothing is shuffled."""
    done = F.array_distinct(F.transform("actions", lambda a: a["action"]))
    changes = F.explode(F.filter(done, lambda action: action != NONE))
    return folded.select("endpoint", "record_id", *carry, changes.alias("action"))


def file_counts(actions: DataFrame) -> DataFrame:
    """What each file read, upserted and deleted."""
    return actions.groupBy("file_ord").agg(
        F.sum("lines").alias("record_count"),
        F.count_if(F.col("action") == UPSERT).alias("upserted"),
        F.count_if(F.col("action") == DELETE).alias("deleted"),
    )


def current_state(records: DataFrame, line_order: Iterable[str]) -> DataFrame:
    """The state one source leaves behind: latest row per record, deleted ones dropped."""
    carry = [c for c in records.columns if c not in ("endpoint", "record_id")]
    latest = latest_per_key(records, ["endpoint", "record_id"], line_order, carry)
    return latest.where(~F.col("is_delete")).drop("lines", "is_delete")
