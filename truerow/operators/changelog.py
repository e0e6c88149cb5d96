"""Which tracked fields of which records changed between two runs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truerow.config.tracking import TrackedEndpoint, TrackingConfig
from truerow.functions.canonical import sorted_arrays
from truerow.functions.jsons import (
    BAD,
    bound,
    computed_once,
    payload_fields,
    variant_path,
)
from truerow.functions.times import utc_now
from truerow.operators.ingest import DELETE
from truerow.operators.snapshots import allocate_run_id, any_field_differs, keyed_diff
from truerow.session import delete_folder, staged
from truerow.sources.store import (
    CHANGELOG_EVENTS,
    CHANGELOG_INDEX,
    CHANGELOG_RUNS,
    MasterStore,
)

# -- C2, C3: the tracked part of a payload as canonical text ---------------------------------


def _tree(paths: Iterable[str]) -> dict:
    """Nested names of the tracked paths; a path covers everything below it."""
    tree: dict = {}
    for path in sorted(set(paths), key=lambda p: p.count(".")):
        node, covered = tree, False
        parts = path.split(".")
        for part in parts[:-1]:
            if part in node and node[part] is None:
                covered = True
                break
            node = node.setdefault(part, {})
        if not covered:
            node[parts[-1]] = None
    return tree


def _json_key(name: str) -> str:
    text = name.replace("\\", "\\\\").replace('"', '\\"')
    return f'"{text}":'


def _values(tree: Mapping, parent: Column, top: bool = True) -> list[Column]:
    """JSON text of every tracked value, in the order of the names, from the struct of top-level variants.

    SQL NULL means the path is missing; a JSON null is a value. The JSON writer sorts object
    keys and writes no blanks.
    """
    found = []
    for name in sorted(tree):
        value = parent[name] if top else F.try_variant_get(parent, variant_path(name), "variant")
        found += [F.to_json(value)] if tree[name] is None else _values(tree[name], value, False)
    return found


def _value_text(text: Column, endpoint: TrackedEndpoint) -> Column:
    """The text of one value, NULL when it is not to be tracked."""
    if endpoint.drop_empty:
        text = F.when(text.isin("null", '""', "[]", "{}"), None).otherwise(text)
    elif endpoint.include_missing:
        text = F.coalesce(text, F.lit("null"))
    return text


def _object_text(tree: Mapping, texts: Iterator[Column], top: bool = True) -> Column:
    parts = []
    for name in sorted(tree):
        text = next(texts) if tree[name] is None else _object_text(tree[name], texts, False)
        parts.append(F.concat(F.lit(_json_key(name)), text))
    whole = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return whole if top else F.nullif(whole, F.lit("{}"))


def index(
    records: DataFrame, endpoints: Mapping[str, TrackedEndpoint], keep: Iterable[str] = ()
) -> DataFrame:
    """(endpoint, record_id, payload_hash, tracked_payload_json) of tracked endpoints.

    Payloads are parsed once, for the tracked top-level fields only, and every tracked value is written
    as text once; text that is no JSON object is left out.
    """
    roots = {root for entry in endpoints.values() for root in entry.roots()}
    groups: dict[TrackedEndpoint, list[str]] = {}
    for name, entry in endpoints.items():
        same = TrackedEndpoint("", *[getattr(entry, f) for f in _SETTINGS])
        groups.setdefault(same, []).append(name)
    names = ["endpoint", "record_id", *keep]
    wanted = records.where(F.col("endpoint").isin(sorted(endpoints))).select(*names, "payload")
    parsed = computed_once(wanted, "parsed", payload_fields(F.col("payload"), roots, "VARIANT"))
    values, text = F.lit(None).cast("array<string>"), F.lit(None).cast("string")
    for entry, members in groups.items():
        tree = _tree(entry.fields)
        found = _values(tree, F.col("parsed"))
        given = [F.get(F.col("values"), n) for n in range(len(found))]
        chosen = F.col("endpoint").isin(members)
        if entry.sort_arrays:
            given = sorted_arrays([text if len(groups) == 1 else F.when(chosen, text) for text in given])
        tracked = _object_text(tree, iter([_value_text(text, entry) for text in given]))
        values = F.when(chosen, F.array(*found)).otherwise(values)
        text = F.when(chosen, tracked).otherwise(text)
    valued = computed_once(parsed.where(F.col("parsed")[BAD].isNull()).select(*names, "parsed"), "values", values)
    tracked = computed_once(valued.select(*names, "values"), "tracked_payload_json", text).drop("values")
    return tracked.withColumn("payload_hash", F.sha2("tracked_payload_json", 256))


_SETTINGS = ("fields", "include_missing", "drop_empty", "sort_arrays")


# -- C8, C9: the difference ------------------------------------------------------------------


def _top_level(text: Column) -> Column:
    """Top-level keys with their JSON text; a JSON null counts as missing."""
    entries = F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")
    texts = F.transform_values(entries, lambda _, v: F.to_json(v))
    shown = F.map_filter(texts, lambda _, t: t != "null")
    return F.coalesce(shown, F.create_map().cast("map<string,string>"))


def changed_fields(previous: Column, current: Column) -> Column:
    """Sorted names of the top-level fields whose values differ."""
    return _differing(_top_level(previous), _top_level(current))


def _differing(old: Column, new: Column) -> Column:
    names = F.array_union(F.map_keys(old), F.map_keys(new))
    return F.array_sort(
        F.filter(
            names,
            lambda n: ~F.try_element_at(old, n).eqNullSafe(F.try_element_at(new, n)),
        )
    )


def diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """One event per record that appeared, vanished or has another payload hash."""
    changes = keyed_diff(
        previous,
        current,
        ["endpoint", "record_id"],
        ["payload_hash", "tracked_payload_json"],
        any_field_differs(["payload_hash"]),
    )
    old, new = F.col("previous.tracked_payload_json"), F.col("current.tracked_payload_json")
    # Only rows that differ get here, so only their payloads are opened, and only where the names are read.
    fields = F.struct(_top_level(old).alias("old"), _top_level(new).alias("new"))
    return changes.select(
        "endpoint",
        "record_id",
        "change_type",
        F.col("previous.payload_hash").alias("previous_hash"),
        F.col("current.payload_hash").alias("current_hash"),
        bound(fields, lambda f: _differing(f["old"], f["new"])).alias("changed_fields"),
        old.alias("previous_payload_json"),
        new.alias("current_payload_json"),
    )


def scoped_previous(previous: DataFrame, current: DataFrame, deleted: DataFrame) -> DataFrame:
    """The stored rows a scoped run compares with: records it rebuilt or saw deleted."""
    keys = ["endpoint", "record_id"]
    scope = current.select(*keys).unionByName(deleted.select(*keys))
    return previous.join(scope, keys, "left_semi")


# -- C5, C6, C10, C15, C16: one run ----------------------------------------------------------


@dataclass(frozen=True)
class ChangelogRun:
    run_id: str
    endpoint_count: int
    record_count: int
    event_count: int
    full_refresh: bool
    scoped_record_count: int


def needs_full_refresh(stored: DataFrame, names: Iterable[str], digest: str) -> bool:
    """True when any selected endpoint has no rows yet or rows of other settings."""
    counts = stored.groupBy("endpoint").agg(
        F.count("*").alias("n"), F.count_if(F.col("config_sha256") == digest).alias("same")
    )
    current = {r["endpoint"] for r in counts.where("n = same").collect()}
    return not set(names) <= current


def _with_bucket(store: MasterStore, keys: DataFrame | None, names: Iterable[str]) -> DataFrame:
    """The distinct keys of tracked endpoints with their bucket; none given is an empty scope."""
    if keys is None:
        keys = store.spark.createDataFrame([], "endpoint STRING, record_id STRING")
    wanted = keys.select("endpoint", "record_id").where(F.col("endpoint").isin(list(names)))
    bucket = store.bucket(F.col("endpoint"), F.col("record_id"))
    return wanted.distinct().withColumn("bucket", bucket)


def record(
    store: MasterStore,
    config: TrackingConfig,
    endpoints: Iterable[str] | None = None,
    changed: DataFrame | None = None,
    deleted: DataFrame | None = None,
    full: bool = False,
    created_at: datetime | None = None,
) -> ChangelogRun:
    """Compare the current state with the index and store both outcome and index.

    ``changed`` and ``deleted`` are (endpoint, record_id) DataFrames. Given either, only these
    records are looked at, unless the index must be rebuilt.
    """
    now = created_at or utc_now()
    selected = config.only(config.endpoints if endpoints is None else endpoints)
    runs = store.read(CHANGELOG_RUNS.name)
    run_id = allocate_run_id(runs, f"{now:%Y-%m-%dT%H%M%SZ}-endpoint-changelog")
    if not selected:
        return ChangelogRun(run_id, 0, 0, 0, False, 0)

    keys = ["endpoint", "record_id"]
    stored = store.read(CHANGELOG_INDEX.name).where(F.col("endpoint").isin(list(selected)))
    scoped = changed is not None or deleted is not None
    full = full or not scoped or needs_full_refresh(stored, selected, config.digest)
    changed_keys = _with_bucket(store, changed, selected)
    stamp = {
        "config_sha256": F.lit(config.digest),
        "updated_at": F.lit(now).cast("timestamp_ntz"),
        "run_id": F.lit(run_id),
    }
    if full:
        wanted = store.bucketed_records()
        replaced = store.partitions_of(stored, "endpoint", "bucket")
    else:
        deleted_keys = _with_bucket(store, deleted, selected)
        replaced = store.partitions_of(changed_keys.unionByName(deleted_keys), "endpoint", "bucket")
        records = store.bucketed_records(replaced)
        wanted = records.join(changed_keys.select(*keys), keys, "left_semi")
    # The new rows are stored first, so that the payloads are parsed only once.
    current, path = staged(index(wanted, selected, ["bucket"]).withColumns(stamp), "index")
    if full:
        rows, compared, parts = current, stored, None
    else:
        near = store.read(CHANGELOG_INDEX.name, replaced)
        compared = scoped_previous(near, current, deleted_keys)
        rows = near.join(compared.select(*keys), keys, "left_anti").unionByName(current)
        parts = store.tasks_per_bucket
    # The index comes after the events, which need its old rows; the run row comes last.
    store.replace(
        CHANGELOG_EVENTS.name,
        diff(compared, current).withColumns(
            {"run_id": F.lit(run_id), "changed_at": F.lit(now).cast("timestamp_ntz")}
        ),
    )
    events = store.read(CHANGELOG_EVENTS.name, [(name, run_id) for name in selected])
    run = ChangelogRun(
        run_id,
        len(selected),
        current.count(),
        events.count(),
        full,
        0 if changed is None else changed_keys.count(),
    )
    store.replace(CHANGELOG_INDEX.name, rows, replaced, parts)
    delete_folder(store.spark, path)
    row = (
        run_id,
        now,
        config.source,
        config.digest,
        run.endpoint_count,
        run.record_count,
        run.event_count,
        full,
        run.scoped_record_count,
    )
    run_row = store.spark.createDataFrame([row], CHANGELOG_RUNS.schema)
    store.append(CHANGELOG_RUNS.name, run_row.coalesce(1))
    return run


def record_after_ingest(store: MasterStore, config: TrackingConfig | None, ingested):
    """The chained run; None when nothing changed or nothing changed is tracked."""
    if config is None or not ingested.changed_endpoints:
        return None
    names = set(ingested.changed_endpoints) & set(config.endpoints)
    if not names:
        return None
    changes = ingested.changes.where(F.col("endpoint").isin(sorted(names)))
    deleted = changes.where(F.col("action") == DELETE)
    return record(store, config, names, changed=changes, deleted=deleted)


# -- C11-C14: listings -----------------------------------------------------------------------


def _since(rows: DataFrame, column: str, since: datetime | None) -> DataFrame:
    return rows if since is None else rows.where(F.col(column) >= F.lit(since).cast("timestamp_ntz"))


def list_runs(runs: DataFrame, since: datetime | None = None, limit: int = 20) -> DataFrame:
    """C11: newest runs first."""
    return (
        _since(runs, "created_at", since)
        .drop("config_sha256")
        .fillna({"full_refresh": False, "scoped_record_count": 0})
        .orderBy(F.desc("created_at"))
        .limit(limit)
    )


def change_summary(
    events: DataFrame, since: datetime | None = None, limit: int = 100
) -> DataFrame:
    """Number of events by endpoint and type."""
    counts = _since(events, "changed_at", since).groupBy("endpoint", "change_type")
    return counts.agg(F.count("*").alias("count")).orderBy("endpoint", "change_type").limit(limit)


def list_changes(
    events: DataFrame,
    endpoint: str | None = None,
    since: datetime | None = None,
    limit: int = 50,
) -> DataFrame:
    """Newest events first; an endpoint filter prunes the scan."""
    rows = _since(events, "changed_at", since)
    if endpoint:
        rows = rows.where(F.col("endpoint") == endpoint)
    return (
        rows.select(
            "run_id",
            "endpoint",
            "record_id",
            "changed_at",
            "change_type",
            "changed_fields",
            "previous_payload_json",
            "current_payload_json",
        )
        .orderBy(F.desc("changed_at"), "endpoint", "record_id")
        .limit(limit)
    )


def with_parsed_payloads(changes: DataFrame) -> DataFrame:
    """The payload texts of a listing as VARIANT columns."""
    return changes.withColumns(
        {
            "previous_payload": F.try_parse_json("previous_payload_json"),
            "current_payload": F.try_parse_json("current_payload_json"),
        }
    ).drop("previous_payload_json", "current_payload_json")


def record_history(events: DataFrame, endpoint: str, record_id: str) -> DataFrame:
    """C14: all events of one record, newest first."""
    return (
        events.where((F.col("endpoint") == endpoint) & (F.col("record_id") == record_id))
        .select("changed_at", "change_type", "previous_payload_json", "current_payload_json")
        .orderBy(F.desc("changed_at"))
    )
