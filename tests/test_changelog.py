import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from truerow.config import TrackedEndpoint, TrackingConfig
from truerow.operators import changelog
from truerow.sources.store import CHANGELOG_EVENTS, CHANGELOG_INDEX, RECORDS, MasterStore

TRACKED = {"factories": ("code", "lines"), "seasons": ("name", "year")}
CONFIG = TrackingConfig.load({"defaults": {"sort_arrays": True}, "endpoints": {e: list(f) for e, f in TRACKED.items()}})


def _record(rng, endpoint):
    """A random record; `note` is not tracked and the order of `lines` does not count."""
    if endpoint == "factories":
        row = {"code": rng.choice("abc"), "lines": rng.sample([1, 2, 3], rng.randrange(1, 4))}
    else:
        row = {"name": rng.choice(["spring", "autumn"]), "year": rng.choice([2030, 2031])}
    return {**row, "note": rng.random()}


def _put(store, records):
    """Make these the whole state."""
    data = [(e, i, json.dumps(p), True) for (e, i), p in records.items()]
    rows = store.spark.createDataFrame(data, "endpoint STRING, record_id STRING, payload STRING, live BOOLEAN")
    rows = rows.withColumn("bucket", store.bucket(F.col("endpoint"), F.col("record_id")))
    old = store.partitions_of(store.read(RECORDS.name), "endpoint", "bucket")
    store.replace(RECORDS.name, rows, old)


def _keys(spark, keys):
    return spark.createDataFrame(sorted(keys), "endpoint STRING, record_id STRING")


def _text(value):
    value = {k: sorted(v) if isinstance(v, list) else v for k, v in value.items() if k != "note"}
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def _diff(known, records, keys):
    """Plain Python: the events of these keys, and the index after them."""
    events, after = set(), dict(known)
    for key in keys:
        old, new = known.get(key), records.get(key) and _text(records[key])
        if new is None:
            after.pop(key, None)
        else:
            after[key] = new
        if old != new:
            kind = "added" if old is None else "removed" if new is None else "changed"
            a, b = json.loads(old or "{}"), json.loads(new or "{}")
            fields = tuple(sorted(f for f in {*a, *b} if a.get(f) != b.get(f)))
            events.add((*key, kind, fields, old, new))
    return events, after


def _events(store, run):
    rows = store.read(CHANGELOG_EVENTS.name).where(F.col("run_id") == run.run_id).collect()
    names = ("endpoint", "record_id", "change_type")
    assert all((r["previous_hash"] != r["current_hash"]) for r in rows)
    return {
        (*(r[n] for n in names), tuple(r["changed_fields"]), r["previous_payload_json"], r["current_payload_json"])
        for r in rows
    }


def _index(store):
    return {(r["endpoint"], r["record_id"]): r["tracked_payload_json"] for r in store.read(CHANGELOG_INDEX.name).collect()}


def test_generated_runs_equal_a_model(spark, tmp_path):
    """A full run, three scoped ones over other parts of the records each, a full one, and new settings."""
    rng = random.Random(11)
    store = MasterStore(spark, str(tmp_path / "s"), buckets=3)
    every = [(e, f"{e[0]}{n}") for e in TRACKED for n in range(12)]
    known, counts = {}, Counter()
    for step, share in enumerate((1, 0.5, 0.3, 0.6, 1)):
        records = {key: _record(rng, key[0]) for key in every if rng.random() < 0.8}
        _put(store, records)
        if share == 1:
            scope = set(every)
            run = changelog.record(store, CONFIG, full=step > 0)
        else:
            scope = {key for key in every if rng.random() < share}
            alive = {key for key in scope if key in records}
            run = changelog.record(store, CONFIG, changed=_keys(spark, alive), deleted=_keys(spark, scope - alive))
            assert run.scoped_record_count == run.record_count == len(alive)
        events, known = _diff(known, records, scope)
        assert run.full_refresh == (share == 1) and run.event_count == len(events)
        assert events and _events(store, run) == events and _index(store) == known
        counts += Counter((e[0], e[2]) for e in events)
    summary = changelog.change_summary(store.read(CHANGELOG_EVENTS.name)).collect()
    assert {(r["endpoint"], r["change_type"]): r["count"] for r in summary} == counts
    # Other settings make a scoped run a full one of its endpoints.
    other = TrackingConfig({**CONFIG.endpoints, "seasons": TrackedEndpoint("seasons", ("year",))})
    again = changelog.record(store, other, ["seasons"], changed=_keys(spark, [("seasons", "s0")]))
    seasons = {key: text for key, text in known.items() if key[0] == "seasons"}
    assert again.full_refresh and again.record_count == again.event_count == len(seasons)
    assert {e[3] for e in _events(store, again)} == {("name",)}
    nothing = changelog.record(store, other, ["seasons"], deleted=_keys(spark, [("seasons", "none")]))
    assert not nothing.full_refresh and nothing.event_count == 0


def _tracked(spark, payload, **settings):
    entry = TrackedEndpoint("e", **settings)
    df = spark.createDataFrame([("e", "1", payload)], "endpoint STRING, record_id STRING, payload STRING")
    row = changelog.index(df, {"e": entry}).first()
    return row and row["tracked_payload_json"]


@pytest.mark.parametrize(
    "payload, settings, expected",
    [
        ('{"b": 1, "a": null}', {"fields": ("b", "a", "c")}, '{"a":null,"b":1}'),
        ('{"b": 1}', {"fields": ("b", "c"), "include_missing": True}, '{"b":1,"c":null}'),
        (
            '{"b": "", "a": null, "c": [], "d": {}, "e": 0, "f": " "}',
            {"fields": tuple("abcdef"), "drop_empty": True},
            '{"e":0,"f":" "}',
        ),
        (
            '{"o": {"x": {"y": 1}, "z": [2, 1], "w": 5}, "p": 3}',
            {"fields": ("o.x.y", "o.z", "p.q")},
            '{"o":{"x":{"y":1},"z":[2,1]}}',
        ),
        ('{"o": {"x": 1}}', {"fields": ("o", "o.x")}, '{"o":{"x":1}}'),
        ('{"z": ["b", "a"]}', {"fields": ("z",), "sort_arrays": True}, '{"z":["a","b"]}'),
        (
            '{"z": [[2, 1], {"k": ["y", "x"]}], "w": "[b,a]"}',
            {"fields": ("z", "w"), "sort_arrays": True},
            '{"w":"[b,a]","z":[[1,2],{"k":["x","y"]}]}',
        ),
        ("{broken", {"fields": ("a",)}, None),
    ],
)
def test_tracked_payload(spark, payload, settings, expected):
    assert _tracked(spark, payload, **settings) == expected


def test_missing_and_null_count_as_equal_field(spark):
    df = spark.createDataFrame([('{"a":null,"b":1}', '{"b":2}')], "p STRING, c STRING")
    row = df.select(changelog.changed_fields(F.col("p"), F.col("c")).alias("f")).first()
    assert row["f"] == ["b"]


def test_tracking_config_is_checked():
    for bad in ({}, {"endpoints": {"a": []}}, {"endpoints": {"a": {"fields": [""]}}}):
        with pytest.raises(ValueError):
            TrackingConfig.load(bad)
    with pytest.raises(ValueError):
        TrackingConfig.load({"defaults": {"drop_empty": "no"}, "endpoints": {"a": ["b"]}})


@pytest.mark.parametrize(
    "values, expected",
    [
        (["b\\", 'a"]', "[x", "{", "é", "b"], r'["[x","a\"]","b","b\\","{","é"]'),
        ([10, 9, True, None, 1.5, "c,d", ""], '["","c,d",1.5,10,9,null,true]'),
        ([], "[]"),
        ({"t": "a[0]", "s": 1}, '{"s":1,"t":"a[0]"}'),
    ],
)
def test_arrays_are_sorted_by_the_text_of_their_items(spark, values, expected):
    payload = json.dumps({"v": values}, ensure_ascii=False)
    assert _tracked(spark, payload, fields=("v",), sort_arrays=True) == f'{{"v":{expected}}}'


def _plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString().lower()


def test_values_are_written_and_sent_to_python_once(spark):
    df = spark.createDataFrame([("e", "1", "{}")], "endpoint STRING, record_id STRING, payload STRING")
    entry = TrackedEndpoint("e", fields=("a", "b.c", "b.d"), sort_arrays=True)
    plan = _plan(changelog.index(df, {"e": entry}))
    assert plan.count("structstojsonevaluator(") == 3 and "schemaofvariant" not in plan
    assert plan.count("arrowevalpython") == 1


def test_payloads_are_opened_only_for_the_changed_fields(spark):
    schema = "endpoint STRING, record_id STRING, payload_hash STRING, tracked_payload_json STRING"
    rows = spark.createDataFrame([("e", "1", "h", "{}")], schema)
    changes = changelog.diff(rows, rows)
    assert "parsejson" not in _plan(changes.groupBy("endpoint", "change_type").count())
    assert "parsejson" in _plan(changes)
