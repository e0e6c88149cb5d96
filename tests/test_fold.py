"""The one-shuffle fold against file-by-file application in plain Python."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from truerow.operators.ingest import actions_of, extract, fold

START = datetime(2026, 1, 1)


def _apply(state, event):
    """One event on the state of its record, which is None or (ts, payload)."""
    ts, payload, is_delete = event
    not_older = state is None or ts is None or state[0] is None or ts >= state[0]
    if is_delete:
        return (None, "delete") if state is not None and not_older else (state, "none")
    newer = state is not None and ts is not None and state[0] is not None and ts > state[0]
    if state is None or newer or (not_older and payload != state[1]):
        return (ts, payload), "upsert"
    return state, "none"


def test_fold_equals_sequential_application(spark):
    rng = random.Random(11)
    rows, expected, actions = [], {}, set()
    for key in range(400):
        seed = None
        record_id = f"K{key}"
        if rng.random() < 0.5:
            seed = (rng.choice([None, START]), "seed")
            rows.append(("e", record_id, -1, seed[0], "seed", False, 0))
        state = seed
        for file_ord in sorted(rng.sample(range(9), rng.randrange(0, 7))):
            ts = rng.choice([None, *(START + timedelta(days=d) for d in range(-2, 3))])
            event = (ts, rng.choice(["a", "b", "seed"]), rng.random() < 0.3)
            rows.append(("e", record_id, file_ord, *event, 1))
            state, action = _apply(state, event)
            actions.add((record_id, file_ord, action))
        if state is not None:
            expected[record_id] = state
    rng.shuffle(rows)
    df = spark.createDataFrame(
        rows,
        "endpoint STRING, record_id STRING, file_ord INT, modified_at_ts TIMESTAMP_NTZ, "
        "payload STRING, is_delete BOOLEAN, lines LONG",
    )
    empty = F.lit(None).cast("string")
    names = ("modified_at", "source_file", "source_run_id", "ingested_at")
    df = df.withColumns({**{n: empty for n in names}, "ingested_at_ts": F.lit(None).cast("timestamp_ntz")})
    folded = fold(df).cache()
    live = folded.where("live").collect()
    assert {r["record_id"]: (r["modified_at_ts"], r["payload"]) for r in live} == expected
    found = actions_of(folded).collect()
    assert {(r["record_id"], r["file_ord"], r["action"]) for r in found} == actions


def test_a_line_is_read_once(spark):
    """Nothing is shared inside a generator, so what it names twice would run twice for every line."""
    lines = spark.createDataFrame(
        [("e", p) for p in ('{"id": "a", "_modified_at": "2031-02-03"}', ' {"id": "b"} ', '["id"]', "7", '{"id": " "}')],
        "endpoint STRING, payload STRING",
    )
    records = extract(lines, {})
    assert records.columns == ["endpoint", "payload", "record_id", "modified_at", "modified_at_ts", "is_delete"]
    assert [(r.record_id, r.modified_at) for r in records.orderBy("record_id").collect()] == [("a", "2031-02-03"), ("b", None)]
    assert records._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
