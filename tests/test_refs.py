import json
import random

from truerow.config import Naming, Relationship
from truerow.operators import affected, products, refs
from truerow.operators.refs import NOT_SEEN

RULES = (
    Relationship("a_b", "a", ("b1", "b2"), "b", ("id", "code")),
    Relationship("b_c", "b", ("c",), "c"),
    Relationship("a_c", "a", ("c",), "c"),
)


def _records(spark, rows):
    data = [(e, p["id"], json.dumps(p)) for e, p in rows]
    return spark.createDataFrame(data, "endpoint STRING, record_id STRING, payload STRING")


def _leaves(value):
    if isinstance(value, str):
        text = value.strip()
        return [text] if text and text != "plm:" else []
    items = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return [leaf for item in items for leaf in _leaves(item)]


def _expected(rows):
    """Brute force over plain Python records."""
    result = {}
    for rule in RULES:
        ids = {x for e, p in rows if e == rule.target for f in rule.target_fields for x in _leaves(p.get(f))}
        numbers = dict.fromkeys(("records", "with", "bad", "declared", "seen", "missing", "invalid"), 0)
        for endpoint, payload in rows:
            if endpoint != rule.source:
                continue
            numbers["records"] += 1
            found = {x for f in rule.source_fields for x in _leaves(payload.get(f))}
            valid = {x for x in found if x[0] == "C" and x[1:2].isdigit()}
            seen = valid & ids
            numbers["with"] += bool(found)
            numbers["bad"] += seen != found
            numbers["declared"] += len(found)
            numbers["seen"] += len(seen)
            numbers["missing"] += len(valid - ids)
            numbers["invalid"] += len(found - valid)
        result[rule.name] = tuple(numbers.values())
    return result


def _random_value(rng, depth=0):
    kind = rng.choice(["ref"] * 4 + ["bad", "blank", "number", "null", "list", "dict"])
    if depth > 5 or kind == "ref":
        return f"C{rng.randrange(12)}"
    if kind in ("list", "dict"):
        items = [_random_value(rng, depth + 1) for _ in range(rng.randrange(4))]
        return items if kind == "list" else {str(n): item for n, item in enumerate(items)}
    return {"bad": "X1", "blank": rng.choice(["", " \t", "plm:"]), "number": 5, "null": None}[kind]


def test_coverage_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [("c", {"id": f" C{n}"}) for n in range(6)]
    rows += [("b", {"id": f"C{n}", "code": [f"C{n + 5}"], "c": _random_value(rng)}) for n in range(6)]
    rows += [
        ("a", {"id": f"A{n}", "b1": _random_value(rng), "b2": _random_value(rng), "c": _random_value(rng)})
        for n in range(60)
    ]
    rows.append(("a", {"id": "deep", "b1": json.loads("[" * 40 + '"C1"' + "]" * 40)}))
    df = _records(spark, rows)
    coverage = refs.coverage(df, RULES).collect()
    names = (
        "source_records",
        "source_records_with_refs",
        "source_records_with_missing_refs",
        "declared_refs",
        "seen_refs",
        "missing_refs",
        "invalid_refs",
    )
    assert {r["relationship"]: tuple(r[n] for n in names) for r in coverage} == _expected(rows)
    for row in coverage:
        expected = round(row["seen_refs"] / row["declared_refs"] * 100, 2)
        assert abs(row["coverage_percent"] - expected) < 1e-9


def test_reports_of_coverage(spark):
    rows = [
        ("styles", {"id": "S1", "active_colorways": {"0": "C1"}, "product_sizes": {"0": "C2"}}),
        ("sizes", {"id": "C2"}),
    ]
    df = _records(spark, rows)
    found = refs.coverage(df).cache()
    by_name = {r["relationship"]: r for r in found.collect()}
    assert len(by_name) == 10
    assert by_name["style_sizes"]["coverage_percent"] == 100.0
    assert by_name["factory_suppliers"]["coverage_percent"] == 100.0
    counts = refs.endpoint_counts(df, ["colorways", "sizes", "styles"])
    issues = [tuple(r) for r in refs.coverage_issues(found, counts).collect()]
    assert issues == [
        ("ENDPOINT_EMPTY", "warning", "colorways", 1),
        ("REFERENCED_RECORD_NOT_SEEN", "error", "style_colorways", 1),
    ]
    unresolved = refs.unresolved_counts(found).collect()
    assert [tuple(r) for r in unresolved] == [("style_colorways", "colorways", NOT_SEEN, 1)]
    summary = refs.coverage_summary(found, refs.endpoint_counts(df)).first()
    assert (summary["styles"], summary["endpoints"], summary["relationships_checked"]) == (1, 2, 10)
    assert (summary["declared_refs"], summary["coverage_percent"]) == (2, 50.0)


def test_affected_records_walk_up_to_products(spark):
    rows = [
        ("a", {"id": "A1", "b1": "C1"}),
        ("a", {"id": "A2", "b2": ["K2"]}),
        ("a", {"id": "A3", "c": "C9"}),
        ("a", {"id": "A4"}),
        ("b", {"id": "C1", "c": {"x": "C7"}}),
        ("b", {"id": "C2", "code": "K2", "c": "C8"}),
        ("c", {"id": "C7"}),
    ]
    current = _records(spark, rows)
    previous = _records(spark, [("c", {"id": "C9"}), ("b", {"id": "C3", "code": "C1"})])

    def affected_by(*keys):
        changed = spark.createDataFrame(list(keys), "endpoint STRING, record_id STRING")
        found = affected.affected_records(changed, [current, previous], "a", RULES)
        return sorted(r["record_id"] for r in found.collect())

    assert affected_by(("c", "C7")) == ["A1"]
    assert affected_by(("c", "C8"), ("a", "A4")) == ["A2", "A4"]
    assert affected_by(("c", "C9")) == ["A3"]
    assert affected_by(("b", "C3")) == ["A1"]
    assert affected_by(("c", "C0")) == []


def test_products_and_check_projection(spark, tmp_path):
    from truerow.sources.store import PRODUCTS, SOURCE_REFS, MasterStore

    rows = [("styles", {"id": "S1", "brand_code": " BR ", "product_type": 7}), ("styles", {"id": " "})]
    master = products.master_products(_records(spark, rows))
    store = MasterStore(spark, str(tmp_path / "s"))
    summary = products.write_master(store, master)
    assert summary == {"products_reconstructed": 1, "source_refs": 1, "warnings": 0}
    row = store.read(PRODUCTS.name).first()
    assert (row["product_id"], row["brand_code"], row["product_type_code"]) == ("S1", "BR", "7")
    graph = json.loads(row["graph_json"])
    assert graph == {
        "style_id": "S1",
        "relationship_ids": {},
        "relationships": {},
        "applicability": {},
        "unresolved_refs": [],
        "placeholder": True,
    }
    assert store.read(SOURCE_REFS.name).first()["relation_type"] == "style"

    given = {
        "relationships": {"material_ids": ["M1", "M2"], "size": "x", "no": "", "x_applicability": 1},
        "unresolved_refs": [{"status": "not_seen"}, "odd"],
        "materials": [1],
    }
    data = [("", "S9", json.dumps(given), [("m", "M1", "material"), ("m", "M1", "material"), ("z", "Z", "zip"), ("s", "S9", "style"), ("n", "N", None)], [(None, " ", "", None, None)])]
    schema = f"product_id STRING, style_id STRING, graph STRING, source_refs {products.REFS_TYPE}, warnings {products.WARNINGS_TYPE}"
    coerced = products.coerce_products(spark.createDataFrame(data, schema))
    check = products.check_projection(coerced).first()
    assert check["style_id"] == "S9"
    assert check["counts"]["relationship_ids"] == {"material_ids": 2, "size": 1, "no": 0}
    assert check["counts"]["resolved_records"] == {"materials": 1, "zip": 1}
    assert check["counts"]["unresolved_refs"] == 1 and set(check["applicability"]) == {"x_applicability"}
    assert check["warnings"][0]["code"] == "RECONSTRUCTION_WARNING"
    compact = coerced.select(products.compact_graph(coerced["graph"]).alias("g")).first()["g"]
    assert set(compact) == {"relationships", "unresolved_refs"}


def test_naming_sets_the_bare_prefix(spark):
    df = _records(spark, [("a", {"id": "A", "c": ["erp:", "plm:"]})])
    found = refs.declared_refs(df, RULES, Naming(system="erp")).collect()
    assert [r["ref"] for r in found] == ["plm:"]


def test_coverage_writes_no_extract(spark, monkeypatch):
    """A single measure reads the records in place."""
    from truerow.operators import refs

    def written(*_):
        raise AssertionError("nothing is to be written")

    monkeypatch.setattr(refs, "scratch_dir", written)
    rule = refs.Relationship("r", "a", ("x",), "b")
    rows = [("a", "1", '{"x": [" C1 ", {"k": "C2"}, "plm:", "q"]}'), ("b", "C1", '{"id": "C1"}')]
    records = spark.createDataFrame(rows, "endpoint STRING, record_id STRING, payload STRING")
    found = refs.coverage(records, [rule]).first()
    assert (found["declared_refs"], found["seen_refs"], found["missing_refs"], found["invalid_refs"]) == (3, 1, 1, 1)


def test_extraction_makes_no_text_of_values(spark):
    """Payloads are read by one JSON reader; VARIANTs written as text again took most of the time."""
    records = _records(spark, [("a", {"id": "A1", "b1": "C1"})])
    plan = refs.declared_refs(records, RULES)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "mapinarrow" in plan and "variant" not in plan and "json" not in plan


def test_extraction_of_odd_payloads(spark):
    payloads = {
        "escaped": r'{"c": ["C1", "a\"b", "😀", "é", "C1"]}',
        "half": r'{"c": ["x\ud800", "x?"]}',
        "depth": '{"c": ' + "[" * 1001 + '"C2"' + "]" * 1001 + "}",
        "keys": '{"c": {"z": "C3", "C9": ["C4", {"b": "C6", "a": "C5"}], "a": " C7\\u3000"}}',
        "numbers": '{"c": [1' + "0" * 5000 + ', 1e400, -0, true, null, "C8"]}',
        "again": '{"c": "C1", "c": "C2"}',
        "looks": '{"c": "[\\"C1\\"]"}',
        "more": ' {"c": "C1"} {"c": "C2"}',
        "broken": '{"c": "C1"',
        "list": '[{"c": "C1"}]',
        "empty": "",
        "none": None,
    }
    rows = [("b", name, text) for name, text in payloads.items()]
    records = spark.createDataFrame(rows, "endpoint STRING, record_id STRING, payload STRING")
    found = {}
    for row in refs.declared_refs(records, RULES).orderBy("record_id", "pos").collect():
        found.setdefault(row["record_id"], []).append(row["ref"])
    assert found == {
        "escaped": ["C1", 'a"b', "\U0001f600", "é"],
        "half": ["x?"],
        "depth": ["C2"],
        "keys": ["C4", "C5", "C6", "C7", "C3"],
        "numbers": ["C8"],
        "again": ["C2"],
        "looks": ['["C1"]'],
        "more": ["C1"],
    }
    kinds = {r["kind"]: r["count"] for r in refs.extract(records, RULES).groupBy("kind").count().collect()}
    assert kinds == {"ref": 12, "id": 12, "record": 12}


def test_references_are_stripped_of_all_white_space():
    from truerow.functions.text import WHITE_SPACE

    assert set(WHITE_SPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}
