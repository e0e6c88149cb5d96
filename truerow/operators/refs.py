"""Do the references between record types resolve?

Where many things are measured, the records are read once: references, ids and the records themselves
come out of one pass and are written. A single measure reads them in place. References are made distinct inside their own record without a shuffle; then one join
on (target, reference) and one aggregation follow.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truerow.config.naming import Naming
from truerow.config.relationships import (
    DEFAULT_RELATIONSHIPS,
    VALID_REF_PATTERN,
    Relationship,
)
from truerow.functions.numbers import percent
from truerow.session import scratch_dir

# Statuses, issue codes and the version of the coverage report.
SEEN = "seen"
NOT_SEEN = "not_seen"
INVALID = "invalid_ref"
MISSING_CODE = "REFERENCED_RECORD_NOT_SEEN"
INVALID_CODE = "INVALID_REFERENCE_VALUE"
EMPTY_CODE = "ENDPOINT_EMPTY"
COVERAGE_VERSION = "reconstruction-check-coverage-v1"


# Numbers are no references, so they are read in the way that refuses none of them.
_DECODER = json.JSONDecoder(parse_int=float)


def _parsed(payload: bytes | None) -> dict:
    """The JSON object a payload begins with; empty for anything else."""
    if payload is None:
        return {}
    try:
        text = payload.decode("utf-8", "replace").lstrip(" \t\r\n")
        value, _ = _DECODER.raw_decode(text)
        if "\\u" in text:  # half a surrogate pair is no character
            value = json.loads(json.dumps(value, ensure_ascii=False).encode("utf-8", "replace"))
    except (ValueError, RecursionError):
        return {}
    return value if isinstance(value, dict) else {}


def refs_below(values: list, empty_ref: str) -> list[str]:
    """The distinct references in JSON values, at any depth; those in an object by the order of its keys.

    Texts are stripped; empty ones and the bare prefix are no references, and neither are
    numbers, booleans and nulls.
    """
    found, waiting = {}, values[::-1]
    while waiting:
        value = waiting.pop()
        kind = type(value)
        if kind is str:
            found[value.strip()] = None
        elif kind is list:
            waiting += value[::-1]
        elif kind is dict:
            waiting += [value[key] for key in sorted(value, reverse=True)] if len(value) > 1 else value.values()
    found.pop("", None)
    found.pop(empty_ref, None)
    return list(found)


# What a row of the extract is: a reference, an id that references may name, or a record itself.
REF, ID, RECORD = "ref", "id", "record"
EXTRACT_SCHEMA = "kind STRING, name STRING, endpoint STRING, record_id STRING, refs ARRAY<STRING>"


def extract(
    records: DataFrame,
    relationships: Iterable[Relationship] = DEFAULT_RELATIONSHIPS,
    naming: Naming | None = None,
    kinds: Sequence[str] = (REF, ID, RECORD),
) -> DataFrame:
    """(kind, name, endpoint, record_id, refs): all that the relationships need, in one pass.

    A ``ref`` row has the distinct references of a record under the name of its relationship, an
    ``id`` row the ids of a record under the name of its target key, and every record has one
    ``record`` row without its id. ``records`` has the columns endpoint, record_id and payload; a payload is
    parsed once. No shuffle. Only the given ``kinds`` of rows are made.

    The rows go through Arrow to Python, whose JSON reader takes a fraction of the time of VARIANTs,
    their text and lambdas over it.
    """
    rules, empty_ref = list(relationships), (naming or Naming()).empty_ref
    wanted = [(REF, r.name, r.source, r.source_fields) for r in rules]
    wanted += [(ID, *key) for key in sorted({(r.target_key, r.target, r.target_fields) for r in rules})]
    always = RECORD in kinds
    owned: dict[str, list] = {}
    for kind, name, owner, fields in wanted:
        if kind in kinds:
            owned.setdefault(owner, []).append((kind, name, fields))

    def rows_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        endpoints, ids, payloads = batch.columns
        at, made, names, sizes, refs = [], [], [], [], []
        for n, (endpoint, payload) in enumerate(zip(endpoints.to_pylist(), payloads.to_pylist(), strict=True)):
            if always:
                at.append(n), made.append(RECORD), names.append(None), sizes.append(None)
            own = owned.get(endpoint)
            if not own:
                continue
            fields = _parsed(payload)
            for kind, name, wanted_fields in own:
                found = refs_below([fields.get(field) for field in wanted_fields], empty_ref)
                at.append(n), made.append(kind), names.append(name), sizes.append(len(found))
                refs.extend(found)
        nothing = pa.array([size is None for size in sizes], pa.bool_())
        starts = pa.array(list(accumulate((size or 0 for size in sizes), initial=0)), pa.int32())
        kinds_made, rows = pa.array(made, pa.string()), pa.array(at, pa.int64())
        record_ids = pc.if_else(pc.equal(kinds_made, RECORD), pa.scalar(None, ids.type), ids.take(rows))
        lists = pa.ListArray.from_arrays(starts, pa.array(refs, pa.string()), mask=nothing)
        return pa.RecordBatch.from_arrays(
            [kinds_made, pa.array(names, pa.string()), endpoints.take(rows), record_ids, lists],
            ["kind", "name", "endpoint", "record_id", "refs"],
        )

    payload = F.col("payload").cast("binary").alias("payload")
    return records.select("endpoint", "record_id", payload).mapInArrow(
        lambda batches: map(rows_of, batches), EXTRACT_SCHEMA
    )


@dataclass(frozen=True)
class References:
    """The extract of some records, written once, and everything that is measured on it.

    Each part reads only its own kind of rows and the columns it needs, never a payload.
    """

    rows: DataFrame
    relationships: tuple[Relationship, ...]

    @classmethod
    def of(
        cls,
        records: DataFrame,
        relationships: Iterable[Relationship] = DEFAULT_RELATIONSHIPS,
        naming: Naming | None = None,
        folder: str | None = None,
    ) -> References:
        rules = tuple(relationships)
        spark = records.sparkSession
        path = folder or scratch_dir(spark, "references")
        rows = extract(records, rules, naming)
        rows.write.parquet(path)
        return cls(spark.read.schema(rows.schema).parquet(path), rules)

    def _of_kind(self, kind: str) -> DataFrame:
        return self.rows.where(F.col("kind") == kind)

    def declared(self) -> DataFrame:
        """(relationship, target_key, source_endpoint, record_id, pos, ref)."""
        keys = F.create_map(*[F.lit(x) for r in self.relationships for x in (r.name, r.target_key)])
        # The outer form: the plain one would make the optimizer test the array's size below,
        # which means computing it a second time where nothing is written in between.
        rows = self._of_kind(REF).select(
            F.col("name").alias("relationship"),
            keys[F.col("name")].alias("target_key"),
            F.col("endpoint").alias("source_endpoint"),
            "record_id",
            F.posexplode_outer("refs").alias("pos", "ref"),
        )
        return rows.where(F.col("ref").isNotNull())

    def ids(self) -> DataFrame:
        """(target_key, endpoint, record_id, ref): under which ids a record may be referred to."""
        rows = self._of_kind(ID).select(
            F.col("name").alias("target_key"), "endpoint", "record_id", F.explode_outer("refs").alias("ref")
        )
        return rows.where(F.col("ref").isNotNull())

    def targets(self) -> DataFrame:
        """The distinct (target_key, ref) a reference may resolve to."""
        return self.ids().select("target_key", "ref").distinct()

    def counts(self, expected: Iterable[str] = ()) -> DataFrame:
        """R8."""
        return endpoint_counts(self._of_kind(RECORD), expected)

    def statuses(self, pattern: str = VALID_REF_PATTERN) -> DataFrame:
        """Every reference with its status."""
        return with_status(self.declared(), self.targets(), pattern)

    def coverage(self, pattern: str = VALID_REF_PATTERN) -> DataFrame:
        """R5."""
        return relationship_coverage(self.statuses(pattern), self.counts(), self.relationships)

    def issues(self, expected: Iterable[str] = (), pattern: str = VALID_REF_PATTERN) -> DataFrame:
        """R7."""
        return coverage_issues(self.coverage(pattern), self.counts(expected))

    def summary(self, style_endpoint: str = "styles", pattern: str = VALID_REF_PATTERN) -> DataFrame:
        """R9."""
        return coverage_summary(self.coverage(pattern), self.counts(), style_endpoint)


@dataclass(frozen=True)
class UnwrittenReferences(References):
    """The same measured straight on the records, where each kind of rows is needed only once.

    ``rows`` are the records. Each kind reads the records of the endpoints that hold it and parses only
    its own fields; the record counts parse nothing. What is read twice is cheaper than what would be written.
    """

    naming: Naming | None = None

    def _of_kind(self, kind: str) -> DataFrame:
        if kind == RECORD:
            return self.rows
        owners = {r.source if kind == REF else r.target for r in self.relationships}
        own = self.rows.where(F.col("endpoint").isin(sorted(owners)))
        return extract(own, self.relationships, self.naming, [kind])


def declared_refs(
    records: DataFrame,
    relationships: Iterable[Relationship] = DEFAULT_RELATIONSHIPS,
    naming: Naming | None = None,
) -> DataFrame:
    """The references of ``References.declared`` in one plan with whatever reads them."""
    rules = tuple(relationships)
    return UnwrittenReferences(records, rules, naming).declared()


def target_ids(
    records: DataFrame,
    relationships: Iterable[Relationship] = DEFAULT_RELATIONSHIPS,
    naming: Naming | None = None,
) -> DataFrame:
    """The target ids of ``References.targets`` in one plan with whatever reads them."""
    rules = tuple(relationships)
    return UnwrittenReferences(records, rules, naming).targets()


def is_valid_ref(ref: Column, pattern: str = VALID_REF_PATTERN) -> Column:
    """R3."""
    return ref.rlike(pattern)


def with_status(
    refs: DataFrame, targets: DataFrame, pattern: str = VALID_REF_PATTERN
) -> DataFrame:
    """Adds ``status``. A malformed reference is invalid even where the target has it.

    Targets are distinct, so the join never multiplies rows. A reference that a third of all
    records carry makes one large partition of the left side only; adaptive execution splits
    it, since nothing downstream depends on the join's partitioning.
    """
    known = targets.withColumn("known", F.lit(True))
    joined = refs.join(known, ["target_key", "ref"], "left")
    status = (
        F.when(~is_valid_ref(F.col("ref"), pattern), INVALID)
        .when(F.col("known"), SEEN)
        .otherwise(NOT_SEEN)
    )
    return joined.withColumn("status", status).drop("known")


def endpoint_counts(records: DataFrame, expected: Iterable[str] = ()) -> DataFrame:
    """Records per endpoint. ``expected`` endpoints without records are listed with 0."""
    counts = records.groupBy("endpoint").agg(F.count("*").alias("records"))
    names = sorted(set(expected))
    if names:
        wanted = records.sparkSession.createDataFrame([(n,) for n in names], "endpoint STRING")
        counts = counts.join(wanted, "endpoint", "full_outer").fillna(0, ["records"])
    return counts.orderBy("endpoint")


def relationship_coverage(
    statuses: DataFrame,
    counts: DataFrame,
    relationships: Iterable[Relationship] = DEFAULT_RELATIONSHIPS,
) -> DataFrame:
    """One row per relationship, those without any reference included.

    Counting happens on the map side. For the number of records with a problem only the
    records that have one are shuffled: all others share the NULL key.
    """
    status, bad = F.col("status"), F.col("status") != SEEN
    measured = statuses.groupBy("relationship").agg(
        F.count("*").alias("declared_refs"),
        F.count_if(status == SEEN).alias("seen_refs"),
        F.count_if(status == NOT_SEEN).alias("missing_refs"),
        F.count_if(status == INVALID).alias("invalid_refs"),
        F.count_if(F.col("pos") == 0).alias("source_records_with_refs"),
        F.count_distinct(F.when(bad, F.col("record_id"))).alias(
            "source_records_with_missing_refs"
        ),
    )
    rules = statuses.sparkSession.createDataFrame(
        [(r.name, r.source, r.target) for r in relationships],
        "relationship STRING, source_endpoint STRING, target_endpoint STRING",
    )
    sources = counts.select(
        F.col("endpoint").alias("source_endpoint"), F.col("records").alias("source_records")
    )
    numbers = [
        "source_records",
        "source_records_with_refs",
        "source_records_with_missing_refs",
        "declared_refs",
        "seen_refs",
        "missing_refs",
        "invalid_refs",
    ]
    rows = rules.join(measured, "relationship", "left").join(sources, "source_endpoint", "left")
    return (
        rows.fillna(0, numbers)
        .select("relationship", "source_endpoint", "target_endpoint", *numbers)
        .withColumn(
            "coverage_percent", percent(F.col("seen_refs"), F.col("declared_refs"), 100.0)
        )
    )


def coverage(
    records: DataFrame,
    relationships: Iterable[Relationship] = DEFAULT_RELATIONSHIPS,
    naming: Naming | None = None,
    pattern: str = VALID_REF_PATTERN,
) -> DataFrame:
    """R1-R5 from the current records; see ``UnwrittenReferences``."""
    return UnwrittenReferences(records, tuple(relationships), naming).coverage(pattern)


def unresolved_counts(coverage_rows: DataFrame) -> DataFrame:
    """(relationship, target_endpoint, status, count) of what did not resolve."""
    long = coverage_rows.select(
        "relationship",
        "target_endpoint",
        F.col("invalid_refs").alias(INVALID),
        F.col("missing_refs").alias(NOT_SEEN),
    ).unpivot(["relationship", "target_endpoint"], [INVALID, NOT_SEEN], "status", "count")
    return long.where("count > 0")


def coverage_issues(coverage_rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(code, severity, bucket, count), sorted."""

    def entry(code: str, severity: str, bucket: str, count: Column) -> Column:
        return F.struct(
            F.lit(code).alias("code"),
            F.lit(severity).alias("severity"),
            F.col(bucket).alias("bucket"),
            count.cast("long").alias("count"),
        )

    of_rules = F.array(
        entry(MISSING_CODE, "error", "relationship", F.col("missing_refs")),
        entry(INVALID_CODE, "error", "relationship", F.col("invalid_refs")),
    )
    empty = counts.where("records = 0").select(F.inline(F.array(entry(EMPTY_CODE, "warning", "endpoint", F.lit(1)))))
    parts = coverage_rows.select(F.inline(of_rules)).where("count > 0").unionByName(empty)
    return parts.orderBy("code", "severity", "bucket")


def coverage_summary(
    coverage_rows: DataFrame, counts: DataFrame, style_endpoint: str = "styles"
) -> DataFrame:
    """One row with the totals over all relationships."""
    totals = coverage_rows.agg(
        F.count("*").alias("relationships_checked"),
        *[
            F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in ("declared_refs", "seen_refs", "missing_refs", "invalid_refs")
        ],
    )
    stored = counts.agg(
        F.coalesce(
            F.sum(F.when(F.col("endpoint") == style_endpoint, F.col("records"))), F.lit(0)
        ).alias("styles"),
        F.count("*").alias("endpoints"),
    )
    # Two single rows side by side.
    return stored.withColumn("one", F.lit(1)).join(
        totals.withColumn("one", F.lit(1)), "one"
    ).drop("one").withColumn(
        "coverage_percent", percent(F.col("seen_refs"), F.col("declared_refs"), 100.0)
    )
