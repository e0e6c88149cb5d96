"""M9: which products do changed records belong to?

The relationships form a graph without cycles. Its edges, (target key, id) to the referring record, and
the ids of every record are extracted once from the records and written; the walk from a changed
record up to the products then needs one join per referring endpoint on these narrow tables. What
is reached at an endpoint is written before the next one reads it, so plans do not grow with the
number of steps. A deleted record is reached through the references of the previous state, so
both states take part.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truerow.config.naming import Naming
from truerow.config.relationships import DEFAULT_RELATIONSHIPS, Relationship
from truerow.operators.refs import References
from truerow.session import scratch_dir


def walk_order(relationships: Iterable[Relationship]) -> list[str]:
    """Endpoints with those that are referred to before those that refer to them."""
    graph: dict[str, set[str]] = {}
    for rule in relationships:
        graph.setdefault(rule.source, set()).add(rule.target)
    return list(TopologicalSorter(graph).static_order())


def affected_records(
    changed: DataFrame,
    states: Sequence[DataFrame],
    product_endpoint: str = "styles",
    relationships: Iterable[Relationship] = DEFAULT_RELATIONSHIPS,
    naming: Naming | None = None,
) -> DataFrame:
    """record_id of every ``product_endpoint`` record that reaches a changed record.

    ``changed`` is (endpoint, record_id); ``states`` are the current and, if records were
    deleted, the previous records. A reference may name any of the target's key fields.
    """
    rules = list(relationships)
    records = states[0].select("endpoint", "record_id", "payload")
    for state in states[1:]:
        records = records.unionByName(state.select("endpoint", "record_id", "payload"))
    return walk(changed, References.of(records, rules, naming), product_endpoint)


def walk(changed: DataFrame, edges: References, product_endpoint: str = "styles") -> DataFrame:
    """The walk on edges that are written already; they may serve many sets of changes."""
    order = walk_order(edges.relationships)
    reached = {
        name: changed.where(F.col("endpoint") == name).select("record_id").distinct()
        for name in {*order, product_endpoint}
    }
    for source in order:
        outgoing = [rule for rule in edges.relationships if rule.source == source]
        if not outgoing:
            continue
        keys = reduce(DataFrame.unionByName, [_keys_of(edges, reached[r.target], r) for r in _by_target(outgoing)])
        refs = edges.declared().where(F.col("relationship").isin([r.name for r in outgoing]))
        hits = refs.select("target_key", "ref", "record_id").join(keys.distinct(), ["target_key", "ref"], "left_semi")
        reached[source] = _written(reached[source].unionByName(hits.select("record_id")).distinct())
    return reached[product_endpoint]


def _by_target(rules: list[Relationship]) -> list[Relationship]:
    """One rule per target key; they share its ids."""
    return list({rule.target_key: rule for rule in rules}.values())


def _keys_of(edges: References, ids: DataFrame, rule: Relationship) -> DataFrame:
    """The (target_key, ref) under which the given records of the rule's target can be referred to."""
    own = ids.select(F.lit(rule.target_key).alias("target_key"), F.col("record_id").alias("ref"))
    if rule.target_fields == ("id",):
        return own
    named = edges.ids().where(F.col("target_key") == rule.target_key)
    return own.unionByName(named.join(ids, "record_id", "left_semi").select("target_key", "ref"))


def _written(ids: DataFrame) -> DataFrame:
    path = scratch_dir(ids.sparkSession, "reached")
    ids.write.parquet(path)
    return ids.sparkSession.read.schema(ids.schema).parquet(path)
