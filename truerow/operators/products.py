"""M1-M8: master products and their compact relationship state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truerow.functions.jsons import BAD, as_array, as_map, bound, computed_once, is_json_null, payload_fields
from truerow.functions.text import filled
from truerow.functions.times import utc_now
from truerow.session import delete_folder, staged
from truerow.sources.store import PRODUCT_WARNINGS, PRODUCTS, SOURCE_REFS, MasterStore

REFS_TYPE = "array<struct<endpoint:string,record_id:string,relation_type:string>>"
WARNINGS_TYPE = (
    "array<struct<code:string,message:string,severity:string,"
    "source_endpoint:string,source_record_id:string>>"
)
GRAPH_TYPE = "map<string,variant>"

# The graph of a product nothing but its style is known of.
EMPTY_GRAPH = (
    '{"relationship_ids":{},"relationships":{},"applicability":{},'
    '"unresolved_refs":[],"placeholder":true}'
)
# Bulky graph entries that are not stored.
RECORD_BUCKETS = (
    "style",
    "seasons",
    "colorways",
    "sizes",
    "boms",
    "bom_rows",
    "materials",
    "supplier_quotes",
    "factories",
    "suppliers",
)
# The bucket in which a relation type is counted.
RELATION_BUCKETS = {
    "season": "seasons",
    "colorway": "colorways",
    "size": "sizes",
    "bom": "boms",
    "bom_row": "bom_rows",
    "material": "materials",
    "supplier_quote": "supplier_quotes",
    "factory": "factories",
    "supplier": "suppliers",
}
DEFAULT_WARNING_CODE = "RECONSTRUCTION_WARNING"


def master_products(records: DataFrame, endpoint: str = "styles") -> DataFrame:
    """M1: one product per style with an id, with an empty graph and one source reference."""
    fields = payload_fields(F.col("payload"), ["id", "brand_code", "product_type"])
    styles = records.where(F.col("endpoint") == endpoint).select("payload")
    parsed = computed_once(styles, "p", fields).where(F.col("p")[BAD].isNull())
    style = parsed.select(
        filled(F.col("p.id")).alias("product_id"),
        filled(F.col("p.brand_code")).alias("brand_code"),
        filled(F.col("p.product_type")).alias("product_type_code"),
    ).where(F.col("product_id").isNotNull())
    empty = F.try_variant_get(F.parse_json(F.lit(EMPTY_GRAPH)), "$", GRAPH_TYPE)
    own_id = F.create_map(
        F.lit("style_id"), F.to_variant_object(F.struct(F.col("product_id").alias("v")))
    )
    own_id = F.transform_values(own_id, lambda _, v: F.try_variant_get(v, "$.v", "variant"))
    source = F.struct(
        F.lit(endpoint).alias("endpoint"),
        F.col("product_id").alias("record_id"),
        F.lit("style").alias("relation_type"),
    )
    return style.select(
        "product_id",
        F.col("product_id").alias("style_id"),
        "brand_code",
        F.lit(None).cast("string").alias("season"),
        "product_type_code",
        F.map_concat(own_id, empty).alias("graph"),
        F.array(source).cast(REFS_TYPE).alias("source_refs"),
        F.array().cast(WARNINGS_TYPE).alias("warnings"),
    )


def coerce_products(products: DataFrame) -> DataFrame:
    """M6: bring the products of a plug-in into shape; a product without an id is an error.

    Missing columns are allowed; texts are stripped and empty ones become NULL.
    """
    have = dict(products.dtypes)

    def raw(name: str, kind: str = "string") -> Column:
        if have.get(name) == kind:
            return F.col(name)
        return F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)

    given_id = F.coalesce(F.nullif(raw("product_id"), F.lit("")), F.nullif(raw("style_id"), F.lit("")))
    no_id = F.raise_error(F.lit("A product needs product_id or style_id."))
    refs = F.lit(None).cast(REFS_TYPE)
    if "source_refs" in have:
        incomplete = F.raise_error(F.lit("A source reference needs endpoint and record_id."))
        refs = F.transform(
            raw("source_refs", REFS_TYPE),
            lambda r: F.struct(
                F.coalesce(filled(r["endpoint"]), incomplete.cast("string")).alias("endpoint"),
                F.coalesce(filled(r["record_id"]), incomplete.cast("string")).alias("record_id"),
                filled(r["relation_type"]).alias("relation_type"),
            ),
        )
    warnings = F.lit(None).cast(WARNINGS_TYPE)
    if "warnings" in have:
        warnings = F.transform(
            raw("warnings", WARNINGS_TYPE),
            lambda w: F.struct(
                F.coalesce(filled(w["code"]), F.lit(DEFAULT_WARNING_CODE)).alias("code"),
                F.coalesce(filled(w["message"]), F.lit("")).alias("message"),
                F.coalesce(filled(w["severity"]), F.lit("warning")).alias("severity"),
                filled(w["source_endpoint"]).alias("source_endpoint"),
                filled(w["source_record_id"]).alias("source_record_id"),
            ),
        )
    graph = F.col("graph") if have.get("graph") == GRAPH_TYPE else _graph_from(products, have)
    return products.select(
        F.coalesce(given_id, no_id.cast("string")).alias("product_id"),
        filled(raw("style_id")).alias("style_id"),
        filled(raw("brand_code")).alias("brand_code"),
        filled(raw("season")).alias("season"),
        filled(raw("product_type_code")).alias("product_type_code"),
        F.coalesce(graph, F.create_map().cast(GRAPH_TYPE)).alias("graph"),
        F.coalesce(refs, F.array().cast(REFS_TYPE)).alias("source_refs"),
        F.coalesce(warnings, F.array().cast(WARNINGS_TYPE)).alias("warnings"),
    )


def _graph_from(products: DataFrame, have: dict[str, str]) -> Column:
    if "graph" not in have:
        return F.lit(None).cast(GRAPH_TYPE)
    graph = F.col("graph")
    if have["graph"] == "string":
        graph = F.try_parse_json(graph)
    elif have["graph"] != "variant":
        graph = F.try_parse_json(F.to_json(graph))
    return F.try_variant_get(graph, "$", GRAPH_TYPE)


def compact_graph(graph: Column) -> Column:
    return F.map_filter(graph, lambda key, _: ~key.isin(*RECORD_BUCKETS))


def write_master(store: MasterStore, products: DataFrame) -> dict[str, int]:
    """M2, M3: replace the three master tables; returns the summary.

    The products are stored once with their nested parts; the two detail tables are read
    back from there, so a costly reconstruction runs only once.
    """
    made = products.withColumns(
        {
            "graph_json": F.to_json(compact_graph(F.col("graph"))),
            "warning_count": F.size("warnings"),
            "reconstructed_at_ts": F.lit(utc_now()).cast("timestamp_ntz"),
        }
    ).drop("graph")
    stored, path = staged(made, "master")
    store.replace(SOURCE_REFS.name, source_refs(stored))
    store.replace(PRODUCT_WARNINGS.name, product_warnings(stored))
    store.replace(PRODUCTS.name, stored)
    summary = master_summary(stored).first().asDict()
    delete_folder(store.spark, path)
    return summary


def source_refs(products: DataFrame) -> DataFrame:
    """M2: one row per source reference."""
    rows = products.select("product_id", F.inline_outer("source_refs"))
    return rows.where(F.col("record_id").isNotNull()).select(
        "product_id",
        F.col("endpoint").alias("source_endpoint"),
        F.col("record_id").alias("source_record_id"),
        "relation_type",
    )


def product_warnings(products: DataFrame) -> DataFrame:
    """M2: one row per warning."""
    rows = products.select("product_id", F.inline_outer("warnings"))
    return rows.where(F.col("code").isNotNull())


def master_summary(products: DataFrame) -> DataFrame:
    """M3: one row with the number of products, references and warnings."""
    return products.agg(
        F.count("*").alias("products_reconstructed"),
        F.coalesce(F.sum(F.size("source_refs")), F.lit(0)).alias("source_refs"),
        F.coalesce(F.sum(F.size("warnings")), F.lit(0)).alias("warnings"),
    )


# -- M4, M5: the check projection ------------------------------------------------------------


def resolved_counts(refs: Column) -> Column:
    """M5: bucket to number of distinct record ids, from a product's source references.

    A product's references are already one array, so no shuffle is needed.
    """
    names = F.create_map(*[F.lit(x) for pair in RELATION_BUCKETS.items() for x in pair])
    counted = F.filter(refs, lambda r: r["relation_type"] != "style")
    found = F.array_distinct(
        F.transform(
            counted,
            lambda r: F.struct(
                F.coalesce(
                    F.try_element_at(names, r["relation_type"]), r["relation_type"]
                ).alias("bucket"),
                r["record_id"].alias("record_id"),
            ),
        )
    )

    def numbers(of: Column) -> Column:
        return F.transform(of["buckets"], lambda b: F.size(F.filter(of["all"], lambda x: x == b)))

    # One bucket name per distinct pair; the names are sorted, distinct and never null.
    parts = bound(found["bucket"], lambda n: F.struct(n.alias("all"), F.sort_array(F.array_distinct(n)).alias("buckets")))
    return bound(parts, lambda of: F.map_from_arrays(of["buckets"], numbers(of)))


def resolved_counts_of(refs: DataFrame) -> DataFrame:
    """M5 on the long table (product_id, record_id, relation_type), however many rows a
    product has: the distinct ids are reduced on the map side first."""
    names = F.create_map(*[F.lit(x) for pair in RELATION_BUCKETS.items() for x in pair])
    relation = F.col("relation_type")
    rows = refs.where(relation != "style").select(
        "product_id",
        F.coalesce(F.try_element_at(names, relation), relation).alias("bucket"),
        "record_id",
    )
    return rows.groupBy("product_id", "bucket").agg(
        F.count_distinct("record_id").alias("resolved_records")
    )


def _value_count(value: Column) -> Column:
    """Length of a list or object, 0 for null and '', 1 for any other value."""
    is_empty = is_json_null(value) | (
        F.coalesce(F.try_variant_get(value, "$", "string"), F.lit("-")) == ""
    )
    return F.coalesce(F.size(as_array(value)), F.size(as_map(value)), F.when(is_empty, 0).otherwise(1))


def check_projection(products: DataFrame) -> DataFrame:
    """M4: the compact relationship state of each product, input of the check."""
    no_map = F.create_map().cast(GRAPH_TYPE)
    graph = F.col("graph")

    def part(key: str, kind: str) -> Column:
        return F.try_variant_get(F.try_element_at(graph, F.lit(key)), "$", kind)

    relationships = F.col("relationships")
    suffix = "_applicability"
    ids = F.map_filter(relationships, lambda key, _: ~key.endswith(suffix))
    objects = F.filter(
        F.coalesce(part("unresolved_refs", "array<variant>"), F.array().cast("array<variant>")),
        lambda v: as_map(v).isNotNull(),
    )
    counts = F.struct(
        F.transform_values(F.col("ids_"), lambda _, v: _value_count(v)).alias("relationship_ids"),
        resolved_counts(F.col("source_refs")).alias("resolved_records"),
        F.size("unresolved_refs").alias("unresolved_refs"),
        F.size("warnings").alias("warnings"),
    )
    # A column that several later ones use stays a projection of its own, so it is computed once.
    opened = products.withColumn("relationships", F.coalesce(part("relationships", GRAPH_TYPE), no_map))
    opened = opened.withColumns({"unresolved_refs": objects, "ids_": ids})
    return opened.select(
        F.coalesce("style_id", "product_id").alias("style_id"),
        F.col("ids_").alias("relationship_ids"),
        counts.alias("counts"),
        F.map_filter(relationships, lambda key, _: key.endswith(suffix)).alias("applicability"),
        "unresolved_refs",
        "warnings",
    )
