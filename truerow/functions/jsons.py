"""JSON payload access.

``payload_fields`` parses a payload once and returns only the wanted top-level fields,
instead of one parse per field.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD = "__unparsed"
_PARSE_OPTIONS = {"columnNameOfCorruptRecord": BAD, "allowSingleQuotes": "false"}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def payload_fields(payload: Column, names: Iterable[str], kind: str = "STRING") -> Column:
    """A struct of the named top-level fields plus the marker for unparsed text.

    With STRING, numbers and booleans arrive as their JSON text. With VARIANT, a missing
    field is NULL while a JSON null stays a variant null.
    """
    fields = ", ".join(f"{quoted(name)} {kind}" for name in sorted(set(names)))
    schema = f"{fields}, {BAD} STRING" if fields else f"{BAD} STRING"
    return F.from_json(payload, schema, _PARSE_OPTIONS)


def computed_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column in such a way that it is never computed again.

    The optimizer moves filters below projections and copies the expressions they name; a
    parse would then run for the filter and again for the columns. Nothing that depends on
    the output of a generator is moved below it, so a one-element explode is the barrier.
    """
    return rows.select(*rows.columns, F.explode(F.array(value)).alias(name))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a costly value that it names more than once, inside one expression.

    Lambdas and what they are applied to are not compiled, so there each mention computes it again.
    """
    return F.get(F.transform(F.array(value), body), 0)


def line_fields(payload: Column, names: Iterable[str]) -> Column:
    """The named top-level fields of a line that is one JSON object and nothing else, as text.

    NULL for every other line. The JSON readers stop at an object's closing brace and would
    not notice text after it, so the line is read as the only item of an array.
    """
    return _only_object(payload, _line_items(payload, names))


def with_line_fields(lines: DataFrame, names: Iterable[str]) -> DataFrame:
    """Lines with the column parsed: the ``line_fields`` of their payload, read a single time.

    Inside a generator nothing is shared, so what is named twice is a column below it.
    """
    read = lines.select(*lines.columns, _line_items(F.col("payload"), names).alias("items_"))
    parsed = _only_object(F.col("payload"), F.col("items_"))
    return computed_once(read, "parsed", parsed).drop("items_")


def _line_items(payload: Column, names: Iterable[str]) -> Column:
    fields = ", ".join(f"{quoted(name)} STRING" for name in sorted({*names}) or [BAD])
    return F.from_json(_in_array(payload), f"ARRAY<STRUCT<{fields}>>", _PARSE_OPTIONS)


def _only_object(payload: Column, items: Column) -> Column:
    text = F.trim(payload, F.lit(" \t\r\n"))
    is_object = text.startswith("{") & text.endswith("}")
    return F.when(is_object & (F.size(items) == 1), F.get(items, 0))


def first_value(payload: Column, fields: Column, name: str) -> Column:
    """A field of ``line_fields`` by the first of its keys, where an object repeats the key.

    The readers keep the last one. A second parse runs only where the key's text occurs again.
    """
    key = F.lit(json.dumps(name, ensure_ascii=False))
    again = F.position(key, payload, F.position(key, payload) + 1) > 0
    return F.when(again, F.get_json_object(payload, variant_path_of(name))).otherwise(fields[name])


def variant_path_of(name: str) -> str:
    """The path of one top-level field, whatever characters it has."""
    return "$['" + name.replace("'", "\\'") + "']"


def _in_array(payload: Column) -> Column:
    return F.concat(F.lit("["), payload, F.lit("]"))


def is_malformed(payload: Column, fields: Column) -> Column:
    """True for a line that is no single JSON value; arrays and scalars are legal JSON.

    The second parse only runs for lines that ``line_fields`` could not read.
    """
    items = as_array(F.try_parse_json(_in_array(payload)))
    return F.when(fields.isNotNull(), F.lit(False)).otherwise(F.coalesce(F.size(items), F.lit(0)) != 1)


def variant_path(path: str) -> str:
    """``a.b`` as a variant path with every part taken literally."""
    return "$" + "".join("['" + part.replace("'", "\\'") + "']" for part in path.split("."))


def is_json_null(value: Column) -> Column:
    return F.coalesce(F.is_variant_null(value), F.lit(False))


def variant_kind(value: Column) -> Column:
    """STRING, BIGINT, DECIMAL(...), DOUBLE, BOOLEAN, ARRAY<...>, OBJECT<...> or VOID."""
    return F.schema_of_variant(value)


def as_map(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def as_array(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")
