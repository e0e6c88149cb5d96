"""Array order that does not count."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def _text(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _ordered(value):
    if isinstance(value, dict):
        return {key: _ordered(item) for key, item in value.items()}
    if isinstance(value, list):
        return sorted(map(_ordered, value), key=_text)
    return value


# Texts of arrays without escapes, brackets and braces inside, and their items; texts of all others with arrays.
# The patterns repeat nothing but classes of characters, so long texts take no stack.
_PLAIN, _PLAIN_ITEM = r"^\[[^\[{\\]*$", r'"[^"]*"|[^,\[\]]+'
_OTHER = r"^(?:\[[^\[{\\]*[\[{\\]|\{[^\[]*\[)"
_ITEM = re.compile(r'"(?:[^"\\]|\\.)*"|[^,\[\]]+')
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"')


def _sorted_text(text: str | None) -> str | None:
    if text is None:
        return None
    bare = _STRING.sub("", text)
    if "[" in bare[1:] or "{" in bare:
        return _text(_ordered(json.loads(text)))
    return "[" + ",".join(sorted(_ITEM.findall(text))) + "]"


@F.pandas_udf(ArrayType(StringType()))
def _sort_others(texts: pd.Series) -> pd.Series:
    return texts.map(lambda row: None if row is None else [_sorted_text(text) for text in row])


def sorted_arrays(texts: Sequence[Column]) -> list[Column]:
    """JSON texts, as the JSON writer writes them, with arrays at every depth sorted by their items' text.

    Plain arrays are sorted in the JVM. Only rows with others, such as arrays inside other containers,
    go through Arrow to Python; all others are sent as NULL.
    """
    others = [F.coalesce(text.rlike(_OTHER), F.lit(False)) for text in texts]
    held = F.array(*[F.when(other, text) for other, text in zip(others, texts, strict=True)])
    done = _sort_others(F.when(reduce(or_, others), held))

    def in_order(text: Column) -> Column:
        items = F.sort_array(F.regexp_extract_all(text, F.lit(_PLAIN_ITEM), F.lit(0)))
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))

    return [
        F.when(text.rlike(_PLAIN), in_order(text)).otherwise(F.coalesce(F.get(done, n), text))
        for n, text in enumerate(texts)
    ]
