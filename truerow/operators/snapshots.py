"""Compare two keyed snapshots: the one full outer join behind history and changelog."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADDED = "added"
CHANGED = "changed"
REMOVED = "removed"


def keyed_diff(
    previous: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    differs: Callable[[Column, Column], Column],
) -> DataFrame:
    """Rows that were added, removed or changed, with both sides as ``previous`` / ``current``.

    Both sides must have unique keys. ``differs`` gets the two value structs.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*keys, F.struct(*values).alias(name))

    old, new = F.col("previous"), F.col("current")
    change = (
        F.when(old.isNull(), ADDED)
        .when(new.isNull(), REMOVED)
        .when(differs(old, new), CHANGED)
    )
    joined = side(previous, "previous").join(side(current, "current"), list(keys), "full_outer")
    return joined.withColumn("change_type", change).where(F.col("change_type").isNotNull())


def any_field_differs(names: Sequence[str]) -> Callable[[Column, Column], Column]:
    def differs(old: Column, new: Column) -> Column:
        result = F.lit(False)
        for name in names:
            result = result | ~old[name].eqNullSafe(new[name])
        return result

    return differs


def allocate_run_id(taken: DataFrame, base: str) -> str:
    """``base``, or the first free one of ``base-2`` to ``base-100``."""
    rows = taken.where(F.col("run_id").startswith(base)).select("run_id").collect()
    used = {row["run_id"] for row in rows}
    for name in [base, *(f"{base}-{number}" for number in range(2, 101))]:
        if name not in used:
            return name
    raise RuntimeError(f"No run id left for {base}.")


def latest(rows: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """The row per key with the largest ``newest``; NULLs count as oldest."""
    others = [name for name in rows.columns if name not in keys]
    packed = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), newest).alias("row"))
    return packed.select(*keys, "row.*").select(*rows.columns)
