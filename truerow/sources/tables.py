"""Parquet tables below one root folder, written by plain Spark jobs.

Rows are appended, or they replace the partitions they fall into (dynamic partition overwrite).
There is no log and there are no versions. A job that writes several tables is safe by its order:
the table that says that the work is done, a ledger or a run row, comes last, and the steps before
it write the same rows when they run again. One job at a time may write, and a DataFrame on a
table is read before that table is replaced. On a cluster with a table format that offers MERGE,
``append`` and ``replace`` are the two calls to plug it into.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truerow.session import configure

#: The values of a table's partition columns.
Partition = tuple


@dataclass(frozen=True)
class TableSpec:
    """``key`` is never NULL in a row; a row without it only says that its partition was written."""

    name: str
    ddl: str
    partition_by: tuple[str, ...] = ()
    key: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


def within(names: Sequence[str], partitions: Iterable[Partition]) -> Column:
    """Whether a row lies in one of the partitions; a scan lists and reads only these."""
    *outer, last = names
    by_outer: dict[tuple, list] = {}
    for *head, value in partitions:
        by_outer.setdefault(tuple(head), []).append(value)
    found = F.lit(False)
    for head, values in by_outer.items():
        here = F.col(last).isin(values)
        for name, value in zip(outer, head):
            here = here & (F.col(name) == value)
        found = found | here
    return found


class TableStore:
    def __init__(self, spark: SparkSession, root: str, specs: Iterable[TableSpec]) -> None:
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.specs = {spec.name: spec for spec in specs}
        self._settled = False

    def settings(self) -> dict:
        """What must stay as it was when the first rows were stored."""
        return {}

    def _check_settings(self, writing: bool) -> None:
        if self._settled:
            return
        path, own = f"{self.root}/settings", json.dumps(self.settings(), sort_keys=True)
        try:
            row = self.spark.read.text(path).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            row = None
        if row is None and not writing:
            return
        if row is None:
            self.spark.createDataFrame([(own,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
        elif row["value"] != own:
            raise ValueError(f"{self.root} was stored with {row['value']}, not with {own}.")
        self._settled = True

    def read(self, table: str, partitions: Iterable[Partition] | None = None) -> DataFrame:
        """The rows; ``partitions`` restricts the scan to these values of the partition columns."""
        self._check_settings(writing=False)
        spec = self.specs[table]
        try:
            rows = self.spark.read.schema(spec.schema).parquet(f"{self.root}/{table}").select(*spec.schema.names)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], spec.schema)
        if partitions is not None:
            rows = rows.where(within(spec.partition_by, partitions))
        return rows.where(F.col(spec.key).isNotNull()) if spec.key else rows

    def partitions_of(self, rows: DataFrame, *partition_by: str) -> list[Partition]:
        """The partitions that rows fall into: at most one per folder, whatever the number of rows."""
        return sorted(tuple(row) for row in rows.select(*partition_by).distinct().collect())

    def append(self, table: str, rows: DataFrame) -> None:
        spec = self.specs[table]
        self._written(spec, rows, "append")

    def replace(
        self, table: str, rows: DataFrame, partitions: Iterable[Partition] = (), parts: int | None = None
    ) -> None:
        """Replace the partitions that the rows fall into, or a table without partitions as a whole.

        ``partitions`` are replaced even if no row is left for them. ``parts`` shuffles the rows
        such that this many tasks write each partition; without it they are written where they are.
        """
        spec = self.specs[table]
        named = list(partitions)
        if named:
            types = {field.name: field for field in spec.schema}
            marks = self.spark.createDataFrame(named, T.StructType([types[name] for name in spec.partition_by]))
            rows = rows.unionByName(marks, allowMissingColumns=True)
        if parts:
            rows = rows.repartition(*spec.partition_by, F.pmod(F.xxhash64(spec.key), F.lit(parts)))
        self._written(spec, rows, "overwrite")

    def _written(self, spec: TableSpec, rows: DataFrame, mode: str) -> None:
        """Columns the rows do not have become NULL, so older producers keep working."""
        self._check_settings(writing=True)
        have = set(rows.columns)
        columns = [
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spec.schema
        ]
        writer = rows.select(*columns).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*spec.partition_by).parquet(f"{self.root}/{spec.name}")
