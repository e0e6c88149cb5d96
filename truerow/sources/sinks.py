"""Report tables as CSV or Parquet folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header. Rows keep their partitions; nothing is pulled together."""
    rows.write.mode("overwrite").option("header", "true").csv(path)


def write_sheets(
    sheets: Mapping[str, DataFrame], folder: str, file_format: str = "csv"
) -> dict[str, str]:
    """One sub-folder per sheet; nested columns become JSON text in CSV."""
    paths = {}
    for name, rows in sheets.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        if file_format == "csv":
            write_csv(_flat(rows), paths[name])
        elif file_format == "parquet":
            rows.write.mode("overwrite").parquet(paths[name])
        else:
            raise ValueError(f"Unknown report format {file_format!r}.")
    return paths


def _flat(rows: DataFrame) -> DataFrame:
    nested = ("array", "map", "struct")
    return rows.select(
        *[
            F.to_json(name).alias(name) if kind.startswith(nested) else F.col(name)
            for name, kind in rows.dtypes
        ]
    )


def write_text(text: str, path: str, spark) -> None:
    """A small text such as a Markdown summary, as a one-file folder on any file system."""
    rows = spark.createDataFrame([(text,)], "value STRING")
    rows.coalesce(1).write.mode("overwrite").text(path)
