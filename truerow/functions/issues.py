"""The issue struct every check produces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ERROR = "error"
WARNING = "warning"

ISSUE_TYPE = (
    "struct<code:string,message:string,severity:string,fix_location:string,"
    "source_field:string,rule_id:string,blocking:boolean>"
)
ISSUES_TYPE = f"array<{ISSUE_TYPE}>"


def _column(value: Column | str | bool) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def issue(
    code: Column | str,
    message: Column | str,
    severity: Column | str,
    fix_location: str,
    source_field: Column | str,
    rule_id: Column | str,
    blocking: Column | bool = True,
) -> Column:
    return F.struct(
        _column(code).alias("code"),
        _column(message).alias("message"),
        _column(severity).alias("severity"),
        _column(fix_location).alias("fix_location"),
        _column(source_field).alias("source_field"),
        _column(rule_id).alias("rule_id"),
        _column(blocking).alias("blocking"),
    )


def present(issues: Sequence[Column]) -> Column:
    """The given optional issues as an array without the NULL ones."""
    if not issues:
        return F.array().cast(ISSUES_TYPE)
    return F.filter(F.array(*issues), lambda i: i.isNotNull())


def listed(tests: Sequence[tuple[Column, Column]]) -> Column:
    """The issues whose tests hold, in order. Unlike ``present`` it has no lambda, so it is compiled."""
    none = F.array().cast(ISSUES_TYPE)
    return F.concat(none, *[F.when(test, F.array(found)).otherwise(none) for test, found in tests])


def joined(*groups: Column) -> Column:
    return F.concat(*groups)


def count_where(issues: Column, test) -> Column:
    return F.size(F.filter(issues, test))


def is_blocking(i: Column) -> Column:
    return (i["severity"] == ERROR) & i["blocking"]


def is_warning(i: Column) -> Column:
    return i["severity"] == WARNING
