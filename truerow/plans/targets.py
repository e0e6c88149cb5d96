"""Plug in the parts of a target as functions on DataFrames.

A target is a name with up to six functions. Each gets and returns DataFrames, so its work
runs on the executors; where rules need plain Python, use an Arrow UDF or mapInPandas inside.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.config.naming import Naming
from truerow.config.rules import RuleSet
from truerow.operators import check, products, readiness
from truerow.plans import reporting

CHECK_TARGET = "check"


@dataclass(frozen=True)
class Target:
    """The functions of one target; all optional.

    - ``master(records)``: products from the current records (see ``coerce_products``)
    - ``reconstruct(records, scope)``: documents to validate; ``scope`` is None or a DataFrame
      of ``product_id``
    - ``project(products)``: documents from master products
    - ``affected(changed, states)``: ``record_id`` of products behind changed records
    - ``validate(documents)``: results
    - ``report(results, folder, template)``: writes report tables
    - ``artifact(spark)``: a static table
    """

    name: str
    master: Callable[[DataFrame], DataFrame] | None = None
    reconstruct: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None
    project: Callable[[DataFrame], DataFrame] | None = None
    affected: Callable[[DataFrame, list[DataFrame]], DataFrame] | None = None
    validate: Callable[[DataFrame], DataFrame] | None = None
    report: Callable[[DataFrame, str, str], None] | None = None
    artifact: Callable[[SparkSession], DataFrame] | None = None
    rule_set_version: str | None = None


_TARGETS: dict[str, Target] = {CHECK_TARGET: Target(CHECK_TARGET)}


def register_target(name: str, **parts) -> Target:
    _TARGETS[name] = Target(name, **parts)
    return _TARGETS[name]


def register_rules(name: str, rules: RuleSet, naming: Naming | None = None, **parts) -> Target:
    """A target whose documents are validated against a rule set, with the readiness report.

    ``parts`` gives at least ``reconstruct`` or ``project``, which make the documents
    (``readiness.document_schema``), and may replace the built-in ``validate`` and ``report``.
    """

    def validate(documents: DataFrame) -> DataFrame:
        return readiness.validate(documents, rules, naming)

    def report(results: DataFrame, folder: str, template: str) -> None:
        reporting.write_readiness_report(results, folder, rules.version, naming)

    built_in = {"validate": validate, "report": report, "rule_set_version": rules.version}
    return register_target(name, **(built_in | parts))


def target(name: str) -> Target:
    return _TARGETS.get(name, Target(name))


def _needed(name: str, part: str):
    raise ValueError(f"Target {name!r} needs a function {part!r}; give it to register_target.")


def master_products(name: str, records: DataFrame) -> DataFrame:
    """The target's own master products, or one per style."""
    own = target(name).master
    return products.coerce_products(own(records)) if own else products.master_products(records)


def documents(
    name: str, records: DataFrame, scope: DataFrame | None = None
) -> DataFrame:
    """M7, M8: what is to be validated: reconstructed directly, or projected from products."""
    chosen = target(name)
    if chosen.reconstruct:
        return chosen.reconstruct(records, scope)
    made = master_products(name, records)
    if scope is not None:
        made = made.join(scope.select("product_id"), "product_id", "left_semi")
    if chosen.project:
        return chosen.project(made)
    if name == CHECK_TARGET:
        return products.check_projection(made)
    return _needed(name, "reconstruct")


def results(name: str, docs: DataFrame, naming: Naming | None = None) -> DataFrame:
    """The target's own validation; the check has a built-in one."""
    own = target(name).validate
    if own:
        return own(docs)
    return check.validate(docs, naming) if name == CHECK_TARGET else _needed(name, "validate")


def report(name: str, rows: DataFrame, folder: str, template: str = "default") -> None:
    """The target's own report; the check has a built-in one, whatever the template."""
    own = target(name).report
    if own:
        own(rows, folder, template)
    elif name == CHECK_TARGET:
        reporting.write_check_report(rows, folder)
    else:
        _needed(name, "report")


def artifact(name: str, spark: SparkSession) -> DataFrame:
    """L8."""
    own = target(name).artifact
    return own(spark) if own else _needed(name, "artifact")


def describe_target(name: str) -> dict[str, str]:
    """Which implementation each step of a target uses."""
    chosen = target(name)
    built_in = {
        "validate": "built-in check",
        "project": "built-in check projection",
        "report": "built-in check report",
    }
    steps = {}
    for part in ("master", "reconstruct", "project", "affected", "validate", "report", "artifact"):
        if getattr(chosen, part):
            steps[part] = "registered function"
        elif part == "master":
            steps[part] = "one product per style"
        else:
            steps[part] = built_in.get(part, "none") if name == CHECK_TARGET else "none"
    return steps


def scope_of(ids: DataFrame) -> DataFrame:
    """Distinct, non-blank product ids."""
    text = ids.select(F.col(ids.columns[0]).cast("string").alias("product_id"))
    return text.where(F.trim("product_id") != "").distinct()
