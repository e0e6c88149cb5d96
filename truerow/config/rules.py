"""V1: the readiness rule set."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from truerow.config.yamlfile import load_mapping

# Penalties used when the rule set names none.
DEFAULT_WEIGHTS = {"blocking_error": 20, "warning": 5}


@dataclass(frozen=True)
class AttributeRule:
    code: str
    label: str | None = None
    data_type: str = "string"


@dataclass(frozen=True)
class ProductTypeRule:
    code: str
    label: str | None = None
    template_code: str | None = None
    required: tuple[str, ...] = ()
    recommended: tuple[str, ...] = ()


@dataclass(frozen=True)
class BrandRule:
    code: str
    name: str = ""
    required: tuple[str, ...] = ()


@dataclass(frozen=True)
class RuleSet:
    version: str
    attributes: dict[str, AttributeRule] = field(default_factory=dict)
    product_types: dict[str, ProductTypeRule] = field(default_factory=dict)
    brands: dict[str, BrandRule] = field(default_factory=dict)
    weights: dict[str, int] = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))

    @classmethod
    def load(cls, source: str | Path | Mapping[str, Any]) -> RuleSet:
        content = load_mapping(source, "Rule set")
        if "version" not in content:
            raise ValueError("A rule set needs a version.")
        return cls(
            version=str(content["version"]),
            attributes=_by_code(
                content.get("attributes"),
                lambda e: AttributeRule(e["code"], e.get("label"), e.get("data_type", "string")),
            ),
            product_types=_by_code(
                content.get("product_types"),
                lambda e: ProductTypeRule(
                    e["code"],
                    e.get("label"),
                    e.get("dpp_template_code"),
                    tuple(e.get("required_attributes") or ()),
                    tuple(e.get("warning_attributes") or ()),
                ),
            ),
            brands=_by_code(
                content.get("brands"),
                lambda e: BrandRule(
                    e["code"], e.get("name", ""), tuple(e.get("required_attributes") or ())
                ),
            ),
            weights=dict(content["score"]) if "score" in content else dict(DEFAULT_WEIGHTS),
        )

    def penalty(self, kind: str) -> int:
        return int(self.weights.get(kind, DEFAULT_WEIGHTS[kind]))

    def data_type(self, code: str) -> str:
        rule = self.attributes.get(code)
        return rule.data_type if rule else "string"


def _by_code(entries: Any, build: Any) -> dict[str, Any]:
    return {entry["code"]: build(entry) for entry in entries or ()}
