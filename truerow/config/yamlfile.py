"""Read one YAML mapping on the driver."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path
from typing import Any

import yaml


def load_mapping(source: str | Path | Mapping[str, Any], what: str) -> dict[str, Any]:
    if isinstance(source, Mapping):
        return dict(source)
    path = Path(source)
    if not path.is_file():
        raise ValueError(f"{what} file not found: {path}")
    content = yaml.safe_load(path.read_text(encoding="utf-8"))
    if content is None:
        return {}
    if not isinstance(content, dict):
        raise ValueError(f"{what} must be a mapping: {path}")
    return content
