"""Which fields of which endpoint count as a change."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass
from pathlib import Path
from typing import Any

from truerow.config.yamlfile import load_mapping

_SWITCHES = ("include_missing", "drop_empty", "sort_arrays")


@dataclass(frozen=True)
class TrackedEndpoint:
    name: str
    fields: tuple[str, ...]
    include_missing: bool = False
    drop_empty: bool = False
    sort_arrays: bool = False

    def __post_init__(self) -> None:
        if self.include_missing:
            for path in self.fields:
                if any(other.startswith(path + ".") for other in self.fields):
                    raise ValueError(
                        f"{self.name}: with include_missing, {path!r} may not also be tracked "
                        "by one of its own parts."
                    )

    def roots(self) -> list[str]:
        return sorted({path.split(".")[0] for path in self.fields})


@dataclass(frozen=True)
class TrackingConfig:
    endpoints: dict[str, TrackedEndpoint]
    source: str = ""

    @property
    def digest(self) -> str:
        """Hash of the settings themselves, so that comments do not force a rebuild."""
        settings = {name: asdict(entry) for name, entry in sorted(self.endpoints.items())}
        return hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()

    def only(self, names: Iterable[str]) -> dict[str, TrackedEndpoint]:
        return {name: self.endpoints[name] for name in sorted(set(names) & set(self.endpoints))}

    @classmethod
    def load(cls, source: str | Path | Mapping[str, Any]) -> TrackingConfig:
        content = load_mapping(source, "Tracking config")
        entries = content.get("endpoints")
        if not isinstance(entries, Mapping) or not entries:
            raise ValueError("A tracking config must define endpoints.")
        defaults = content.get("defaults") or {}
        if not isinstance(defaults, Mapping):
            raise ValueError("Tracking defaults must be a mapping.")
        endpoints = {}
        for name, settings in entries.items():
            settings = {"fields": settings} if isinstance(settings, list) else settings or {}
            if not isinstance(settings, Mapping):
                raise ValueError(f"Tracking of {name!r} must be a mapping or a list of fields.")
            switches = {}
            for switch in _SWITCHES:
                value = settings.get(switch, defaults.get(switch, False))
                if not isinstance(value, bool):
                    raise ValueError(f"Tracking setting {switch!r} must be true or false.")
                switches[switch] = value
            endpoints[str(name)] = TrackedEndpoint(
                str(name), _fields(settings.get("fields"), name), **switches
            )
        label = "" if isinstance(source, Mapping) else str(source)
        return cls(endpoints, label)


def _fields(value: Any, name: Any) -> tuple[str, ...]:
    if not isinstance(value, list) or not value:
        raise ValueError(f"Tracking of {name!r} needs a list of fields.")
    if any(not isinstance(item, str) or not item.strip() for item in value):
        raise ValueError(f"Tracking of {name!r} has a field without a name.")
    return tuple(item.strip() for item in value)
