"""How the source system names itself inside the data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Naming:
    """``system`` prefixes id columns and references, ``label`` is used in texts.

    A system called ``plm`` delivers ``plm_style_id`` and ``plm_variant_id``, writes an
    empty reference as ``plm:``, and issues are to be fixed in ``PLM``.
    """

    system: str = "plm"
    label: str = "PLM"
    hub: str = "MDM"

    @property
    def style_id(self) -> str:
        return f"{self.system}_style_id"

    @property
    def variant_id(self) -> str:
        return f"{self.system}_variant_id"

    @property
    def empty_ref(self) -> str:
        return f"{self.system}:"
