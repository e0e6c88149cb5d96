"""Which fields of which endpoint point to which other endpoint."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Relationship:
    name: str
    source: str
    source_fields: tuple[str, ...]
    target: str
    target_fields: tuple[str, ...] = ("id",)

    @property
    def target_key(self) -> str:
        """Name of the id set looked up; relationships with equal targets share it."""
        return f"{self.target}:{','.join(self.target_fields)}"


# Relationship names, endpoints and field names of the delivered records.
DEFAULT_RELATIONSHIPS: tuple[Relationship, ...] = (
    Relationship(
        "style_colorways",
        "styles",
        ("product_colors", "active_colorways", "sample_colorways", "production_colorways"),
        "colorways",
    ),
    Relationship("style_sizes", "styles", ("product_sizes", "size_set_sample_sizes"), "sizes"),
    Relationship(
        "style_seasons",
        "styles",
        ("parent_season", "original_season"),
        "seasons",
        ("id", "code"),
    ),
    Relationship(
        "style_bom_master",
        "styles",
        ("authority_bom",),
        "boms",
        # Installations whose revisions carry a parent id add that field in their own rules.
        ("id", "parent_bom_id"),
    ),
    Relationship("bom_rows", "boms", ("items",), "bomrows"),
    Relationship("bom_materials", "boms", ("bom_main_materials", "bom_materials"), "materials"),
    Relationship("bomrow_materials", "bomrows", ("actual", "original"), "materials"),
    Relationship(
        "material_default_quotes",
        "materials",
        ("default_quote",),
        "supplierquotes",
        ("id", "master"),
    ),
    Relationship("supplier_quote_factories", "supplierquotes", ("quote_factory",), "factories"),
    Relationship("factory_suppliers", "factories", ("suppliers",), "suppliers"),
)

# Fixed value: a reference is a capital C followed by a digit.
VALID_REF_PATTERN = "^C[0-9]"
