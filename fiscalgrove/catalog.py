"""Record layouts: which field of a record type sits at which position.

A layout lists its fields in position order; position 1 is the record type itself.
Names and positions live in one object, so they cannot diverge. Only the layouts
the diagnosis and the subsidy valuation read are built in; the full official
catalogue is a parameter, loaded from a file or a table of
``(return_type, register, position, field)`` rows.
"""

from __future__ import annotations

import csv
import json
import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


class ContractError(ValueError):
    """A schema, layout or report specification breaks its contract."""


@dataclass(frozen=True)
class Layout:
    """Fields of one record type in position order (``fields[0]`` has position 1)."""

    register: str
    fields: tuple[str, ...]
    types: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        lowered = [f.lower() for f in self.fields]
        twice = sorted({f for f in lowered if lowered.count(f) > 1})
        if twice:
            raise ContractError(f"{self.register}: fields named twice: {twice}")
        unknown = sorted(set(self.types) - set(self.fields))
        if unknown:
            raise ContractError(f"{self.register}: types for unknown fields: {unknown}")

    def positions(self) -> dict[str, int]:
        return {name: i for i, name in enumerate(self.fields, start=1)}

    def type_of(self, name: str) -> str:
        return self.types.get(name, "string")

    def struct(self) -> T.StructType:
        return T.StructType([
            T.StructField(n, T._parse_datatype_string(self.type_of(n)), True) for n in self.fields
        ])


Catalogue = dict[str, Layout]


def layout_from_positions(register: str, positions: Mapping[str, int],
                          types: Mapping[str, str] | None = None) -> Layout:
    """Layout from a field -> position map; positions must be 1..n without a gap."""
    ordered = sorted(positions.items(), key=lambda kv: kv[1])
    if [p for _, p in ordered] != list(range(1, len(ordered) + 1)):
        raise ContractError(f"{register}: positions are not 1..{len(ordered)}")
    return Layout(register, tuple(n for n, _ in ordered), types or {})


def check_layout(layout: Layout, schema_fields: Iterable[str]) -> None:
    """Raise unless a separately declared schema names the same fields in order."""
    declared = list(schema_fields)
    if declared != list(layout.fields):
        missing = [f for f in layout.fields if f not in declared]
        extra = [f for f in declared if f not in layout.fields]
        raise ContractError(
            f"{layout.register}: schema and layout differ (missing {missing}, extra {extra}, "
            "or another order)")


def catalogue_from_mapping(spec: Mapping[str, Iterable[str] | str]) -> Catalogue:
    """``{"C190": "CST_ICMS CFOP ..."}``; REG is put first when it is not listed."""
    out: Catalogue = {}
    for reg, names in spec.items():
        listed = names.split() if isinstance(names, str) else list(names)
        if not listed or listed[0] != "REG":
            listed = ["REG", *listed]
        out[reg] = Layout(reg, tuple(listed))
    return out


def catalogues_from_rows(rows: Iterable[Mapping[str, str]]) -> dict[str, Catalogue]:
    """Catalogues per return type from ``return_type, register, position, field[, type]``."""
    found: dict[tuple[str, str], dict[str, int]] = {}
    types: dict[tuple[str, str], dict[str, str]] = {}
    for row in rows:
        key = (row["return_type"], row["register"])
        positions = found.setdefault(key, {})
        if row["field"] in positions:
            raise ContractError(f"{key}: field {row['field']} listed twice")
        positions[row["field"]] = int(row["position"])
        if row.get("type"):
            types.setdefault(key, {})[row["field"]] = row["type"]
    out: dict[str, Catalogue] = {}
    for (kind, reg), positions in found.items():
        out.setdefault(kind, {})[reg] = layout_from_positions(reg, positions, types.get((kind, reg)))
    return out


def load_catalogues(path: str) -> dict[str, Catalogue]:
    """Catalogues from a ``.csv`` of rows or a ``.json``/``.yaml`` of field lists."""
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".csv"):
            return catalogues_from_rows(csv.DictReader(handle))
        data = _parse_document(path, handle.read())
    return {kind: catalogue_from_mapping(regs) for kind, regs in data.items()}


def _parse_document(path: str, text: str):
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as exc:  # pragma: no cover - depends on the image
        raise ContractError("reading YAML needs the yaml package; use JSON instead") from exc
    return yaml.safe_load(text)


def load_document(path: str):
    """A JSON or YAML configuration (report specs, parent rules)."""
    with open(path, encoding="utf-8") as handle:
        return _parse_document(path, handle.read())


def parent_rules(rules: Iterable[Mapping]) -> tuple[dict[str, str], set[str]]:
    """``[{parent, children, children_override}]`` -> (child -> parent, forced-to-root)."""
    parent_of: dict[str, str] = {}
    to_root: set[str] = set()
    for rule in rules:
        for child in rule.get("children") or []:
            parent_of[child] = rule["parent"]
        to_root.update(rule.get("children_override") or [])
    return parent_of, to_root


# --- fixed values: official layouts of the records this engine reads itself ---
_BUILT_IN = load_catalogues(os.path.join(os.path.dirname(__file__), "layouts.json"))
EFD_FISCAL, ECF = _BUILT_IN["EFD_FISCAL"], _BUILT_IN["ECF"]
ECF_PARENTS = [
    {"parent": "0000", "children": ["L030", "M030", "N030", "Y570"]},
    {"parent": "0000", "children": ["0010"]},
    {"parent": "L030", "children": ["L100", "L300"]},
    {"parent": "M030", "children": ["M300"]},
    {"parent": "M300", "children": ["M310"]},
    {"parent": "N030", "children": ["N500"]},
]
FISCAL_PARENTS = [
    {"parent": "0000", "children": ["0150", "C100"]},
    {"parent": "C100", "children": ["C170", "C190"]},
]
# ------------------------------------------------------------------------------
CATALOGUES: dict[str, Catalogue] = {"EFD_FISCAL": EFD_FISCAL, "ECF": ECF}
PARENT_RULES: dict[str, list[dict]] = {"EFD_FISCAL": FISCAL_PARENTS, "ECF": ECF_PARENTS}
