"""Source contracts: ordered columns with types, as YAML-like mappings.

A contract is read from JSON or, where PyYAML is installed, YAML. Unknown keys
are errors. Types that a source declares twice keep the wider and report both.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T

SPARK_TYPES = {
    "string": T.StringType(), "whole": T.LongType(), "number": T.DoubleType(), "timestamp": T.TimestampType(),
    "date": T.DateType(), "boolean": T.BooleanType(),
}
#: Declared type names to ours; anything else is text.
DECLARED = {
    "text": "string", "int64.type": "whole", "number": "number", "currency.type": "number", "percentage.type": "number",
    "date": "timestamp", "datetime": "timestamp", "datetimezone": "timestamp", "logical": "boolean",
}
_WIDER = {("whole", "number"): "number", ("number", "whole"): "number"}


@dataclass(frozen=True)
class Column:
    name: str
    dtype: str = "string"
    conflicts: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    slug: str
    columns: tuple[Column, ...]
    entity: str | None = None
    notes: str | None = None
    extra: dict = field(default_factory=dict)

    def schema(self) -> T.StructType:
        """Typed schema; conflicts are kept as field metadata."""
        return T.StructType([T.StructField(c.name, SPARK_TYPES[c.dtype], True, {"conflicts": list(c.conflicts)})
            for c in self.columns])


def declared_type(name: str) -> str:
    """Our type of a declared one: "type nullable number" is "number"."""
    return DECLARED.get(name.lower().removeprefix("type ").removeprefix("nullable ").strip(), "string")


def merge(slug: str, declarations: Iterable[Mapping[str, str]]) -> Contract:
    """One contract of several queries' declarations, in order of first sight."""
    seen: dict[str, list[str]] = {}
    for one in declarations:
        for name, kind in one.items():
            seen.setdefault(name, []).append(declared_type(kind))
    columns = []
    for name, kinds in seen.items():
        now = kinds[0]
        for k in kinds[1:]:
            now = _WIDER.get((now, k), now)
        columns.append(Column(name, now, tuple(dict.fromkeys(k for k in kinds if k != now))))
    return Contract(slug, tuple(columns))


def dump(contracts: Iterable[Contract], path: str) -> None:
    """Write as JSON; hand-written entity and notes of an older file stay."""
    try:
        old = {c.slug: c for c in load(path)}
    except FileNotFoundError:
        old = {}
    out = []
    for c in contracts:
        d = asdict(c)
        if c.slug in old:
            d["entity"], d["notes"] = d["entity"] or old[c.slug].entity, d["notes"] or old[c.slug].notes
        out.append(d)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(out, f, indent=1)


def load(path: str) -> list[Contract]:
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            import yaml  # optional

            rows = yaml.safe_load(f)
        else:
            rows = json.load(f)
    out = []
    for r in rows:
        if unknown := set(r) - {"slug", "columns", "entity", "notes", "extra"}:
            raise ValueError(f"unknown keys in contract {r.get('slug')}: {sorted(unknown)}")
        cols = tuple(Column(c["name"], c.get("dtype", "string"), tuple(c.get("conflicts", ()))) for c in r["columns"])
        out.append(Contract(r["slug"], cols, r.get("entity"), r.get("notes"), r.get("extra") or {}))
    return out
