"""Typed configuration: every setting has a name, a type and a default; anything else is an error.

Settings come from a JSON file. ``${NAME}`` in a text is the environment
variable of that name, which must be set.
"""

from __future__ import annotations

import dataclasses
import json
import os
import re
from dataclasses import dataclass, field
from typing import Any, get_args, get_origin, get_type_hints


class ConfigError(ValueError):
    """A setting that doesn't exist or has another type."""


@dataclass(frozen=True)
class Discovery:
    roots: list[str] = field(default_factory=list)
    extensions: list[str] = field(default_factory=lambda: [".csv", ".xlsx", ".xlsm"])
    skip_dirs: list[str] = field(default_factory=lambda: ["archive"])
    skip_globs: list[str] = field(default_factory=lambda: ["~$*"])
    domains: dict[str, list[str]] = field(default_factory=dict)
    redact: dict[str, str] = field(default_factory=dict)
    max_file_mb: int = 400
    header_overlap: float = 0.70
    header_overlap_min_columns: int = 4
    bloat_min_rows: int = 5000
    bloat_value_ratio: float = 0.10
    heavy_formula_count: float = 500.0
    heavy_formulas_per_row: float = 1.0


@dataclass(frozen=True)
class Canonical:
    locations: str | None = None
    unknown_share: float = 0.02
    snapshot_stale_days: int = 7
    overstock_months: float = 8.0
    channels: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Config:
    discovery: Discovery = field(default_factory=Discovery)
    canonical: Canonical = field(default_factory=Canonical)


def _expand(text: str) -> str:
    def put(m: re.Match[str]) -> str:
        if m[1] not in os.environ:
            raise ConfigError(f"environment variable {m[1]} is not set")
        return os.environ[m[1]]

    return re.sub(r"\$\{(\w+)\}", put, text)


def _read(value: Any, kind: Any, where: str) -> Any:
    origin, args = get_origin(kind), get_args(kind)
    if dataclasses.is_dataclass(kind):
        if not isinstance(value, dict):
            raise ConfigError(f"{where}: settings by name are wanted")
        hints = get_type_hints(kind)
        if unknown := sorted(set(value) - set(hints)):
            raise ConfigError(f"{where}: there is no {', '.join(unknown)}")
        return kind(**{k: _read(v, hints[k], f"{where}.{k}") for k, v in value.items()})
    if origin is list and isinstance(value, list):
        return [_read(v, args[0], where) for v in value]
    if origin is dict and isinstance(value, dict):
        return {k: _read(v, args[1], f"{where}.{k}") for k, v in value.items()}
    options = args if args and origin not in (list, dict) else (kind,)
    if float in options and type(value) is int:
        return float(value)
    if not any(type(value) is o for o in options if isinstance(o, type) and get_origin(o) is None):
        raise ConfigError(f"{where}: {value!r} is not of its type")
    return _expand(value) if isinstance(value, str) else value


def load(path: str) -> Config:
    """The configuration in a JSON file; what it leaves out has its default."""
    with open(path, encoding="utf-8") as f:
        try:
            value = json.load(f)
        except json.JSONDecodeError as e:
            raise ConfigError(f"{path}: {e}") from e
    return _read(value, Config, "config")
