"""The vocabulary and thresholds, read once from YAML on the driver."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path
from typing import Any, NamedTuple

import yaml


class Config(NamedTuple):
    classes: dict[str, list[dict]]
    fields: dict[str, Any]
    tags: dict[str, Any]
    settings: dict[str, Any]


def read_yaml(path: Path) -> dict:
    """A YAML mapping; anything else is an error."""
    found = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(found, dict):
        raise ValueError(f"{path} is no mapping")
    return found


def write_yaml(path: Path, value: dict) -> None:
    Path(path).write_text(yaml.safe_dump(value, sort_keys=False, allow_unicode=True), encoding="utf-8")


def base_of(folder: str | None) -> Path:
    return Path(folder) if folder else Path(__file__).resolve().parent


def write_thresholds(folder: str | None, fitted: dict[str, float]) -> None:
    """Rewrite tags.yaml with these cutoffs; tags that it does not list are passed over."""
    path = base_of(folder) / "tags.yaml"
    found = read_yaml(path)
    for name in found["tags"].keys() & fitted.keys():
        found["tags"][name]["threshold"] = fitted[name]
    write_yaml(path, found)
    load.cache_clear()


@lru_cache(maxsize=8)
def load(folder: str | None = None) -> Config:
    """The configuration in a folder, by default the package's own."""
    base = base_of(folder)
    return Config(*(read_yaml(base / f"{name}.yaml") for name in Config._fields))
