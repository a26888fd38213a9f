"""Settings from TOML files."""

from __future__ import annotations

import tomllib
from dataclasses import fields, is_dataclass
from typing import Any, TypeVar

from .errors import ConfigError

T = TypeVar("T")


def load_toml(path: str, kind: type[T] | None = None) -> T | dict[str, Any]:
    """The tables of a TOML file, as a dataclass of type ``kind`` where one is given."""
    try:
        with open(path, "rb") as f:
            found = tomllib.load(f)
    except (OSError, tomllib.TOMLDecodeError) as e:
        raise ConfigError(f"{path}: {e}") from e
    if kind is None or not is_dataclass(kind):
        return found
    unknown = set(found) - {f.name for f in fields(kind)}
    if unknown:
        raise ConfigError(f"{path}: unknown settings {', '.join(sorted(unknown))}")
    return kind(**found)
