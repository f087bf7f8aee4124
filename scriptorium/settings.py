"""Settings in four layers: flag, environment, file, default; driver side.

As a table, `resolve_columns` takes the same order over columns.
"""

from __future__ import annotations

import difflib
import math
import tomllib
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Setting:
    key: str
    default: Any
    convert: Callable[[str], Any] = str


@dataclass(frozen=True)
class Resolved:
    value: Any
    origin: str
    refused: tuple[str, ...] = ()


def boolean(value: str) -> bool:
    known = {"1": True, "true": True, "yes": True, "on": True, "0": False, "false": False, "no": False, "off": False}
    return known[str(value).strip().lower()]


def at_least(least: int) -> Callable[[str], int]:
    def convert(value: str) -> int:
        number = int(value)
        if number < least:
            raise ValueError(f"{number} is below {least}")
        return number

    return convert


def within(low: float, high: float) -> Callable[[str], float]:
    def convert(value: str) -> float:
        number = float(value)
        if not math.isfinite(number) or not low <= number <= high:
            raise ValueError(f"{value} isn't from {low} to {high}")
        return number

    return convert


def read_file(text: str, known: set[str]) -> dict[str, Any]:
    """section.key of a TOML text; an unknown key is an error that names the nearest."""
    flat = {f"{s}.{k}": v for s, table in tomllib.loads(text).items() if isinstance(table, dict) for k, v in table.items()}
    for key in flat:
        if key not in known:
            near = difflib.get_close_matches(key, known, 1)
            raise KeyError(f"unknown setting {key}" + (f"; did you mean {near[0]}?" if near else ""))
    return flat


def resolve(setting: Setting, flag: Any, env: Any, file: Any) -> Resolved:
    """An empty or bad value of a lower layer is refused and noted; a bad flag is an error."""
    refused: list[str] = []
    for origin, value in (("flag", flag), ("env", env), ("file", file)):
        if value is None:
            continue
        try:
            if str(value).strip() == "":
                raise ValueError("empty")
            return Resolved(setting.convert(value), origin, tuple(refused))
        except (ValueError, KeyError):
            if origin == "flag":
                raise ValueError(f"{setting.key}: {value!r}") from None
            refused.append(origin)
    return Resolved(setting.default, "default", tuple(refused))


def resolve_columns(flag: Column, env: Column, file: Column, default: Column) -> Column:
    """struct(value, origin) by rows."""
    given = [F.nullif(F.trim(c), F.lit("")) for c in (flag, env, file)]
    origin = F.when(given[0].isNotNull(), "flag").when(given[1].isNotNull(), "env").when(given[2].isNotNull(), "file").otherwise("default")
    return F.struct(F.coalesce(*given, default).alias("value"), origin.alias("origin"))


def phases(all_phases: list[str], chosen: str | None, changes: list[str]) -> list[str]:
    """The chosen phases, then +name and -name from left to right; both for one name is an error."""
    now = [p for p in all_phases if p in (chosen.split(",") if chosen else all_phases)]
    if {c[1:] for c in changes if c[0] == "+"} & {c[1:] for c in changes if c[0] == "-"}:
        raise ValueError("a phase is both added and removed")
    for change in changes:
        if change[1:] not in all_phases:
            raise ValueError(f"unknown phase {change[1:]}")
        now = [p for p in all_phases if (p in now or p == change[1:]) and not (change[0] == "-" and p == change[1:])]
    return now
