"""Building Spark SQL text from settings. One parsed expression replaces hundreds of column calls."""

from __future__ import annotations

from collections.abc import Iterable


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def listed(values: Iterable[str]) -> str:
    return ", ".join(text(v) for v in values)
