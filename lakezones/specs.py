"""Table configuration."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """What a zone job must know about one table."""

    name: str
    primary_keys: tuple[str, ...] = ()
    timestamp_columns: tuple[str, ...] = ()
    sources: tuple[str, ...] = field(default=())

    @property
    def condition(self) -> str:
        """The match condition of the upsert, target ``old`` against batch ``new``."""
        return merge_condition(self.primary_keys)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    known = {column.lower() for column in columns}
    while name.lower() in known:
        name = "_" + name
    return name


def quoted_table(name: str | tuple[str, ...]) -> str:
    """Quote each part of a table name, so that names with hyphens or dots work.

    A string is split at its dots; pass a tuple when a part itself holds a dot.
    """
    parts = name.split(".") if isinstance(name, str) else name
    return ".".join(quoted(part.strip("`")) for part in parts)


def sql_text(text: str) -> str:
    """A text literal for SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def merge_condition(keys: tuple[str, ...] | list[str]) -> str:
    return " AND ".join(f"old.{quoted(key)} = new.{quoted(key)}" for key in keys)
