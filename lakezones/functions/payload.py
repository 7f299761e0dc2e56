"""Text columns out of a JSON payload, all from one parse.

Each field says which paths it needs and how to build its column from the parsed payload.
``payload_schema`` joins the paths of all fields, so that the payload is parsed once however
many columns are taken from it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakezones.fixed_values import EMAIL_LENGTH, NAME_LENGTH
from lakezones.specs import quoted

Path = tuple[str, ...]
LIST = "[]"


class PayloadField(Protocol):
    alias: str

    def paths(self) -> list[Path]: ...

    def column(self, payload: Column) -> Column: ...


def clean_text(value: Column, length: int | None) -> Column:
    """Trimmed, cut to ``length`` characters if one is given, never null."""
    trimmed = F.trim(value)
    return F.coalesce(trimmed if length is None else F.left(trimmed, F.lit(length)), F.lit(""))


def at(payload: Column, path: Path) -> Column:
    for step in path:
        payload = payload.getField(step)
    return payload


@dataclass(frozen=True)
class TextField:
    """One text at ``path``, whole if ``length`` is None."""

    alias: str
    path: Path
    length: int | None = NAME_LENGTH

    def paths(self) -> list[Path]:
        return [self.path]

    def column(self, payload: Column) -> Column:
        return clean_text(at(payload, self.path), self.length)


@dataclass(frozen=True)
class JoinedField:
    """Several texts put together; empty as soon as one of them is missing."""

    alias: str
    parts: tuple[Path, ...]
    separator: str = " "
    length: int = NAME_LENGTH

    def paths(self) -> list[Path]:
        return list(self.parts)

    def column(self, payload: Column) -> Column:
        pieces: list[Column] = []
        for path in self.parts:
            pieces += [F.lit(self.separator)] if pieces else []
            pieces.append(at(payload, path))
        return clean_text(F.concat(*pieces), self.length)


@dataclass(frozen=True)
class ListField:
    """The distinct non-empty ``item`` texts of an array of objects, in order of appearance."""

    alias: str
    path: Path
    item: str
    separator: str = ","
    length: int = EMAIL_LENGTH

    def paths(self) -> list[Path]:
        return [(*self.path, LIST, self.item)]

    def column(self, payload: Column) -> Column:
        texts = F.transform(
            at(payload, self.path), lambda entry: F.trim(F.coalesce(entry.getField(self.item), F.lit("")))
        )
        kept = F.array_distinct(F.filter(texts, lambda text: text != ""))
        return clean_text(F.concat_ws(self.separator, kept), self.length)


def payload_schema(fields: Iterable[PayloadField]) -> T.StructType:
    """The smallest schema that holds every path of ``fields``."""
    tree: dict = {}
    for field in fields:
        for path in field.paths():
            node = tree
            for step in path:
                node = node.setdefault(step, {})
    return _schema_of(tree)


def _schema_of(tree: dict) -> T.DataType:
    if not tree:
        return T.StringType()
    if LIST in tree:
        return T.ArrayType(_schema_of(tree[LIST]))
    return T.StructType([T.StructField(name, _schema_of(below)) for name, below in tree.items()])


def extract_fields(
    df: DataFrame, fields: Iterable[PayloadField], content: str = "content", keep: Iterable[str] | None = None
) -> DataFrame:
    """Replace the payload column by the columns of ``fields``.

    ``keep`` names the other columns to carry on, by default all of them.
    """
    fields = list(fields)
    kept = [c for c in df.columns if c.lower() != content.lower()] if keep is None else list(keep)
    scratch = "_payload"
    while scratch in df.columns:
        scratch = "_" + scratch
    parsed = df.withColumn(scratch, F.from_json(F.col(quoted(content)), payload_schema(fields)))
    return parsed.select(*map(quoted, kept), *[field.column(F.col(scratch)).alias(field.alias) for field in fields])
