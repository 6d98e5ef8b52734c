"""Declared record models: one declaration gives the schema that is read, the defaults of what a record leaves out, the
typed columns of a table, and a JSON schema for those who write such records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_JSON_KINDS = {"string": "string", "bigint": "integer", "int": "integer", "double": "number", "boolean": "boolean"}


@dataclass(frozen=True)
class Field:
    """A field by its name in tables, its SQL type, its name in records, and the value it has where a record lacks it.

    ``blank``: an empty string counts as absent."""

    name: str
    kind: str
    wire: str | None = None
    default: object = None
    blank: bool = False
    required: bool = False
    note: str = ""

    @property
    def key(self) -> str:
        return self.wire or self.name


@dataclass(frozen=True)
class Model:
    """Fields in the order of their columns."""

    fields: tuple[Field, ...]

    def __post_init__(self):
        for names in ([f.name for f in self.fields], [f.key for f in self.fields]):
            if len(set(names)) < len(names):
                raise ValueError(f"fields of one name: {names}")

    @classmethod
    def of(cls, fields: str) -> Model:
        """A model without defaults from ``name type, name type``."""
        return cls(tuple(Field(*f.split(None, 1)) for f in fields.split(", ")))

    def wire_schema(self) -> str:
        """The struct that records are read with; nothing in it is required."""
        return f"struct<{', '.join(f'`{f.key}`: {f.kind}' for f in self.fields)}>"

    def schema(self) -> str:
        return f"struct<{', '.join(f'`{f.name}`: {f.kind}' for f in self.fields)}>"

    def _value(self, record: Column, f: Field) -> Column:
        value = record[f.key]
        if f.blank:
            value = F.when(value != "", value)
        return value if f.default is None else F.coalesce(value, F.lit(f.default).cast(f.kind))

    def resolved(self, record: Column) -> Column:
        """A record read with ``wire_schema`` as the table's struct, defaults filled in; null for a null record."""
        return F.when(record.isNotNull(), F.struct(*(self._value(record, f).alias(f.name) for f in self.fields)))

    def columns(self, value: Column | None, prefix: str = "") -> list[Column]:
        """A column a field, out of a resolved struct; typed nulls without one."""
        return [(F.lit(None) if value is None else value[f.name]).cast(f.kind).alias(f"{prefix}{f.name}") for f in self.fields]

    def incomplete(self, record: Column) -> Column:
        """Names of required fields that a record lacks."""
        lacking = [F.when(record[f.key].isNull(), F.lit(f.key)) for f in self.fields if f.required]
        return F.array_compact(F.array(*lacking)) if lacking else F.array().cast("array<string>")

    def json_schema(self, children: str | None = None, levels: int = 4) -> dict:
        """The JSON schema of a record with nothing referred to; ``children`` names a list of records of the same kind,
        written out ``levels`` times and null below."""
        out: dict = {"type": "object", "additionalProperties": False, "properties": {}, "required": [f.key for f in self.fields if f.required]}
        for f in self.fields:
            inner = f.kind.removeprefix("array<").removesuffix(">")
            kind = {"type": "array", "items": {"type": _JSON_KINDS.get(inner, "string")}} if f.kind.startswith("array<") else {"type": _JSON_KINDS.get(f.kind, "string")}
            out["properties"][f.key] = kind | ({"description": f.note} if f.note else {})
        if children:
            below = self.json_schema(children, levels - 1) if levels > 1 else {"type": "null"}
            out["properties"][children] = {"type": "array", "items": below}
        return out
