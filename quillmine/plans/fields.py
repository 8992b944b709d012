"""Extraction fields given as a flat list, as JSON Schema and as a Spark type."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

# The types of leaves in JSON Schema and in Spark.
LEAVES = {
    "string": ({"type": "string"}, "string"), "integer": ({"type": "integer"}, "bigint"), "float": ({"type": "number"}, "double"), "boolean": ({"type": "boolean"}, "boolean"),
    "list[string]": ({"type": "array", "items": {"type": "string"}}, "array<string>"), "list[integer]": ({"type": "array", "items": {"type": "integer"}}, "array<bigint>"),
}
NESTED = ("object", "list[object]")


@dataclass
class Field:
    name: str
    type: str
    description: str = ""
    required: bool = True
    parent: str | None = None
    values: list[str] = field(default_factory=list)


def check(fields: Iterable[Field]) -> None:
    """ValueError on repeated names, unknown types, enums without values, and parents that are missing or go round."""
    by = {}
    for f in fields:
        if f.name in by:
            raise ValueError(f"field {f.name!r} is defined twice")
        if f.type not in (*LEAVES, "enum", *NESTED):
            raise ValueError(f"field {f.name!r} has the unknown type {f.type!r}")
        if f.type == "enum" and not f.values:
            raise ValueError(f"field {f.name!r} is an enum without values")
        by[f.name] = f
    for f in by.values():
        seen, up = {f.name}, f.parent
        while up:
            if up not in by:
                raise ValueError(f"the parent {up!r} of field {f.name!r} does not exist")
            if up in seen:
                raise ValueError(f"the parents of field {f.name!r} go round in a circle")
            seen.add(up)
            up = by[up].parent


def _object(fields: list[Field], parent: str | None) -> dict:
    own = [f for f in fields if f.parent == parent]

    def one(f: Field) -> dict:
        if f.type in NESTED:
            inner = _object(fields, f.name)
            return inner if f.type == "object" else {"type": "array", "items": inner}
        return {"type": "string", "enum": list(f.values)} if f.type == "enum" else dict(LEAVES[f.type][0])

    out = {"type": "object", "properties": {f.name: one(f) | {"description": f.description} for f in own}, "additionalProperties": False}
    needed = [f.name for f in own if f.required]
    return out | ({"required": needed} if needed else {})


def json_schema(fields: list[Field], name: str) -> dict:
    check(fields)
    return {"type": "json_schema", "json_schema": {"name": name, "strict": True, "schema": _object(fields, None)}}


def spark_type(fields: list[Field], parent: str | None = None) -> str:
    """The fields as a Spark struct, for from_json."""
    if parent is None:
        check(fields)

    def one(f: Field) -> str:
        if f.type in NESTED:
            inner = spark_type(fields, f.name)
            return inner if f.type == "object" else f"array<{inner}>"
        return "string" if f.type == "enum" else LEAVES[f.type][1]

    return f"struct<{','.join(f'`{f.name}`:{one(f)}' for f in fields if f.parent == parent)}>"


def problems(record: object, fields: list[Field], parent: str | None = None, at: str = "") -> list[str]:
    """Where an extracted record departs from its fields: what is missing, of another type, or not foreseen."""
    own = {f.name: f for f in fields if f.parent == parent}
    if not isinstance(record, dict):
        return [f"{at or 'record'} is no object"]
    out = [f"{at}{name} is not foreseen" for name in record if name not in own]
    kinds = {"string": str, "integer": int, "float": (int, float), "boolean": bool}
    for name, f in own.items():
        here, value = f"{at}{name}", record.get(name)
        if value is None:
            out += [f"{here} is missing"] * (f.required and name not in record)
        elif f.type == "object":
            out += problems(value, fields, name, f"{here}.")
        elif f.type == "list[object]":
            out += [p for i, v in enumerate(value) for p in problems(v, fields, name, f"{here}[{i}].")] if isinstance(value, list) else [f"{here} is no list"]
        elif f.type == "enum":
            out += [f"{here} is none of its values"] * (value not in f.values)
        else:
            inner = f.type.removeprefix("list[").removesuffix("]")
            good = lambda v, inner=inner: isinstance(v, kinds[inner]) and (inner == "boolean" or not isinstance(v, bool))
            fits = isinstance(value, list) and all(map(good, value)) if f.type.startswith("list[") else good(value)
            out += [] if fits else [f"{here} is no {f.type}"]
    return out


def model_class(fields: list[Field], name: str = "Record"):
    """The fields as a pydantic model, nested ones as models of their own; what is not foreseen is refused."""
    from typing import Literal

    from pydantic import ConfigDict, create_model  # optional: only this function needs it

    check(fields)
    kinds = {"string": str, "integer": int, "float": float, "boolean": bool}

    def of(f: Field):
        if f.type in NESTED:
            inner = build(f.name, f"{name}_{f.name}")
            return inner if f.type == "object" else list[inner]
        if f.type == "enum":
            return Literal[tuple(f.values)]
        return list[kinds[f.type[5:-1]]] if f.type.startswith("list[") else kinds[f.type]

    def build(parent: str | None, title: str):
        own = {f.name: (of(f), ...) if f.required else (of(f) | None, None) for f in fields if f.parent == parent}
        return create_model(title, __config__=ConfigDict(extra="forbid"), **own)

    return build(None, name)
