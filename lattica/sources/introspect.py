"""Schemas from samples, from validators, and from Spark schemas.

Samples are documents: dictionaries as a document store or a JSON file gives them, in which
one field can have values of many types.  Each document gives types; they are unified.
"""

from __future__ import annotations

import datetime as dt
import decimal
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import SchemaError
from ..types import ANY, BOTTOM, SCALARS, TOP, ListOf, Named, Nullable, ObjectType, Predicate, Scalar, Type, from_spark, normalise, type_from, type_json, unify, unify_objects

Objects = dict[str, ObjectType]

SAMPLE_SIZE = 10_000
SAMPLE_SEED = 5


@dataclass
class CollectionSchema:
    name: str
    type: str
    objects: Objects = field(default_factory=dict)
    description: str | None = None


# -- sampling --------------------------------------------------------------------------------


def type_of_value(value: Any, name: str, objects: Objects, all_nullable: bool) -> Type:
    """Type of one value; objects in it are added under names made from the path."""
    if value is None:
        return Scalar("null")
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, Mapping):
        if tagged := _extended(value):
            return Scalar(tagged)
        add_object(value, name, objects, all_nullable)
        return Named(name)
    if isinstance(value, (list, tuple)):
        element: Type = BOTTOM
        for v in value:
            element = unify(element, type_of_value(v, name, objects, all_nullable))
        return ListOf(element)
    if isinstance(value, bool):
        return Scalar("bool")
    if isinstance(value, int):
        return Scalar("int" if -(2**31) <= value < 2**31 else "long")
    if isinstance(value, float):
        return Scalar("double")
    if isinstance(value, decimal.Decimal):
        return Scalar("decimal")
    if isinstance(value, (dt.datetime, dt.date)):
        return Scalar("date")
    if isinstance(value, (bytes, bytearray)):
        return Scalar("binData")
    return Scalar("string") if isinstance(value, str) else TOP


_TAGS = {"$oid": "objectId", "$numberInt": "int", "$numberLong": "long", "$numberDouble": "double", "$numberDecimal": "decimal", "$date": "date", "$binary": "binData", "$uuid": "uuid", "$regularExpression": "regex", "$timestamp": "timestamp", "$symbol": "symbol", "$minKey": "minKey", "$maxKey": "maxKey", "$undefined": "undefined"}


def _extended(value: Mapping) -> str | None:
    return _TAGS.get(next(iter(value))) if len(value) == 1 else None


def add_object(document: Mapping, name: str, objects: Objects, all_nullable: bool, top: bool = False) -> None:
    fields: dict[str, Type] = {}
    for key, value in document.items():
        found = type_of_value(value, f"{name}_{key}", objects, all_nullable)
        # the id of a collection's documents is always there
        fields[key] = found if top and key == "_id" or not all_nullable else normalise(Nullable(found))
    own = ObjectType(fields)
    objects[name] = unify_objects(objects[name], own) if name in objects else own


def sample_documents(name: str, documents: Iterable[Mapping], all_nullable: bool = True, type_name: str | None = None) -> CollectionSchema | None:
    """The schema that all documents meet; None if there is none to look at."""
    type_name, each = type_name or name, []
    for d in documents:
        objects: Objects = {}
        add_object(d, type_name, objects, all_nullable, top=True)
        each.append(objects)
    if not each:
        return None
    return CollectionSchema(name, type_name, reduce(_merged, each))


def _merged(a: Objects, b: Objects) -> Objects:
    return {n: unify_objects(a[n], b[n]) if n in a and n in b else a.get(n) or b[n] for n in dict.fromkeys([*a, *b])}


def sample_frame(name: str, df: DataFrame, size: int = SAMPLE_SIZE, all_nullable: bool = True) -> CollectionSchema | None:
    """Schema of a table.  A column of JSON documents named ``document`` is sampled: ``size``
    rows at most, drawn from all of them (a scan that keeps the smallest of ``size`` random
    numbers a task); typed columns say what they are."""
    if df.columns == ["document"]:
        import json

        rows = df.select(F.col("document").cast("string")).filter(F.col("document").isNotNull()).orderBy(F.rand(SAMPLE_SEED)).limit(size).collect()
        return sample_documents(name, [json.loads(r[0]) for r in rows], all_nullable)
    if df.isEmpty():
        return None
    objects: Objects = {}
    from_spark(df.schema, name, objects, nullable=False)
    if not all_nullable:
        return CollectionSchema(name, name, objects)
    return CollectionSchema(name, name, {n: ObjectType({k: t if n == name and k == "_id" else normalise(Nullable(t)) for k, t in o.fields.items()}) for n, o in objects.items()})


def sample_all(tables: Mapping[str, Any], known: Mapping[str, CollectionSchema] | None = None, size: int = SAMPLE_SIZE, all_nullable: bool = True) -> tuple[dict[str, CollectionSchema], dict[str, str]]:
    """Schemas of collections, and why others were passed over: names of the system, empty
    ones, and ones that cannot be read.  Known schemas only grow."""
    found: dict[str, CollectionSchema] = {}
    skipped: dict[str, str] = {}
    for name, table in tables.items():
        if name.startswith("system."):
            skipped[name] = "reserved for the system"
            continue
        try:
            own = sample_frame(name, table() if callable(table) else table, size, all_nullable)
        except Exception as error:  # an unreadable collection must not end the others
            skipped[name] = f"unreadable: {type(error).__name__}"
            continue
        if own is None:
            skipped[name] = "empty"
            continue
        found[name] = keep_compatible(known[name], own) if known and name in known else own
    return found, skipped


def keep_compatible(existing: CollectionSchema, updated: CollectionSchema) -> CollectionSchema:
    """The existing schema and what is new: types that are there stay as they are, new fields
    and the object types that they need are added, nothing goes."""
    out: Objects = {}
    if existing.type != updated.type:
        updated = CollectionSchema(updated.name, existing.type, {(existing.type if n == updated.type else n): o for n, o in updated.objects.items()})

    def visit(name: str) -> None:
        if name in out:
            return
        old, new = existing.objects.get(name), updated.objects.get(name)
        if old is None and new is None:
            return
        fields = dict(old.fields) if old else {}
        for key, kind in (new.fields if new else {}).items():
            fields.setdefault(key, kind)
        out[name] = ObjectType(fields, (old.description if old else None) or (new.description if new else None))
        for kind in fields.values():
            for used in named_in(kind):
                visit(used)

    visit(existing.type)
    for name in existing.objects:
        visit(name)
    return CollectionSchema(existing.name, existing.type, out, existing.description or updated.description)


def named_in(t: Type) -> list[str]:
    match t:
        case Named(name):
            return [name]
        case Nullable(inner):
            return named_in(inner)
        case ListOf(element):
            return named_in(element)
        case Predicate(name):
            return [name]
    return []


# -- validators --------------------------------------------------------------------------------


def from_validator(name: str, validator: Mapping[str, Any]) -> CollectionSchema:
    """Schema of a collection's JSON-schema validator: what it does not require is nullable,
    an object with no list of properties is of any type, and there is always an ``_id``."""
    schema = validator.get("$jsonSchema", validator)
    objects: Objects = {}
    _validated(schema, name, objects)
    own = objects.setdefault(name, ObjectType())
    if "_id" not in own.fields:
        own.fields = {"_id": Scalar("objectId"), **own.fields}
    return CollectionSchema(name, name, objects, schema.get("description"))


def _validated(schema: Mapping[str, Any], name: str, objects: Objects) -> Type:
    kind = schema.get("bsonType", schema.get("type"))
    if isinstance(kind, (list, tuple)):
        null = "null" in kind
        rest = [_validated({**schema, "bsonType": k}, name, objects) for k in kind if k != "null"]
        found = reduce(unify, rest, BOTTOM) if rest else Scalar("null")
        return normalise(Nullable(found)) if null else found
    if kind == "object" or kind is None and "properties" in schema:
        properties = schema.get("properties")
        if not properties:
            return TOP
        required = set(schema.get("required", ()))
        fields: dict[str, Type] = {}
        for key, own in properties.items():
            found = _validated(own, f"{name}_{key}", objects)
            fields[key] = found if key in required else normalise(Nullable(found))
        objects[name] = ObjectType(fields, schema.get("description"))
        return Named(name)
    if kind == "array":
        items = schema.get("items")
        if isinstance(items, (list, tuple)):
            return ListOf(reduce(unify, [_validated(i, name, objects) for i in items], BOTTOM))
        return ListOf(_validated(items, name, objects) if items else TOP)
    if kind == "number":
        return Scalar("double")
    if kind == "boolean":
        return Scalar("bool")
    if kind == "integer":
        return Scalar("int")
    return Scalar(kind) if kind in SCALARS else TOP


# -- documents of schemas ------------------------------------------------------------------------


def schema_json(c: CollectionSchema) -> dict:
    own: dict[str, Any] = {"type": c.type} | ({"description": c.description} if c.description else {})
    return {"name": c.name, "collections": {c.name: own}, "objectTypes": objects_json(c.objects)}


def objects_json(objects: Mapping[str, ObjectType]) -> dict:
    return {n: {"fields": {k: {"type": type_json(t)} for k, t in o.fields.items()}} | ({"description": o.description} if o.description else {}) for n, o in sorted(objects.items())}


def objects_from(tree: Mapping[str, Any]) -> Objects:
    out: Objects = {}
    for name, own in (tree or {}).items():
        if set(own) - {"fields", "description"}:
            raise SchemaError(f"object type {name} has unknown entries: {sorted(set(own) - {'fields', 'description'})}")
        out[name] = ObjectType({k: type_from(f["type"]) for k, f in own.get("fields", {}).items()}, own.get("description"))
    return out


def schema_from(tree: Mapping[str, Any]) -> list[CollectionSchema]:
    objects = objects_from(tree.get("objectTypes") or {})
    out = []
    for name, own in (tree.get("collections") or {}).items():
        if own["type"] not in objects:
            raise SchemaError(f"collection {name} has no object type {own['type']}")
        out.append(CollectionSchema(name, own["type"], objects, own.get("description")))
    return out


def any_typed(objects: Mapping[str, ObjectType]) -> dict[str, ObjectType]:
    """As the relational form sees it: nested values are of any type."""

    def flat(t: Type) -> Type:
        match t:
            case Nullable(inner):
                return normalise(Nullable(flat(inner)))
            case Scalar():
                return t
        return Scalar(ANY)

    return {n: ObjectType({k: flat(t) for k, t in o.fields.items()}, o.description) for n, o in objects.items()}


_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_.\-]*$")


def check_name(name: str) -> str:
    if not _NAME.match(name):
        raise SchemaError(f"not a name: {name!r}")
    return name
