"""Types of the document model: scalars, compound types, their order of generality, their
Spark types, and their JSON forms.

A declared type is a plain value::

    Scalar("int")    ListOf(t)    Nullable(t)    Named("movies")    Predicate("movies")
"""

from __future__ import annotations

import base64
import datetime as dt
import decimal
import json
import math
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from .errors import InvalidArgument, ResponseMismatch, SchemaError

ANY, UNDEFINED = "extendedJSON", "undefined"

#: Scalar types, with whether they are numeric, can be ordered, and can be compared.
SCALARS: dict[str, tuple[bool, bool, bool]] = {
    "double": (True, True, True),
    "decimal": (True, True, True),
    "int": (True, True, True),
    "long": (True, True, True),
    "string": (False, True, True),
    "date": (False, True, True),
    "timestamp": (False, True, True),
    "binData": (False, False, True),
    "uuid": (False, False, True),
    "objectId": (False, False, True),
    "bool": (False, False, True),
    "null": (False, False, True),
    "undefined": (False, False, True),
    "regex": (False, False, False),
    "javascript": (False, False, False),
    "javascriptWithScope": (False, False, False),
    "minKey": (False, False, True),
    "maxKey": (False, False, True),
    "dbPointer": (False, False, True),
    "symbol": (False, False, True),
    "extendedJSON": (True, True, True),
}
FRACTIONAL = {"double", "decimal", ANY}
DECIMAL = T.DecimalType(38, 10)


def is_numeric(name: str) -> bool:
    return SCALARS[name][0]


def is_orderable(name: str) -> bool:
    return SCALARS[name][1]


def is_comparable(name: str) -> bool:
    return SCALARS[name][2]


def comparison_operators(name: str) -> list[str]:
    """Names of the comparisons that a scalar type has."""
    out = ["_eq", "_neq", "_in", "_nin"] if is_comparable(name) else []
    out += ["_lt", "_lte", "_gt", "_gte"] if is_orderable(name) else []
    return out + (["_regex", "_iregex"] if name in ("string", ANY) else [])


def aggregate_functions(name: str) -> list[str]:
    out = ["min", "max"] if is_orderable(name) else []
    return ["count", *out, *(["avg", "sum"] if is_numeric(name) else [])]


def aggregate_result(function: str, name: str) -> str:
    """Scalar type of an aggregate over a column of a scalar type."""
    if function == "count":
        return "int"
    if function == "avg":
        return "double"
    if function == "sum":
        return "double" if name in FRACTIONAL else "long"
    return name


# -- declared types -----------------------------------------------------------------------


@dataclass(frozen=True)
class Scalar:
    name: str

    def __post_init__(self) -> None:
        if self.name not in SCALARS:
            raise SchemaError(f"unknown scalar type: {self.name}")


@dataclass(frozen=True)
class ListOf:
    element: Type


@dataclass(frozen=True)
class Nullable:
    inner: Type


@dataclass(frozen=True)
class Named:
    """An object type, by name."""

    name: str


@dataclass(frozen=True)
class Predicate:
    """A condition on objects of a type; only arguments have it."""

    object_type: str


Type = Scalar | ListOf | Nullable | Named | Predicate
TOP, BOTTOM = Scalar(ANY), Scalar(UNDEFINED)


@dataclass
class ObjectType:
    fields: dict[str, Type] = field(default_factory=dict)
    description: str | None = None


def normalise(t: Type) -> Type:
    """No nullable of a nullable, of the any type, of null or of undefined."""
    match t:
        case Nullable(inner):
            inner = normalise(inner)
            if isinstance(inner, Nullable) or inner in (TOP, BOTTOM, Scalar("null")):
                return inner
            return Nullable(inner)
        case ListOf(element):
            return ListOf(normalise(element))
    return t


def unify_scalars(a: str, b: str) -> str:
    """Least scalar type above both: undefined is below all, extendedJSON above all."""
    if a == b or b == UNDEFINED:
        return a
    if a == UNDEFINED:
        return b
    pair = {a, b}
    if pair == {"int", "double"}:
        return "double"
    if pair == {"uuid", "binData"}:
        return "binData"
    return ANY


def unify(a: Type, b: Type) -> Type:
    """Least type above both.  Commutative and associative; undefined is neutral, the any
    type absorbs, null makes the other nullable.  Different object types have no type above
    them but any: those of one path share a name and are unified by their fields."""
    a, b = normalise(a), normalise(b)
    if a == BOTTOM:
        return b
    if b == BOTTOM:
        return a
    if TOP in (a, b):
        return TOP
    null = Scalar("null")
    if a == null or b == null:
        return normalise(Nullable(b if a == null else a)) if a != b else null
    if isinstance(a, Nullable) or isinstance(b, Nullable):
        strip = lambda t: t.inner if isinstance(t, Nullable) else t
        return normalise(Nullable(unify(strip(a), strip(b))))
    match a, b:
        case Scalar(x), Scalar(y):
            return Scalar(unify_scalars(x, y))
        case ListOf(x), ListOf(y):
            return ListOf(unify(x, y))
    return a if a == b else TOP


def unify_objects(a: ObjectType, b: ObjectType) -> ObjectType:
    """Fields of both; one that only one side has becomes nullable."""
    out: dict[str, Type] = {}
    for name in dict.fromkeys([*a.fields, *b.fields]):
        if name in a.fields and name in b.fields:
            out[name] = unify(a.fields[name], b.fields[name])
        else:
            out[name] = normalise(Nullable(a.fields.get(name) or b.fields[name]))
    return ObjectType(out, a.description or b.description)


def type_json(t: Type) -> dict:
    match t:
        case Scalar(name):
            return {"scalar": name}
        case ListOf(element):
            return {"arrayOf": type_json(element)}
        case Nullable(inner):
            return {"nullable": type_json(inner)}
        case Named(name):
            return {"object": name}
        case Predicate(name):
            return {"predicate": {"objectTypeName": name}}
    raise SchemaError(f"not a type: {t!r}")


def type_from(tree: Any) -> Type:
    if tree == ANY:
        return TOP
    match tree:
        case {"scalar": name}:
            return Scalar(name)
        case {"arrayOf": element}:
            return normalise(ListOf(type_from(element)))
        case {"nullable": inner}:
            return normalise(Nullable(type_from(inner)))
        case {"object": name}:
            return Named(name)
        case {"predicate": {"objectTypeName": name}}:
            return Predicate(name)
    raise SchemaError(f"not a type: {tree!r}")


# -- Spark types ----------------------------------------------------------------------------

_SPARK: dict[str, T.DataType] = {
    "double": T.DoubleType(),
    "decimal": DECIMAL,
    "int": T.IntegerType(),
    "long": T.LongType(),
    "string": T.StringType(),
    "date": T.TimestampType(),
    "timestamp": T.StructType([T.StructField("t", T.IntegerType()), T.StructField("i", T.IntegerType())]),
    "binData": T.StructType([T.StructField("base64", T.BinaryType()), T.StructField("subType", T.StringType())]),
    "uuid": T.StringType(),
    "objectId": T.StringType(),
    "bool": T.BooleanType(),
    "null": T.NullType(),
    "undefined": T.NullType(),
    "regex": T.StructType([T.StructField("pattern", T.StringType()), T.StructField("options", T.StringType())]),
    "extendedJSON": T.VariantType(),
}


def spark_type(t: Type, objects: Mapping[str, ObjectType]) -> T.DataType:
    match t:
        case Scalar(name):
            return _SPARK.get(name, T.StringType())
        case ListOf(element):
            return T.ArrayType(spark_type(element, objects), True)
        case Nullable(inner):
            return spark_type(inner, objects)
        case Named(name):
            if name not in objects:
                raise SchemaError(f"unknown object type: {name}")
            return spark_struct(objects[name], objects)
    raise SchemaError(f"no column can be {t!r}")


def spark_struct(t: ObjectType, objects: Mapping[str, ObjectType]) -> T.StructType:
    """Every field of a nested object may be missing, so all are nullable."""
    return T.StructType([T.StructField(n, spark_type(f, objects), True) for n, f in t.fields.items()])


def from_spark(t: T.DataType, name: str, objects: dict[str, ObjectType], nullable: bool = True) -> Type:
    """Declared type of a Spark type; structs become object types named after their path."""
    match t:
        case T.StructType():
            objects[name] = ObjectType({f.name: from_spark(f.dataType, f"{name}_{f.name}", objects, f.nullable) for f in t.fields})
            out: Type = Named(name)
        case T.ArrayType():
            out = ListOf(from_spark(t.elementType, name, objects, False))
        case T.ByteType() | T.ShortType() | T.IntegerType():
            out = Scalar("int")
        case T.LongType():
            out = Scalar("long")
        case T.FloatType() | T.DoubleType():
            out = Scalar("double")
        case T.DecimalType():
            out = Scalar("decimal")
        case T.BooleanType():
            out = Scalar("bool")
        case T.DateType() | T.TimestampType() | T.TimestampNTZType():
            out = Scalar("date")
        case T.BinaryType():
            out = Scalar("binData")
        case T.NullType():
            out = Scalar("null")
        case T.StringType() | T.VarcharType() | T.CharType():
            out = Scalar("string")
        case _:
            out = TOP
    return normalise(Nullable(out)) if nullable else out


# -- JSON forms -------------------------------------------------------------------------------

_HEX24 = re.compile(r"^[0-9a-f]{24}$")
_UUID = re.compile(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")


def iso(value: dt.datetime) -> str:
    """UTC, with milliseconds."""
    naive = value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value
    return naive.isoformat(timespec="milliseconds") + "Z"


def parse_iso(text: str) -> dt.datetime:
    found = dt.datetime.fromisoformat(text)
    found = found if found.tzinfo else found.replace(tzinfo=dt.UTC)
    found = found.astimezone(dt.UTC)
    return found.replace(microsecond=found.microsecond // 1000 * 1000)


def to_json(value: Any, t: Type, objects: Mapping[str, ObjectType]) -> Any:
    """JSON form of a value by its declared type.  64-bit and decimal numbers are strings."""
    match t:
        case Nullable(inner):
            return None if value is None else to_json(value, inner, objects)
        case ListOf(element):
            if not isinstance(value, (list, tuple)):
                raise ResponseMismatch(f"expected a list, not {value!r}")
            return [to_json(v, element, objects) for v in value]
        case Named(name):
            row = value.asDict() if hasattr(value, "asDict") else value
            if not isinstance(row, Mapping):
                raise ResponseMismatch(f"expected {name}, not {value!r}")
            out = {}
            for n, f in objects[name].fields.items():
                if row.get(n) is not None or not isinstance(f, Nullable):
                    out[n] = to_json(row.get(n), f, objects)
                else:
                    out[n] = None
            return out
        case Scalar(name):
            return _scalar_to_json(value, name)
    raise ResponseMismatch(f"no value can be {t!r}")


_PYTHON: dict[str, tuple[type, ...]] = {"double": (float, int), "int": (int,), "long": (int,), "decimal": (decimal.Decimal, int), "string": (str,), "symbol": (str,), "javascript": (str,), "bool": (bool,), "uuid": (str,), "objectId": (str,), "date": (dt.datetime,), "null": (type(None),), "undefined": (type(None),)}


def _scalar_to_json(value: Any, name: str) -> Any:
    want = _PYTHON.get(name)
    if want and (not isinstance(value, want) or isinstance(value, bool) and name != "bool"):
        raise ResponseMismatch(f"expected {name}, not {value!r}")
    if name in ("long", "decimal"):
        return str(value)
    if name == "double":
        return value if math.isfinite(value) else None
    if name == "date":
        return iso(value)
    if name == "binData":
        return {"base64": base64.b64encode(value["base64"]).decode(), "subType": value["subType"]} if isinstance(value, Mapping) else {"base64": base64.b64encode(value).decode(), "subType": "00"}
    if name == ANY:
        return tagged(value)
    if name in ("minKey", "maxKey"):
        return {}
    return value


def from_json(value: Any, t: Type, objects: Mapping[str, ObjectType]) -> Any:
    """Python value of a JSON form by its declared type; the inverse of to_json()."""
    match t:
        case Nullable(inner):
            return None if value is None else from_json(value, inner, objects)
        case ListOf(element):
            if not isinstance(value, list):
                raise InvalidArgument(f"expected a list, not {value!r}")
            return [from_json(v, element, objects) for v in value]
        case Named(name):
            if not isinstance(value, dict):
                raise InvalidArgument(f"expected {name}, not {value!r}")
            return {n: from_json(value.get(n), f, objects) for n, f in objects[name].fields.items()}
        case Scalar(name):
            try:
                return _scalar_from_json(value, name)
            except (TypeError, ValueError, KeyError, decimal.InvalidOperation) as error:
                raise InvalidArgument(f"expected {name}, not {value!r}") from error
    raise InvalidArgument(f"no value can be {t!r}")


def _scalar_from_json(value: Any, name: str) -> Any:
    if name in ("int", "long"):
        number = int(value)
        if isinstance(value, (bool, float)) or not -(2 ** (31 if name == "int" else 63)) <= number < 2 ** (31 if name == "int" else 63):
            raise ValueError(value)
        return number
    if name == "double":
        return float("nan") if value is None else float(value)
    if name == "decimal":
        return decimal.Decimal(str(value))
    if name == "date":
        return parse_iso(value)
    if name == "binData":
        return {"base64": base64.b64decode(value["base64"]), "subType": value["subType"]}
    if name == "objectId" and not _HEX24.match(value):
        raise ValueError(value)
    if name == "uuid":
        if not _UUID.match(value.lower()):
            raise ValueError(value)
        return value.lower()
    if name == "bool" and not isinstance(value, bool) or name in ("string", "symbol", "javascript") and not isinstance(value, str):
        raise ValueError(value)
    if name in ("null", "undefined") and value is not None:
        raise ValueError(value)
    return untagged(value) if name == ANY else value


def tagged(value: Any, relaxed: bool = True) -> Any:
    """Extended JSON of a value.  Relaxed form writes numbers as numbers."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, int):
        small = -(2**31) <= value < 2**31
        return value if relaxed else {"$numberInt" if small else "$numberLong": str(value)}
    if isinstance(value, float):
        if relaxed and math.isfinite(value):
            return value
        text = repr(value) if math.isfinite(value) else "NaN" if math.isnan(value) else "Infinity" if value > 0 else "-Infinity"
        return {"$numberDouble": text}
    if isinstance(value, decimal.Decimal):
        return {"$numberDecimal": str(value)}
    if isinstance(value, dt.datetime):
        if relaxed:
            return {"$date": iso(value)}
        naive = value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value
        return {"$date": {"$numberLong": str((naive - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1))}}
    if isinstance(value, (bytes, bytearray)):
        return {"$binary": {"base64": base64.b64encode(value).decode(), "subType": "00"}}
    if hasattr(value, "asDict"):
        value = value.asDict()
    if hasattr(value, "toPython"):
        value = value.toPython()
    if isinstance(value, Mapping):
        return {k: tagged(v, relaxed) for k, v in value.items()}
    if isinstance(value, Iterable):
        return [tagged(v, relaxed) for v in value]
    return value if isinstance(value, (int, float)) else str(value)


def untagged(tree: Any) -> Any:
    """Python value of extended JSON."""
    match tree:
        case {"$numberInt": text} | {"$numberLong": text}:
            return int(text)
        case {"$numberDouble": text}:
            return float(text)
        case {"$numberDecimal": text}:
            return decimal.Decimal(text)
        case {"$date": {"$numberLong": text}}:
            return dt.datetime(1970, 1, 1, tzinfo=dt.UTC) + dt.timedelta(milliseconds=int(text))
        case {"$date": str() as text}:
            return parse_iso(text)
        case {"$oid": text}:
            return text
        case {"$uuid": text}:
            return text.lower()
        case {"$binary": {"base64": text}}:
            return base64.b64decode(text)
        case dict():
            return {k: untagged(v) for k, v in tree.items()}
        case list():
            return [untagged(v) for v in tree]
    return tree


# -- rows of relational queries ------------------------------------------------------------------


def encode_value(value: Any, kind: T.DataType) -> Any:
    """JSON form of one value of a relational row: nested values become JSON text."""
    if value is None:
        return None
    match kind:
        case T.LongType() | T.DecimalType():
            return str(value)
        case T.DoubleType() | T.FloatType():
            return value if math.isfinite(value) else None
        case T.TimestampType() | T.TimestampNTZType():
            return iso(value)
        case T.DateType():
            return iso(dt.datetime(value.year, value.month, value.day))
        case T.BinaryType():
            return {"base64": base64.b64encode(value).decode(), "subType": "00"}
        case T.StructType() | T.ArrayType() | T.MapType() | T.VariantType():
            return json.dumps(_inner(value, kind), ensure_ascii=False, separators=(",", ":"))
    return value


def _inner(value: Any, kind: T.DataType) -> Any:
    if value is None:
        return None
    match kind:
        case T.StructType():
            return {f.name: _inner(value[f.name], f.dataType) for f in kind.fields}
        case T.ArrayType():
            return [_inner(v, kind.elementType) for v in value]
        case T.MapType():
            return {str(k): _inner(v, kind.valueType) for k, v in value.items()}
        case T.VariantType():
            return tagged(value)
    return encode_value(value, kind)


def encode_row(row: Any, schema: T.StructType) -> list[Any]:
    return [encode_value(v, f.dataType) for v, f in zip(row, schema.fields, strict=True)]
