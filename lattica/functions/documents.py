"""Paths into documents, and conditions on them.

A path that crosses an array stands for the values in all its elements; a condition on it
holds if it holds for any of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import BadQuery, UnknownField


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def resolve(schema: T.StructType, path: Sequence[str], base: Column | None = None, strict: bool = True) -> tuple[Column, T.DataType]:
    """Column and type of a path.  Nested arrays on the way are flattened.  A field that is
    not there is an error, or null if not ``strict``."""
    name, rest = path[0], path[1:]
    if name not in schema.fieldNames():
        if strict:
            raise UnknownField(f"no field {name} among {', '.join(schema.fieldNames())}")
        return F.lit(None), T.NullType()
    column, kind = quoted(name) if base is None else base.getField(name), schema[name].dataType
    return _into(column, kind, rest, strict)


def _into(column: Column, kind: T.DataType, rest: Sequence[str], strict: bool) -> tuple[Column, T.DataType]:
    if not rest:
        return column, kind
    if isinstance(kind, T.StructType):
        return resolve(kind, rest, column, strict)
    if isinstance(kind, T.ArrayType):
        inner: list[T.DataType] = []

        def step(x: Column) -> Column:
            found, t = _into(x, kind.elementType, rest, strict)
            inner.append(t)
            return found

        out = F.transform(column, step)
        if isinstance(inner[0], T.ArrayType):
            return F.flatten(out), inner[0]
        return out, T.ArrayType(inner[0], True)
    if isinstance(kind, T.VariantType):
        steps = "".join("['" + p.replace("'", "\\'") + "']" for p in rest)
        return F.try_variant_get(column, "$" + steps, "variant"), kind
    if isinstance(kind, T.MapType):
        return _into(F.try_element_at(column, F.lit(rest[0])), kind.valueType, rest[1:], strict)
    if strict:
        raise UnknownField(f"{kind.simpleString()} has no field {rest[0]}")
    return F.lit(None), T.NullType()


def literal(value: Any, kind: T.DataType | None = None) -> Column:
    """A JSON value as a column; of the type of what it is compared with, where that helps."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (list, tuple)):
        element = kind.elementType if isinstance(kind, T.ArrayType) else None
        return F.array(*[literal(v, element) for v in value])
    if isinstance(value, dict):
        return F.struct(*[literal(v).alias(k) for k, v in value.items()])
    out = F.lit(value)
    if value is not None and isinstance(value, str) and isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.NumericType, T.BooleanType)):
        out = out.cast(kind)  # 64-bit numbers, decimals and dates come as text in JSON
    return out


def one_test(op: str, x: Column, y: Column, positive: bool = False) -> Column:
    """A comparison of single values, true or false; where null is as good as false
    (``positive``), plain comparisons, which reach the scan."""
    if op in ("eq", "neq"):
        return x.eqNullSafe(y) if op == "eq" else ~x.eqNullSafe(y)
    tests = {"lt": lambda: x < y, "lte": lambda: x <= y, "gt": lambda: x > y, "gte": lambda: x >= y, "regex": lambda: F.rlike(x.cast("string"), y), "iregex": lambda: F.rlike(x.cast("string"), F.concat(F.lit("(?i)"), y))}
    if op not in tests:
        raise BadQuery(f"no operator {op}")
    return tests[op]() if positive else F.coalesce(tests[op](), F.lit(False))


def any_of(x: Column, holds: Callable[[Column], Column]) -> Column:
    """Whether a condition holds for an element of an array; false for null."""
    return F.coalesce(F.exists(x, lambda e: holds(e)), F.lit(False))


def test(op: str, x: Column, kind: T.DataType, value: Any, positive: bool = False) -> Column:
    """A comparison with a value or a column; on an array, with any of its elements."""
    if op in ("in", "nin"):
        if isinstance(value, Column):
            found = F.coalesce(F.exists(value, lambda v: v.eqNullSafe(x)), F.lit(False))
        else:
            single = kind.elementType if isinstance(kind, T.ArrayType) else kind
            if isinstance(kind, T.ArrayType):
                found = F.lit(False)
                for v in value:
                    found = found | any_of(x, literal(v, single).eqNullSafe)
            elif value and all(v is not None for v in value):
                found = x.isin(*[literal(v, single) for v in value])
                found = found if positive and op == "in" else F.coalesce(found, F.lit(False))
            else:
                found = F.lit(False)
                for v in value:
                    found = found | x.eqNullSafe(literal(v, single))
        return found if op == "in" else ~found
    if isinstance(kind, T.ArrayType) and not isinstance(value, (list, tuple)):
        inner = kind.elementType
        if op == "neq":  # holds for none
            return ~test("eq", x, kind, value)
        return any_of(x, lambda e: test(op, e, inner, value))
    if positive and op == "eq" and value is not None and not isinstance(value, Column):
        return x == literal(value, kind)
    return one_test(op, x, literal(value, kind), positive)
