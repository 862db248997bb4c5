"""Typed literals and casts.  Times of day and durations are whole milliseconds."""

from __future__ import annotations

import decimal
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument, UnsupportedExpression
from ..plans.relational import Expr
from .context import Context, is_temporal, millis, scalar

LONG_MAX = 2**63 - 1

INTEGERS = {"int8": "tinyint", "int16": "smallint", "int32": "int", "uint8": "int", "uint16": "int", "int64": "bigint", "uint32": "bigint", "uint64": "bigint"}

#: Milliseconds in a unit, as (multiplier, divisor).
UNITS = {"second": (1000, 1), "millisecond": (1, 1), "microsecond": (1, 1000), "nanosecond": (1, 1_000_000)}


def _to_millis(value: int, unit: str) -> int:
    times, over = UNITS[unit]
    quotient = abs(value) * times // over
    out = quotient if value >= 0 else -quotient
    if not -LONG_MAX - 1 <= out <= LONG_MAX:
        raise InvalidArgument(f"{value} {unit}s do not fit in 64 bits of milliseconds")
    return out


def literal_column(spec: dict[str, Any]) -> Column:
    kind, value = spec["type"], spec.get("value")
    if kind == "null" or value is None and kind != "interval":
        return F.lit(None)
    if kind == "boolean":
        return F.lit(bool(value))
    if kind == "string":
        return F.lit(str(value))
    if kind in INTEGERS:
        if kind == "uint64" and int(value) > LONG_MAX:
            raise InvalidArgument(f"{value} does not fit in 64 signed bits")
        return F.lit(int(value)).cast(INTEGERS[kind])
    if kind in ("float32", "float64"):
        return F.lit(float(value)).cast("double")
    if kind in ("decimal128", "decimal256"):
        scale = int(spec.get("scale", 0))
        number = decimal.Decimal(int(value)).scaleb(-scale)
        return F.lit(str(number)).cast(T.DecimalType(38, max(0, scale)))
    if kind == "date32":
        return F.date_add(F.lit("1970-01-01").cast("date"), F.lit(int(value)))
    if kind == "date64":
        return F.timestamp_millis(F.lit(int(value)).cast("bigint"))
    for start in ("time32_", "time64_", "timestamp_", "duration_"):
        if kind.startswith(start) and kind.removeprefix(start) in UNITS:
            ms = F.lit(_to_millis(int(value), kind.removeprefix(start))).cast("bigint")
            return F.timestamp_millis(ms) if start == "timestamp_" else ms
    if kind == "interval":
        parts = spec.get("value") or spec
        ms = _to_millis(int(parts.get("nanoseconds", 0)), "nanosecond")
        return F.struct(F.lit(int(parts.get("months", 0))).alias("months"), F.lit(int(parts.get("days", 0))).alias("days"), F.lit(ms).cast("bigint").alias("millis"))
    raise UnsupportedExpression(f"unknown literal: {kind}")


@scalar("literal")
def _literal(ctx: Context, e: Expr) -> Column:
    return literal_column(e.fields["literal"])


def cast_column(ctx: Context, x: Column, target: Any, soft: bool) -> Column:
    """``x`` as the target type; what cannot be cast is an error, or null if ``soft``.

    Dates keep their time of day.  Any text is true as a boolean, as in the document model;
    numbers are true unless zero.  Nested values become JSON text.
    """
    spec = target if isinstance(target, dict) else {"type": str(target)}
    kind, own = spec["type"], ctx.type_of(x)
    to: Callable[[Column, Any], Column] = (lambda c, t: c.try_cast(t)) if soft else (lambda c, t: c.cast(t))
    if kind == "utf8":
        if isinstance(own, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            return F.to_json(x)
        return x.cast("string")
    if kind == "boolean":
        if isinstance(own, T.StringType):
            return F.when(x.isNotNull(), F.lit(True))
        return x if isinstance(own, T.BooleanType) else x != F.lit(0)
    if kind in INTEGERS:
        small = "int" if INTEGERS[kind] in ("tinyint", "smallint") else INTEGERS[kind]
        return to(millis(x), small) if is_temporal(own) else to(x, small)
    if kind in ("float32", "float64"):
        return to(x, "double")
    if kind in ("decimal128", "decimal256"):
        return to(x, T.DecimalType(38, int(spec.get("scale", 10))))
    if kind in ("date", "timestamp"):
        return F.timestamp_millis(x.cast("bigint")) if isinstance(own, T.NumericType) else to(x, "timestamp")
    if kind == "time":
        t = to(x, "timestamp")
        return F.pmod(F.unix_millis(t), F.lit(86_400_000).cast("bigint"))
    if kind == "duration":
        return millis(x) if is_temporal(own) else to(x, "bigint")
    if kind == "interval":
        ms = millis(x) if is_temporal(own) else to(x, "bigint")
        return F.when(ms.isNotNull(), F.struct(F.lit(0).alias("months"), F.lit(0).alias("days"), ms.alias("millis")))
    raise UnsupportedExpression(f"unknown cast target: {kind}")


@scalar("cast")
def _cast(ctx: Context, e: Expr) -> Column:
    return cast_column(ctx, ctx.compile(e.fields["expr"]), e.fields["as_type"], soft=False)


@scalar("try_cast")
def _try_cast(ctx: Context, e: Expr) -> Column:
    return cast_column(ctx, ctx.compile(e.fields["expr"]), e.fields["as_type"], soft=True)
