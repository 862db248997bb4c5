"""Aggregates.  Each argument may be any scalar expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import UnsupportedExpression
from ..plans.relational import Expr, SortKey
from .context import Compiler, Context, is_temporal

AGGREGATES: dict[str, Compiler] = {}


def aggregate(*kinds: str) -> Callable[[Compiler], Compiler]:
    def add(f: Compiler) -> Compiler:
        for k in kinds:
            AGGREGATES[k] = f
        return f

    return add


def compile_aggregate(ctx: Context, e: Expr) -> Column:
    if e.kind not in AGGREGATES:
        raise UnsupportedExpression(f"{e.kind} is not an aggregate")
    return AGGREGATES[e.kind](ctx, e)


def sort_key(ctx: Context, keys: tuple[SortKey, ...]) -> Column:
    """One value that orders rows as the keys do, ascending: so that min_by and max_by, which
    work map-side and hold one row a group, can stand in for a sort."""
    parts = []
    for i, k in enumerate(keys):
        x = ctx.compile(k.expr)
        parts.append(F.when(x.isNull(), F.lit(0 if k.nulls else 2)).otherwise(F.lit(1)).alias(f"n{i}"))
        parts.append((x if k.ascending else descending(ctx.type_of(x), x)).alias(f"k{i}"))
    return F.struct(*parts)


def descending(own: T.DataType, x: Column) -> Column:
    """A value that goes down as ``x``, of the type ``own``, goes up."""
    if isinstance(own, (T.DecimalType, T.DoubleType, T.FloatType)):
        return -x
    if isinstance(own, T.NumericType):
        return -x.cast("decimal(20,0)")
    if isinstance(own, T.BooleanType):
        return ~x
    if is_temporal(own):
        return -F.unix_micros(x.cast("timestamp"))
    if isinstance(own, T.StringType):  # code points from high to low, a prefix behind what it begins
        return F.concat(F.transform(F.split(x, ""), lambda c: -F.ascii(c)), F.array(F.lit(1)))
    raise UnsupportedExpression(f"cannot order {own.simpleString()} downwards here")


def _arg(ctx: Context, e: Expr) -> Column:
    return ctx.compile(e.fields["expr"])


def _is_star(e: Expr) -> bool:
    x = e.get("expr")
    return x is None or x.kind == "literal" and x.fields["literal"]["type"] == "null"


@aggregate("count")
def _count(ctx: Context, e: Expr) -> Column:
    """Of rows if the argument is the null literal or left out, else of values."""
    if _is_star(e):
        return ctx.over_window(F.count(F.lit(1)))
    x = _arg(ctx, e)
    if not e.get("distinct"):
        return ctx.over_window(F.count(x))
    if ctx.over is not None:
        raise UnsupportedExpression("a distinct count over a window")
    found = F.count_distinct(x)
    if ctx.options.strict:
        found = found + F.coalesce(F.max(x.isNull().cast("bigint")), F.lit(0))
    return found


@aggregate("sum")
def _sum(ctx: Context, e: Expr) -> Column:
    """0 if there is no value."""
    return F.coalesce(ctx.over_window(F.sum(_arg(ctx, e))), F.lit(0))


#: Relative standard deviation of an approximate distinct count: a sketch of 3.3 KB a group.
DISTINCT_ERROR = 0.02
_PLAIN = {"average": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev_samp, "stddev_pop": F.stddev_pop, "var": F.var_samp, "approx_distinct": lambda x: F.approx_count_distinct(x, DISTINCT_ERROR)}


@aggregate(*_PLAIN)
def _plain(ctx: Context, e: Expr) -> Column:
    return ctx.over_window(_PLAIN[e.kind](_arg(ctx, e)))


@aggregate("median")
def _median(ctx: Context, e: Expr) -> Column:
    """Exact, in memory that grows with the distinct values of a group; of a sketch of fixed size
    under ``approximate``."""
    x = _arg(ctx, e)
    return ctx.over_window(F.percentile_approx(x, 0.5) if ctx.options.approximate else F.median(x))


@aggregate("first_value", "last_value")
def _first_last(ctx: Context, e: Expr) -> Column:
    """In the order of the sorted input; without one, of whichever row comes first or last."""
    x, first = _arg(ctx, e), e.kind == "first_value"
    if ctx.order is None:
        return ctx.over_window(F.first(x) if first else F.last(x))
    return ctx.over_window(F.min_by(x, ctx.order) if first else F.max_by(x, ctx.order))


@aggregate("approx_percentile_cont")
def _percentile(ctx: Context, e: Expr) -> Column:
    share = float(e.fields["percentile"])
    if not 0 <= share <= 1:
        raise UnsupportedExpression("a percentile lies between 0 and 1")
    return ctx.over_window(F.percentile_approx(_arg(ctx, e), share))


def _collected(ctx: Context, e: Expr) -> Column:
    """An array of structs with the value as v, nulls kept, in the order asked for."""
    x = _arg(ctx, e)
    keys = e.get("order_by")
    # of distinct values a task ships each once
    collect = F.collect_set if e.get("distinct") else F.collect_list
    if keys:
        rows = F.array_sort(ctx.over_window(collect(F.struct(sort_key(ctx, tuple(keys)).alias("k"), x.alias("v")))))
    elif ctx.order is not None:
        rows = F.array_sort(ctx.over_window(collect(F.struct(ctx.order.alias("k"), x.alias("v")))))
    else:
        rows = ctx.over_window(collect(F.struct(x.alias("v"))))
    values = F.transform(rows, lambda r: r["v"])
    return F.array_distinct(values) if e.get("distinct") else values


@aggregate("array_agg")
def _array_agg(ctx: Context, e: Expr) -> Column:
    """Nulls are kept."""
    return _collected(ctx, e)


@aggregate("string_agg")
def _string_agg(ctx: Context, e: Expr) -> Column:
    """Nulls are skipped; null if nothing is left."""
    separator = e.fields["separator"]
    values = F.filter(_collected(ctx, e), lambda v: v.isNotNull())
    return F.when(F.size(values) > 0, F.array_join(F.transform(values, lambda v: v.cast("string")), str(separator)))


@aggregate("bool_and")
def _bool_and(ctx: Context, e: Expr) -> Column:
    """Null counts as false."""
    return ctx.over_window(F.min(F.coalesce(_arg(ctx, e).cast("boolean"), F.lit(False))))


@aggregate("bool_or")
def _bool_or(ctx: Context, e: Expr) -> Column:
    return ctx.over_window(F.max(F.coalesce(_arg(ctx, e).cast("boolean"), F.lit(False))))
