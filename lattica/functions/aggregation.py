"""Expressions and accumulators of document pipelines.

"$a.b" is a field, "$$ROOT" the document, "$$name" a variable, {"$op": arguments} an
operation, {"$literal": x} a value as it stands; other values stand for themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import NotSupported, UnknownArgument
from .documents import literal, one_test, quoted, resolve
from .scalar import WHITE_SPACE


class Scope:
    """The document at hand and the variables that expressions may use."""

    def __init__(self, schema: T.StructType, variables: Mapping[str, Column] | None = None, order: Column | None = None):
        self.schema, self.variables = schema, dict(variables or {})
        #: One value that orders the rows of a group, if they come sorted.
        self.order = order

    def root(self) -> Column:
        return F.struct(*[quoted(f) for f in self.schema.fieldNames()])


def compile_expression(tree: Any, scope: Scope) -> Column:
    if isinstance(tree, Column):
        return tree
    if isinstance(tree, str) and tree.startswith("$$"):
        name, _, rest = tree[2:].partition(".")
        if name in ("ROOT", "CURRENT"):
            return resolve(scope.schema, rest.split("."), strict=False)[0] if rest else scope.root()
        if name not in scope.variables:
            raise UnknownArgument(f"no variable {name}")
        out = scope.variables[name]
        for part in rest.split(".") if rest else ():
            out = out.getField(part)
        return out
    if isinstance(tree, str) and tree.startswith("$"):
        return resolve(scope.schema, tree[1:].split("."), strict=False)[0]
    if isinstance(tree, Mapping):
        if len(tree) == 1 and next(iter(tree)).startswith("$"):
            ((op, arguments),) = tree.items()
            if op == "$literal":
                return literal(arguments)
            if op not in OPERATORS:
                raise NotSupported(f"no operator {op}")
            return OPERATORS[op](arguments, scope)
        return F.struct(*[compile_expression(v, scope).alias(k) for k, v in tree.items()])
    if isinstance(tree, (list, tuple)):
        return F.array(*[compile_expression(v, scope) for v in tree])
    return literal(tree)


Operator = Callable[[Any, Scope], Column]
OPERATORS: dict[str, Operator] = {}


def _listed(arguments: Any) -> list:
    return list(arguments) if isinstance(arguments, (list, tuple)) else [arguments]


def _op(name: str, f: Callable[..., Column]) -> None:
    def run(arguments: Any, scope: Scope) -> Column:
        return f(*[compile_expression(a, scope) for a in _listed(arguments)])

    OPERATORS[name] = run


def _true(x: Column) -> Column:
    return F.coalesce(x.cast("boolean"), F.lit(False))


for _name in ("abs", "sqrt", "exp", "ln", "log10", "sin", "cos", "tan", "asin", "acos", "atan", "sinh", "cosh", "tanh", "asinh", "acosh", "atanh"):
    _op(f"${_name}", lambda x, n=_name: F.call_function(n, x))
for _name in ("eq", "ne", "gt", "gte", "lt", "lte"):
    _op(f"${_name}", lambda x, y, n=_name: one_test({"ne": "neq"}.get(n, n), x, y))
for _name, _f in {
    "add": lambda *x: reduce(lambda a, b: a + b, x),
    "multiply": lambda *x: reduce(lambda a, b: a * b, x),
    "subtract": lambda a, b: a - b,
    "divide": lambda a, b: a / b,
    "mod": lambda a, b: a % b,
    "pow": F.pow,
    "ceil": F.ceil,
    "floor": F.floor,
    "atan2": F.atan2,
    "and": lambda *x: reduce(lambda a, b: a & b, map(_true, x), F.lit(True)),
    "or": lambda *x: reduce(lambda a, b: a | b, map(_true, x), F.lit(False)),
    "not": lambda x: ~_true(x),
    "allElementsTrue": lambda x: F.forall(x, _true),
    "anyElementTrue": lambda x: F.exists(x, _true),
    "arrayElemAt": lambda x, i: F.when(i < 0, F.get(x, F.size(x) + i)).otherwise(F.get(x, i)),
    "size": F.size,
    "concat": F.concat,
    "concatArrays": F.concat,
    "toLower": F.lower,
    "toUpper": F.upper,
    "strLenCP": F.char_length,
    "toString": lambda x: x.cast("string"),
    "toInt": lambda x: x.cast("int"),
    "toLong": lambda x: x.cast("bigint"),
    "toDouble": lambda x: x.cast("double"),
    "toBool": lambda x: x.cast("boolean"),
    "ifNull": F.coalesce,
    "year": F.year,
    "month": F.month,
    "dayOfMonth": F.dayofmonth,
    "dayOfWeek": F.dayofweek,
    "dayOfYear": F.dayofyear,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
    "reverseArray": F.reverse,
    "setUnion": F.array_union,
    "setIntersection": F.array_intersect,
    "isArray": lambda x: F.typeof(x).startswith("array"),
    "in": lambda x, xs: F.coalesce(F.exists(xs, lambda v: v.eqNullSafe(x)), F.lit(False)),
    "max": F.greatest,
    "min": F.least,
}.items():
    _op(f"${_name}", _f)


def _split(arguments: Any, scope: Scope) -> Column:
    text, mark = (compile_expression(a, scope) for a in arguments)
    # the mark is plain text, not a pattern
    return F.split(text, F.concat(F.lit("\\Q"), mark, F.lit("\\E")), -1)


def _cond(arguments: Any, scope: Scope) -> Column:
    test, yes, no = (arguments["if"], arguments["then"], arguments["else"]) if isinstance(arguments, Mapping) else arguments
    return F.when(_true(compile_expression(test, scope)), compile_expression(yes, scope)).otherwise(compile_expression(no, scope))


def _switch(arguments: Any, scope: Scope) -> Column:
    out = None
    for b in arguments["branches"]:
        out = (F if out is None else out).when(_true(compile_expression(b["case"], scope)), compile_expression(b["then"], scope))
    return out.otherwise(compile_expression(arguments.get("default"), scope))


def _let(arguments: Any, scope: Scope) -> Column:
    own = {k: compile_expression(v, scope) for k, v in arguments["vars"].items()}
    return compile_expression(arguments["in"], Scope(scope.schema, scope.variables | own))


def _map(arguments: Any, scope: Scope) -> Column:
    name = arguments.get("as", "this")
    return F.transform(compile_expression(arguments["input"], scope), lambda x: compile_expression(arguments["in"], Scope(scope.schema, scope.variables | {name: x})))


def _filter(arguments: Any, scope: Scope) -> Column:
    name = arguments.get("as", "this")
    return F.filter(compile_expression(arguments["input"], scope), lambda x: _true(compile_expression(arguments["cond"], Scope(scope.schema, scope.variables | {name: x}))))


def _trim(arguments: Any, scope: Scope) -> Column:
    chars = arguments.get("chars")
    return F.btrim(compile_expression(arguments["input"], scope), F.lit(WHITE_SPACE) if chars is None else compile_expression(chars, scope))


OPERATORS |= {"$split": _split, "$cond": _cond, "$switch": _switch, "$let": _let, "$map": _map, "$filter": _filter, "$trim": _trim}


# -- accumulators -----------------------------------------------------------------------------

Accumulator = Callable[[Any, Scope], Column]


def _of(f: Callable[[Column], Column]) -> Accumulator:
    return lambda arguments, scope: f(compile_expression(arguments, scope))


def _kept(x: Column) -> Column:
    """All values with nulls: a list drops bare nulls, not structs that hold one."""
    return F.transform(F.collect_list(F.struct(x.alias("v"))), lambda r: r["v"])


def _percentile(arguments: Any, scope: Scope) -> Column:
    return F.percentile_approx(compile_expression(arguments["input"], scope), [float(p) for p in arguments["p"]])


def _edge(first: bool) -> Accumulator:
    """In the order of the sort before the group; without one, of whichever row comes first or
    last."""

    def value(arguments: Any, scope: Scope) -> Column:
        x = compile_expression(arguments, scope)
        if scope.order is None:
            return F.first(x) if first else F.last(x)
        return F.min_by(x, scope.order) if first else F.max_by(x, scope.order)

    return value


ACCUMULATORS: dict[str, Accumulator] = {
    "$sum": _of(lambda x: F.coalesce(F.sum(x), F.lit(0))),
    "$avg": _of(F.avg),
    "$min": _of(F.min),
    "$max": _of(F.max),
    "$first": _edge(True),
    "$last": _edge(False),
    "$push": _of(_kept),
    "$addToSet": _of(lambda x: F.transform(F.collect_set(F.struct(x.alias("v"))), lambda r: r["v"])),
    "$count": lambda arguments, scope: F.count(F.lit(1)),
    "$stdDevSamp": _of(F.stddev_samp),
    "$stdDevPop": _of(F.stddev_pop),
    "$median": lambda arguments, scope: F.percentile_approx(compile_expression(arguments["input"], scope), 0.5),
    "$percentile": _percentile,
}


def compile_accumulator(tree: Mapping[str, Any], scope: Scope) -> Column:
    ((op, arguments),) = tree.items()
    if op not in ACCUMULATORS:
        raise NotSupported(f"no accumulator {op}")
    return ACCUMULATORS[op](arguments, scope)
