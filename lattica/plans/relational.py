"""Positional relational algebra: relations over columns that are known by their index.

Relations and expressions are plain values.  ``to_json`` and ``from_json`` give them as
trees of dictionaries with a "type" entry; builders below make them in Python::

    scan("lineitem", ["l_quantity", "l_returnflag"]).filter(gt(col(0), 10))
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from ..errors import BadQuery, UnsupportedExpression

#: Fields of each kind of expression; a "?" marks one that may be left out.
FIELDS: dict[str, str] = {
    "column": "index",
    "literal": "literal",
    # logic and comparison
    "and": "left right",
    "or": "left right",
    "not": "expr",
    "eq": "left right",
    "not_eq": "left right",
    "lt": "left right",
    "lt_eq": "left right",
    "gt": "left right",
    "gt_eq": "left right",
    "is_distinct_from": "left right",
    "is_not_distinct_from": "left right",
    "is_null": "expr",
    "is_not_null": "expr",
    "is_true": "expr",
    "is_false": "expr",
    "is_not_true": "expr",
    "is_not_false": "expr",
    "in": "expr list",
    "not_in": "expr list",
    "between": "low expr high",
    "not_between": "low expr high",
    "like": "expr pattern",
    "not_like": "expr pattern",
    "i_like": "expr pattern",
    "not_i_like": "expr pattern",
    "contains": "str search_str",
    "is_nan": "expr",
    "is_zero": "expr",
    # conditional
    "case": "when scrutinee? default?",
    "coalesce": "exprs",
    "null_if": "expr1 expr2",
    "nvl": "expr1 expr2",
    "greatest": "exprs",
    "least": "exprs",
    # arithmetic and mathematics
    "plus": "left right",
    "minus": "left right",
    "multiply": "left right",
    "divide": "left right",
    "modulo": "left right",
    "negate": "expr",
    "abs": "expr",
    "ceil": "expr",
    "floor": "expr",
    "round": "expr prec?",
    "trunc": "expr prec?",
    "sqrt": "expr",
    "power": "base exp",
    "exp": "expr",
    "ln": "expr",
    "log": "expr base?",
    "log10": "expr",
    "log2": "expr",
    "cos": "expr",
    "tan": "expr",
    "random": "",
    # strings
    "concat": "exprs",
    "character_length": "str",
    "substr": "str start_pos len?",
    "str_pos": "str substr",
    "to_lower": "expr",
    "to_upper": "expr",
    "l_trim": "str trim_str?",
    "r_trim": "str trim_str?",
    "b_trim": "str trim_str?",
    "replace": "str substr replacement",
    "left": "str n",
    "right": "str n",
    "reverse": "str",
    "l_pad": "str n padding_str?",
    "r_pad": "str n padding_str?",
    "substr_index": "str delim count",
    "binary_concat": "left right",
    # nested values and JSON
    "get_field": "column field",
    "array_element": "column index",
    "json_get": "json keys",
    "json_get_str": "json keys",
    "json_get_int": "json keys",
    "json_get_float": "json keys",
    "json_get_bool": "json keys",
    "json_get_json": "json keys",
    "json_as_text": "json keys",
    "json_length": "json keys",
    "json_contains": "json keys",
    # dates and times
    "current_date": "",
    "current_time": "",
    "current_timestamp": "",
    "date_part": "expr part",
    "date_trunc": "expr part",
    "to_date": "expr",
    "to_timestamp": "expr",
    # casts
    "cast": "expr as_type from_type?",
    "try_cast": "expr as_type from_type?",
    # aggregates
    "count": "expr? distinct?",
    "sum": "expr",
    "average": "expr",
    "min": "expr",
    "max": "expr",
    "first_value": "expr",
    "last_value": "expr",
    "median": "expr",
    "stddev": "expr",
    "stddev_pop": "expr",
    "approx_percentile_cont": "expr percentile",
    "array_agg": "expr distinct? order_by?",
    "string_agg": "expr separator distinct? order_by?",
    "bool_and": "expr",
    "bool_or": "expr",
    "var": "expr",
    "approx_distinct": "expr",
    # windows
    "row_number": "order_by? partition_by?",
    "rank": "order_by? partition_by?",
    "dense_rank": "order_by? partition_by?",
    "n_tile": "n order_by? partition_by?",
    "cume_dist": "order_by? partition_by?",
    "percent_rank": "order_by? partition_by?",
    "lag": "expr offset? default? order_by? partition_by?",
    "lead": "expr offset? default? order_by? partition_by?",
    "aggregate_over": "aggregate order_by? partition_by? frame?",
}


@dataclass(frozen=True)
class Expr:
    kind: str
    fields: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in FIELDS:
            raise UnsupportedExpression(f"unknown expression: {self.kind}")
        names = FIELDS[self.kind].split()
        allowed = {n.rstrip("?") for n in names}
        if extra := set(self.fields) - allowed:
            raise UnsupportedExpression(f"{self.kind} has no {', '.join(sorted(extra))}")
        if missing := [n for n in names if not n.endswith("?") and n not in self.fields]:
            raise UnsupportedExpression(f"{self.kind} needs {', '.join(missing)}")

    def get(self, name: str, default: Any = None) -> Any:
        found = self.fields.get(name)
        return default if found is None else found

    def __add__(self, other: Any) -> Expr:
        return call("plus", self, other)

    def __sub__(self, other: Any) -> Expr:
        return call("minus", self, other)

    def __mul__(self, other: Any) -> Expr:
        return call("multiply", self, other)

    def __truediv__(self, other: Any) -> Expr:
        return call("divide", self, other)

    def __mod__(self, other: Any) -> Expr:
        return call("modulo", self, other)

    def __neg__(self) -> Expr:
        return call("negate", self)

    def __and__(self, other: Any) -> Expr:
        return call("and", self, other)

    def __or__(self, other: Any) -> Expr:
        return call("or", self, other)

    def __invert__(self) -> Expr:
        return call("not", self)


@dataclass(frozen=True)
class SortKey:
    expr: Expr
    ascending: bool = True
    #: None: nulls first if ascending, else last.
    nulls_first: bool | None = None

    @property
    def nulls(self) -> bool:
        return self.ascending if self.nulls_first is None else self.nulls_first


class Relation:
    """Builders; each returns a new relation."""

    def filter(self, predicate: Expr) -> Filter:
        return Filter(self, predicate)

    def sort(self, *keys: SortKey | Expr) -> Sort:
        return Sort(self, tuple(k if isinstance(k, SortKey) else SortKey(k) for k in keys))

    def paginate(self, fetch: int | None = None, skip: int = 0) -> Paginate:
        return Paginate(self, fetch, skip)

    def project(self, *exprs: Any) -> Project:
        return Project(self, tuple(map(expr, exprs)))

    def join(self, right: Relation, on: Sequence[tuple[Any, Any]] = (), kind: str = "inner") -> Join:
        return Join(self, right, tuple((expr(a), expr(b)) for a, b in on), kind)

    def aggregate(self, group_by: Sequence[Any] = (), aggregates: Sequence[Expr] = ()) -> Aggregate:
        return Aggregate(self, tuple(map(expr, group_by)), tuple(aggregates))

    def window(self, *exprs: Expr) -> Window:
        return Window(self, tuple(exprs))


@dataclass(frozen=True)
class From(Relation):
    collection: str
    columns: tuple[str, ...]
    arguments: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Filter(Relation):
    input: Relation
    predicate: Expr


@dataclass(frozen=True)
class Sort(Relation):
    input: Relation
    exprs: tuple[SortKey, ...]


@dataclass(frozen=True)
class Paginate(Relation):
    input: Relation
    fetch: int | None = None
    skip: int = 0


@dataclass(frozen=True)
class Project(Relation):
    input: Relation
    exprs: tuple[Expr, ...]


JOINS = ("inner", "left", "right", "left_semi", "left_anti", "right_semi", "right_anti", "full")


@dataclass(frozen=True)
class Join(Relation):
    left: Relation
    right: Relation
    on: tuple[tuple[Expr, Expr], ...] = ()
    join_type: str = "inner"


@dataclass(frozen=True)
class Aggregate(Relation):
    input: Relation
    group_by: tuple[Expr, ...] = ()
    aggregates: tuple[Expr, ...] = ()
    #: Beyond one list of keys: "cube", "rollup", or lists of key numbers.
    grouping: Any = None


@dataclass(frozen=True)
class Window(Relation):
    input: Relation
    exprs: tuple[Expr, ...]


@dataclass(frozen=True)
class Union(Relation):
    relations: tuple[Relation, ...]


@dataclass(frozen=True)
class SetOperation(Relation):
    """Rows of the left that are (intersect) or are not (except) among those of the right,
    each as often as multiset rules have it."""

    kind: str
    left: Relation
    right: Relation


# -- builders -------------------------------------------------------------------------


def scan(collection: str, columns: Sequence[str], **arguments: Any) -> From:
    return From(collection, tuple(columns), arguments)


def col(index: int) -> Expr:
    return Expr("column", {"index": index})


def lit(value: Any, kind: str | None = None) -> Expr:
    """A literal; the type of a Python value is taken from it unless ``kind`` names one."""
    if kind is None:
        if value is None:
            return Expr("literal", {"literal": {"type": "null"}})
        if isinstance(value, bool):
            kind = "boolean"
        elif isinstance(value, int):
            kind = "int32" if -(2**31) <= value < 2**31 else "int64"
        elif isinstance(value, float):
            kind = "float64"
        elif isinstance(value, str):
            kind = "string"
        elif isinstance(value, decimal.Decimal):
            scale = max(0, -value.as_tuple().exponent)
            return Expr("literal", {"literal": {"type": "decimal128", "value": int(value.scaleb(scale)), "scale": scale}})
        elif isinstance(value, dt.datetime):
            naive = value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value
            return Expr("literal", {"literal": {"type": "timestamp_millisecond", "value": (naive - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)}})
        elif isinstance(value, dt.date):
            return Expr("literal", {"literal": {"type": "date32", "value": (value - dt.date(1970, 1, 1)).days}})
        else:
            raise BadQuery(f"no literal for {type(value).__name__}")
    return Expr("literal", {"literal": {"type": kind, "value": value}})


def expr(value: Any) -> Expr:
    return value if isinstance(value, Expr) else lit(value)


#: Fields that hold plain values, not expressions.
PLAIN = {"index", "literal", "field", "part", "as_type", "from_type", "distinct", "percentile", "separator", "order_by", "partition_by", "frame"}
#: Fields that hold lists of expressions.
LISTS = {"exprs", "list", "keys"}


def call(kind: str, *args: Any, **named: Any) -> Expr:
    """An expression of a kind, its fields in order or by name; Python values become
    literals where an expression belongs."""
    if kind not in FIELDS:
        raise UnsupportedExpression(f"unknown expression: {kind}")
    names = [n.rstrip("?") for n in FIELDS[kind].split()]
    if len(names) == 1 and names[0] in LISTS:
        given = {names[0]: args[0] if len(args) == 1 and isinstance(args[0], (list, tuple)) else list(args)} if args else {}
    elif len(names) == 2 and names[1] in LISTS and len(args) > 1 and not isinstance(args[1], (list, tuple)):
        given = {names[0]: args[0], names[1]: list(args[1:])}
    else:
        given = dict(zip(names, args, strict=False))
    given |= named
    out = {}
    for name, value in given.items():
        if value is None and name not in ("expr", "left", "right", "expr1", "expr2"):
            continue
        if kind == "column" or name in PLAIN and not (name == "index" and kind == "array_element"):
            out[name] = value
        elif name in LISTS:
            out[name] = [expr(v) for v in value]
        elif name == "when":
            out[name] = [(expr(a), expr(b)) for a, b in value]
        else:
            out[name] = expr(value)
    return Expr(kind, out)


def _maker(kind: str):
    def make(*args: Any, **named: Any) -> Expr:
        return call(kind, *args, **named)

    make.__name__ = make.__qualname__ = kind
    return make


eq, not_eq, lt, lt_eq, gt, gt_eq = map(_maker, ("eq", "not_eq", "lt", "lt_eq", "gt", "gt_eq"))


def asc(e: Any, nulls_first: bool | None = None) -> SortKey:
    return SortKey(expr(e), True, nulls_first)


def desc(e: Any, nulls_first: bool | None = None) -> SortKey:
    return SortKey(expr(e), False, nulls_first)


# -- JSON -----------------------------------------------------------------------------


def _sort_json(keys: Sequence[SortKey]) -> list[dict]:
    return [{"expr": expr_json(k.expr), "direction": "asc" if k.ascending else "desc", "nulls_sort": "nulls_first" if k.nulls else "nulls_last"} for k in keys]


def _sort_from(rows: Sequence[Any]) -> tuple[SortKey, ...]:
    out = []
    for r in rows or ():
        nulls = r.get("nulls_sort")
        out.append(SortKey(expr_from(r["expr"]), r.get("direction", "asc") == "asc", None if nulls is None else nulls == "nulls_first"))
    return tuple(out)


def expr_json(e: Expr) -> dict:
    out: dict[str, Any] = {"type": e.kind}
    for name, value in e.fields.items():
        if name == "order_by":
            out[name] = _sort_json(value)
        elif name == "when":
            out[name] = [{"when": expr_json(a), "then": expr_json(b)} for a, b in value]
        elif isinstance(value, Expr):
            out[name] = expr_json(value)
        elif isinstance(value, (list, tuple)) and value and all(isinstance(v, Expr) for v in value):
            out[name] = [expr_json(v) for v in value]
        else:
            out[name] = value
    return out


def expr_from(tree: Any) -> Expr:
    if isinstance(tree, Expr):
        return tree
    if not isinstance(tree, dict) or "type" not in tree:
        raise BadQuery(f"not an expression: {tree!r}")
    kind, out = tree["type"], {}
    for name, value in tree.items():
        if name == "type" or value is None:
            continue
        if name == "order_by":
            out[name] = _sort_from(value)
        elif name == "when":
            out[name] = [(expr_from(w["when"]), expr_from(w["then"])) for w in value]
        elif name in LISTS or name == "partition_by":
            out[name] = [expr_from(v) for v in value]
        elif isinstance(value, dict) and "type" in value and name not in ("literal", "as_type", "from_type"):
            out[name] = expr_from(value)
        else:
            out[name] = value
    return Expr(kind, out)


def relation_json(r: Relation) -> dict:
    match r:
        case From():
            return {"type": "from", "collection": r.collection, "columns": list(r.columns), "arguments": dict(r.arguments)}
        case Filter():
            return {"type": "filter", "input": relation_json(r.input), "predicate": expr_json(r.predicate)}
        case Sort():
            return {"type": "sort", "input": relation_json(r.input), "exprs": _sort_json(r.exprs)}
        case Paginate():
            return {"type": "paginate", "input": relation_json(r.input), "fetch": r.fetch, "skip": r.skip}
        case Project():
            return {"type": "project", "input": relation_json(r.input), "exprs": [expr_json(e) for e in r.exprs]}
        case Join():
            return {"type": "join", "left": relation_json(r.left), "right": relation_json(r.right), "on": [{"left": expr_json(a), "right": expr_json(b)} for a, b in r.on], "join_type": r.join_type}
        case Aggregate():
            return {"type": "aggregate", "input": relation_json(r.input), "group_by": [expr_json(e) for e in r.group_by], "aggregates": [expr_json(e) for e in r.aggregates], "grouping": r.grouping}
        case Window():
            return {"type": "window", "input": relation_json(r.input), "exprs": [expr_json(e) for e in r.exprs]}
        case Union():
            return {"type": "union", "relations": [relation_json(x) for x in r.relations]}
        case SetOperation():
            return {"type": r.kind, "left": relation_json(r.left), "right": relation_json(r.right)}
    raise BadQuery(f"not a relation: {r!r}")


def relation_from(tree: Any) -> Relation:
    if isinstance(tree, Relation):
        return tree
    if not isinstance(tree, dict) or "type" not in tree:
        raise BadQuery(f"not a relation: {tree!r}")
    many = lambda name: tuple(expr_from(e) for e in tree.get(name) or ())
    match tree["type"]:
        case "from":
            return From(tree["collection"], tuple(tree["columns"]), dict(tree.get("arguments") or {}))
        case "filter":
            return Filter(relation_from(tree["input"]), expr_from(tree["predicate"]))
        case "sort":
            return Sort(relation_from(tree["input"]), _sort_from(tree["exprs"]))
        case "paginate":
            return Paginate(relation_from(tree["input"]), tree.get("fetch"), tree.get("skip") or 0)
        case "project":
            return Project(relation_from(tree["input"]), many("exprs"))
        case "join":
            on = tuple((expr_from(o["left"]), expr_from(o["right"])) for o in tree.get("on") or ())
            return Join(relation_from(tree["left"]), relation_from(tree["right"]), on, tree.get("join_type", "inner"))
        case "aggregate":
            return Aggregate(relation_from(tree["input"]), many("group_by"), many("aggregates"), tree.get("grouping"))
        case "window":
            return Window(relation_from(tree["input"]), many("exprs"))
        case "union":
            return Union(tuple(relation_from(x) for x in tree["relations"]))
        case "intersect" | "except":
            return SetOperation(tree["type"], relation_from(tree["left"]), relation_from(tree["right"]))
    raise BadQuery(f"unknown relation: {tree['type']}")
