"""Document queries as trees of plain values, and builders for them.

A request names a collection, a query over it, the relationships that the query uses, and
perhaps sets of variables::

    request("customer",
            query(fields={"name": field("c_name"),
                          "orders": related_field("orders", query(aggregates={"n": star_count()}))},
                  predicate=binop("_gt", target("c_acctbal"), value(0))),
            relationships={"orders": relationship("orders", {"c_custkey": ["o_custkey"]})})
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

Tree = dict[str, Any]


def request(collection: str, query: Tree, arguments: Mapping[str, Any] | None = None, relationships: Mapping[str, Tree] | None = None, variables: Sequence[Mapping[str, Any]] | None = None) -> Tree:
    return {"collection": collection, "query": query, "arguments": dict(arguments or {}), "collection_relationships": dict(relationships or {}), "variables": None if variables is None else [dict(v) for v in variables]}


def query(**parts: Any) -> Tree:
    """fields, aggregates, groups, predicate, order_by (a list), limit, offset."""
    known = {"fields", "aggregates", "groups", "predicate", "order_by", "limit", "offset"}
    if extra := set(parts) - known:
        raise TypeError(f"a query has no {', '.join(sorted(extra))}")
    out = {k: v for k, v in parts.items() if v is not None}
    if "order_by" in out:
        out["order_by"] = {"elements": list(out["order_by"])}
    return out


def relationship(target_collection: str, column_mapping: Mapping[str, Sequence[str] | str], kind: str = "array", arguments: Mapping[str, Any] | None = None) -> Tree:
    return {"target_collection": target_collection, "column_mapping": {k: [v] if isinstance(v, str) else list(v) for k, v in column_mapping.items()}, "relationship_type": kind, "arguments": dict(arguments or {})}


# fields


def field(column: str, fields: Tree | None = None, arguments: Mapping[str, Any] | None = None) -> Tree:
    return {"type": "column", "column": column, "fields": fields, "arguments": dict(arguments or {})}


def nested_object(**fields: Tree) -> Tree:
    return {"type": "object", "fields": fields}


def nested_array(inner: Tree) -> Tree:
    return {"type": "array", "fields": inner}


def related_field(relationship: str, query: Tree, arguments: Mapping[str, Any] | None = None) -> Tree:
    return {"type": "relationship", "relationship": relationship, "query": query, "arguments": dict(arguments or {})}


# predicates


def target(name: str, *field_path: str) -> Tree:
    return {"type": "column", "name": name, "field_path": list(field_path)}


def value(v: Any) -> Tree:
    return {"type": "scalar", "value": v}


def variable(name: str) -> Tree:
    return {"type": "variable", "name": name}


def column_value(name: str, *field_path: str, scope: int | None = None) -> Tree:
    return {"type": "column", "name": name, "field_path": list(field_path), "scope": scope}


def binop(operator: str, column: Tree, v: Tree) -> Tree:
    return {"type": "binary_comparison_operator", "column": column, "operator": operator, "value": v}


def is_null(column: Tree) -> Tree:
    return {"type": "unary_comparison_operator", "column": column, "operator": "is_null"}


def and_(*expressions: Tree) -> Tree:
    return {"type": "and", "expressions": list(expressions)}


def or_(*expressions: Tree) -> Tree:
    return {"type": "or", "expressions": list(expressions)}


def not_(expression: Tree) -> Tree:
    return {"type": "not", "expression": expression}


def array_contains(column: Tree, v: Tree) -> Tree:
    return {"type": "array_comparison", "column": column, "comparison": {"type": "contains", "value": v}}


def array_is_empty(column: Tree) -> Tree:
    return {"type": "array_comparison", "column": column, "comparison": {"type": "is_empty"}}


def exists(in_collection: Tree, predicate: Tree | None = None) -> Tree:
    return {"type": "exists", "in_collection": in_collection, "predicate": predicate}


def related(relationship: str, **arguments: Any) -> Tree:
    return {"type": "related", "relationship": relationship, "arguments": arguments}


def unrelated(collection: str, **arguments: Any) -> Tree:
    return {"type": "unrelated", "collection": collection, "arguments": arguments}


def nested(column: str, *field_path: str) -> Tree:
    return {"type": "nested_collection", "column_name": column, "field_path": list(field_path)}


def nested_scalars(column: str, *field_path: str) -> Tree:
    return {"type": "nested_scalar_collection", "column_name": column, "field_path": list(field_path)}


# order, aggregates, groups


def path_step(relationship: str, predicate: Tree | None = None, arguments: Mapping[str, Any] | None = None) -> Tree:
    return {"relationship": relationship, "predicate": predicate, "arguments": dict(arguments or {})}


def order(name: str, *field_path: str, descending: bool = False, path: Sequence[Tree] = ()) -> Tree:
    return {"order_direction": "desc" if descending else "asc", "target": {"type": "column", "name": name, "field_path": list(field_path), "path": list(path)}}


def order_aggregate(aggregate: Tree, path: Sequence[Tree], descending: bool = False) -> Tree:
    return {"order_direction": "desc" if descending else "asc", "target": {"type": "aggregate", "aggregate": aggregate, "path": list(path)}}


def star_count() -> Tree:
    return {"type": "star_count"}


def column_count(column: str, *field_path: str, distinct: bool = False) -> Tree:
    return {"type": "column_count", "column": column, "field_path": list(field_path), "distinct": distinct}


def column_aggregate(function: str, column: str, *field_path: str) -> Tree:
    return {"type": "single_column", "function": function, "column": column, "field_path": list(field_path)}


def dimension(column: str, *field_path: str, path: Sequence[Tree] = ()) -> Tree:
    return {"type": "column", "column_name": column, "field_path": list(field_path), "path": list(path)}


def groups(dimensions: Sequence[Tree], aggregates: Mapping[str, Tree], order_by: Sequence[Tree] = (), predicate: Tree | None = None, limit: int | None = None, offset: int | None = None) -> Tree:
    """``order_by``: dimension_order() or group_aggregate_order()."""
    return {"dimensions": list(dimensions), "aggregates": dict(aggregates), "order_by": {"elements": list(order_by)} if order_by else None, "predicate": predicate, "limit": limit, "offset": offset}


def dimension_order(index: int, descending: bool = False) -> Tree:
    return {"order_direction": "desc" if descending else "asc", "target": {"type": "dimension", "index": index}}


def group_aggregate_order(name: str, descending: bool = False) -> Tree:
    return {"order_direction": "desc" if descending else "asc", "target": {"type": "aggregate", "name": name}}


def group_test(operator: str, aggregate: str, v: Any) -> Tree:
    """A condition on an aggregate of a group, for its ``predicate``."""
    return {"type": "binary_comparison_operator", "target": {"type": "aggregate", "name": aggregate}, "operator": operator, "value": value(v)}
