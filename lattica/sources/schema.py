"""Descriptions of what can be asked for: scalar types with their operators, object types,
collections, functions, and capabilities."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from ..types import SCALARS, aggregate_functions, aggregate_result, comparison_operators
from .catalog import Catalog
from .introspect import any_typed, objects_json, sample_frame

#: JSON forms of the scalar types, where they are not what the name says.
_FORMS = {"double": "float64", "decimal": "bigdecimal", "int": "int32", "long": "int64", "string": "string", "date": "timestamp", "uuid": "uuid", "bool": "boolean", "objectId": "string", "symbol": "string", "javascript": "string", "extendedJSON": "json"}


def scalar_types(relational: bool = False) -> dict[str, Any]:
    out = {}
    for name in SCALARS:
        out[name] = {
            "representation": "string" if relational and name in ("extendedJSON",) else _FORMS.get(name, "json"),
            "comparison_operators": comparison_operators(name),
            "aggregate_functions": {f: aggregate_result(f, name) for f in aggregate_functions(name)},
        }
    return out


def schema_response(catalog: Catalog, relational: bool = False) -> dict[str, Any]:
    """Types and columns of all collections and views; columns come from analysed plans."""
    objects: dict[str, Any] = {}
    collections, functions = [], []
    for name in sorted(catalog.tables):
        found = sample_frame(name, catalog.open(name), all_nullable=True)
        if found is None:
            continue
        own = any_typed(found.objects) if relational else found.objects
        objects |= objects_json(own)
        collections.append({"name": name, "type": found.type, "arguments": {}})
    for name, view in sorted(catalog.views.items()):
        entry = {"name": name, "arguments": {n: None if t is None else t.simpleString() for n, t in view.arguments.items()}}
        (functions if view.kind == "function" else collections).append(entry)
    return {"scalar_types": scalar_types(relational), "object_types": objects, "collections": collections, "functions": functions, "procedures": []}


def capabilities() -> Mapping[str, Any]:
    """What the engine can do; {} marks a capability without options."""
    on: dict[str, Any] = {}
    return {
        "query": {
            "aggregates": {"group_by": {"filter": on, "order": on, "paginate": on}},
            "variables": on,
            "explain": on,
            "nested_fields": {"filter_by": {"nested_arrays": {"contains": on, "is_empty": on}}, "order_by": on, "aggregates": on},
            "exists": {"unrelated": on, "nested_collections": on, "nested_scalar_collections": on},
        },
        "mutation": {"transactional": None, "explain": None},
        "relationships": {"relation_comparisons": on, "order_by_aggregate": on},
        "relational_query": {
            "filter": on,
            "project": on,
            "sort": on,
            "paginate": on,
            "aggregate": on,
            "join": {t: on for t in ("inner", "left", "right", "left_semi", "left_anti", "right_semi", "right_anti", "full")},
            "window": on,
            "union": on,
            "streaming": on,
        },
    }
