"""A configuration directory: collections, views and mutations as JSON or YAML files.

    configuration.json       options
    schema/*.json            collections and object types
    native_queries/*.json    views: a pipeline with placeholders
    native_mutations/*.json  commands with placeholders (native_procedures: their old name)
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from ..errors import SchemaError
from ..types import ObjectType, Predicate, Type, spark_type, type_from
from .catalog import Catalog
from .introspect import SAMPLE_SIZE, CollectionSchema, objects_from, schema_from, schema_json

#: Options and their defaults; unknown ones are an error.
OPTIONS: dict[str, dict[str, Any]] = {
    "introspectionOptions": {"sampleSize": SAMPLE_SIZE, "noValidatorSchema": False, "allSchemaNullable": True},
    "serializationOptions": {"extendedJsonMode": "canonical", "onResponseTypeMismatch": "fail"},
}
_CHOICES = {"extendedJsonMode": ("canonical", "relaxed"), "onResponseTypeMismatch": ("fail", "skipRow")}
_SUFFIXES = (".json", ".yaml", ".yml")


@dataclass
class ViewConfig:
    name: str
    pipeline: list[dict]
    arguments: dict[str, Type]
    representation: str = "collection"
    input_collection: str | None = None
    result: str | None = None
    objects: dict[str, ObjectType] = field(default_factory=dict)
    description: str | None = None


@dataclass
class MutationConfig:
    name: str
    command: dict
    arguments: dict[str, Type]
    objects: dict[str, ObjectType] = field(default_factory=dict)
    description: str | None = None


@dataclass
class Configuration:
    collections: dict[str, CollectionSchema] = field(default_factory=dict)
    objects: dict[str, ObjectType] = field(default_factory=dict)
    views: dict[str, ViewConfig] = field(default_factory=dict)
    mutations: dict[str, MutationConfig] = field(default_factory=dict)
    options: dict[str, dict[str, Any]] = field(default_factory=lambda: {k: dict(v) for k, v in OPTIONS.items()})

    def register(self, catalog: Catalog) -> None:
        """Adds the views to a catalog."""
        from ..operators.pipeline import pipeline_view

        for v in self.views.values():
            kinds = {n: None if isinstance(t, Predicate) else spark_type(t, self.objects) for n, t in v.arguments.items()}
            catalog.add_view(pipeline_view(v.name, v.pipeline, kinds, v.input_collection, v.representation))


def read_tree(path: Path) -> Any:
    text = path.read_text()
    if path.suffix == ".json":
        return json.loads(text)
    try:
        import yaml
    except ImportError as error:
        raise SchemaError(f"{path.name} is YAML, and no reader for it is installed") from error
    return yaml.safe_load(text)


def _files(folder: Path) -> list[Path]:
    return sorted(p for p in folder.iterdir() if p.suffix in _SUFFIXES) if folder.is_dir() else []


def options_from(tree: Mapping[str, Any]) -> dict[str, dict[str, Any]]:
    out = {k: dict(v) for k, v in OPTIONS.items()}
    for group, own in tree.items():
        if group not in out:
            raise SchemaError(f"unknown option group {group}")
        for name, value in (own or {}).items():
            if name not in out[group]:
                raise SchemaError(f"unknown option {name}")
            if name in _CHOICES and value not in _CHOICES[name]:
                raise SchemaError(f"{name} is one of {', '.join(_CHOICES[name])}")
            out[group][name] = value
    return out


def _add(into: dict, new: Mapping, what: str) -> None:
    for name, value in new.items():
        if name in into and into[name] != value:
            raise SchemaError(f"{what} {name} is defined twice")
        into[name] = value


def read_configuration(folder: str | Path) -> Configuration:
    root, out = Path(folder), Configuration()
    for path in _files(root):
        if path.stem == "configuration":
            out.options = options_from(read_tree(path))
    for path in _files(root / "schema"):
        tree = read_tree(path)
        _add(out.objects, objects_from(tree.get("objectTypes") or {}), "object type")
        _add(out.collections, {c.name: c for c in schema_from(tree)}, "collection")
    for path in _files(root / "native_queries"):
        v = view_from(read_tree(path), path.stem)
        _add(out.views, {v.name: v}, "view")
        _add(out.objects, v.objects, "object type")
    for folder_name in ("native_mutations", "native_procedures"):
        for path in _files(root / folder_name):
            m = mutation_from(read_tree(path), path.stem)
            _add(out.mutations, {m.name: m}, "mutation")
            _add(out.objects, m.objects, "object type")
    if both := set(out.views) & set(out.collections):
        raise SchemaError(f"both views and collections: {', '.join(sorted(both))}")
    return out


def _arguments(tree: Mapping[str, Any]) -> dict[str, Type]:
    return {n: type_from(a["type"]) for n, a in (tree.get("arguments") or {}).items()}


def view_from(tree: Mapping[str, Any], name: str) -> ViewConfig:
    kind = tree.get("representation", "collection")
    if kind not in ("collection", "function"):
        raise SchemaError(f"{name}: a view is a collection or a function, not {kind}")
    return ViewConfig(tree.get("name", name), list(tree["pipeline"]), _arguments(tree), kind, tree.get("inputCollection"), tree.get("resultDocumentType"), objects_from(tree.get("objectTypes") or {}), tree.get("description"))


def mutation_from(tree: Mapping[str, Any], name: str) -> MutationConfig:
    return MutationConfig(tree.get("name", name), dict(tree["command"]), _arguments(tree), objects_from(tree.get("objectTypes") or {}), tree.get("description"))


def write_schema(folder: str | Path, schema: CollectionSchema) -> Path:
    path = Path(folder) / "schema" / f"{schema.name}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(schema_json(schema), indent=2) + "\n")
    return path


def update_schemas(folder: str | Path, tables: Mapping[str, Any]) -> tuple[list[str], dict[str, str]]:
    """Samples the tables and writes what is new to the schema files; returns the collections
    written and why others were passed over."""
    from .introspect import sample_all

    known = read_configuration(folder)
    options = known.options["introspectionOptions"]
    found, skipped = sample_all(tables, known.collections, options["sampleSize"], options["allSchemaNullable"])
    for schema in found.values():
        write_schema(folder, schema)
    return sorted(found), skipped


def create_view(folder: str | Path, catalog: Catalog, name: str, pipeline: list[dict], arguments: Mapping[str, Type] | None = None, input_collection: str | None = None, kind: str = "collection", force: bool = False) -> Path:
    """Writes a view and the object types of its rows, which come from the analysed plan: a
    view without arguments is analysed as it is, one with them with nulls in their place."""
    from ..operators.pipeline import pipeline_view
    from ..types import from_spark, type_json
    from .introspect import check_name, objects_json

    path = Path(folder) / "native_queries" / f"{check_name(name)}.json"
    if path.exists() and not force:
        raise SchemaError(f"there is a view {name} already")
    arguments = dict(arguments or {})
    view = pipeline_view(name, pipeline, dict.fromkeys(arguments), input_collection, kind)
    samples = {n: _sample(t) for n, t in arguments.items()}
    objects: dict[str, ObjectType] = {}
    from_spark(view.make(catalog, samples).schema, name, objects, nullable=False)
    tree = {"name": name, "representation": kind, **({"inputCollection": input_collection} if input_collection else {}), "arguments": {n: {"type": type_json(t)} for n, t in arguments.items()}, "resultDocumentType": name, "objectTypes": objects_json(objects), "pipeline": pipeline}
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(tree, indent=2) + "\n")
    catalog.add_view(view)
    return path


def _sample(t: Type) -> Any:
    from ..types import ListOf, Nullable, Scalar

    match t:
        case Nullable(inner):
            return _sample(inner)
        case ListOf():
            return []
        case Scalar("int" | "long"):
            return 0
        case Scalar("double" | "decimal"):
            return 0.0
        case Scalar("bool"):
            return False
    return ""


def delete_view(folder: str | Path, catalog: Catalog, name: str) -> None:
    path = Path(folder) / "native_queries" / f"{name}.json"
    if not path.exists():
        raise SchemaError(f"no view {name}")
    path.unlink()
    catalog.drop_view(name)
