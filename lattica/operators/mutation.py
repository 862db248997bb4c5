"""Commands that change collections: insert, update, delete.

A collection that can change is a folder of versions.  Inserts add files to the version at
hand; updates and deletes write the next version and then move on to it, so readers see
one version or the other.  There are no transactions over several commands.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import BadQuery, MissingArgument, NotSupported, UnknownArgument, UnknownCollection
from ..functions.aggregation import Scope, compile_expression
from ..functions.documents import literal, quoted, resolve
from ..plans.templates import interpolate
from ..sources.catalog import Catalog
from ..sources.config import MutationConfig
from .pipeline import Pipeline, match_document, _set_path


class VersionedTable:
    """A Parquet collection under a folder, as <folder>/v<number>."""

    def __init__(self, catalog: Catalog, name: str, folder: str, first: DataFrame):
        self.catalog, self.name, self.folder, self.version = catalog, name, folder.rstrip("/"), 0
        first.write.mode("errorifexists").parquet(self.path)
        self.schema = first.schema
        catalog.add(name, self.read)

    @property
    def path(self) -> str:
        return f"{self.folder}/v{self.version}"

    def read(self) -> DataFrame:
        return self.catalog.spark.read.schema(self.schema).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)

    def replace(self, rows: DataFrame) -> None:
        rows.write.mode("errorifexists").parquet(f"{self.folder}/v{self.version + 1}")
        self.version += 1


def run_command(tables: Mapping[str, VersionedTable], catalog: Catalog, command: Mapping[str, Any]) -> dict[str, Any]:
    kind = next(iter(command))
    if kind not in ("insert", "update", "delete"):
        raise NotSupported(f"no command {kind}")
    name = command[kind]
    if name not in tables:
        raise UnknownCollection(f"no collection {name} that can change")
    table = tables[name]
    if kind == "insert":
        return _insert(table, command["documents"])
    n = 0
    for own in command["updates" if kind == "update" else "deletes"]:
        n += (_update if kind == "update" else _delete)(table, catalog, own)
    return {"ok": 1.0, "n": n}


def _insert(table: VersionedTable, documents: Sequence[Mapping[str, Any]]) -> dict[str, Any]:
    """Missing fields are null; fields that the collection has not are an error."""
    spark = table.catalog.spark
    for d in documents:
        if extra := set(d) - set(table.schema.fieldNames()):
            raise BadQuery(f"{table.name} has no {', '.join(sorted(extra))}")
        row = spark.range(1).select(*[literal(d.get(f.name), f.dataType).cast(f.dataType).alias(f.name) for f in table.schema.fields])
        table.append(row)
    return {"ok": 1.0, "n": len(documents)}


def _condition(table: VersionedTable, catalog: Catalog, q: Any) -> Column:
    return q if isinstance(q, Column) else match_document(Pipeline(catalog), table.schema, q or {})


def _changed(schema: T.StructType, u: Mapping[str, Any]) -> list[Column]:
    """The fields of an updated document."""
    current, out = schema, [quoted(f) for f in schema.fieldNames()]
    values: list[tuple[str, Column]] = []
    for op, fields in u.items():
        for path, v in fields.items():
            column, kind = resolve(schema, path.split("."))
            if op == "$set":
                new = compile_expression(v, Scope(schema)) if isinstance(v, (Mapping, str)) and not isinstance(kind, T.StringType) else literal(v, kind)
            elif op == "$inc":
                new = column + F.lit(v)
            elif op == "$mul":
                new = column * F.lit(v)
            elif op == "$unset":
                new = F.lit(None)
            elif op in ("$min", "$max"):
                new = (F.least if op == "$min" else F.greatest)(column, literal(v, kind))
            else:
                raise NotSupported(f"no update {op}")
            values.append((path, new.cast(kind)))
    by_field: dict[str, list[tuple[list[str], Column]]] = {}
    for path, new in values:
        head, *rest = path.split(".")
        by_field.setdefault(head, []).append((rest, new))
    out = []
    for f in current.fields:
        x = quoted(f.name)
        for rest, new in by_field.get(f.name, ()):
            x = new if not rest else F.struct(*_set_path(f.dataType, rest, new, x))
        out.append(x.alias(f.name))
    return out


def _update(table: VersionedTable, catalog: Catalog, own: Mapping[str, Any]) -> int:
    if not own.get("multi"):
        raise NotSupported("an update of the first match only: rows have no order")
    where = _condition(table, catalog, own.get("q"))
    before = table.read()
    n = before.filter(where).count()
    if n:
        columns = [F.when(where, new).otherwise(quoted(f)).alias(f) for f, new in zip(table.schema.fieldNames(), _changed(table.schema, own["u"]), strict=True)]
        table.replace(before.select(*columns))
    return n


def _delete(table: VersionedTable, catalog: Catalog, own: Mapping[str, Any]) -> int:
    if own.get("limit"):
        raise NotSupported("a delete of the first match only: rows have no order")
    where = _condition(table, catalog, own.get("q"))
    before = table.read()
    n = before.filter(where).count()
    if n:
        table.replace(before.filter(~where))
    return n


def run_mutations(tables: Mapping[str, VersionedTable], catalog: Catalog, known: Mapping[str, MutationConfig], calls: Sequence[tuple[str, Mapping[str, Any]]], fields: Mapping[str, str] | None = None) -> list[dict[str, Any]]:
    """Runs named mutations at the same time; ``fields`` (alias to name) picks from results."""
    commands = []
    for name, arguments in calls:
        if name not in known:
            raise BadQuery(f"no mutation {name}")
        declared = known[name].arguments
        if extra := set(arguments) - set(declared):
            raise UnknownArgument(f"mutation {name} has no argument {', '.join(sorted(extra))}")
        if missing := set(declared) - set(arguments):
            raise MissingArgument(f"mutation {name} needs {', '.join(sorted(missing))}")
        commands.append(interpolate(known[name].command, arguments))
    with ThreadPoolExecutor(max(1, len(commands))) as pool:
        results = list(pool.map(lambda c: run_command(tables, catalog, c), commands))
    return results if fields is None else [{a: r.get(n) for a, n in fields.items()} for r in results]
