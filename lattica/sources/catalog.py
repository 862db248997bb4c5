"""Collections and views by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import FunctionAsTable, InvalidArgument, MissingArgument, UnknownArgument, UnknownCollection, UnknownField

ViewFactory = Callable[["Catalog", dict[str, Any]], DataFrame]

_PYTHON = {T.StringType: str, T.BooleanType: bool, T.IntegerType: int, T.LongType: int, T.DoubleType: (int, float)}


@dataclass(frozen=True)
class View:
    """A parameterised view.  ``arguments`` maps names to Spark types (None: any value); a
    view of kind "function" gives one row with one column ``__value``."""

    name: str
    make: ViewFactory
    arguments: Mapping[str, T.DataType | None] = field(default_factory=dict)
    optional: frozenset[str] = frozenset()
    kind: str = "collection"

    def bind(self, given: Mapping[str, Any]) -> dict[str, Any]:
        """The arguments, checked: none unknown, none missing, each of its type."""
        for name in given:
            if name not in self.arguments:
                raise UnknownArgument(f'view "{self.name}" has no argument "{name}"')
        out = {}
        for name, kind in self.arguments.items():
            if name not in given:
                if name not in self.optional:
                    raise MissingArgument(f'view "{self.name}" needs argument "{name}"')
                out[name] = None
                continue
            value = given[name]
            want = _PYTHON.get(type(kind)) if kind is not None else None
            if value is not None and want and (not isinstance(value, want) or isinstance(value, bool) and want is not bool):
                raise InvalidArgument(f'argument "{name}" of "{self.name}" is no {kind.simpleString()}: {value!r}')
            if isinstance(kind, T.IntegerType) and isinstance(value, int) and not -(2**31) <= value < 2**31:
                raise InvalidArgument(f'argument "{name}" of "{self.name}" does not fit in 32 bits: {value}')
            out[name] = value
        return out


class Catalog:
    """Names to DataFrames.  A table is a DataFrame or a function that opens one."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None):
        self.spark = spark
        self.tables = dict(tables or {})
        self.views: dict[str, View] = {}

    @classmethod
    def parquet(cls, spark: SparkSession, folder: str, names: Sequence[str]) -> Catalog:
        """Tables of a folder with <name>.parquet each; nothing is read until it is asked for."""
        return cls(spark, {n: (lambda path=f"{folder}/{n}.parquet": spark.read.parquet(path)) for n in names})

    def add(self, name: str, table: DataFrame | Callable[[], DataFrame]) -> None:
        self.tables[name] = table

    def add_view(self, view: View) -> None:
        self.views[view.name] = view

    def drop_view(self, name: str) -> None:
        if name not in self.views:
            raise UnknownCollection(f'no view "{name}"')
        del self.views[name]

    def list_views(self) -> list[str]:
        return sorted(self.views)

    def show_view(self, name: str, **arguments: Any) -> dict[str, Any]:
        """What a view takes and gives; the columns come from the analysed plan."""
        view = self.views.get(name)
        if view is None:
            raise UnknownCollection(f'no view "{name}"')
        known = {n: None if t is None else t.simpleString() for n, t in view.arguments.items()}
        out: dict[str, Any] = {"name": name, "kind": view.kind, "arguments": known}
        if set(view.arguments) - set(view.optional) <= set(arguments):
            out["columns"] = {f.name: f.dataType.simpleString() for f in self.view(name, arguments).schema}
        return out

    def view(self, name: str, arguments: Mapping[str, Any]) -> DataFrame:
        view = self.views[name]
        return view.make(self, view.bind(arguments))

    def open(self, name: str, arguments: Mapping[str, Any] | None = None) -> DataFrame:
        arguments = arguments or {}
        if name in self.views:
            if self.views[name].kind == "function":
                raise FunctionAsTable(f'view "{name}" gives one value and cannot be used as a table')
            return self.view(name, arguments)
        if name not in self.tables:
            raise UnknownCollection(f'no collection "{name}"')
        if arguments:
            raise UnknownArgument(f'collection "{name}" takes no arguments: {", ".join(arguments)}')
        found = self.tables[name]
        return found if isinstance(found, DataFrame) else found()

    def call(self, name: str, arguments: Mapping[str, Any]) -> DataFrame:
        """The one row of a view of kind "function"."""
        if name not in self.views or self.views[name].kind != "function":
            raise UnknownCollection(f'no function "{name}"')
        df = self.view(name, arguments)
        if df.columns != ["__value"]:
            raise InvalidArgument(f'function "{name}" has to give one column, __value')
        return df

    def rows(self, name: str, columns: Sequence[str], arguments: Mapping[str, Any] | None = None) -> DataFrame:
        df = self.open(name, arguments)
        if unknown := [c for c in columns if c not in df.columns]:
            raise UnknownField(f'"{name}" has no {", ".join(unknown)}')
        return df.select(*[F.col("`" + c.replace("`", "``") + "`") for c in columns])


#: Tables of the test data.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
