"""Document queries to DataFrames.

A query gives up to three results over one row set (filtered, ordered, limited): rows,
aggregates, groups.  A related query is the same thing once per parent: it runs over the
whole target collection, grouped by the keys that join it to its parents, and the results
are joined on.  Sets of variables are parents of that kind as well, so a query with a
thousand sets is one join, not a thousand queries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import count
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import BadQuery, MissingArgument, NotSupported, ResponseMismatch, UnknownArgument
from ..functions.documents import literal, quoted, resolve, test
from ..plans.graph import Tree
from ..sources.catalog import Catalog
from ..types import Type, from_spark, to_json

SET = "__set"


@dataclass
class Results:
    """Lazy results of a query; with sets of variables each has a column ``__set``."""

    rows: DataFrame | None = None
    aggregates: DataFrame | None = None
    groups: DataFrame | None = None
    #: Number of sets of variables, or None.
    sets: int | None = None
    dimensions: list[str] = field(default_factory=list)
    #: The row set that the parts share, held in memory until release(), if there is one.
    shared: DataFrame | None = None

    def release(self) -> None:
        """Gives up the shared row set; the parts still work, from the start."""
        if self.shared is not None:
            self.shared.unpersist()
            self.shared = None

    def explain(self) -> str:
        """Plans of all parts."""
        parts = {n: df for n in ("rows", "aggregates", "groups") if (df := getattr(self, n)) is not None}
        return "\n".join(f"== {n} ==\n" + df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")) for n, df in parts.items())


def _path(tree: Tree, name: str = "name") -> list[str]:
    return [tree[name], *(tree.get("field_path") or ())]


class GraphCompiler:
    def __init__(self, catalog: Catalog, relationships: Mapping[str, Tree] | None = None, variables: Sequence[Mapping[str, Any]] | None = None):
        self.catalog, self.relationships, self.sets = catalog, dict(relationships or {}), variables
        self.number = count()
        #: How many EXISTS over related rows the predicate at hand stands in.
        self.depth = 0

    def fresh(self, what: str) -> str:
        return f"__{what}{next(self.number)}"

    # -- requests -------------------------------------------------------------------------------

    def request(self, tree: Tree) -> Results:
        query, keys = tree["query"], []
        if self.sets is None:
            df = self.catalog.open(tree["collection"], self.arguments(tree.get("arguments")))
        else:
            keys, parts = [SET], []
            for given, ordinals in self._argument_sets(tree.get("arguments")):
                part, own = self._with_variables(self.catalog.open(tree["collection"], given), query, ordinals)
                parts.append(part)
            df, query = reduce(DataFrame.unionByName, parts), own
        df = self.row_set(df, query, keys)
        out = Results(sets=None if self.sets is None else len(self.sets))
        has = {n: bool(query.get(n)) for n in ("fields", "aggregates")} | {"groups": query.get("groups") is not None}
        if sum(has.values()) > 1 and (query.get("limit") is not None or query.get("offset")):
            # which rows a limit keeps may differ from run to run: all parts get the same ones
            df = self._mark(df.persist(), df._lattica_order)
            out.shared = df
        if has["aggregates"]:
            out.aggregates = self.aggregates(df, query["aggregates"], keys)
        if has["groups"]:
            out.groups, out.dimensions = self.groups(df, query["groups"], keys)
        if has["fields"] or not (has["aggregates"] or has["groups"]):
            out.rows = self.rows(df, query, keys)
        return out

    def arguments(self, given: Mapping[str, Any] | None) -> dict[str, Any]:
        """Plain values of literal arguments."""
        out = {}
        for name, a in (given or {}).items():
            if isinstance(a, Mapping) and a.get("type") == "literal":
                out[name] = a["value"]
            elif isinstance(a, Mapping) and a.get("type") == "variable":
                values = {repr(s.get(a["name"])): s.get(a["name"]) for s in self.sets or ()}
                if len(values) != 1:
                    raise NotSupported(f'argument "{name}" differs between the sets of variables')
                (out[name],) = values.values()
            else:
                out[name] = a
        return out

    def _argument_sets(self, given: Mapping[str, Any] | None) -> list[tuple[dict[str, Any], list[int]]]:
        """The arguments of a view for the sets of variables, each with the sets that have
        them; without variables in them, one for all sets."""
        found: dict[str, tuple[dict[str, Any], list[int]]] = {}
        for i, s in enumerate(self.sets or ()):
            own = {n: {"type": "literal", "value": s.get(a["name"])} if isinstance(a, Mapping) and a.get("type") == "variable" else a for n, a in (given or {}).items()}
            plain = self.arguments(own)
            found.setdefault(repr(sorted(plain.items())), (plain, []))[1].append(i)
        return list(found.values()) or [(self.arguments(given), [])]

    def _with_variables(self, df: DataFrame, query: Tree, ordinals: Sequence[int]) -> tuple[DataFrame, Tree]:
        """Rows met with each set of variables: one column per variable that is used, and an
        ordinal.  The sets come with the request, so they are few and are broadcast; equalities
        with variables become the condition of a hash join."""
        used = sorted(_variables(query))
        sets = list(self.sets or ())
        for name in used:
            if any(name not in s for s in sets):
                raise MissingArgument(f"no variable {name} in some set")
        samples = [[s[n] for n in used] for s in sets]
        kinds = [_type_of([row[i] for row in samples]) for i in range(len(used))]
        schema = T.StructType([T.StructField(SET, T.IntegerType(), False), *[T.StructField(f"__var_{n}", k) for n, k in zip(used, kinds, strict=True)]])
        own = self.catalog.spark.createDataFrame([(i, *samples[i]) for i in ordinals], schema)
        equal, rest = [], []
        for p in _conjuncts(query.get("predicate")):
            simple = p["type"] == "binary_comparison_operator" and p["operator"] == "_eq" and p["value"]["type"] == "variable"
            (equal if simple else rest).append(p)
        pairs = []
        for p in equal:
            column, kind = resolve(df.schema, _path(p["column"]))
            variable = quoted(f"__var_{p['value']['name']}")
            pairs.append(test("eq", column, kind, variable) if isinstance(kind, T.ArrayType) else column.eqNullSafe(variable.cast(kind)))
        on = reduce(lambda a, b: a & b, pairs, F.lit(True))
        joined = df.join(F.broadcast(own), on)
        return joined, {**query, "predicate": {"type": "and", "expressions": rest}}

    # -- row sets -------------------------------------------------------------------------------

    def row_set(self, df: DataFrame, query: Tree, keys: Sequence[str]) -> DataFrame:
        """Filtered, ordered and limited, per key; the order is left in hidden columns."""
        if query.get("predicate"):
            df = self.filter(df, query["predicate"])
        elements = (query.get("order_by") or {}).get("elements") or []
        limit, offset = query.get("limit"), query.get("offset") or 0
        df, order = self._order_columns(df, elements)
        if limit is None and not offset:
            return self._mark(df, order)
        if keys:
            rank = self.fresh("rank")
            over = Window.partitionBy(*map(quoted, keys)).orderBy(*(order or [F.lit(1)]))
            df = df.withColumn(rank, F.row_number().over(over)).filter(quoted(rank) > offset)
            if limit is not None:
                df = df.filter(quoted(rank) <= offset + limit)
            return self._mark(df.drop(rank), order)
        df = df.orderBy(*order) if order else df
        df = df.offset(offset) if offset else df
        return self._mark(df if limit is None else df.limit(limit), order)

    def _mark(self, df: DataFrame, order: list[Column]) -> DataFrame:
        df._lattica_order = order
        return df

    def _order_columns(self, df: DataFrame, elements: Sequence[Tree]) -> tuple[DataFrame, list[Column]]:
        order = []
        for e in elements:
            t, name = e["target"], self.fresh("order")
            down = e["order_direction"] == "desc"
            if t["type"] == "aggregate":
                df = self._along_path(df, t["path"], lambda inner, keys, t=t, name=name: self.aggregates(inner, {name: t["aggregate"]}, keys), name)
                if t["aggregate"]["type"] != "single_column":
                    df = df.withColumn(name, F.coalesce(quoted(name), F.lit(0)))
            elif t.get("path"):
                # among several related rows the least value counts upwards, the greatest downwards
                pick = F.max if down else F.min
                df = self._along_path(df, t["path"], lambda inner, keys, t=t, name=name, pick=pick: inner.groupBy(*map(quoted, keys)).agg(pick(resolve(inner.schema, _path(t))[0]).alias(name)), name)
            else:
                column, kind = resolve(df.schema, _path(t))
                if isinstance(kind, T.ArrayType):
                    column = F.array_max(column) if down else F.array_min(column)
                df = df.withColumn(name, column)
            order.append(quoted(name).desc_nulls_last() if down else quoted(name).asc_nulls_first())
        return df, order

    def _along_path(self, df: DataFrame, path: Sequence[Tree], summary, name: str) -> DataFrame:
        """Joins to ``df`` one value per row, a summary of the rows at the end of a path."""
        first, names = path[0], []
        inner = self._target(first)
        r = self._relationship(first["relationship"])
        for mapped in r["column_mapping"].values():
            key = self.fresh("key")
            inner = inner.withColumn(key, resolve(inner.schema, list(mapped))[0])
            names.append(key)
        for step in path[1:]:
            following = self._target(step)
            following = following.select([quoted(c).alias(c if not c.startswith("__") else c) for c in following.columns])
            mapping = self._relationship(step["relationship"])["column_mapping"]
            condition, far = [], []
            for source, mapped in mapping.items():
                key = self.fresh("key")
                following = following.withColumn(key, resolve(following.schema, list(mapped))[0])
                far.append(key)
                condition.append((source, key))
            carried = inner.select(*[quoted(n) for n in names], *[resolve(inner.schema, [source])[0].alias(f"{k}s") for source, k in condition])
            on = reduce(lambda a, b: a & b, [quoted(f"{k}s").eqNullSafe(quoted(k)) for _, k in condition])
            inner = carried.join(following, on).drop(*far, *[f"{k}s" for _, k in condition])
        summed = summary(inner, names).select(*map(quoted, names), quoted(name))
        on = self._on(df, summed, r, names)
        return df.join(summed, on, "left").drop(*names)

    # -- relationships ----------------------------------------------------------------------------

    def _relationship(self, name: str) -> Tree:
        if name not in self.relationships:
            raise BadQuery(f"no relationship {name}")
        return self.relationships[name]

    def _target(self, step: Tree) -> DataFrame:
        r = self._relationship(step["relationship"])
        given = {**self.arguments(r.get("arguments")), **self.arguments(step.get("arguments"))}
        df = self.catalog.open(r["target_collection"], given)
        return self.filter(df, step["predicate"]) if step.get("predicate") else df

    def _on(self, df: DataFrame, other: DataFrame, r: Tree, names: Sequence[str]) -> Column:
        """Null joins null, as all equalities have it."""
        pairs = []
        for source, key in zip(r["column_mapping"], names, strict=True):
            column = resolve(df.schema, source.split(".") if source not in df.columns else [source])[0]
            nullable = df.select(column).schema[0].nullable and other.schema[key].nullable
            pairs.append(column.eqNullSafe(quoted(key)) if nullable else column == quoted(key))
        return reduce(lambda a, b: a & b, pairs)

    def _keyed(self, df: DataFrame, r: Tree) -> tuple[DataFrame, list[str]]:
        names = []
        for mapped in r["column_mapping"].values():
            key = self.fresh("key")
            df = df.withColumn(key, resolve(df.schema, list(mapped))[0])
            names.append(key)
        return df, names

    def add_related(self, df: DataFrame, tree: Tree, name: str) -> DataFrame:
        """``df`` with a struct column: the results of a related query for each row."""
        r, query = self._relationship(tree["relationship"]), tree["query"]
        inner, keys = self._keyed(self._target(tree), r)
        inner = self.row_set(inner, query, keys)
        parts: dict[str, DataFrame] = {}
        if query.get("aggregates"):
            own = self.aggregates(inner, query["aggregates"], keys)
            names = list(query["aggregates"])
            parts["aggregates"] = own.select(*map(quoted, keys), F.struct(*map(quoted, names)).alias("__v"))
        if query.get("groups") is not None:
            own, dims = self.groups(inner, query["groups"], keys)
            value = F.struct(F.struct(*[quoted(d).alias(f"d{i}") for i, d in enumerate(dims)]).alias("dimensions"), F.struct(*[quoted(a) for a in query["groups"]["aggregates"]] or [F.lit(None).alias("none")]).alias("aggregates"))
            place = [c for c in own.columns if c.startswith("__place")]
            parts["groups"] = own.groupBy(*map(quoted, keys)).agg(self._listed(value, place))
        if query.get("fields") or not parts:
            rows, columns, place = self._selected(inner, query.get("fields") or {}, keys)
            value = F.struct(*map(quoted, columns)) if columns else F.struct(F.lit(None).alias("none"))
            parts["rows"] = rows.groupBy(*map(quoted, keys)).agg(self._listed(value, place))
        out, columns = None, []
        for part, frame in parts.items():
            own = [self.fresh("k") for _ in keys]
            held = self.fresh("v")
            frame = frame.select(*[quoted(k).alias(o) for k, o in zip(keys, own, strict=True)], quoted("__v").alias(held))
            df = df.join(frame, self._on(df, frame, r, own), "left").drop(*own)
            value = quoted(held)
            if part == "aggregates":  # no related rows: counts are 0, the rest is null
                kind = frame.schema[held].dataType
                empty = [F.coalesce(value.getField(n), F.lit(0)).alias(n) if a["type"] != "single_column" else value.getField(n).alias(n) for n, a in query["aggregates"].items()]
                value = F.struct(*empty) if empty else value.cast(kind)
            else:
                value = F.coalesce(value, F.array().cast(frame.schema[held].dataType))
            columns.append((part, held, value))
        out = df.withColumn(name, F.struct(*[v.alias(p) for p, _, v in columns]))
        return out.drop(*[h for _, h, _ in columns])

    def _listed(self, value: Column, place: Sequence[str]) -> Column:
        """Values of a group as an array, in the order of their place columns."""
        if not place:
            return F.collect_list(value).alias("__v")
        rows = F.array_sort(F.collect_list(F.struct(*[quoted(p) for p in place], value.alias("v"))))
        return F.transform(rows, lambda r: r["v"]).alias("__v")

    # -- rows -------------------------------------------------------------------------------------

    def _selected(self, df: DataFrame, fields: Mapping[str, Tree], keys: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
        """``df`` with the keys, the fields under fresh names, and a place column if ordered."""
        order: list[Column] = getattr(df, "_lattica_order", [])
        place = []
        if order:
            place = [self.fresh("place")]
            over = Window.partitionBy(*map(quoted, keys)).orderBy(*order)
            df = df.withColumn(place[0], F.row_number().over(over))
        made: list[tuple[str, Column]] = []
        for alias, tree in fields.items():
            if tree["type"] == "relationship":
                held = self.fresh("rel")
                df = self.add_related(df, tree, held)
                made.append((alias, quoted(held)))
            elif tree["type"] == "column":
                if tree.get("arguments"):
                    raise UnknownArgument(f'field "{tree["column"]}" takes no arguments')
                column, kind = resolve(df.schema, [tree["column"]])
                made.append((alias, self.shaped(column, kind, tree.get("fields"))))
            else:
                raise BadQuery(f"no field of type {tree['type']}")
        out = df.select(*map(quoted, keys), *map(quoted, place), *[c.alias(a) for a, c in made])
        return out, [a for a, _ in made], place

    def shaped(self, column: Column, kind: T.DataType, tree: Tree | None) -> Column:
        """A nested selection: objects of chosen fields, through arrays of any depth.  Null
        objects and arrays stay null."""
        if tree is None:
            return column
        if tree["type"] == "array":
            if not isinstance(kind, T.ArrayType):
                raise BadQuery(f"{kind.simpleString()} is not an array")
            return F.transform(column, lambda x: self.shaped(x, kind.elementType, tree["fields"]))
        if isinstance(kind, T.ArrayType):
            return F.transform(column, lambda x: self.shaped(x, kind.elementType, tree))
        if not isinstance(kind, T.StructType):
            raise BadQuery(f"{kind.simpleString()} has no fields")
        parts = []
        for alias, inner in tree["fields"].items():
            if inner["type"] != "column":
                raise NotSupported("relationships inside nested objects")
            value, own = resolve(kind, [inner["column"]], column)
            parts.append(self.shaped(value, own, inner.get("fields")).alias(alias))
        return F.when(column.isNotNull(), F.struct(*parts))

    def rows(self, df: DataFrame, query: Tree, keys: Sequence[str]) -> DataFrame:
        order: list[Column] = getattr(df, "_lattica_order", [])
        hidden = [c for c in df.columns if c.startswith("__order")]
        made: list[Column] = []
        for alias, tree in (query.get("fields") or {}).items():
            if tree["type"] == "relationship":
                held = self.fresh("rel")
                df = self.add_related(df, tree, held)
                made.append(quoted(held).alias(alias))
            else:
                (_, value), = [(alias, self._field(df, tree))]
                made.append(value.alias(alias))
        out = df.select(*map(quoted, keys), *made, *map(quoted, hidden))
        if order:  # joins lose the order, so it comes last
            out = out.orderBy(*[quoted(k) for k in keys], *order)
        return out.drop(*hidden)

    def _field(self, df: DataFrame, tree: Tree) -> Column:
        if tree["type"] != "column":
            raise BadQuery(f"no field of type {tree['type']}")
        if tree.get("arguments"):
            raise UnknownArgument(f'field "{tree["column"]}" takes no arguments')
        column, kind = resolve(df.schema, [tree["column"]])
        return self.shaped(column, kind, tree.get("fields"))

    # -- aggregates and groups -----------------------------------------------------------------------

    def aggregate_column(self, schema: T.StructType, tree: Tree) -> Column:
        if tree["type"] == "star_count":
            return F.count(F.lit(1))
        column, kind = resolve(schema, _path(tree, "column"))
        if isinstance(kind, T.ArrayType):
            raise NotSupported(f"an aggregate through the array {tree['column']}")
        if tree["type"] == "column_count":
            return F.count_distinct(column) if tree.get("distinct") else F.count(column)
        makers = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
        if tree["function"] not in makers:
            raise BadQuery(f"no aggregate {tree['function']}")
        return makers[tree["function"]](column)

    def aggregates(self, df: DataFrame, trees: Mapping[str, Tree], keys: Sequence[str]) -> DataFrame:
        """One row per key; without keys one row, of no rows too: counts 0, the rest null.  With
        sets of variables a set without rows has its row as well."""
        own = [self.aggregate_column(df.schema, t).alias(n) for n, t in trees.items()]
        out = df.groupBy(*map(quoted, keys)).agg(*own) if keys else df.agg(*own)
        if list(keys) == [SET]:
            sets = self.catalog.spark.range(len(self.sets or ())).select(F.col("id").cast("int").alias(SET))
            filled = [F.coalesce(quoted(n), F.lit(0)).alias(n) if t["type"] != "single_column" else quoted(n) for n, t in trees.items()]
            out = sets.join(out, SET, "left").select(SET, *filled)
        return out

    def groups(self, df: DataFrame, tree: Tree, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
        """One row per key and group: the dimensions, then the aggregates by name."""
        dims = []
        for d in tree["dimensions"]:
            name = self.fresh("dim")
            if d.get("path"):
                # the dimension is all values found along the path
                df = self._along_path(df, d["path"], lambda inner, ks, d=d, name=name: inner.groupBy(*map(quoted, ks)).agg(F.sort_array(F.collect_list(resolve(inner.schema, _path(d, "column_name"))[0])).alias(name)), name)
                kind = df.schema[name].dataType
                df = df.withColumn(name, F.coalesce(quoted(name), F.array().cast(kind)))
            else:
                df = df.withColumn(name, resolve(df.schema, _path(d, "column_name"))[0])
            dims.append(name)
        own = [self.aggregate_column(df.schema, a).alias(n) for n, a in tree["aggregates"].items()]
        by = [*map(quoted, keys), *map(quoted, dims)]
        out = df.groupBy(*by).agg(*own) if own else df.select(*by).distinct()
        for p in _conjuncts(tree.get("predicate")):
            name = p["target"]["name"]
            out = out.filter(test(p["operator"].removeprefix("_"), quoted(name), out.schema[name].dataType, p["value"]["value"]))
        elements = (tree.get("order_by") or {}).get("elements") or []
        order = []
        for e in elements:
            t = e["target"]
            c = quoted(dims[t["index"]] if t["type"] == "dimension" else t["name"])
            order.append(c.desc_nulls_last() if e["order_direction"] == "desc" else c.asc_nulls_first())
        limit, offset = tree.get("limit"), tree.get("offset") or 0
        if keys and (order or limit is not None or offset):
            place = self.fresh("place")
            over = Window.partitionBy(*map(quoted, keys)).orderBy(*(order or map(quoted, dims)))
            out = out.withColumn(place, F.row_number().over(over)).filter(quoted(place) > offset)
            out = out if limit is None else out.filter(quoted(place) <= offset + limit)
        elif not keys:
            out = out.orderBy(*order) if order else out
            out = out.offset(offset) if offset else out
            out = out if limit is None else out.limit(limit)
        return out, dims

    # -- predicates -------------------------------------------------------------------------------------

    def filter(self, df: DataFrame, tree: Tree) -> DataFrame:
        """Parts of a conjunction one by one: a related exists there is a semi-join."""
        for part in _conjuncts(tree):
            if part["type"] == "exists" and part["in_collection"]["type"] == "related":
                df = self._semi(df, part)
                continue
            before = df.columns
            df, condition = self.condition(df, part, positive=True)
            df = df.filter(condition).select(*map(quoted, before))
        return df

    def _matching(self, df: DataFrame, tree: Tree) -> tuple[DataFrame, Column, list[str]]:
        """Rows that stand for the matches of an EXISTS over related rows, the condition that
        joins them to ``df``, and their columns.

        A predicate that names columns of rows around it is tried on pairs: each distinct
        combination of the keys and these columns, joined by key to the related rows.
        """
        where, predicate = tree["in_collection"], tree.get("predicate")
        r = self._relationship(where["relationship"])
        outer = self._outer_columns(predicate)
        if not outer:
            self.depth += 1
            inner = self._target({**where, "predicate": predicate})
            self.depth -= 1
            keyed, names = self._keyed(inner, r)
            return keyed.select(*map(quoted, names)), self._on(df, keyed, r, names), names
        sources = [resolve(df.schema, s.split(".") if s not in df.columns else [s])[0] for s in r["column_mapping"]]
        mine = [self.fresh("mine") for _ in sources]
        carried = {name: resolve(df.schema, [column])[0] for name, column in outer.items()}
        asked = df.select(*[s.alias(m) for s, m in zip(sources, mine, strict=True)], *[c.alias(n) for n, c in carried.items()]).distinct()
        inner, names = self._keyed(self._target(where), r)
        on = reduce(lambda a, b: a & b, [quoted(m).eqNullSafe(quoted(n)) for m, n in zip(mine, names, strict=True)])
        self.depth += 1
        pairs = self.filter(inner.drop(*[c for c in carried if c in inner.columns]).join(asked, on), predicate)
        self.depth -= 1
        held = [self.fresh("held") for _ in (*mine, *carried)]
        found = pairs.select(*[quoted(c).alias(h) for c, h in zip((*mine, *carried), held, strict=True)]).distinct()
        return found, reduce(lambda a, b: a & b, [c.eqNullSafe(quoted(h)) for c, h in zip((*sources, *carried.values()), held, strict=True)]), held

    def _outer_columns(self, predicate: Tree | None) -> dict[str, str]:
        """What a predicate over related rows uses of the rows around them: the name that it is
        carried by, and its column in the row set at hand."""
        out: dict[str, str] = {}
        for back, column in _scoped(predicate, 0):
            name = _carried(self.depth - back + 1, column)
            out[name] = column if back == 1 else name
        return out

    def _semi(self, df: DataFrame, tree: Tree) -> DataFrame:
        inner, on, _ = self._matching(df, tree)
        return df.join(inner, on, "left_semi")

    def condition(self, df: DataFrame, tree: Tree, positive: bool = False) -> tuple[DataFrame, Column]:
        """A condition, and ``df`` with the flag columns that it needs; ``positive`` if null
        is as good as false there."""
        kind = tree["type"]
        if kind in ("and", "or"):
            parts = []
            for e in tree["expressions"]:
                df, c = self.condition(df, e, positive)
                parts.append(c)
            return df, reduce(lambda a, b: a & b if kind == "and" else a | b, parts, F.lit(kind == "and")) if parts else F.lit(kind == "and")
        if kind == "not":
            df, c = self.condition(df, tree["expression"])
            return df, ~c
        if kind == "exists":
            return self._exists(df, tree)
        return df, self.comparison(df.schema, tree, None, positive)

    def _exists(self, df: DataFrame, tree: Tree) -> tuple[DataFrame, Column]:
        where, predicate = tree["in_collection"], tree.get("predicate")
        if where["type"] == "related":  # under "or" or "not": a flag by key
            inner, on, names = self._matching(df, tree)
            flag = self.fresh("flag")
            inner = inner.distinct().withColumn(flag, F.lit(True))
            df = df.join(inner, on, "left").drop(*names)
            return df, F.coalesce(quoted(flag), F.lit(False))
        if where["type"] == "unrelated":
            if _scoped(predicate, 0):
                raise NotSupported("columns of the rows around an EXISTS over unrelated rows")
            inner = self.catalog.open(where["collection"], self.arguments(where.get("arguments")))
            inner = self.filter(inner, predicate) if predicate else inner
            return df, inner.select(F.lit(1)).limit(1).exists()
        column, kind = resolve(df.schema, _path(where, "column_name"))
        if not isinstance(kind, T.ArrayType):
            raise BadQuery(f"{where['column_name']} is not an array")
        if predicate is None:
            return df, F.coalesce(F.size(column) > 0, F.lit(False))
        if where["type"] == "nested_scalar_collection":
            wrapped = T.StructType([T.StructField("__value", kind.elementType)])
            return df, F.coalesce(F.exists(column, lambda x: self.element_condition(wrapped, F.struct(x.alias("__value")), predicate)), F.lit(False))
        if not isinstance(kind.elementType, T.StructType):
            raise BadQuery(f"{where['column_name']} holds no objects")
        return df, F.coalesce(F.exists(column, lambda x: self.element_condition(kind.elementType, x, predicate)), F.lit(False))

    def element_condition(self, schema: T.StructType, x: Column, tree: Tree) -> Column:
        """A condition on an element of an array; nothing outside it can be named."""
        kind = tree["type"]
        if kind in ("and", "or"):
            parts = [self.element_condition(schema, x, e) for e in tree["expressions"]]
            return reduce(lambda a, b: a & b if kind == "and" else a | b, parts, F.lit(kind == "and")) if parts else F.lit(kind == "and")
        if kind == "not":
            return ~self.element_condition(schema, x, tree["expression"])
        if kind == "exists":
            where = tree["in_collection"]
            if where["type"] not in ("nested_collection", "nested_scalar_collection"):
                raise NotSupported("related rows of an array's elements")
            column, own = resolve(schema, _path(where, "column_name"), x)
            inner = own.elementType
            predicate = tree.get("predicate")
            if predicate is None:
                return F.coalesce(F.size(column) > 0, F.lit(False))
            if where["type"] == "nested_scalar_collection":
                wrapped = T.StructType([T.StructField("__value", inner)])
                return F.coalesce(F.exists(column, lambda y: self.element_condition(wrapped, F.struct(y.alias("__value")), predicate)), F.lit(False))
            return F.coalesce(F.exists(column, lambda y: self.element_condition(inner, y, predicate)), F.lit(False))
        return self.comparison(schema, tree, x)

    def comparison(self, schema: T.StructType, tree: Tree, base: Column | None = None, positive: bool = False) -> Column:
        target = tree["column"]
        if target.get("path"):
            raise NotSupported("a comparison with a related column; use exists")
        column, kind = resolve(schema, _path(target), base)
        if tree["type"] == "unary_comparison_operator":
            if tree["operator"] != "is_null":
                raise BadQuery(f"no operator {tree['operator']}")
            return column.isNull()
        if tree["type"] == "array_comparison":
            c = tree["comparison"]
            if c["type"] == "is_empty":
                return F.coalesce(F.size(column) == 0, F.lit(False))
            return test("eq", column, kind, self.operand(schema, c["value"], base))
        if tree["type"] != "binary_comparison_operator":
            raise BadQuery(f"no condition of type {tree['type']}")
        op = tree["operator"].removeprefix("_")
        v = self.operand(schema, tree["value"], base)
        if op in ("regex", "iregex") and not isinstance(v, Column):
            v = F.lit(v)
        return test(op, column, kind, v, positive)

    def operand(self, schema: T.StructType, tree: Tree, base: Column | None = None) -> Any:
        if tree["type"] == "scalar":
            return tree["value"]
        if tree["type"] == "variable":
            name = f"__var_{tree['name']}"
            if base is None and name not in schema.fieldNames():
                raise MissingArgument(f"no variable {tree['name']} here")
            return quoted(name)
        if tree["type"] == "column":
            if tree.get("path"):
                raise NotSupported("a comparison with a column of a related row")
            if scope := tree.get("scope"):
                if base is not None and scope == 1:  # a field of the document around the array
                    return quoted(tree["name"])
                if base is not None:
                    raise NotSupported("columns of rows around the document that holds an array")
                name = _carried(self.depth - scope, tree["name"])
                if name not in schema.fieldNames():
                    raise BadQuery(f"no scope {scope} around {tree['name']}")
                return resolve(schema, [name, *(tree.get("field_path") or ())])[0]
            return resolve(schema, _path(tree), base)[0]
        raise BadQuery(f"no value of type {tree['type']}")


def _carried(depth: int, column: str) -> str:
    """The name of a column of the rows at a depth, inside the EXISTS below."""
    return f"__scope{depth}_{column}"


def _scoped(tree: Tree | None, level: int) -> set[tuple[int, str]]:
    """(scopes back, column) of the columns that a predicate names outside its own rows."""
    if not tree:
        return set()
    if tree["type"] in ("and", "or"):
        return set().union(*[_scoped(e, level) for e in tree["expressions"]])
    if tree["type"] == "not":
        return _scoped(tree["expression"], level)
    if tree["type"] == "exists":
        return _scoped(tree.get("predicate"), level + 1)
    v = tree.get("value") or {}
    back = (v.get("scope") or 0) - level if v.get("type") == "column" else 0
    return {(back, v["name"])} if back > 0 else set()


def _conjuncts(tree: Tree | None) -> list[Tree]:
    if not tree:
        return []
    if tree["type"] == "and":
        return [c for e in tree["expressions"] for c in _conjuncts(e)]
    return [tree]


def _variables(tree: Any) -> set[str]:
    """Names of the variables that a query uses; those that it does not are left out."""
    if isinstance(tree, Mapping):
        own = {tree["name"]} if tree.get("type") == "variable" else set()
        return own.union(*[_variables(v) for v in tree.values()])
    if isinstance(tree, (list, tuple)):
        return set().union(*map(_variables, tree))
    return set()


def _type_of(values: Sequence[Any]) -> T.DataType:
    known = [v for v in values if v is not None]
    if not known:
        return T.StringType()
    if all(isinstance(v, bool) for v in known):
        return T.BooleanType()
    if all(isinstance(v, int) for v in known):
        return T.LongType()
    if all(isinstance(v, (int, float)) for v in known):
        return T.DoubleType()
    if all(isinstance(v, (list, tuple)) for v in known):
        return T.ArrayType(_type_of([x for v in known for x in v]))
    return T.StringType()


def compile_request(tree: Tree, catalog: Catalog) -> Results:
    """The lazy results of a request."""
    return GraphCompiler(catalog, tree.get("collection_relationships"), tree.get("variables")).request(tree)


def execute_request(tree: Tree, catalog: Catalog, declared: Mapping[str, Type] | None = None, on_mismatch: str = "fail") -> list[Tree]:
    """Row sets as JSON values, one per set of variables, or one.  For results that fit the
    driver; larger ones are read from compile_request().

    ``declared`` gives types of row fields that differ from those of the plan; a row whose
    value does not have its type is an error, or is left out ("skipRow"), which changes no
    aggregate.
    """
    found = compile_request(tree, catalog)
    out: list[Tree] = [{} for _ in range(1 if found.sets is None else found.sets)]
    keys = 0 if found.sets is None else 1

    def put(df: DataFrame | None, add, types: Mapping[str, Type] | None = None) -> None:
        if df is None:
            return
        objects: dict = {}
        top = from_spark(df.schema, "row", objects, nullable=False)
        objects["row"].fields.update(types or {})
        for row in df.collect():
            try:
                value = to_json(row.asDict(), top, objects)
            except ResponseMismatch:
                if on_mismatch != "skipRow":
                    raise
                continue
            add(out[value.pop(SET) if keys else 0], value)

    if found.rows is not None:
        for o in out:
            o["rows"] = []
        put(found.rows, lambda o, v: o["rows"].append(v), declared)
    put(found.aggregates, lambda o, v: o.update(aggregates=v))
    if found.groups is not None:
        for o in out:
            o["groups"] = []
        put(found.groups, lambda o, v: o["groups"].append({"dimensions": [v[d] for d in found.dimensions], "aggregates": {n: v[n] for n in tree["query"]["groups"]["aggregates"]}}))
    found.release()
    return out
