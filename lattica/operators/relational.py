"""Relations to DataFrames.

Columns of every intermediate DataFrame are named by place (col_0, col_1, ...), so names
never clash, in self-joins either.  Renaming is free: Catalyst folds the projections and
still pushes filters and column choices into the scans.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import BadQuery, InvalidUnion, UnsupportedExpression, UnsupportedJoin, UnsupportedRelation
from ..functions import scalar  # noqa: F401  registers the scalar expressions
from ..functions.aggregates import AGGREGATES, compile_aggregate, sort_key
from ..functions.context import Context, Options
from ..functions.windows import compile_window, order_column
from ..plans import relational as R
from ..sources.catalog import Catalog
from .ranges import add_ranks, can_spread

INT_MAX = 2**31 - 1
#: Aggregates whose state is a sketch or a list of values.  Beside a distinct count Spark holds
#: one such state for every distinct value, in place of one a group.
BULKY = frozenset({"median", "approx_percentile_cont", "approx_distinct", "array_agg", "string_agg"})
#: Operations that may give other rows when they run again, by the order rows come in.
UNSTEADY = frozenset({"GlobalLimit", "LocalLimit", "Offset", "Tail", "Sample", "Window"})


@dataclass(frozen=True)
class Rows:
    """A DataFrame, and the keys by which it comes sorted, if it does."""

    df: DataFrame
    order: tuple[R.SortKey, ...] = ()


def by_place(df: DataFrame, first: int = 0) -> DataFrame:
    return df.toDF(*[f"col_{first + i}" for i in range(len(df.columns))])


class RelationCompiler:
    def __init__(self, catalog: Catalog, options: Options = Options()):
        self.catalog, self.options = catalog, options

    def compile(self, relation: R.Relation | dict) -> DataFrame:
        return self.rows(R.relation_from(relation)).df

    def context(self, df: DataFrame, order: tuple[R.SortKey, ...] = ()) -> Context:
        ctx = Context(df, self.options)
        return Context(df, self.options, 0, sort_key(ctx, order)) if order else ctx

    def rows(self, r: R.Relation) -> Rows:
        match r:
            case R.From():
                return Rows(by_place(self.catalog.rows(r.collection, r.columns, r.arguments)))
            case R.Filter():
                inner = self.rows(r.input)
                return Rows(inner.df.filter(replace(self.context(inner.df), positive=True).compile(r.predicate)), inner.order)
            case R.Sort():
                inner = self.rows(r.input)
                ctx = self.context(inner.df)
                return Rows(inner.df.orderBy(*[order_column(ctx, k) for k in r.exprs]), r.exprs) if r.exprs else inner
            case R.Paginate():
                return self._paginate(r)
            case R.Project():
                return self._project(r)
            case R.Join():
                return self._join(r)
            case R.Aggregate():
                return self._aggregate(r)
            case R.Window():
                return self._window(r)
            case R.Union():
                return self._union(r)
            case R.SetOperation():
                left, right = self.rows(r.left).df, self.rows(r.right).df
                self._same_width([left, right])
                return Rows(left.intersectAll(right) if r.kind == "intersect" else left.exceptAll(right))
        raise UnsupportedRelation(f"{type(r).__name__} is not a relation")

    def _window(self, r: R.Window) -> Rows:
        df = self.rows(r.input).df
        first = len(df.columns)
        left = {f"col_{first + i}": e for i, e in enumerate(r.exprs)}
        names = [*df.columns, *left]
        ctx = self.context(df)
        spread = {c: e for c, e in left.items() if self.options.spread_windows and can_spread(ctx, e)}
        while spread:  # those whose orders begin alike go together
            key = next(iter(spread.values())).fields["order_by"][0]
            own = {c: e for c, e in spread.items() if e.fields["order_by"][0] == key}
            df = add_ranks(self.context(df), key, own)
            spread = {c: e for c, e in spread.items() if c not in own}
            left = {c: e for c, e in left.items() if c not in own}
        ctx = self.context(df)
        return Rows(df.select("*", *[compile_window(ctx, e).alias(c) for c, e in left.items()]).select(*names))

    def _paginate(self, r: R.Paginate) -> Rows:
        inner = self.rows(r.input)
        df = inner.df
        for n in (r.skip, r.fetch):
            if n is not None and not 0 <= n <= INT_MAX:
                raise BadQuery(f"a page is counted from 0 to {INT_MAX}, not {n}")
        if r.skip:
            df = df.offset(r.skip)
        if r.fetch is not None:
            df = df.limit(r.fetch)
        return Rows(df, inner.order)

    def _project(self, r: R.Project) -> Rows:
        inner = self.rows(r.input)
        ctx = self.context(inner.df)
        df = inner.df.select(*[ctx.compile(e).alias(f"col_{i}") for i, e in enumerate(r.exprs)])
        # the order goes on as far as its keys are still among the columns
        places = {e.fields["index"]: i for i, e in reversed(list(enumerate(r.exprs))) if e.kind == "column"}
        kept = all(k.expr.kind == "column" and k.expr.fields["index"] in places for k in inner.order)
        order = tuple(R.SortKey(R.col(places[k.expr.fields["index"]]), k.ascending, k.nulls) for k in inner.order) if kept else ()
        return Rows(df, order)

    def _join(self, r: R.Join) -> Rows:
        if r.join_type not in R.JOINS:
            raise UnsupportedJoin(f"no join {r.join_type}")
        if r.join_type in ("right_semi", "right_anti"):
            swapped = R.Join(r.right, r.left, tuple((b, a) for a, b in r.on), r.join_type.replace("right", "left"))
            return self._join(swapped)
        left = self.rows(r.left).df
        right = by_place(self.rows(r.right).df, len(left.columns))
        if not r.on:
            if r.join_type == "inner":
                return Rows(left.crossJoin(right))  # a product is what an empty condition asks for
            condition = F.lit(True)
        else:
            a, b = self.context(left), self.context(right)
            condition = reduce(lambda x, y: x & y, [self._keys(left, right, a.compile(x), b.compile(y)) for x, y in r.on])
        return Rows(left.join(right, condition, {"full": "full_outer"}.get(r.join_type, r.join_type)))

    def _keys(self, left: DataFrame, right: DataFrame, x: Column, y: Column) -> Column:
        """Null joins null; a plain equality does where one side has no nulls."""
        if self.options.ansi_nulls:
            return x == y
        nullable = left.select(x).schema[0].nullable and right.select(y).schema[0].nullable
        return x.eqNullSafe(y) if nullable else x == y

    def _aggregate(self, r: R.Aggregate) -> Rows:
        inner = self.rows(r.input)
        ctx = self.context(inner.df, inner.order)
        keys = [ctx.compile(e).alias(f"col_{i}") for i, e in enumerate(r.group_by)]
        if bad := [e.kind for e in r.aggregates if e.kind not in AGGREGATES]:
            raise UnsupportedExpression(f"not aggregates: {', '.join(bad)}")
        aggregates = [compile_aggregate(ctx, e).alias(f"col_{len(keys) + i}") for i, e in enumerate(r.aggregates)]
        if not aggregates:
            if not keys:
                raise BadQuery("an aggregate needs keys or aggregates")
            return Rows(inner.df.select(*keys).distinct())
        if r.grouping in ("cube", "rollup"):
            grouped = getattr(inner.df, r.grouping)(*keys)
        elif r.grouping:
            plain = inner.df.select("*", *[k.alias(f"key_{i}") for i, k in enumerate(keys)])
            names = [F.col(f"key_{i}") for i in range(len(keys))]
            grouped = plain.groupingSets([[names[i] for i in own] for own in r.grouping], *names)
        else:
            grouped = inner.df.groupBy(*keys)
        alone = not keys and self.options.strict
        counted = [F.count(F.lit(1)).alias("__n")] if alone else []
        distinct = [e.kind == "count" and bool(e.get("distinct")) for e in r.aggregates]
        if any(distinct) and not r.grouping and not BULKY.isdisjoint(e.kind for e in r.aggregates) and is_steady(inner.df):
            parts = [[a for a, d in zip(aggregates, distinct) if d], [a for a, d in zip(aggregates, distinct) if not d] + counted]
            names = [f"col_{i}" for i in range(len(keys) + len(aggregates))]
            df = put_together([grouped.agg(*p) for p in parts], names[: len(keys)]).select(*names, *["__n"] * alone)
        else:
            df = grouped.agg(*aggregates, *counted)
        return Rows(df.filter(F.col("__n") > 0).drop("__n") if alone else by_place(df))

    def _same_width(self, parts: list[DataFrame]) -> None:
        widths = {len(p.columns) for p in parts}
        if len(widths) > 1:
            raise InvalidUnion(f"inputs have different numbers of columns: {sorted(widths)}")

    def _union(self, r: R.Union) -> Rows:
        if not r.relations:
            raise InvalidUnion("a union needs an input")
        parts = [self.rows(x).df for x in r.relations]
        self._same_width(parts)
        return Rows(reduce(DataFrame.union, parts))


def is_steady(df: DataFrame) -> bool:
    """Whether the rows are the same whenever they are read, as far as the plan tells."""
    plan = df._jdf.queryExecution().analyzed()
    left, names = [plan], set()
    while left:
        node = left.pop()
        names.add(node.nodeName())
        left += [node.children().apply(i) for i in range(node.children().size())]
    return plan.deterministic() and UNSTEADY.isdisjoint(names)


def put_together(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """The columns of aggregates of one input by the same keys, each key once; a null key is a key."""
    whole = [p.select(*keys, F.struct(*[c for c in p.columns if c not in keys]).alias(f"part_{i}")) for i, p in enumerate(parts)]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), whole)
    found = together.groupBy(*keys).agg(*[F.first(f"part_{i}", ignorenulls=True).alias(f"part_{i}") for i in range(len(parts))])
    return found.select(*keys, *[f"part_{i}.*" for i in range(len(parts))])


def compile_relation(relation: R.Relation | dict, catalog: Catalog, options: Options = Options()) -> DataFrame:
    """The lazy DataFrame of a relation; its columns are col_0, col_1, ..."""
    return RelationCompiler(catalog, options).compile(relation)
