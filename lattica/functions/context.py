"""What an expression is compiled against."""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ExpressionTooDeep, InvalidColumnIndex, UnsupportedExpression
from ..plans.relational import Expr, SortKey

#: Expressions nest this deep at most.
MAX_DEPTH = 512


@dataclass(frozen=True)
class Options:
    """``ansi_nulls``: comparisons with null give null, as in SQL; otherwise every comparison
    is true or false, null equals null and orders nowhere.  ``strict``: a global aggregate of
    no rows gives no row, and a distinct count counts null as a value.  ``approximate``: a
    median comes from a sketch.  ``spread_windows``: ranks of all rows, by a number or a time
    first, are made by ranges in many tasks; compiling them runs a job for the cuts, and they
    are longs."""

    ansi_nulls: bool = False
    strict: bool = False
    approximate: bool = False
    spread_windows: bool = False


@dataclass(frozen=True)
class Context:
    df: DataFrame
    options: Options = Options()
    depth: int = 0
    #: Sort key of the rows as they come, if they come sorted.
    order: Column | None = None
    #: Whether null counts as false anyway where this expression stands: as a filter, or as a
    #: part of one under "and" and "or".  Plain comparisons will do there, and reach the scan.
    positive: bool = False
    own_positive: bool = False
    #: Window that aggregates run over, if they do.
    over: WindowSpec | None = None

    def over_window(self, aggregate: Column) -> Column:
        return aggregate if self.over is None else aggregate.over(self.over)

    def compile(self, e: Expr) -> Column:
        if not self.depth:
            check_depth(e)
        if e.kind not in SCALARS:
            raise UnsupportedExpression(f"{e.kind} does not belong here")
        inner = replace(self, depth=self.depth + 1, own_positive=self.positive, positive=self.positive and e.kind in ("and", "or"))
        return SCALARS[e.kind](inner, e)

    def column(self, index: int) -> Column:
        if not isinstance(index, int) or not 0 <= index < len(self.df.columns):
            raise InvalidColumnIndex(f"there is no column {index}")
        return F.col(f"`{self.df.columns[index]}`")

    def type_of(self, column: Column) -> T.DataType:
        """Static type, from the analyser: nothing runs."""
        return self.df.select(column).schema[0].dataType


def check_depth(e: Expr) -> None:
    """Raises an error if an expression nests too deep; makes room for those that do not."""
    level, depth = [e], 0
    while level:
        depth += 1
        if depth > MAX_DEPTH:
            raise ExpressionTooDeep(f"expressions nest {MAX_DEPTH} deep at most")
        level = [x for parent in level for x in _children(parent.fields.values())]
    if depth > 100:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 10 * MAX_DEPTH))


def _children(values) -> list[Expr]:
    out: list[Expr] = []
    for v in values:
        if isinstance(v, Expr):
            out.append(v)
        elif isinstance(v, SortKey):
            out.append(v.expr)
        elif isinstance(v, (list, tuple)):
            out += _children(v)
    return out


Compiler = Callable[[Context, Expr], Column]
SCALARS: dict[str, Compiler] = {}


def scalar(*kinds: str) -> Callable[[Compiler], Compiler]:
    def add(f: Compiler) -> Compiler:
        for k in kinds:
            SCALARS[k] = f
        return f

    return add


def literal_of(e: Expr | None):
    """The plain value of a literal expression, or None."""
    return e.fields["literal"].get("value") if isinstance(e, Expr) and e.kind == "literal" else None


def is_temporal(t: T.DataType) -> bool:
    return isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType))


def millis(column: Column) -> Column:
    """Milliseconds since the epoch; clock times without a zone are UTC."""
    return F.unix_millis(column.cast("timestamp"))
