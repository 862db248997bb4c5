"""Window functions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import UnsupportedExpression
from ..plans.relational import Expr, SortKey
from .aggregates import compile_aggregate
from .context import Context, literal_of

_RANKS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank, "cume_dist": F.cume_dist, "percent_rank": F.percent_rank}
_EDGES = {"unbounded_preceding": W.unboundedPreceding, "unbounded_following": W.unboundedFollowing, "current_row": W.currentRow}


def order_column(ctx: Context, key: SortKey) -> Column:
    x = ctx.compile(key.expr)
    if key.ascending:
        return x.asc_nulls_first() if key.nulls else x.asc_nulls_last()
    return x.desc_nulls_first() if key.nulls else x.desc_nulls_last()


def compile_window(ctx: Context, e: Expr) -> Column:
    """Without ``partition_by`` all rows are one partition, in one task, as the query says;
    for ranks see also ``Options.spread_windows``."""
    keys = [ctx.compile(p) for p in e.get("partition_by", [])]
    order = [order_column(ctx, k) for k in e.get("order_by", [])]
    over = W.partitionBy(*keys)
    if order:
        over = over.orderBy(*order)
    if e.kind in _RANKS or e.kind == "n_tile":
        if not order:
            over = over.orderBy(F.lit(1))
        return (F.ntile(int(literal_of(e.fields["n"]))) if e.kind == "n_tile" else _RANKS[e.kind]()).over(over)
    if e.kind in ("lag", "lead"):
        step, default = literal_of(e.get("offset")), literal_of(e.get("default"))
        return getattr(F, e.kind)(ctx.compile(e.fields["expr"]), 1 if step is None else int(step), default).over(over)
    if e.kind == "aggregate_over":
        frame = e.get("frame")
        if frame:
            start, end = (_EDGES[x] if isinstance(x, str) else int(x) for x in (frame["start"], frame["end"]))
            over = over.rangeBetween(start, end) if frame.get("unit") == "range" else over.rowsBetween(start, end)
        return compile_aggregate(replace(ctx, over=over, order=None), e.fields["aggregate"])
    raise UnsupportedExpression(f"{e.kind} is not a window function")
