"""Ranks over all rows, without one task that holds all rows.

The first sort key is cut into ranges at its quantiles, about as many as there are shuffle
partitions.  Rows are ranked inside their range; what lies before a range is a sum over the
other ranges' counts, one row each, which is broadcast.  Any cuts give right ranks, as
equal values share a range; quantiles make the ranges alike.  One value that many rows share
is one range still.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.context import Context, is_temporal, literal_of
from ..functions.windows import order_column
from ..plans.relational import Expr, SortKey

KINDS = ("row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "n_tile")


def can_spread(ctx: Context, e: Expr) -> bool:
    """Whether an expression ranks all rows by a number or a time first."""
    if e.kind not in KINDS or e.get("partition_by") or not e.get("order_by"):
        return False
    kind = ctx.type_of(ctx.compile(e.fields["order_by"][0].expr))
    return isinstance(kind, T.NumericType) or is_temporal(kind)


def range_number(x: Column, cuts: Sequence, key: SortKey) -> Column:
    """The number of a value's range: 0 to len(cuts), in the order of the sort, and one more
    on either side for null.  A look at every so many-th cut leaves only those behind it."""
    step = max(1, math.isqrt(len(cuts)))
    parts = [F.array(*map(F.lit, cuts[i : i + step])) for i in range(0, len(cuts), step)]
    number = F.lit(0)
    if parts:
        passed = lambda c: c <= x
        part = F.greatest(F.size(F.filter(F.array(*map(F.lit, cuts[::step])), passed)) - 1, F.lit(0))
        number = part * step + F.size(F.filter(F.get(F.array(*parts), part), passed))
    number = number if key.ascending else len(cuts) - number
    return F.when(x.isNull(), F.lit(-1 if key.nulls else len(cuts) + 1)).otherwise(number)


def add_ranks(ctx: Context, first: SortKey, wanted: dict[str, Expr]) -> DataFrame:
    """The rows of ``ctx`` with a column for each of ``wanted``, ranks whose orders all begin
    with ``first``: one shuffle by range serves all of them.  The cuts are looked up at once, a
    job over that key alone; no rows give no cuts and no rows."""
    df = ctx.df
    x = ctx.compile(first.expr)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)]
    cuts = (df.agg(F.percentile_approx(x, shares)).first()[0] or []) if shares else []
    marked = df.withColumn("__range", range_number(x, cuts, first))
    # equal rows of a dense rank count once
    values = {f"__in_{c}": F.count_distinct(F.struct(*[ctx.compile(k.expr).alias(f"k{i}") for i, k in enumerate(e.fields["order_by"])])) for c, e in wanted.items() if e.kind == "dense_rank"}
    counts = marked.groupBy(F.col("__range").alias("__r")).agg(F.count(F.lit(1)).alias("__in"), *[v.alias(c) for c, v in values.items()])
    earlier = W.orderBy("__r").rowsBetween(W.unboundedPreceding, -1)  # a row per range
    before = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c.replace("__in", "__before", 1)) for c in ("__in", *values)]
    counts = counts.select("__r", *before, F.sum("__in").over(W.partitionBy()).alias("__all"))
    joined = marked.join(F.broadcast(counts), F.col("__range") == F.col("__r"))  # len(cuts) + 2 rows at most
    ranks = [_rank(c, e, W.partitionBy("__range").orderBy(*[order_column(ctx, k) for k in e.fields["order_by"]])).alias(c) for c, e in wanted.items()]
    return joined.select(*df.columns, *ranks)


def _rank(name: str, e: Expr, over: WindowSpec) -> Column:
    ahead, rows = F.col("__before"), F.col("__all")
    match e.kind:
        case "row_number":
            return ahead + F.row_number().over(over)
        case "rank":
            return ahead + F.rank().over(over)
        case "dense_rank":
            return F.col(f"__before_{name}") + F.dense_rank().over(over)
        case "percent_rank":
            return F.when(rows > 1, (ahead + F.rank().over(over) - 1) / (rows - 1)).otherwise(F.lit(0.0))
        case "cume_dist":
            return (ahead + F.count(F.lit(1)).over(over)) / rows
    # n_tile: the first rows % n tiles hold a row more than the others
    n, place = int(literal_of(e.fields["n"])), ahead + F.row_number().over(over) - 1
    small, large = F.floor(rows / n), rows % n
    wide = large * (small + 1)
    return F.when(place < wide, F.floor(place / (small + 1))).otherwise(large + F.floor((place - wide) / F.greatest(small, F.lit(1)))) + 1
