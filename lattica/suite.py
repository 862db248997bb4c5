"""Queries over the test tables, by name, each with SQL that gives the same rows.

They go through the plans and compilers as a user's queries do.  Column names of a
relational query are by place; each query gives its columns the names of its SQL.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import error_response
from .functions.context import Options
from .operators.graph import compile_request, execute_request
from .operators.pipeline import Pipeline, facets, nearest, pipeline_view
from .operators.relational import compile_relation
from .plans import graph as G
from .plans.relational import Relation, SetOperation, Union, Aggregate, asc, call, col, desc, eq, gt, gt_eq, lit, lt, lt_eq, not_eq, scan
from .sources.catalog import TABLES, Catalog
from .sources.introspect import objects_json, sample_frame
from .sources.schema import schema_response
from .streaming.events import sessions, windowed
from .streaming.rows import buffered, streamed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def catalog_of(spark: SparkSession, sf_dir: str) -> Catalog:
    catalog = Catalog.parquet(spark, sf_dir, TABLES)
    rows = lambda name: catalog.open(name)
    turn = F.struct("turn", "role", "text")
    catalog.add("chats", lambda: rows("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns")))
    info = F.struct(F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("price"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("$level"))
    catalog.add("boxes", lambda: rows("orders").select(F.col("o_orderkey").alias("key"), info.alias("info")))
    catalog.add("regions", lambda: rows("nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"), F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")))).alias("nations")))
    return catalog


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def run(spark: SparkSession, sf_dir: str, relation: Relation, names: str, options: Options = Options()) -> DataFrame:
    return compile_relation(relation, catalog_of(spark, sf_dir), options).toDF(*names.split())


def fn(kind: str, *args, **named):
    return call(kind, *args, **named)


def total(e):
    return fn("sum", e)


def rounded(e, places: int):
    return fn("cast", fn("round", fn("cast", e, {"type": "float64"}), lit(places)), {"type": "float64"})


DAY = lambda text: fn("cast", lit(text), {"type": "timestamp"})

# -- relations --------------------------------------------------------------------------------

LINE = ["l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


@query("""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 6) AS avg_price,
       round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL ORDER BY 1, 2""")
def q_pricing_summary(spark, sf_dir):
    net = col(3) * (lit(1) - col(4))
    r = scan("lineitem", LINE).filter(lt_eq(col(6), DAY("1998-09-02"))).aggregate([col(0), col(1)], [total(col(2)), total(col(3)), total(net), total(net * (lit(1) + col(5))), fn("average", col(2)), fn("average", col(3)), fn("average", col(4)), fn("count")])
    r = r.project(col(0), col(1), *[rounded(col(i), 2) for i in range(2, 6)], *[rounded(col(i), 6) for i in range(6, 9)], col(9)).sort(asc(col(0)), asc(col(1)))
    return run(spark, sf_dir, r, "l_returnflag l_linestatus sum_qty sum_base_price sum_disc_price sum_charge avg_qty avg_price avg_disc count_order")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def q_topk_orders(spark, sf_dir):
    r = scan("orders", ["o_orderkey", "o_custkey", "o_totalprice"]).sort(desc(col(2)), asc(col(0))).paginate(20)
    return run(spark, sf_dir, r, "o_orderkey o_custkey o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice, o_orderkey LIMIT 15 OFFSET 30")
def q_paginate(spark, sf_dir):
    r = scan("orders", ["o_orderkey", "o_totalprice", "o_orderstatus"]).filter(eq(col(2), "F")).sort(asc(col(1)), asc(col(0))).paginate(15, 30).project(col(0), col(1))
    return run(spark, sf_dir, r, "o_orderkey o_totalprice")


@query("""
SELECT c_mktsegment, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY c_mktsegment""")
def q_inner_join_revenue(spark, sf_dir):
    orders = scan("orders", ["o_orderkey", "o_custkey", "o_orderdate"]).filter(lt(col(2), DAY("1997-01-01")))
    lines = scan("lineitem", ["l_orderkey", "l_extendedprice", "l_discount"])
    r = scan("customer", ["c_custkey", "c_mktsegment"]).join(orders, [(col(0), col(1))]).join(lines, [(col(2), col(0))])
    r = r.aggregate([col(1)], [total(col(6) * (lit(1) - col(7))), fn("count")]).project(col(0), rounded(col(1), 2), col(2))
    return run(spark, sf_dir, r, "c_mktsegment revenue n")


@query("""
SELECT c_custkey, coalesce(n, 0) AS n, last_order IS NULL AS has_none FROM customer LEFT JOIN
  (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS last_order FROM orders WHERE o_totalprice > 200000 GROUP BY 1) ON o_custkey = c_custkey""")
def q_left_join_null(spark, sf_dir):
    big = scan("orders", ["o_custkey", "o_orderkey", "o_totalprice"]).filter(gt(col(2), 200000.0)).aggregate([col(0)], [fn("count"), fn("max", col(1))])
    r = scan("customer", ["c_custkey"]).join(big, [(col(0), col(0))], "left").project(col(0), fn("coalesce", col(2), lit(0)), fn("is_null", col(3)))
    return run(spark, sf_dir, r, "c_custkey n has_none")


def _customers_by_orders(kind: str) -> Relation:
    orders = scan("orders", ["o_custkey", "o_totalprice"]).filter(gt(col(1), 250000.0))
    return scan("customer", ["c_custkey", "c_name"]).join(orders, [(col(0), col(0))], kind)


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def q_semi(spark, sf_dir):
    return run(spark, sf_dir, _customers_by_orders("left_semi"), "c_custkey c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def q_anti(spark, sf_dir):
    return run(spark, sf_dir, _customers_by_orders("left_anti"), "c_custkey c_name")


def _suppliers() -> Relation:
    return scan("supplier", ["s_suppkey", "s_nationkey", "s_acctbal"]).filter(gt(col(2), 9000.0))


@query("SELECT s_suppkey, n_name FROM (SELECT * FROM supplier WHERE s_acctbal > 9000) RIGHT JOIN nation ON s_nationkey = n_nationkey")
def q_right(spark, sf_dir):
    r = _suppliers().join(scan("nation", ["n_nationkey", "n_name"]), [(col(1), col(0))], "right").project(col(0), col(4))
    return run(spark, sf_dir, r, "s_suppkey n_name")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def q_right_semi(spark, sf_dir):
    r = _suppliers().join(scan("nation", ["n_nationkey", "n_name"]), [(col(1), col(0))], "right_semi")
    return run(spark, sf_dir, r, "n_nationkey n_name")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def q_right_anti(spark, sf_dir):
    r = _suppliers().join(scan("nation", ["n_nationkey", "n_name"]), [(col(1), col(0))], "right_anti")
    return run(spark, sf_dir, r, "n_nationkey n_name")


@query("SELECT s_suppkey, n_nationkey FROM (SELECT * FROM supplier WHERE s_acctbal > 9000) FULL JOIN (SELECT * FROM nation WHERE n_regionkey = 1) ON s_nationkey = n_nationkey")
def q_full_join(spark, sf_dir):
    nations = scan("nation", ["n_nationkey", "n_regionkey"]).filter(eq(col(1), 1))
    r = _suppliers().join(nations, [(col(1), col(0))], "full").project(col(0), col(3))
    return run(spark, sf_dir, r, "s_suppkey n_nationkey")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem JOIN
  (SELECT l_orderkey AS k, max(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_orderkey = k AND l_quantity = q""")
def q_multi_key_join(spark, sf_dir):
    top = scan("lineitem", ["l_orderkey", "l_quantity"]).aggregate([col(0)], [fn("max", col(1))])
    r = scan("lineitem", ["l_orderkey", "l_linenumber", "l_quantity"]).join(top, [(col(0), col(0)), (col(2), col(1))]).project(col(0), col(1), col(2))
    return run(spark, sf_dir, r, "l_orderkey l_linenumber l_quantity")


@query("""
WITH b AS (SELECT CASE WHEN o_totalprice > 150000 THEN o_orderpriority END AS k FROM orders)
SELECT coalesce(x.k, '-') AS k, CAST(sum(n) AS BIGINT) AS n FROM b x JOIN (SELECT k, count(*) AS n FROM b GROUP BY 1) y ON x.k IS NOT DISTINCT FROM y.k GROUP BY 1""")
def q_null_join_keys(spark, sf_dir):
    b = scan("orders", ["o_totalprice", "o_orderpriority"]).project(fn("case", [(gt(col(0), 150000.0), col(1))]))
    keys = b.aggregate([col(0)], [fn("count")])
    r = b.join(keys, [(col(0), col(0))]).aggregate([col(0)], [total(col(2))]).project(fn("coalesce", col(0), lit("-")), col(1))
    return run(spark, sf_dir, r, "k n")


@query("SELECT r_name, n_name FROM region, nation")
def q_cross(spark, sf_dir):
    r = scan("region", ["r_name"]).join(scan("nation", ["n_name"]))
    return run(spark, sf_dir, r, "r_name n_name")


@query("SELECT c_nationkey AS k, c_acctbal AS v FROM customer WHERE c_acctbal < 0 UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def q_union_all(spark, sf_dir):
    r = Union((scan("customer", ["c_nationkey", "c_acctbal"]).filter(lt(col(1), 0)), scan("supplier", ["s_nationkey", "s_acctbal"])))
    return run(spark, sf_dir, r, "k v")


@query("""
SELECT k, count(*) AS n, round(sum(v), 2) AS v FROM (
  SELECT c_nationkey AS k, c_acctbal AS v FROM customer WHERE c_acctbal > 5000
  UNION ALL SELECT s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 5000) GROUP BY k HAVING count(*) > 2""")
def q_aggregate_filter_union(spark, sf_dir):
    parts = tuple(scan(t, [f"{p}_nationkey", f"{p}_acctbal"]).filter(gt(col(1), 5000)) for t, p in (("customer", "c"), ("supplier", "s")))
    r = Union(parts).aggregate([col(0)], [fn("count"), total(col(1))]).filter(gt(col(1), 2)).project(col(0), col(1), rounded(col(2), 2))
    return run(spark, sf_dir, r, "k n v")


@query("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def q_distinct(spark, sf_dir):
    return run(spark, sf_dir, scan("customer", ["c_mktsegment", "c_nationkey"]).aggregate([col(0), col(1)]), "c_mktsegment c_nationkey")


@query("SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
def q_intersect(spark, sf_dir):
    return run(spark, sf_dir, SetOperation("intersect", scan("customer", ["c_nationkey"]), scan("supplier", ["s_nationkey"])), "k")


@query("SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def q_except(spark, sf_dir):
    return run(spark, sf_dir, SetOperation("except", scan("customer", ["c_nationkey"]), scan("supplier", ["s_nationkey"])), "k")


def _grouping(grouping) -> Relation:
    return Aggregate(scan("orders", ["o_orderstatus", "o_orderpriority", "o_totalprice"]), (col(0), col(1)), (fn("count"), fn("max", col(2))), grouping)


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY CUBE (1, 2)")
def q_cube(spark, sf_dir):
    return run(spark, sf_dir, _grouping("cube"), "o_orderstatus o_orderpriority n top")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY ROLLUP (1, 2)")
def q_rollup(spark, sf_dir):
    return run(spark, sf_dir, _grouping("rollup"), "o_orderstatus o_orderpriority n top")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def q_grouping_sets(spark, sf_dir):
    return run(spark, sf_dir, _grouping([[0], [1], []]), "o_orderstatus o_orderpriority n top")


@query("SELECT count(*) AS n, count(o_orderkey) AS k, max(o_totalprice) AS top FROM orders WHERE o_orderkey < 0")
def q_empty_aggregate(spark, sf_dir):
    r = scan("orders", ["o_orderkey", "o_totalprice"]).filter(lt(col(0), 0)).aggregate([], [fn("count"), fn("count", col(0)), fn("max", col(1))])
    return run(spark, sf_dir, r, "n k top")


# -- scalar expressions -----------------------------------------------------------------------


def _half(e):
    """Null for odd order keys: a column with nulls."""
    return fn("case", [(eq(col(0) % lit(2), 0), e)])


@query("""
WITH t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS p, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS q FROM orders)
SELECT k, p IS NOT DISTINCT FROM q AS eq_, p IS DISTINCT FROM q AS ne_, coalesce(p < q, false) AS lt_, coalesce(p <= q, false) AS le_,
  coalesce(p > 150000, false) AS gt_, coalesce(p >= 150000, false) AS ge_, p IS DISTINCT FROM q AS df, p IS NOT DISTINCT FROM q AS nd,
  p IS NULL AS nu, p IS NOT NULL AS nn, coalesce(p > 100000, false) AND coalesce(q < 200000, false) AS an, coalesce(p > 100000, false) OR coalesce(q < 200000, false) AS o_,
  NOT coalesce(p > 100000, false) AS no FROM t""")
def q_compare_logic(spark, sf_dir):
    t = scan("orders", ["o_orderkey", "o_totalprice"]).project(col(0), _half(col(1)), fn("case", [(eq(col(0) % lit(3), 0), col(1))]))
    p, q = col(1), col(2)
    r = t.project(col(0), eq(p, q), not_eq(p, q), lt(p, q), lt_eq(p, q), gt(p, 150000), gt_eq(p, 150000), fn("is_distinct_from", p, q), fn("is_not_distinct_from", p, q), fn("is_null", p), fn("is_not_null", p), gt(p, 100000) & lt(q, 200000), gt(p, 100000) | lt(q, 200000), ~gt(p, 100000))
    return run(spark, sf_dir, r, "k eq_ ne_ lt_ le_ gt_ ge_ df nd nu nn an o_ no")


@query("""
WITH t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice > 150000 END AS b, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS s, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS p FROM orders)
SELECT k, b IS TRUE AS t_, b IS FALSE AS f_, b IS NOT TRUE AS nt, b IS NOT FALSE AS nf, coalesce(s IN ('F', 'O'), false) AS i, NOT coalesce(s IN ('F', 'O'), false) AS ni,
  coalesce(s IN ('F'), false) OR s IS NULL AS inull, coalesce(p BETWEEN 100000 AND 200000, false) AS bt, coalesce(p < 100000, false) OR coalesce(p > 200000, false) AS nb,
  coalesce(NOT b, true) AS nb2 FROM t""")
def q_null_logic(spark, sf_dir):
    t = scan("orders", ["o_orderkey", "o_totalprice", "o_orderstatus"]).project(col(0), _half(gt(col(1), 150000)), _half(col(2)), _half(col(1)))
    b, s, p = col(1), col(2), col(3)
    r = t.project(col(0), fn("is_true", b), fn("is_false", b), fn("is_not_true", b), fn("is_not_false", b), fn("in", s, ["F", "O"]), fn("not_in", s, ["F", "O"]), fn("in", s, [lit("F"), lit(None)]), fn("between", lit(100000), p, lit(200000)), fn("not_between", lit(100000), p, lit(200000)), ~b)
    return run(spark, sf_dir, r, "k t_ f_ nt nf i ni inull bt nb nb2")


@query(r"""
SELECT p_partkey, p_name LIKE '%e_b%' AS l, p_name NOT LIKE '%e_b%' AS nl, p_type ILIKE '%ECO%' AS il, p_type NOT ILIKE '%ECO%' AS nil,
  contains(p_name, 'in') AS c, CASE WHEN p_partkey % 2 = 0 THEN p_name END LIKE 's%' AS ln, '50%' LIKE '%0\%' ESCAPE '\' AS es, p_name LIKE '%' || left(p_type, 1) || '%' AS dy FROM part""")
def q_like(spark, sf_dir):
    name, kind = col(1), col(2)
    half = fn("case", [(eq(col(0) % lit(2), 0), name)])
    dynamic = fn("concat", lit("%"), fn("left", kind, lit(1)), lit("%"))
    r = scan("part", ["p_partkey", "p_name", "p_type"]).project(col(0), fn("like", name, "%e_b%"), fn("not_like", name, "%e_b%"), fn("i_like", kind, "%ECO%"), fn("not_i_like", kind, "%ECO%"), fn("contains", name, "in"), fn("like", half, "s%"), fn("like", lit("50%"), r"%0\%"), fn("like", name, dynamic))
    return run(spark, sf_dir, r, "p_partkey l nl il nil c ln es dy")


@query("""
SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'mid' ELSE 'big' END AS a, CASE p_brand WHEN 'Brand#11' THEN 1 WHEN 'Brand#22' THEN 2 END AS b,
  coalesce(nullif(p_size, 7), -1) AS c, nullif(p_size, 7) AS d, greatest(p_size, 20, nullif(p_size, 7)) AS e, least(p_size, 20) AS f, ifnull(nullif(p_size, 7), 0) AS g FROM part""")
def q_cond(spark, sf_dir):
    size, seven = col(2), fn("null_if", col(2), lit(7))
    r = scan("part", ["p_partkey", "p_brand", "p_size"]).project(col(0), fn("case", [(lt(size, 10), "small"), (lt(size, 30), "mid")], default=lit("big")), fn("case", [(lit("Brand#11"), 1), (lit("Brand#22"), 2)], scrutinee=col(1)), fn("coalesce", seven, lit(-1)), seven, fn("greatest", size, lit(20), seven), fn("least", size, lit(20)), fn("nvl", seven, lit(0)))
    return run(spark, sf_dir, r, "p_partkey a b c d e f g")


@query("""
SELECT l_orderkey, l_linenumber, round(l_quantity + l_tax, 6) AS a, round(l_quantity - l_tax, 6) AS b, round(l_quantity * l_tax, 6) AS c, round(l_extendedprice / l_quantity, 8) AS d,
  l_linenumber % 3 AS e, -l_linenumber AS f, abs(-l_quantity) AS g, ceil(l_extendedprice / 7) AS h, floor(l_extendedprice / 7) AS i, round_even(l_quantity / 2, 0) AS j,
  round(trunc(l_extendedprice / 7), 6) AS k, round(sqrt(l_extendedprice), 6) AS l, round(power(l_quantity, 2), 6) AS m, round(exp(l_discount), 6) AS n, round(ln(l_quantity + 1), 6) AS o,
  round(log10(l_extendedprice), 6) AS p, round(log2(l_extendedprice), 6) AS q, round(cos(l_quantity), 6) AS r, round(tan(l_discount), 6) AS s, round(ln(l_quantity + 1) / ln(3), 6) AS t,
  round(trunc(l_extendedprice * 10) / 10, 6) AS u, l_linenumber = 0 AS v, isnan(l_tax) AS w, l_quantity = 0 AS x FROM lineitem""")
def q_math(spark, sf_dir):
    key, number, quantity, price, discount, tax = map(col, range(6))
    six = lambda e: rounded(e, 6)
    r = scan("lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]).project(
        key, number, six(quantity + tax), six(quantity - tax), six(quantity * tax), rounded(price / quantity, 8), number % lit(3), -number, fn("abs", -quantity), fn("ceil", price / lit(7)), fn("floor", price / lit(7)),
        fn("round", quantity / lit(2)), six(fn("trunc", price / lit(7))), six(fn("sqrt", price)), six(fn("power", quantity, lit(2))), six(fn("exp", discount)), six(fn("ln", quantity + lit(1))), six(fn("log", price)), six(fn("log2", price)),
        six(fn("cos", quantity)), six(fn("tan", discount)), six(fn("log", quantity + lit(1), lit(3))), six(fn("trunc", price, lit(1))), fn("is_zero", number), fn("is_nan", tax), fn("is_zero", quantity))
    return run(spark, sf_dir, r, "l_orderkey l_linenumber a b c d e f g h i j k l m n o p q r s t u v w x")


@query("""
SELECT p_partkey, p_name || '/' || p_brand AS a, length(p_name) AS b, substr(p_name, 3, 4) AS c, substr(p_name, 3) AS d, instr(p_name, 'e') AS e, lower(p_type) AS f, upper(p_name) AS g,
  replace(p_name, 'a', '__') AS h, left(p_name, 5) AS i, right(p_name, 5) AS j, reverse(p_name) AS k FROM part""")
def q_strings_1(spark, sf_dir):
    name, brand, kind = col(1), col(2), col(3)
    r = scan("part", ["p_partkey", "p_name", "p_brand", "p_type"]).project(col(0), fn("concat", name, lit("/"), brand), fn("character_length", name), fn("substr", name, lit(3), lit(4)), fn("substr", name, lit(3)), fn("str_pos", name, "e"), fn("to_lower", kind), fn("to_upper", name), fn("replace", name, "a", "__"), fn("left", name, lit(5)), fn("right", name, lit(5)), fn("reverse", name))
    return run(spark, sf_dir, r, "p_partkey a b c d e f g h i j k")


@query(r"""
SELECT c_custkey, ltrim('  ' || c_name || ' x ', E' \t') AS a, rtrim(c_name || '  ', E' \t') AS b, trim('  ' || c_name || '  ', E' \t') AS c, ltrim(c_name, 'Cu') AS d, rtrim(c_name, '0123456789') AS e,
  trim(c_name, 'C0123456789') AS f, lpad(c_mktsegment, 14, '*-') AS g, rpad(c_mktsegment, 14, '*-') AS h, lpad(c_mktsegment, 4, ' ') AS i, split_part(c_name, '#', 1) AS j, split_part(c_name, '#', -1) AS k FROM customer""")
def q_strings_2(spark, sf_dir):
    name, segment = col(1), col(2)
    r = scan("customer", ["c_custkey", "c_name", "c_mktsegment"]).project(
        col(0), fn("l_trim", fn("concat", lit("  "), name, lit(" x "))), fn("r_trim", fn("concat", name, lit("  "))), fn("b_trim", fn("concat", lit("  "), name, lit("  "))), fn("l_trim", name, "Cu"), fn("r_trim", name, "0123456789"), fn("b_trim", name, "C0123456789"),
        fn("l_pad", segment, lit(14), "*-"), fn("r_pad", segment, lit(14), "*-"), fn("l_pad", segment, lit(4)), fn("substr_index", name, "#", lit(1)), fn("substr_index", name, "#", lit(-1)))
    return run(spark, sf_dir, r, "c_custkey a b c d e f g h i j k")


@query("SELECT doc_id, length(text) AS a, left(reverse(text), 20) AS b, md5(lower(text)) AS c, instr(text, 'é') AS d, substr(text, 5, 9) AS e FROM documents")
def q_strings_3(spark, sf_dir):
    text = col(1)
    r = scan("documents", ["doc_id", "text"]).project(col(0), fn("character_length", text), fn("left", fn("reverse", text), lit(20)), fn("to_lower", text), fn("str_pos", text, "é"), fn("substr", text, lit(5), lit(9)))
    return run(spark, sf_dir, r, "doc_id a b c d e").withColumn("c", F.md5("c"))


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS a, json_extract_string(props, '$.k') AS b, CAST(json_extract(props, '$.k') AS DOUBLE) AS c, CAST(json_extract(props, '$.k') AS INTEGER) <> 0 AS d,
  json_extract_string(props, '$.missing') AS e, json_extract_string(props, '$.k') AS f, json_extract_string(props, '$.k') AS g, 3 AS h, true AS i, false AS j, 7 AS m FROM events""")
def q_json(spark, sf_dir):
    props, nested = col(1), lit('{"a": {"b": [1, 7, 9]}}')
    r = scan("events", ["event_id", "props"]).project(
        col(0), fn("json_get_int", props, "k"), fn("json_get_str", props, "k"), fn("json_get_float", props, "$.k"), fn("json_get_bool", props, "k"), fn("json_get_str", props, "missing"), fn("json_as_text", props, "k"), fn("json_get_str", fn("json_get", props, "k"), []),
        fn("json_length", nested, "$.a.b"), fn("json_contains", nested, "a", "b", 9), fn("json_contains", nested, "a", "b", 8), fn("json_get_int", nested, "a", "b", 1))
    return run(spark, sf_dir, r, "event_id a b c d e f g h i j m")


@query("""
SELECT conv_id, t[1].role AS first_role, t[1].text AS first_text, t[50].text AS none FROM
  (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn) AS t FROM conversations GROUP BY 1)""")
def q_nested(spark, sf_dir):
    first = fn("array_element", col(1), lit(0))
    r = scan("chats", ["conv_id", "turns"]).project(col(0), fn("get_field", first, "role"), fn("get_field", first, "text"), fn("get_field", fn("array_element", col(1), lit(49)), "text"))
    return run(spark, sf_dir, r, "conv_id first_role first_text none")


@query("SELECT vec_id, embedding[1] AS a, embedding[8] AS b, embedding[100000] AS c FROM embeddings")
def q_arrays(spark, sf_dir):
    r = scan("embeddings", ["vec_id", "embedding"]).project(col(0), *[fn("array_element", col(1), lit(i)) for i in (0, 7, 99999)])
    return run(spark, sf_dir, r, "vec_id a b c")


@query("""
SELECT o_orderkey, year(o_orderdate) AS a, quarter(o_orderdate) AS b, month(o_orderdate) AS c, CAST(strftime(o_orderdate, '%U') AS INTEGER) AS d, dayofweek(o_orderdate) + 1 AS e,
  dayofyear(o_orderdate) AS f, day(o_orderdate) AS g, epoch_ms(date_trunc('month', o_orderdate)) AS h, epoch_ms(date_trunc('week', o_orderdate + INTERVAL 1 DAY) - INTERVAL 1 DAY) AS i,
  epoch_ms(o_orderdate + INTERVAL 90 SECOND) AS j, epoch_ms(o_orderdate) - 852076800000 AS k FROM orders""")
def q_dates_1(spark, sf_dir):
    day = col(1)
    ms = lambda e: fn("cast", e, {"type": "duration"})
    part = lambda p: fn("date_part", day, part=p)
    r = scan("orders", ["o_orderkey", "o_orderdate"]).project(
        col(0), part("year"), part("quarter"), part("month"), part("week"), part("day_of_week"), part("day_of_year"), part("day"), ms(fn("date_trunc", day, part="month")), ms(fn("date_trunc", day, part="week")),
        ms(day + lit(90_000)), day - DAY("1997-01-01"))
    return run(spark, sf_dir, r, "o_orderkey a b c d e f g h i j k")


@query("""
SELECT event_id, hour(ts) AS a, minute(ts) AS b, second(ts) AS c, epoch_us(ts) // 1000 % 1000 AS d, (epoch_us(ts) // 1000) / 1000.0 AS e, (epoch_us(ts) // 1000) // 86400000 AS f, (epoch_us(ts) // 1000) // 3600000 % 24 AS g,
  (epoch_us(ts) // 1000) AS h, (epoch_us(ts) // 1000) % 86400000 AS i FROM events""")
def q_dates_2(spark, sf_dir):
    ts = col(1)
    ms = fn("cast", ts, {"type": "duration"})
    part = lambda e, p: fn("date_part", e, part=p)
    r = scan("events", ["event_id", "ts"]).project(col(0), part(ts, "hour"), part(ts, "minute"), part(ts, "second"), part(ts, "millisecond"), part(ts, "epoch"), part(ms, "day"), part(ms, "hour"), fn("cast", fn("to_timestamp", ms), {"type": "duration"}), fn("cast", ts, {"type": "time"}))
    return run(spark, sf_dir, r, "event_id a b c d e f g h i")


@query("SELECT count(*) FILTER (WHERE ok) AS n FROM (SELECT true AS ok FROM orders)")
def q_now(spark, sf_dir):
    today = lt_eq(fn("current_date"), fn("current_timestamp")) & eq(fn("character_length", fn("current_time")), 12) & lt(fn("random"), 1.0) & gt_eq(fn("random"), 0.0)
    return run(spark, sf_dir, scan("orders", ["o_orderkey"]).filter(today).aggregate([], [fn("count")]), "n")


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS a, CAST(trunc(l_quantity) AS INTEGER) AS b, CAST(trunc(l_quantity) AS BIGINT) AS c, CAST(l_linenumber AS DOUBLE) AS d, l_linenumber <> 0 AS e, true AS f,
  CAST(l_quantity AS DECIMAL(38, 2)) AS g, epoch_ms(l_shipdate) AS h, '12' || l_linenumber AS i FROM lineitem""")
def q_casts(spark, sf_dir):
    key, number, quantity, day = map(col, range(4))
    cast = lambda e, t, **more: fn("cast", e, {"type": t, **more})
    r = scan("lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"]).project(key, number, cast(key, "utf8"), cast(quantity, "int16"), cast(quantity, "int64"), cast(number, "float64"), cast(number, "boolean"), cast(lit("false"), "boolean"), cast(quantity, "decimal128", scale=2), cast(cast(day, "date"), "duration"), fn("concat", lit("12"), number))
    return run(spark, sf_dir, r, "l_orderkey l_linenumber a b c d e f g h i")


@query("SELECT doc_id, TRY_CAST(source AS INTEGER) AS a, TRY_CAST(substr(source, 4) AS INTEGER) AS b, TRY_CAST(substr(source, 4) AS DOUBLE) AS c, CAST(NULL AS BIGINT) AS d FROM documents")
def q_try_casts(spark, sf_dir):
    soft = lambda e, t: fn("try_cast", e, {"type": t})
    number = fn("substr", col(1), lit(4))
    r = scan("documents", ["doc_id", "source"]).project(col(0), soft(col(1), "int32"), soft(number, "int32"), soft(number, "float64"), soft(col(1), "duration"))
    return run(spark, sf_dir, r, "doc_id a b c d")


@query("""
SELECT o_orderkey, 7 AS a, 1.5::DOUBLE AS b, CAST(12.34 AS DECIMAL(38, 2)) AS c, 86400000 AS d, 1500 AS e, 3661000 AS f, 1700000000000 AS g, '{"months":1,"days":2,"millis":3}' AS h FROM orders""")
def q_literals(spark, sf_dir):
    ms = lambda e: fn("cast", e, {"type": "duration"})
    literal = lambda **spec: fn("literal", spec)
    r = scan("orders", ["o_orderkey"]).project(col(0), lit(7, "uint8"), lit(1.5), literal(type="decimal128", value=1234, scale=2), ms(lit(1, "date32")), lit(1_500_999, "duration_microsecond"), lit(3661, "time32_second"), ms(lit(1_700_000_000, "timestamp_second")), fn("cast", literal(type="interval", value={"months": 1, "days": 2, "nanoseconds": 3_000_000}), {"type": "utf8"}))
    return run(spark, sf_dir, r, "o_orderkey a b c d e f g h")


@query("""
SELECT o_orderkey, o_totalprice * 1e295 AS a, -o_totalprice * 1e295 AS b, o_totalprice * 1e295 AS c, o_totalprice * 1e295 AS d, o_orderkey % 2 = 0 AS e, ceil(o_totalprice * -7) AS f, floor(o_totalprice * -7) AS g,
  trunc(o_totalprice * -7) AS h, round_even((o_orderkey % 10 + 1) * -1.5::DOUBLE, 0) AS i, ceil(o_totalprice * 1e10) AS j FROM orders""")
def q_round_large(spark, sf_dir):
    key, price = col(0), col(1)
    large = price * lit(1e295)
    nan = fn("case", [(eq(key % lit(2), 0), fn("cast", lit("NaN"), {"type": "float64"}))], default=price)
    r = scan("orders", ["o_orderkey", "o_totalprice"]).project(key, fn("ceil", large), fn("floor", -large), fn("trunc", large), fn("trunc", large, lit(1)), fn("is_nan", nan), fn("ceil", price * lit(-7)), fn("floor", price * lit(-7)), fn("trunc", price * lit(-7)), fn("round", (key % lit(10) + lit(1)) * lit(-1.5)), fn("ceil", price * lit(1e10)))
    return run(spark, sf_dir, r, "o_orderkey a b c d e f g h i j")


@query("""
SELECT o_orderkey, epoch_ms(CASE u WHEN 'week' THEN date_trunc('week', o_orderdate + INTERVAL 1 DAY) - INTERVAL 1 DAY ELSE date_trunc(u, o_orderdate) END) AS a FROM
  (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, CASE o_orderkey % 4 WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 2 THEN 'week' ELSE 'day' END AS u FROM orders)""")
def q_date_trunc_unit(spark, sf_dir):
    unit = fn("case", [(lit(0), "year"), (lit(1), "month"), (lit(2), "week")], scrutinee=col(0) % lit(4), default=lit("day"))
    r = scan("orders", ["o_orderkey", "o_orderdate"]).project(col(0), fn("cast", fn("date_trunc", col(1), part=unit), {"type": "duration"}))
    return run(spark, sf_dir, r, "o_orderkey a")


@query("""
SELECT o_orderkey, epoch_ms(o_orderdate) AS a, epoch_ms(o_orderdate) AS b, '{"months":0,"days":0,"millis":' || epoch_ms(o_orderdate) || '}' AS c, '{"months":0,"days":0,"millis":' || o_orderkey || '}' AS d FROM orders""")
def q_to_date(spark, sf_dir):
    key, day = col(0), col(1)
    cast = lambda e, t: fn("cast", e, {"type": t})
    r = scan("orders", ["o_orderkey", "o_orderdate"]).project(key, cast(fn("to_date", cast(day, "utf8")), "duration"), cast(fn("to_date", cast(day, "duration")), "duration"), cast(cast(day, "interval"), "utf8"), cast(cast(key, "interval"), "utf8"))
    return run(spark, sf_dir, r, "o_orderkey a b c d")


# -- aggregates and windows ---------------------------------------------------------------------


@query("SELECT l_returnflag, count(DISTINCT l_suppkey) AS a, count(l_suppkey) AS b, count(*) AS c FROM lineitem GROUP BY 1")
def q_agg_distinct(spark, sf_dir):
    r = scan("lineitem", ["l_returnflag", "l_suppkey"]).aggregate([col(0)], [fn("count", col(1), True), fn("count", col(1)), fn("count")])
    return run(spark, sf_dir, r, "l_returnflag a b c")


@query("SELECT o_orderstatus, count(DISTINCT k) + max((k IS NULL)::BIGINT) AS a, count(k) AS b FROM (SELECT o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS k FROM orders) GROUP BY 1")
def q_agg_distinct_null(spark, sf_dir):
    """Null is a value of a distinct count, by option."""
    r = scan("orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"]).project(col(1), _half(col(2))).aggregate([col(0)], [fn("count", col(1), True), fn("count", col(1))])
    return run(spark, sf_dir, r, "o_orderstatus a b", Options(strict=True))


@query("""
SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS a, round(stddev_pop(l_quantity), 6) AS b, round(median(l_quantity), 6) AS c, round(var_samp(l_quantity), 6) AS d, min(l_shipdate) = min(l_shipdate) AS e,
  coalesce(sum(CASE WHEN l_quantity < 0 THEN l_quantity END), 0) AS f FROM lineitem GROUP BY 1""")
def q_agg_stats(spark, sf_dir):
    q = col(1)
    r = scan("lineitem", ["l_returnflag", "l_quantity", "l_shipdate"]).aggregate([col(0)], [fn("stddev", q), fn("stddev_pop", q), fn("median", q), fn("var", q), fn("min", col(2)), total(fn("case", [(lt(q, 0), q)]))])
    r = r.project(col(0), *[rounded(col(i), 6) for i in range(1, 5)], eq(col(5), col(5)), col(6))
    return run(spark, sf_dir, r, "l_returnflag a b c d e f")


@query("""
SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name DESC) AS a, array_to_string(list(n_name ORDER BY n_nationkey), '|') AS b, array_to_string(list_sort(list(DISTINCT left(n_name, 1))), '') AS c,
  string_agg(CASE WHEN n_nationkey % 2 = 0 THEN n_name END, ';' ORDER BY n_nationkey) AS d, count(*) AS e FROM nation GROUP BY 1""")
def q_agg_lists(spark, sf_dir):
    key, name = col(1), col(2)
    half = fn("case", [(eq(key % lit(2), 0), name)])
    r = scan("nation", ["n_regionkey", "n_nationkey", "n_name"]).aggregate([col(0)], [fn("string_agg", name, ",", order_by=(desc(name),)), fn("array_agg", name, order_by=(asc(key),)), fn("array_agg", fn("left", name, lit(1)), distinct=True, order_by=(asc(name),)), fn("string_agg", half, ";", order_by=(asc(key),)), fn("array_agg", half)])
    df = run(spark, sf_dir, r, "n_regionkey a b c d e")
    return df.select("n_regionkey", "a", F.array_join("b", "|").alias("b"), F.array_join("c", "").alias("c"), "d", F.size("e").cast("long").alias("e"))


@query("""
SELECT l_returnflag, min(coalesce(b, false)::INT)::BOOLEAN AS a, max(coalesce(b, false)::INT)::BOOLEAN AS o FROM
  (SELECT l_returnflag, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity > 1 END AS b FROM lineitem) GROUP BY 1""")
def q_agg_bool(spark, sf_dir):
    b = fn("case", [(eq(col(1) % lit(2), 0), gt(col(2), 1))])
    r = scan("lineitem", ["l_returnflag", "l_linenumber", "l_quantity"]).aggregate([col(0)], [fn("bool_and", b), fn("bool_or", b)])
    return run(spark, sf_dir, r, "l_returnflag a o")


@query("SELECT l_returnflag, quantile_disc(l_quantity, 0.9) AS p, true AS d, true AS m FROM lineitem GROUP BY 1")
def q_agg_percentile(spark, sf_dir):
    """The approximate percentile is the value of its rank, a distinct count is within a tenth."""
    r = scan("lineitem", ["l_returnflag", "l_quantity", "l_partkey"]).aggregate([col(0)], [fn("approx_percentile_cont", col(1), percentile=0.9), fn("approx_distinct", col(2)), fn("count", col(2), True), fn("median", col(1))])
    near = lt_eq(fn("abs", col(2) - col(3)) * lit(10), col(3))
    return run(spark, sf_dir, r.project(col(0), col(1), near, gt(col(4), 0)), "l_returnflag p d m")


@query("SELECT event_type, arg_min(event_id, (ts, event_id)) AS a, arg_max(event_id, (ts, event_id)) AS b FROM events GROUP BY 1")
def q_first_last(spark, sf_dir):
    r = scan("events", ["event_type", "ts", "event_id"]).sort(asc(col(1)), asc(col(2))).aggregate([col(0)], [fn("first_value", col(2)), fn("last_value", col(2))])
    return run(spark, sf_dir, r, "event_type a b")


def _ranked(kind: str, *more) -> Relation:
    return scan("orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"]).window(fn(kind, *more, partition_by=[col(1)], order_by=(asc(col(2)), *(() if kind in ("rank", "dense_rank", "percent_rank", "cume_dist") else (asc(col(0)),)))))


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS n FROM orders")
def q_row_number(spark, sf_dir):
    return run(spark, sf_dir, _ranked("row_number").project(col(0), col(4)), "o_orderkey n")


@query("SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS n FROM orders")
def q_rank(spark, sf_dir):
    return run(spark, sf_dir, _ranked("rank").project(col(0), col(4)), "o_orderkey n")


@query("SELECT o_orderkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS n FROM orders")
def q_dense_rank(spark, sf_dir):
    return run(spark, sf_dir, _ranked("dense_rank").project(col(0), col(4)), "o_orderkey n")


@query("""
SELECT l_orderkey, l_linenumber, row_number() OVER w AS a, rank() OVER v AS b, dense_rank() OVER v AS c, round(percent_rank() OVER v, 6) AS d, round(cume_dist() OVER v, 6) AS e, ntile(7) OVER w AS f
FROM lineitem WINDOW w AS (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber), v AS (ORDER BY l_extendedprice DESC)""")
def q_ranks_of_all_rows(spark, sf_dir):
    w, v = (desc(col(2)), asc(col(0)), asc(col(1))), (desc(col(2)),)
    ranks = [fn("row_number", order_by=w), fn("rank", order_by=v), fn("dense_rank", order_by=v), fn("percent_rank", order_by=v), fn("cume_dist", order_by=v), fn("n_tile", lit(7), order_by=w)]
    r = scan("lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice"]).window(*ranks).project(col(0), col(1), col(3), col(4), col(5), fn("round", col(6), lit(6)), fn("round", col(7), lit(6)), col(8))
    return run(spark, sf_dir, r, "l_orderkey l_linenumber a b c d e f", Options(spread_windows=True))


@query("""
SELECT o_orderkey, ntile(3) OVER w AS a, round(cume_dist() OVER v, 6) AS b, round(percent_rank() OVER v, 6) AS c, lag(o_orderkey, 2) OVER w AS d, lead(o_orderkey) OVER w AS e,
  round(sum(o_totalprice) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS f, count(*) OVER (PARTITION BY o_custkey) AS g
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey), v AS (PARTITION BY o_custkey ORDER BY o_orderpriority)""")
def q_windows(spark, sf_dir):
    by, w, v = [col(1)], (asc(col(2)), asc(col(0))), (asc(col(2)),)
    running = {"unit": "rows", "start": "unbounded_preceding", "end": "current_row"}
    r = scan("orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"]).window(
        fn("n_tile", lit(3), partition_by=by, order_by=w), fn("cume_dist", partition_by=by, order_by=v), fn("percent_rank", partition_by=by, order_by=v), fn("lag", col(0), lit(2), partition_by=by, order_by=w), fn("lead", col(0), partition_by=by, order_by=w),
        fn("aggregate_over", total(col(3)), partition_by=by, order_by=w, frame=running), fn("aggregate_over", fn("count"), partition_by=by))
    r = r.project(col(0), col(4), rounded(col(5), 6), rounded(col(6), 6), col(7), col(8), rounded(col(9), 2), col(10))
    return run(spark, sf_dir, r, "o_orderkey a b c d e f g")


@query("""
SELECT c_custkey, o_orderkey FROM (SELECT c_custkey, o_orderkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS n
  FROM customer JOIN orders ON o_custkey = c_custkey) WHERE n <= 2""")
def q_filter_above_window(spark, sf_dir):
    r = scan("customer", ["c_custkey"]).join(scan("orders", ["o_orderkey", "o_custkey", "o_totalprice"]), [(col(0), col(1))])
    r = r.window(fn("row_number", partition_by=[col(0)], order_by=(desc(col(3)), asc(col(1))))).filter(lt_eq(col(4), 2)).project(col(0), col(1))
    return run(spark, sf_dir, r, "c_custkey o_orderkey")


@query("SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100) WHERE o_totalprice > 150000")
def q_filter_above_limit(spark, sf_dir):
    r = scan("orders", ["o_orderkey", "o_totalprice"]).sort(asc(col(0))).paginate(100).filter(gt(col(1), 150000))
    return run(spark, sf_dir, r, "o_orderkey o_totalprice")


@query("SELECT p, o_orderkey FROM (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS p, o_orderkey FROM orders) ORDER BY p ASC NULLS LAST, o_orderkey LIMIT 25")
def q_sort_nulls(spark, sf_dir):
    r = scan("orders", ["o_orderkey", "o_totalprice"]).project(_half(col(1)), col(0)).sort(asc(col(0), nulls_first=False), asc(col(1))).paginate(25)
    return run(spark, sf_dir, r, "p o_orderkey")


# -- document queries -----------------------------------------------------------------------------

RELATIONSHIPS = {
    "orders": G.relationship("orders", {"c_custkey": "o_custkey"}),
    "lines": G.relationship("lineitem", {"o_orderkey": "l_orderkey"}),
    "customer": G.relationship("customer", {"o_custkey": "c_custkey"}, "object"),
    "nation": G.relationship("nation", {"c_nationkey": "n_nationkey"}, "object"),
    "region": G.relationship("region", {"n_regionkey": "r_regionkey"}, "object"),
    "customers": G.relationship("customer", {"n_nationkey": "c_nationkey"}),
    "buyer": G.relationship("customer", {"info.cust": "c_custkey"}, "object"),
    "pair_lines": G.relationship("lineitem", {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"}),
}


def ask(spark: SparkSession, sf_dir: str, collection: str, query: G.Tree, variables=None, arguments=None, views=()):
    catalog = catalog_of(spark, sf_dir)
    for view in views:
        catalog.add_view(view)
    return compile_request(G.request(collection, query, arguments, RELATIONSHIPS, variables), catalog)


CHEAP = G.binop("_lt", G.target("o_totalprice"), G.value(100000))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS mean, max(o_totalprice) AS top FROM orders WHERE o_totalprice < 100000 GROUP BY 1, 2")
def q_group_dims(spark, sf_dir):
    q = G.query(predicate=CHEAP, groups=G.groups([G.dimension("o_orderstatus"), G.dimension("o_orderpriority")], {"n": G.star_count(), "mean": G.column_aggregate("avg", "o_totalprice"), "top": G.column_aggregate("max", "o_totalprice")}, [G.dimension_order(0), G.dimension_order(1)]))
    out = ask(spark, sf_dir, "orders", q)
    a, b = out.dimensions
    return out.groups.select(F.col(a).alias("o_orderstatus"), F.col(b).alias("o_orderpriority"), "n", F.round("mean", 4).alias("mean"), "top")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12 ORDER BY n DESC, o_custkey LIMIT 10 OFFSET 2")
def q_group_having(spark, sf_dir):
    q = G.query(groups=G.groups([G.dimension("o_custkey")], {"n": G.star_count()}, [G.group_aggregate_order("n", True), G.dimension_order(0)], G.group_test("_gt", "n", 12), 10, 2))
    out = ask(spark, sf_dir, "orders", q)
    return out.groups.select(F.col(out.dimensions[0]).alias("o_custkey"), "n")


@query("SELECT n_name, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def q_group_by_related(spark, sf_dir):
    nation = G.dimension("n_name", path=[G.path_step("nation")])
    region = G.dimension("r_name", path=[G.path_step("nation"), G.path_step("region")])
    out = ask(spark, sf_dir, "customer", G.query(groups=G.groups([nation, region], {"n": G.star_count()})))
    a, b = out.dimensions
    return out.groups.select(F.get(a, F.lit(0)).alias("n_name"), F.get(b, F.lit(0)).alias("r_name"), "n")


FACETS = G.query(fields={"key": G.field("o_orderkey"), "price": G.field("o_totalprice")}, aggregates={"n": G.star_count(), "total": G.column_aggregate("sum", "o_totalprice"), "customers": G.column_count("o_custkey", distinct=True)}, groups=G.groups([G.dimension("o_orderstatus")], {"n": G.star_count()}), predicate=CHEAP, order_by=[G.order("o_totalprice"), G.order("o_orderkey")], limit=50, offset=5)
_FACET_ROWS = "SELECT * FROM orders WHERE o_totalprice < 100000 ORDER BY o_totalprice, o_orderkey LIMIT 50 OFFSET 5"


@query(f"SELECT o_orderkey AS key, o_totalprice AS price FROM ({_FACET_ROWS})")
def q_facets_rows(spark, sf_dir):
    return ask(spark, sf_dir, "orders", FACETS).rows


@query(f"SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, count(DISTINCT o_custkey) AS customers FROM ({_FACET_ROWS})")
def q_facets_aggs(spark, sf_dir):
    return ask(spark, sf_dir, "orders", FACETS).aggregates.withColumn("total", F.round("total", 2))


@query(f"SELECT o_orderstatus, count(*) AS n FROM ({_FACET_ROWS}) GROUP BY 1")
def q_facets_groups(spark, sf_dir):
    out = ask(spark, sf_dir, "orders", FACETS)
    return out.groups.select(F.col(out.dimensions[0]).alias("o_orderstatus"), "n")


@query("SELECT count(*) AS n, count(o_custkey) AS c, max(o_totalprice) AS top, sum(o_totalprice) AS total FROM orders WHERE o_orderkey < 0")
def q_empty_set_aggregates(spark, sf_dir):
    q = G.query(aggregates={"n": G.star_count(), "c": G.column_count("o_custkey"), "top": G.column_aggregate("max", "o_totalprice"), "total": G.column_aggregate("sum", "o_totalprice")}, predicate=G.binop("_lt", G.target("o_orderkey"), G.value(0)))
    return ask(spark, sf_dir, "orders", q).aggregates


@query("SELECT c_custkey, coalesce(len(l), 0) AS n, array_to_string(l, ',') AS keys FROM customer LEFT JOIN (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey DESC) AS l FROM orders WHERE o_totalprice < 100000 GROUP BY 1) ON o_custkey = c_custkey")
def q_rel_array(spark, sf_dir):
    inner = G.query(fields={"key": G.field("o_orderkey")}, predicate=CHEAP, order_by=[G.order("o_orderkey", descending=True)])
    rows = ask(spark, sf_dir, "customer", G.query(fields={"c_custkey": G.field("c_custkey"), "orders": G.related_field("orders", inner)})).rows
    keys = F.transform("orders.rows", lambda r: r["key"].cast("string"))
    return rows.select("c_custkey", F.size("orders.rows").cast("long").alias("n"), F.when(F.size(keys) > 0, F.array_join(keys, ",")).alias("keys"))


@query("SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def q_rel_object(spark, sf_dir):
    nation = G.related_field("nation", G.query(fields={"name": G.field("n_name")}))
    customer = G.related_field("customer", G.query(fields={"name": G.field("c_name"), "nation": nation}))
    rows = ask(spark, sf_dir, "orders", G.query(fields={"o_orderkey": G.field("o_orderkey"), "customer": customer})).rows
    first = F.get("customer.rows", F.lit(0))
    return rows.select("o_orderkey", first["name"].alias("c_name"), F.get(first["nation"]["rows"], F.lit(0))["name"].alias("n_name"))


@query("""
SELECT c_custkey, array_to_string(list(o_orderkey ORDER BY n), ',') AS keys FROM (SELECT c_custkey, o_orderkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n
  FROM customer JOIN orders ON o_custkey = c_custkey) WHERE n BETWEEN 2 AND 4 GROUP BY 1""")
def q_rel_limit_per_parent(spark, sf_dir):
    inner = G.query(fields={"key": G.field("o_orderkey")}, order_by=[G.order("o_totalprice", descending=True), G.order("o_orderkey")], limit=3, offset=1)
    rows = ask(spark, sf_dir, "customer", G.query(fields={"c_custkey": G.field("c_custkey"), "orders": G.related_field("orders", inner)})).rows
    return rows.filter(F.size("orders.rows") > 0).select("c_custkey", F.array_join(F.transform("orders.rows", lambda r: r["key"].cast("string")), ",").alias("keys"))


@query("""
SELECT c_custkey, coalesce(n, 0) AS n, round(total, 2) AS total, round(top_lines, 2) AS top FROM customer LEFT JOIN
  (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total, max(o_totalprice) AS top_lines FROM orders WHERE o_totalprice < 100000 GROUP BY 1) ON o_custkey = c_custkey""")
def q_rel_agg(spark, sf_dir):
    inner = G.query(aggregates={"n": G.star_count(), "total": G.column_aggregate("sum", "o_totalprice"), "top": G.column_aggregate("max", "o_totalprice")}, predicate=CHEAP)
    rows = ask(spark, sf_dir, "customer", G.query(fields={"c_custkey": G.field("c_custkey"), "o": G.related_field("orders", inner)})).rows
    a = F.col("o.aggregates")
    return rows.select("c_custkey", a["n"].alias("n"), F.round(a["total"], 2).alias("total"), F.round(a["top"], 2).alias("top"))


@query("SELECT c_custkey, coalesce(string_agg(o_orderstatus || n, ',' ORDER BY o_orderstatus), '') AS g FROM customer LEFT JOIN (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) ON o_custkey = c_custkey GROUP BY 1")
def q_rel_groups(spark, sf_dir):
    inner = G.query(groups=G.groups([G.dimension("o_orderstatus")], {"n": G.star_count()}, [G.dimension_order(0)]))
    rows = ask(spark, sf_dir, "customer", G.query(fields={"c_custkey": G.field("c_custkey"), "o": G.related_field("orders", inner)})).rows
    each = F.transform("o.groups", lambda g: F.concat(g["dimensions"]["d0"], g["aggregates"]["n"].cast("string")))
    return rows.select("c_custkey", F.array_join(each, ",").alias("g"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL")
def q_rel_two_keys(spark, sf_dir):
    inner = G.query(aggregates={"n": G.star_count()})
    q = G.query(fields={"l_orderkey": G.field("l_orderkey"), "l_linenumber": G.field("l_linenumber"), "p": G.related_field("pair_lines", inner)})
    rows = ask(spark, sf_dir, "lineitem", q).rows
    return rows.select("l_orderkey", "l_linenumber", F.col("p.aggregates.n").alias("n")).distinct()


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice < 100000 AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 49))")
def q_exists_related(spark, sf_dir):
    lines = G.exists(G.related("lines"), G.binop("_gt", G.target("l_quantity"), G.value(49)))
    q = G.query(fields={"c_custkey": G.field("c_custkey")}, predicate=G.exists(G.related("orders"), G.and_(CHEAP, lines)))
    return ask(spark, sf_dir, "customer", q).rows


@query("SELECT c_custkey FROM customer WHERE c_acctbal < 0 OR NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice < 100000)")
def q_exists_under_or(spark, sf_dir):
    poor = G.binop("_lt", G.target("c_acctbal"), G.value(0))
    q = G.query(fields={"c_custkey": G.field("c_custkey")}, predicate=G.or_(poor, G.not_(G.exists(G.related("orders"), CHEAP))))
    return ask(spark, sf_dir, "customer", q).rows


@query("""
SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND (o_totalprice < c_acctbal OR o_totalprice > 480000))""")
def q_exists_scoped(spark, sf_dir):
    """A column of the customer inside the condition on its orders."""
    inner = G.or_(G.binop("_lt", G.target("o_totalprice"), G.column_value("c_acctbal", scope=1)), G.binop("_gt", G.target("o_totalprice"), G.value(480000)))
    return ask(spark, sf_dir, "customer", G.query(fields={"c_custkey": G.field("c_custkey")}, predicate=G.exists(G.related("orders"), inner))).rows


@query("""
SELECT c_custkey FROM customer WHERE c_acctbal < -900 OR NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND EXISTS
  (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_suppkey > c_nationkey AND l_extendedprice > o_totalprice))""")
def q_exists_scoped_twice(spark, sf_dir):
    """Columns of the order and of its customer inside the condition on a line, under "not"."""
    inner = G.and_(G.binop("_gt", G.target("l_suppkey"), G.column_value("c_nationkey", scope=2)), G.binop("_gt", G.target("l_extendedprice"), G.column_value("o_totalprice", scope=1)))
    orders = G.exists(G.related("orders"), G.exists(G.related("lines"), inner))
    poor = G.binop("_lt", G.target("c_acctbal"), G.value(-900))
    return ask(spark, sf_dir, "customer", G.query(fields={"c_custkey": G.field("c_custkey")}, predicate=G.or_(poor, G.not_(orders)))).rows


@query("""
SELECT level, count(*) AS n, max(price) AS top, round(sum(price), 2) AS total FROM (SELECT o_totalprice AS price, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS level FROM orders)
  WHERE NOT (level IS NULL) OR price > 400000 GROUP BY 1""")
def q_nested_aggregate(spark, sf_dir):
    """Aggregates, dimensions and null tests on nested paths, and a name with a dollar sign."""
    price = ("info", "price")
    some = G.or_(G.not_(G.is_null(G.target("info", "$level"))), G.binop("_gt", G.target(*price), G.value(400000)))
    q = G.query(predicate=some, groups=G.groups([G.dimension("info", "$level")], {"n": G.star_count(), "top": G.column_aggregate("max", *price), "total": G.column_aggregate("sum", *price)}))
    out = ask(spark, sf_dir, "boxes", q)
    return out.groups.select(F.col(out.dimensions[0]).alias("level"), "n", "top", F.round("total", 2).alias("total"))


@query("SELECT o_orderkey AS key, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS level, c_name AS buyer FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 3 = 0 OR o_orderpriority LIKE '1%'")
def q_rel_nested_key(spark, sf_dir):
    """A relationship from a nested field, and a field whose name has a dollar sign."""
    some = G.or_(G.is_null(G.target("info", "$level")), G.binop("_regex", G.target("info", "$level"), G.value("^1")))
    fields = {"key": G.field("key"), "info": G.field("info", G.nested_object(level=G.field("$level"))), "buyer": G.related_field("buyer", G.query(fields={"name": G.field("c_name")}))}
    rows = ask(spark, sf_dir, "boxes", G.query(fields=fields, predicate=some)).rows
    return rows.select("key", F.col("info.level").alias("level"), F.get("buyer.rows", F.lit(0))["name"].alias("buyer"))


@query("SELECT r_name FROM region WHERE EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 9000) AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 1e9)")
def q_exists_unrelated(spark, sf_dir):
    rich = lambda n: G.exists(G.unrelated("supplier"), G.binop("_gt", G.target("s_acctbal"), G.value(n)))
    return ask(spark, sf_dir, "region", G.query(fields={"r_name": G.field("r_name")}, predicate=G.and_(rich(9000), G.not_(rich(1e9))))).rows


@query("SELECT DISTINCT conv_id FROM conversations WHERE role = 'system' AND turn = 0")
def q_exists_nested(spark, sf_dir):
    inner = G.and_(G.binop("_eq", G.target("role"), G.value("system")), G.binop("_eq", G.target("turn"), G.value(0)))
    return ask(spark, sf_dir, "chats", G.query(fields={"conv_id": G.field("conv_id")}, predicate=G.exists(G.nested("turns"), inner))).rows


@query("SELECT DISTINCT conv_id FROM conversations WHERE role = 'system'")
def q_any_element(spark, sf_dir):
    q = G.query(fields={"conv_id": G.field("conv_id")}, predicate=G.binop("_eq", G.target("turns", "role"), G.value("system")))
    return ask(spark, sf_dir, "chats", q).rows


@query("SELECT DISTINCT n_regionkey FROM nation WHERE n_name LIKE '%1' OR n_name = 'NATION_2'")
def q_nested_scalars(spark, sf_dir):
    named = G.exists(G.nested_scalars("names"), G.binop("_regex", G.target("__value"), G.value("1$")))
    contains = G.array_contains(G.target("names"), G.value("NATION_2"))
    q = G.query(fields={"n_regionkey": G.field("n_regionkey")}, predicate=G.and_(G.not_(G.array_is_empty(G.target("names"))), G.or_(named, contains)))
    return ask(spark, sf_dir, "regions", q).rows


@query("SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_nationkey) AS names, count(*) AS n FROM nation GROUP BY 1")
def q_nested_selection(spark, sf_dir):
    picked = G.field("nations", G.nested_array(G.nested_object(title=G.field("name"))))
    rows = ask(spark, sf_dir, "regions", G.query(fields={"n_regionkey": G.field("n_regionkey"), "nations": picked})).rows
    return rows.select("n_regionkey", F.array_join(F.transform("nations", lambda x: x["title"]), ",").alias("names"), F.size("nations").cast("long").alias("n"))


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, 'licen[cs]e') OR regexp_matches(text, '(?i)RIGHTS RESERVED')")
def q_regex(spark, sf_dir):
    q = G.query(fields={"doc_id": G.field("doc_id")}, predicate=G.or_(G.binop("_regex", G.target("text"), G.value("licen[cs]e")), G.binop("_iregex", G.target("text"), G.value("RIGHTS RESERVED"))))
    return ask(spark, sf_dir, "documents", q).rows


@query("SELECT p_partkey FROM part WHERE p_size IN (1, 5, 9) AND p_brand NOT IN ('Brand#11', 'Brand#22')")
def q_in_nin(spark, sf_dir):
    q = G.query(fields={"p_partkey": G.field("p_partkey")}, predicate=G.and_(G.binop("_in", G.target("p_size"), G.value([1, 5, 9])), G.binop("_nin", G.target("p_brand"), G.value(["Brand#11", "Brand#22"]))))
    return ask(spark, sf_dir, "part", q).rows


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey = l_suppkey OR (l_linenumber <> l_quantity AND l_quantity < 2)")
def q_column_comparison(spark, sf_dir):
    q = G.query(fields={"l_orderkey": G.field("l_orderkey"), "l_linenumber": G.field("l_linenumber")}, predicate=G.or_(G.binop("_eq", G.target("l_partkey"), G.column_value("l_suppkey")), G.and_(G.binop("_neq", G.target("l_linenumber"), G.column_value("l_quantity")), G.binop("_lt", G.target("l_quantity"), G.value(2)))))
    return ask(spark, sf_dir, "lineitem", q).rows


@query("SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey ORDER BY r_name DESC, n_name, c_custkey LIMIT 30")
def q_order_by_related(spark, sf_dir):
    q = G.query(fields={"c_custkey": G.field("c_custkey")}, order_by=[G.order("r_name", descending=True, path=[G.path_step("nation"), G.path_step("region")]), G.order("n_name", path=[G.path_step("nation")]), G.order("c_custkey")], limit=30)
    return ask(spark, sf_dir, "customer", q).rows


@query("SELECT n_name FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1) ON c_nationkey = n_nationkey ORDER BY coalesce(n, 0) DESC, n_name LIMIT 7")
def q_order_by_related_count(spark, sf_dir):
    step = G.path_step("customers", G.binop("_gt", G.target("c_acctbal"), G.value(0)))
    q = G.query(fields={"n_name": G.field("n_name")}, order_by=[G.order_aggregate(G.star_count(), [step], descending=True), G.order("n_name")], limit=7)
    return ask(spark, sf_dir, "nation", q).rows


SETS = [{"key": 3, "least": 0, "unused": "x"}, {"key": 7, "least": 5000}, {"key": 99, "least": 0}, {"key": 3, "least": 9000}]
_SETS_SQL = "(VALUES (0, 3, 0), (1, 7, 5000), (2, 99, 0), (3, 3, 9000)) AS v(s, k, b)"


@query(f"SELECT s, c_custkey FROM (SELECT s, c_custkey, row_number() OVER (PARTITION BY s ORDER BY c_acctbal, c_custkey) AS n FROM {_SETS_SQL} JOIN customer ON c_nationkey = k AND c_acctbal >= b) WHERE n <= 5")
def q_foreach(spark, sf_dir):
    predicate = G.and_(G.binop("_eq", G.target("c_nationkey"), G.variable("key")), G.binop("_gte", G.target("c_acctbal"), G.variable("least")))
    q = G.query(fields={"c_custkey": G.field("c_custkey")}, predicate=predicate, order_by=[G.order("c_acctbal"), G.order("c_custkey")], limit=5)
    return ask(spark, sf_dir, "customer", q, SETS).rows.withColumnRenamed("__set", "s")


@query(f"SELECT s, count(c_custkey) AS n, max(c_acctbal) AS top FROM {_SETS_SQL} LEFT JOIN customer ON c_nationkey = k AND c_acctbal >= b GROUP BY 1")
def q_foreach_aggregates(spark, sf_dir):
    predicate = G.and_(G.binop("_eq", G.target("c_nationkey"), G.variable("key")), G.binop("_gte", G.target("c_acctbal"), G.variable("least")))
    q = G.query(aggregates={"n": G.star_count(), "top": G.column_aggregate("max", "c_acctbal")}, predicate=predicate)
    return ask(spark, sf_dir, "customer", q, SETS).aggregates.withColumnRenamed("__set", "s")


_DEAR = pipeline_view("dear", [{"$match": {"o_totalprice": {"$gte": "{{ least }}"}, "o_orderstatus": "{{ status | string }}"}}], {"least": T.DoubleType(), "status": T.StringType()}, "orders")


@query("SELECT s, o_orderkey FROM (VALUES (0, 300000), (1, 350000), (2, 300000)) AS v(s, p) JOIN orders ON o_totalprice >= p AND o_orderstatus = 'F'")
def q_variable_argument(spark, sf_dir):
    """Arguments of a view from each set of variables, and a literal one."""
    arguments = {"least": G.variable("p"), "status": {"type": "literal", "value": "F"}}
    out = ask(spark, sf_dir, "dear", G.query(fields={"o_orderkey": G.field("o_orderkey")}), [{"p": 300000.0}, {"p": 350000.0}, {"p": 300000.0}], arguments, [_DEAR])
    return out.rows.withColumnRenamed("__set", "s")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000 AND o_orderstatus <> 'P'")
def q_predicate_argument(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    catalog.add_view(pipeline_view("where", [{"$match": "{{ condition }}"}, {"$match": {"o_orderstatus": {"$ne": "P"}}}], {"condition": None}, "orders"))
    return catalog.open("where", {"condition": F.col("o_totalprice") > 250000}).select("o_orderkey", "o_totalprice")


# -- pipelines and views ------------------------------------------------------------------------------


@query("SELECT word AS _id, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1")
def q_pipeline_word_count(spark, sf_dir):
    stages = [{"$replaceWith": {"words": {"$split": ["$text", " "]}}}, {"$unwind": {"path": "$words"}}, {"$group": {"_id": "$words", "count": {"$count": {}}}}]
    catalog = catalog_of(spark, sf_dir)
    return Pipeline(catalog).run(stages, catalog.open("documents"))


@query("SELECT p_name AS name, p_brand AS brand, 'hello' AS word FROM part WHERE p_brand = 'Brand#11' AND p_size > 20")
def q_view_args(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    stages = [{"$match": {"p_brand": "{{ brand | string }}", "p_size": {"$gt": "{{ size }}"}}}, {"$project": {"name": "$p_name", "brand": "$p_brand", "word": "hello", "p_size": 1}}, {"$project": {"p_size": False}}]
    catalog.add_view(pipeline_view("parts", stages, {"brand": T.StringType(), "size": T.IntegerType()}, "part"))
    return compile_relation(scan("parts", ["name", "brand", "word"], brand="Brand#11", size=20), catalog).toDF("name", "brand", "word")


@query("SELECT 'hello' AS __value")
def q_view_function(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    catalog.add_view(pipeline_view("hello", [{"$documents": [{"__value": "{{ name }}"}]}], {"name": T.StringType()}, kind="function"))
    return catalog.call("hello", {"name": "hello"})


@query("""
SELECT o_orderstatus AS status, year(o_orderdate) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(o_totalprice) AS low, max(o_totalprice) AS high, round(avg(o_totalprice), 4) AS mean
FROM orders WHERE o_totalprice >= 50000 AND (o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%') AND o_custkey % 3 = 1 AND o_orderstatus <> 'P' GROUP BY 1, 2 ORDER BY n DESC, year LIMIT 10""")
def q_pipeline_group(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    stages = [
        {"$match": {"o_totalprice": {"$gte": 50000}, "$or": [{"o_orderpriority": {"$regex": "^1"}}, {"o_orderpriority": {"$regex": "^2"}}], "o_custkey": {"$mod": [3, 1]}, "$nor": [{"o_orderstatus": "P"}]}},
        {"$addFields": {"year": {"$year": "$o_orderdate"}}},
        {"$group": {"_id": {"status": "$o_orderstatus", "year": "$year"}, "n": {"$sum": 1}, "total": {"$sum": "$o_totalprice"}, "low": {"$min": "$o_totalprice"}, "high": {"$max": "$o_totalprice"}, "mean": {"$avg": "$o_totalprice"}}},
        {"$sort": {"n": -1, "_id.year": 1}},
        {"$limit": 10},
        {"$project": {"_id": 0, "status": "$_id.status", "year": "$_id.year", "n": 1, "total": 1, "low": 1, "high": 1, "mean": 1}},
    ]
    df = Pipeline(catalog).run(stages, catalog.open("orders"))
    return df.select("status", "year", F.col("n").cast("long").alias("n"), F.round("total", 2).alias("total"), "low", "high", F.round("mean", 4).alias("mean"))


@query("SELECT n_name, count(s_suppkey) AS n, coalesce(max(s_acctbal), -1) AS top FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def q_pipeline_lookup(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    stages = [
        {"$lookup": {"from": "supplier", "let": {"k": "$n_nationkey"}, "pipeline": [{"$match": {"$expr": {"$eq": ["$s_nationkey", "$$k"]}}}, {"$project": {"s_suppkey": 1, "s_acctbal": 1}}], "as": "suppliers"}},
        {"$addFields": {"n": {"$size": "$suppliers"}}},
    ]
    df = Pipeline(catalog).run(stages, catalog.open("nation"))
    return df.select("n_name", F.col("n").cast("long").alias("n"), F.coalesce(F.array_max(F.col("suppliers.s_acctbal")), F.lit(-1.0)).alias("top"))


@query("SELECT n_name, c_custkey, place FROM (SELECT n_name, c_custkey, row_number() OVER (PARTITION BY n_nationkey ORDER BY c_acctbal DESC, c_custkey) - 2 AS place FROM nation JOIN customer ON c_nationkey = n_nationkey) WHERE place BETWEEN 0 AND 3")
def q_pipeline_lookup_top(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    top = [{"$match": {"$expr": {"$eq": ["$c_nationkey", "$$k"]}}}, {"$sort": {"c_acctbal": -1, "c_custkey": 1}}, {"$skip": 1}, {"$limit": 4}, {"$project": {"c_custkey": 1}}]
    stages = [
        {"$lookup": {"from": "customer", "let": {"k": "$n_nationkey"}, "pipeline": top, "as": "top"}},
        {"$unwind": {"path": "$top", "includeArrayIndex": "place"}},
    ]
    return Pipeline(catalog).run(stages, catalog.open("nation")).select("n_name", F.col("top.c_custkey").alias("c_custkey"), "place")


@query("""
    SELECT n_name, c_mktsegment AS segment, count(*) AS n, total FROM nation JOIN customer ON c_nationkey = n_nationkey
    JOIN (SELECT c_nationkey AS k, count(*) AS total FROM customer GROUP BY 1) ON k = n_nationkey GROUP BY 1, 2, 4""")
def q_pipeline_lookup_group(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    stages = [
        {"$lookup": {"from": "customer", "localField": "n_nationkey", "foreignField": "c_nationkey", "pipeline": [{"$group": {"_id": "$c_mktsegment", "n": {"$count": {}}}}], "as": "segments"}},
        {"$lookup": {"from": "customer", "localField": "n_nationkey", "foreignField": "c_nationkey", "pipeline": [{"$count": "n"}], "as": "all"}},
        {"$unwind": "$segments"},
    ]
    df = Pipeline(catalog).run(stages, catalog.open("nation"))
    return df.select("n_name", F.col("segments._id").alias("segment"), F.col("segments.n").cast("long").alias("n"), F.col("all")[0]["n"].cast("long").alias("total"))


@query("SELECT n_name, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 300 * n_nationkey GROUP BY 1")
def q_pipeline_lookup_above(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    above = [{"$match": {"$expr": {"$and": [{"$eq": ["$s_nationkey", "$$k"]}, {"$gt": ["$s_acctbal", "$$least"]}]}}}]
    stages = [{"$lookup": {"from": "supplier", "let": {"k": "$n_nationkey", "least": {"$multiply": ["$n_nationkey", 300]}}, "pipeline": above, "as": "found"}}]
    df = Pipeline(catalog).run(stages, catalog.open("nation"))
    return df.select("n_name", F.size("found").cast("long").alias("n"))


@query("SELECT conv_id, pos - 1 AS at, turn.role AS role FROM (SELECT conv_id, unnest(t) AS turn, generate_subscripts(t, 1) AS pos FROM (SELECT conv_id, list({'role': role} ORDER BY turn) AS t FROM conversations GROUP BY 1)) WHERE turn.role <> 'user'")
def q_pipeline_unwind(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    stages = [{"$unwind": {"path": "$turns", "includeArrayIndex": "at", "preserveNullAndEmptyArrays": True}}, {"$match": {"turns.role": {"$ne": "user"}}}, {"$replaceWith": {"conv_id": "$conv_id", "at": "$at", "role": "$turns.role"}}]
    return Pipeline(catalog).run(stages, catalog.open("chats"))


@query("SELECT n_name AS name, 'n' AS kind FROM nation UNION ALL SELECT r_name, 'r' FROM region WHERE r_name <> 'ASIA'")
def q_pipeline_union(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    stages = [{"$project": {"name": "$n_name", "kind": "n"}}, {"$unionWith": {"coll": "region", "pipeline": [{"$match": {"r_name": {"$ne": "ASIA"}}}, {"$project": {"name": "$r_name", "kind": "r"}}]}}]
    return Pipeline(catalog).run(stages, catalog.open("nation"))


@query("SELECT (SELECT count(*) FROM orders WHERE o_totalprice > 200000) AS big, (SELECT count(*) FROM orders WHERE o_totalprice <= 200000) AS small")
def q_pipeline_facet(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    found = facets(Pipeline(catalog), catalog.open("orders"), {"big": [{"$match": {"o_totalprice": {"$gt": 200000}}}, {"$count": "big"}], "small": [{"$match": {"o_totalprice": {"$lte": 200000}}}, {"$count": "small"}]})
    return found["big"].crossJoin(found["small"])  # one row each


@query("""
SELECT (SELECT count(*) FROM orders WHERE o_totalprice > 200000) AS big, (SELECT count(DISTINCT o_orderpriority) FROM orders) AS kinds,
  (SELECT string_agg(o_orderpriority, ',' ORDER BY n DESC, o_orderpriority) FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)) AS by_count, 0 AS none""")
def q_pipeline_facet_stage(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    body = {"big": [{"$match": {"o_totalprice": {"$gt": 200000}}}, {"$count": "n"}], "kinds": [{"$group": {"_id": "$o_orderpriority", "n": {"$sum": 1}}}], "none": [{"$match": {"o_orderkey": -1}}, {"$project": {"o_orderkey": 1}}]}
    df = Pipeline(catalog).run([{"$facet": body}], catalog.open("orders"))
    kinds = F.array_sort(F.transform("kinds", lambda k: F.struct((-k["n"]).alias("n"), k["_id"].alias("k"))))
    return df.select(F.get("big", F.lit(0))["n"].alias("big"), F.size("kinds").cast("long").alias("kinds"), F.array_join(F.transform(kinds, lambda k: k["k"]), ",").alias("by_count"), F.size("none").alias("none"))


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 40")
def q_pipeline_skip(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    stages = [{"$match": {"o_totalprice": {"$gt": 100000}}}, {"$sort": {"o_totalprice": -1, "o_orderkey": 1}}, {"$skip": 40}, {"$limit": 25}, {"$project": {"o_orderkey": 1}}]
    return Pipeline(catalog).run(stages, catalog.open("orders"))


@query("""
SELECT o_custkey AS _id, arg_min(o_orderkey, (-o_totalprice, o_orderkey)) AS dearest, arg_max(o_orderkey, (-o_totalprice, o_orderkey)) AS cheapest, count(*) AS n, count(DISTINCT o_orderstatus) AS kinds, round(stddev_pop(o_totalprice), 4) AS spread
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def q_pipeline_first_last(spark, sf_dir):
    """The first and last of a group are those of the sort before it."""
    catalog = catalog_of(spark, sf_dir)
    group = {"_id": "$o_custkey", "dearest": {"$first": "$o_orderkey"}, "cheapest": {"$last": "$o_orderkey"}, "all": {"$push": "$o_orderkey"}, "kinds": {"$addToSet": "$o_orderstatus"}, "spread": {"$stdDevPop": "$o_totalprice"}}
    stages = [{"$sort": {"o_totalprice": -1, "o_orderkey": 1}}, {"$match": {"o_orderstatus": {"$ne": "P"}}}, {"$group": group}]
    df = Pipeline(catalog).run(stages, catalog.open("orders"))
    return df.select("_id", "dearest", "cheapest", F.size("all").cast("long").alias("n"), F.size("kinds").cast("long").alias("kinds"), F.round("spread", 4).alias("spread"))


@query("""
SELECT l_orderkey, l_linenumber, round(abs(l_tax - l_discount), 6) AS a, round(sin(l_tax) + cos(l_tax) + tan(l_tax) + asin(l_tax) + acos(l_tax) + atan(l_tax), 6) AS b, round(sinh(l_tax) + cosh(l_tax) + tanh(l_tax), 6) AS c,
  l_quantity > 10 AND NOT l_linenumber = 2 AS d, CASE WHEN l_quantity >= 25 THEN 'hi' ELSE 'lo' END AS e, 10 AS f, false AS g, true AS h, round(l_quantity * 2 / 4 - 1 + 3, 6) AS i FROM lineitem""")
def q_pipeline_expressions(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    t = "$l_tax"
    stages = [{"$project": {"l_orderkey": 1, "l_linenumber": 1, "a": {"$abs": {"$subtract": [t, "$l_discount"]}}, "b": {"$add": [{f"${f}": t} for f in ("sin", "cos", "tan", "asin", "acos", "atan")]}, "c": {"$add": [{f"${f}": t} for f in ("sinh", "cosh", "tanh")]}, "d": {"$and": [{"$gt": ["$l_quantity", 10]}, {"$not": [{"$eq": ["$l_linenumber", 2]}]}]}, "e": {"$cond": [{"$gte": ["$l_quantity", 25]}, "hi", "lo"]}, "f": {"$arrayElemAt": [[9, 10], -1]}, "g": {"$allElementsTrue": [[True, False]]}, "h": {"$anyElementTrue": [[True, False]]}, "i": {"$add": [{"$subtract": [{"$divide": [{"$multiply": ["$l_quantity", 2]}, 4]}, 1]}, 3]}}}]
    df = Pipeline(catalog).run(stages, catalog.open("lineitem"))
    return df.select(*[F.round(c, 6).alias(c) if c in "abci" else F.col(c) for c in df.columns])


@query("""
WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0)
SELECT vec_id FROM embeddings, q ORDER BY list_cosine_similarity(embedding::DOUBLE[], v::DOUBLE[]) DESC, vec_id LIMIT 10""")
def q_vector_topk(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    (row,) = catalog.open("embeddings").filter("vec_id = 0").select("embedding").limit(1).collect()
    stages = [{"$vectorSearch": {"path": "embedding", "queryVector": list(row[0]), "limit": 10}}, {"$project": {"vec_id": 1}}]
    return Pipeline(catalog).run(stages, catalog.open("embeddings"))


@query("""
SELECT query_id, vec_id FROM (SELECT q.vec_id AS query_id, e.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, e.vec_id) AS n
  FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0) WHERE n <= 10""")
def q_vector_topk_all(spark, sf_dir):
    rows = catalog_of(spark, sf_dir).open("embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.filter("vec_id % 50 = 0"), "vec_id", "embedding", 10)


@query(r"""
SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x IN ('license', 'version'))) AS score FROM documents WHERE score > 0""")
def q_text_search(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    df = Pipeline(catalog).run([{"$search": {"text": {"query": "license VERSION", "path": "text"}}}], catalog.open("documents"))
    return df.select("doc_id", F.col("searchScore").cast("long").alias("score"))


# -- event windows (extensions) --------------------------------------------------------------------------


@query("SELECT epoch_ms(time_bucket(INTERVAL 1 HOUR, ts)) AS start, event_type, count(*) AS n, round(sum(value), 4) AS v FROM events GROUP BY 1, 2")
def q_event_windows(spark, sf_dir):
    events = catalog_of(spark, sf_dir).open("events")
    df = windowed(events, "ts", ["event_type"], [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("v")], "1 hour")
    return df.select(F.unix_millis("window_start").alias("start"), "event_type", "n", "v")


@query("""
SELECT user_id, epoch_us(min(ts)) // 1000 AS start, count(*) AS n FROM (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM
  (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")
def q_event_sessions(spark, sf_dir):
    events = catalog_of(spark, sf_dir).open("events")
    df = sessions(events, "ts", ["user_id"], [F.count(F.lit(1)).alias("n")], "30 minutes")
    return df.select("user_id", F.unix_millis("window_start").alias("start"), "n")


# -- rows, schemas and requests, as tables of what they give -----------------------------------------------


@query("""
SELECT kind, o_orderkey, o_orderstatus, o_totalprice FROM (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 40), (VALUES ('buffered'), ('streamed')) AS v(kind)""")
def q_row_streams(spark, sf_dir):
    """The rows of a limited relation, whole and as a stream."""
    r = scan("orders", ["o_orderkey", "o_orderstatus", "o_totalprice"]).sort(desc(col(2)), asc(col(0))).paginate(40)
    df = compile_relation(r, catalog_of(spark, sf_dir))
    rows = [("buffered", *x) for x in buffered(df)] + [("streamed", *x) for x in streamed(df)]
    return spark.createDataFrame([(k, int(a), b, float(c)) for k, a, b, c in rows], "kind string, o_orderkey long, o_orderstatus string, o_totalprice double")


@query("""
SELECT s, n, top FROM (SELECT s, CAST(count(c_custkey) AS VARCHAR) AS n, max(c_acctbal) AS top FROM (VALUES (0, 3), (1, 7), (2, 99)) AS v(s, k) LEFT JOIN customer ON c_nationkey = k GROUP BY 1)""")
def q_request_json(spark, sf_dir):
    """A request with sets of variables, answered as JSON: 64-bit counts come as text."""
    q = G.query(aggregates={"n": G.star_count(), "top": G.column_aggregate("max", "c_acctbal")}, predicate=G.binop("_eq", G.target("c_nationkey"), G.variable("k")))
    out = execute_request(G.request("customer", q, variables=[{"k": 3}, {"k": 7}, {"k": 99}]), catalog_of(spark, sf_dir))
    return spark.createDataFrame([(i, o["aggregates"]["n"], o["aggregates"]["top"]) for i, o in enumerate(out)], "s int, n string, top double")


@query("""
SELECT * FROM (VALUES ('nation', 'n_name', 'string'), ('nation', 'n_nationkey', 'int'), ('nation', 'n_regionkey', 'int'), ('region', 'r_name', 'string'), ('region', 'r_regionkey', 'int')) AS v(collection, field, type)""")
def q_schema(spark, sf_dir):
    """Fields of two collections, as discovery finds them."""
    catalog = Catalog.parquet(spark, sf_dir, ["nation", "region"])
    found = schema_response(catalog)["object_types"]
    rows = [(c, f, next(iter(_plain_type(t["type"]).values()))) for c, o in found.items() for f, t in o["fields"].items()]
    return spark.createDataFrame(rows, "collection string, field string, type string")


def _plain_type(tree):
    return _plain_type(tree["nullable"]) if "nullable" in tree else tree


@query("""
SELECT * FROM (VALUES ('a', 'double', true), ('b', 'string', true), ('c', 'extendedJSON', false)) AS v(field, type, nullable)""")
def q_schema_of_documents(spark, sf_dir):
    """Types of sampled documents: numbers widen, what is missing is nullable, what does not go
    together becomes any value, null among them."""
    documents = [json.dumps(d) for d in ({"a": 1, "b": "x", "c": 1}, {"a": 2.5, "c": "y"}, {"a": None, "b": None, "c": True})]
    found = sample_frame("docs", spark.createDataFrame([(d,) for d in documents], "document string"))
    rows = [(f, next(iter(_plain_type(t["type"]).values())), "nullable" in t["type"]) for f, t in objects_json(found.objects)["docs"]["fields"].items()]
    return spark.createDataFrame(rows, "field string, type string, nullable boolean")


@query("""
SELECT * FROM (VALUES ('unknown collection', 'UnknownCollection'), ('unknown field', 'UnknownField'), ('unknown relationship', 'BadQuery'), ('unknown operator', 'BadQuery'), ('missing variable', 'MissingArgument'), ('too deep', 'ExpressionTooDeep')) AS v(request, error)""")
def q_errors(spark, sf_dir):
    """Requests that cannot be answered, and the kind of error that says so."""
    deep = col(0)
    for _ in range(600):
        deep = fn("negate", deep)
    tries = {
        "unknown collection": lambda: ask(spark, sf_dir, "nothing", G.query(fields={})),
        "unknown field": lambda: ask(spark, sf_dir, "region", G.query(fields={"x": G.field("x")})),
        "unknown relationship": lambda: ask(spark, sf_dir, "region", G.query(fields={"x": G.related_field("x", G.query())})),
        "unknown operator": lambda: ask(spark, sf_dir, "region", G.query(predicate=G.binop("_near", G.target("r_name"), G.value("x")))),
        "missing variable": lambda: ask(spark, sf_dir, "region", G.query(predicate=G.binop("_eq", G.target("r_name"), G.variable("v"))), [{}]),
        "too deep": lambda: run(spark, sf_dir, scan("region", ["r_regionkey"]).project(deep), "x"),
    }
    rows = []
    for name, attempt in tries.items():
        try:
            attempt()
        except Exception as error:
            status, body = error_response(error)
            rows.append((name, body["type"]))
    return spark.createDataFrame(rows, "request string, error string")


@query("SELECT count(*) FILTER (WHERE o_totalprice > 200000) AS n, true AS filtered, true AS explained FROM orders")
def q_explain(spark, sf_dir):
    """The plan of a request names its parts and the condition that reaches the scan."""
    dear = G.binop("_gt", G.target("o_totalprice"), G.value(200000.0))
    out = ask(spark, sf_dir, "orders", G.query(aggregates={"n": G.star_count()}, predicate=dear))
    text = out.explain()
    return out.aggregates.select("n", F.lit("GreaterThan(o_totalprice,200000.0)" in text).alias("filtered"), F.lit("== aggregates ==" in text).alias("explained"))
