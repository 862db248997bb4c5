"""Relations over literal tables: nulls, orphans, errors, plans."""

import decimal

import pytest
from pyspark.sql import types as T

from lattica import errors as E
from lattica.functions.context import Options
from lattica.operators.relational import compile_relation
from lattica.plans import relational as R
from lattica.plans.relational import SortKey, asc, call, col, desc, eq, gt, lit, lt, not_eq, scan
from lattica.sources.catalog import Catalog, View
from lattica.streaming.rows import buffered, streamed


@pytest.fixture(scope="module")
def catalog(spark):
    c = Catalog(spark)
    c.add("products", spark.createDataFrame([(1, "Widget", 10.0, "A", 30), (2, "Gadget", 25.0, "A", 25), (3, "Gizmo", 15.0, "B", 40), (4, "Thing", 30.0, "B", 0), (5, "Item", None, "C", 10)], "_id int, name string, price double, category string, stock int"))
    c.add("orders", spark.createDataFrame([(1, 1, 2), (2, 2, 4), (3, 3, 3), (4, 4, 1), (5, 99, 5)], "_id int, product_id int, quantity int"))
    c.add("categories", spark.createDataFrame([("A", "Category A", True), ("B", "Category B", True), ("C", "Category C", False)], "_id string, name string, active boolean"))
    c.add("values", spark.createDataFrame([(1, None), (None, 2), (None, None), (3, 3)], "a int, b int"))
    c.add("dollar", spark.createDataFrame([(1, 2)], "`$odd.name` int, `b` int"))
    return c


PRODUCTS = scan("products", ["_id", "name", "price", "category", "stock"])
ORDERS = scan("orders", ["_id", "product_id", "quantity"])
VALUES = scan("values", ["a", "b"])


def rows(catalog, r, **options):
    return [tuple(x) for x in compile_relation(r, catalog, Options(**options)).collect()]


def one(catalog, e, **options):
    (row,) = rows(catalog, scan("categories", ["_id"]).paginate(1).project(e), **options)
    return row[0]


def test_counts_and_groups(catalog):
    assert rows(catalog, PRODUCTS.aggregate([], [call("count")])) == [(5,)]
    assert rows(catalog, PRODUCTS.aggregate([], [call("count", lit(None)), call("count", col(2))])) == [(5, 4)]
    assert len(rows(catalog, PRODUCTS.aggregate([col(3)], [call("sum", col(2))]))) == 3
    assert (None, "C") not in rows(catalog, PRODUCTS.aggregate([col(3)], [call("sum", col(2))]))


def test_joins_keep_orphans(catalog):
    joined = ORDERS.join(PRODUCTS, [(col(1), col(0))], "left")
    assert len(rows(catalog, joined)) == 5
    assert rows(catalog, joined.filter(call("is_null", col(3))).project(col(0), col(4))) == [(5, None)]
    assert rows(catalog, ORDERS.join(PRODUCTS, [(col(1), col(0))], "left_anti").project(col(0))) == [(5,)]
    assert rows(catalog, ORDERS.join(PRODUCTS, [(col(1), col(0))], "right_anti").project(col(1))) == [("Item",)]
    assert len(rows(catalog, ORDERS.join(PRODUCTS, [(col(1), col(0))], "right_semi"))) == 4
    assert len(rows(catalog, ORDERS.join(PRODUCTS, [(col(1), col(0))], "full"))) == 6
    assert len(rows(catalog, ORDERS.join(PRODUCTS))) == 25


def test_null_keys_join(catalog):
    pairs = VALUES.join(VALUES, [(col(0), col(0))])
    assert len(rows(catalog, pairs)) == 1 + 4 + 1
    assert len(rows(catalog, pairs, ansi_nulls=True)) == 2


def test_computed_join_and_filter(catalog):
    r = ORDERS.join(PRODUCTS, [(col(1), col(0))]).join(scan("categories", ["_id", "name", "active"]), [(col(6), col(0))])
    r = r.filter(eq(col(10), True)).project(col(4), col(5) * col(2)).sort(desc(col(1))).paginate(2)
    assert rows(catalog, r) == [("Gadget", 100.0), ("Gizmo", 45.0)]


def test_comparisons_have_two_values(catalog):
    r = VALUES.project(eq(col(0), col(1)), not_eq(col(0), col(1)), lt(col(0), col(1)), ~gt(col(0), lit(1)))
    assert rows(catalog, r) == [(False, True, False, True), (False, True, False, True), (True, False, False, True), (True, False, False, False)]
    assert rows(catalog, VALUES.project(eq(col(0), col(1)), lt(col(0), col(1))), ansi_nulls=True) == [(None, None)] * 3 + [(True, False)]


def test_members(catalog):
    assert one(catalog, call("in", lit(None), [lit(None), lit(1)])) is True
    assert one(catalog, call("in", lit(None), [lit(1)])) is False
    assert one(catalog, call("not_in", lit(2), [])) is True


@pytest.mark.parametrize(
    ("e", "expected"),
    [
        (call("round", lit(2.5)), 2.0),
        (call("round", lit(-1.55), lit(1)), -1.6),
        (call("trunc", lit(-1.57), lit(1)), -1.5),
        (call("trunc", lit(-1.57)), -1.0),
        (call("ceil", lit(1.2)), 2.0),
        (call("log", lit(1000.0)), 3.0),
        (call("log", lit(8.0), lit(2.0)), 3.0),
        (call("modulo", lit(-7), lit(3)), -1),
        (call("greatest", lit(None), lit(3)), 3),
        (call("b_trim", lit(" \t x\n")), "x"),
        (call("b_trim", lit("xxaxx"), "x"), "a"),
        (call("l_pad", lit("ab"), lit(7), "xyz"), "xyzxyab"),
        (call("r_pad", lit("abcdef"), lit(3)), "abc"),
        (call("substr_index", lit("a.b.c"), ".", lit(-2)), "b.c"),
        (call("right", lit("abc"), lit(9)), "abc"),
        (call("character_length", lit("é🙂")), 2),
        (call("like", lit("a%b"), r"a\%b"), True),
        (call("like", lit("axb"), r"a\%b"), False),
        (call("like", lit(None), "a"), None),
        (call("like", lit(15), "1%"), True),
        (call("contains", lit(None), "a"), False),
        (call("is_nan", lit("text")), False),
        (call("is_nan", lit(float("nan"))), True),
        (call("cast", lit("false"), {"type": "boolean"}), True),
        (call("cast", lit(0), {"type": "boolean"}), False),
        (call("try_cast", lit("x"), {"type": "int32"}), None),
        (call("cast", lit(decimal.Decimal("1.25")), {"type": "float64"}), 1.25),
        (call("json_get_int", lit('{"a":[5,6]}'), ["a", 1]), 6),
        (call("json_get_bool", lit('{"a":0}'), ["a"]), False),
        (call("json_get_bool", lit('{"a":true}'), ["a"]), True),
        (call("json_length", lit("[1,2]"), []), 2),
        (call("json_contains", lit('{"a":["x"]}'), ["a", "x"]), True),
        (call("json_get_str", lit("not json"), ["a"]), None),
        (call("json_get_str", lit('{"a":"z","k":"a"}'), [call("to_lower", lit("A"))]), "z"),
        (call("date_part", lit(90061007), part="hour"), 1),
        (call("date_part", lit(90061007), part="millisecond"), 7),
        (call("null_if", lit(1), lit(1)), None),
        (call("case", [(lit(None), "null"), (lit(1), "one")], scrutinee=lit(None)), "null"),
        (call("replace", lit("aXa"), "a", "b"), "bXb"),
    ],
)
def test_scalars(catalog, e, expected):
    assert one(catalog, e) == expected


def test_weeks_begin_on_sunday(catalog):
    sunday = call("cast", lit("2024-01-07 10:00:00"), {"type": "timestamp"})
    assert one(catalog, call("date_part", sunday, part="week")) == 1
    assert one(catalog, call("date_part", sunday, part="day_of_week")) == 1
    monday = call("cast", lit("2024-01-08 10:00:00"), {"type": "timestamp"})
    assert one(catalog, call("minus", call("date_trunc", monday, part="week"), call("date_trunc", sunday, part="day"))) == 0


def test_errors_of_values(catalog):
    from pyspark.errors import PySparkException

    for e in (call("divide", lit(1), lit(0)), call("cast", lit("x"), {"type": "int32"}), call("json_get_int", lit('{"a":"x"}'), ["a"])):
        with pytest.raises(PySparkException):
            one(catalog, e)


def test_ordered_aggregates(catalog):
    ordered = PRODUCTS.sort(desc(col(2)), asc(col(0)))
    r = ordered.aggregate([], [call("first_value", col(1)), call("last_value", col(1)), call("string_agg", col(1), ",", order_by=(asc(col(1)),)), call("array_agg", col(2), order_by=(desc(col(0)),)), call("array_agg", col(3), distinct=True, order_by=(desc(col(3)),))])
    assert rows(catalog, r) == [("Thing", "Item", "Gadget,Gizmo,Item,Thing,Widget", [None, 30.0, 15.0, 25.0, 10.0], ["C", "B", "A"])]
    names = PRODUCTS.sort(desc(col(1))).aggregate([], [call("first_value", col(1)), call("last_value", col(1))])
    assert rows(catalog, names) == [("Widget", "Gadget")]
    kept = PRODUCTS.sort(desc(col(1))).project(col(0), col(1)).filter(lt(col(0), 4)).aggregate([], [call("first_value", col(1))])
    assert rows(catalog, kept) == [("Widget",)]


def test_null_aggregates(catalog):
    none = VALUES.filter(eq(col(0), 77))
    assert rows(catalog, none.aggregate([], [call("count"), call("sum", col(0)), call("max", col(0)), call("string_agg", col(0), ",")])) == [(0, 0, None, None)]
    assert rows(catalog, none.aggregate([], [call("count")]), strict=True) == []
    assert rows(catalog, VALUES.aggregate([], [call("count", col(0), True)])) == [(2,)]
    assert rows(catalog, VALUES.aggregate([], [call("count", col(0), True)]), strict=True) == [(3,)]
    truth = VALUES.aggregate([], [call("bool_and", call("plus", col(0), lit(0))), call("bool_or", call("plus", col(0), lit(0)))])
    assert rows(catalog, truth) == [(False, True)]
    assert sorted(rows(catalog, VALUES.aggregate([col(0)], [])), key=str) == [(1,), (3,), (None,)]


@pytest.mark.parametrize(
    ("r", "error"),
    [
        (PRODUCTS.project(col(9)), E.InvalidColumnIndex),
        (scan("nothing", ["a"]), E.UnknownCollection),
        (scan("products", ["nope"]), E.UnknownField),
        (scan("products", ["_id"], size=3), E.UnknownArgument),
        (PRODUCTS.project(call("sum", col(2))), E.UnsupportedExpression),
        (PRODUCTS.aggregate([], [col(1)]), E.UnsupportedExpression),
        (PRODUCTS.join(ORDERS, [], "sideways"), E.UnsupportedJoin),
        (R.Union(()), E.InvalidUnion),
        (R.Union((PRODUCTS, ORDERS)), E.InvalidUnion),
        (PRODUCTS.paginate(-1), E.BadQuery),
        (PRODUCTS.project(call("date_part", lit("2024-01-01"), part="nanosecond")), E.UnsupportedExpression),
        (PRODUCTS.project(lit(2**63, "uint64")), E.InvalidArgument),
        (PRODUCTS.project(lit(2**62, "duration_second")), E.InvalidArgument),
    ],
)
def test_errors(catalog, r, error):
    with pytest.raises(error):
        compile_relation(r, catalog)
    assert E.error_response(error("x"))[0] == 400


def test_depth(catalog):
    e = col(0)
    for _ in range(520):
        e = call("negate", e)
    with pytest.raises(E.ExpressionTooDeep):
        compile_relation(PRODUCTS.project(e), catalog)


def test_json_trees(catalog):
    r = ORDERS.join(PRODUCTS, [(col(1), col(0))], "left").filter(call("in", col(0), [1, 2])).window(call("row_number", order_by=(asc(col(0)),), partition_by=[col(6)])).project(col(0), call("case", [(lt(col(2), 3), "few")], default=lit("many")), call("json_get", lit("{}"), ["a"])).sort(desc(col(0), nulls_first=True)).paginate(5, 0)
    tree = R.relation_json(R.Union((r.aggregate([col(0)], [call("string_agg", col(1), ",", order_by=(asc(col(1)),))]), r.project(col(0), col(1)))))
    import json

    again = R.relation_from(json.loads(json.dumps(tree)))
    assert R.relation_json(again) == tree
    assert sorted(rows(catalog, again)) == [(1, "few"), (1, "few"), (2, "many"), (2, "many")]
    with pytest.raises(E.BadQuery):
        R.relation_from({"type": "teleport"})
    with pytest.raises(E.UnsupportedExpression):
        R.expr_from({"type": "eq", "left": {"type": "column", "index": 0}})


def test_views(spark, catalog):
    catalog.add_view(View("big", lambda c, a: c.open("products").filter(f"price > {a['least']}"), {"least": T.DoubleType()}))
    catalog.add_view(View("answer", lambda c, a: c.spark.sql("select 42 as __value"), kind="function"))
    assert len(rows(catalog, scan("big", ["name"], least=12.0))) == 3
    assert catalog.call("answer", {}).collect()[0][0] == 42
    assert catalog.list_views() == ["answer", "big"] and catalog.show_view("big", least=1.0)["columns"]["price"] == "double"
    for r, error in ((scan("big", ["name"]), E.MissingArgument), (scan("big", ["name"], least=1.0, other=2), E.UnknownArgument), (scan("big", ["name"], least="1"), E.InvalidArgument), (scan("answer", ["__value"]), E.FunctionAsTable)):
        with pytest.raises(error):
            compile_relation(r, catalog)
    catalog.drop_view("big")
    with pytest.raises(E.UnknownCollection):
        catalog.drop_view("big")


def test_encoding(spark):
    import datetime as dt

    df = spark.sql("select 1 as a, 2L as b, cast('1.50' as decimal(5,2)) as c, double('nan') as d, timestamp'2024-01-02 03:04:05.678' as e, named_struct('x', 1L, 'y', array(1, null)) as f, array(date'2024-01-01') as g, X'0102' as h, cast(null as string) as i, parse_json('{\"k\":[1]}') as j")
    expected = [1, "2", "1.50", None, "2024-01-02T03:04:05.678Z", '{"x":"1","y":[1,null]}', '["2024-01-01T00:00:00.000Z"]', {"base64": "AQI=", "subType": "00"}, None, '{"k":[1]}']
    assert buffered(df) == [expected] == list(streamed(df))
    assert dt.datetime.fromisoformat(expected[4]).year == 2024


def test_odd_names(catalog):
    assert rows(catalog, scan("dollar", ["$odd.name"])) == [(1,)]


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    c = Catalog.parquet(spark, sf_dir, ["lineitem", "orders"])
    r = scan("lineitem", ["l_quantity", "l_orderkey", "l_tax"]).project(col(1), col(0)).filter(gt(col(1), 10.0))
    text = plan(compile_relation(r, c))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    top = scan("orders", ["o_orderkey", "o_totalprice"]).sort(desc(col(1))).paginate(5)
    assert "TakeOrderedAndProject" in plan(compile_relation(top, c))
    join = scan("lineitem", ["l_orderkey"]).join(scan("orders", ["o_orderkey"]), [(col(0), col(0))])
    assert "NestedLoop" not in plan(compile_relation(join, c)) and "Cartesian" not in plan(compile_relation(join, c))


def test_sketches_beside_distinct_counts(spark):
    """One sketch or list a group, not one for each value that is counted; null keys, no rows."""
    data = [(k, v, w) for k in (None, 1, 2) for v in (None, 5, 5, 7, 9) for w in (None, 1.0, 2.0, 4.0)] + [(3, None, None)]
    c = Catalog(spark, {"t": spark.createDataFrame(data, "k int, v int, w double").repartition(3)})
    t = scan("t", ["k", "v", "w"])
    kinds = [call("count", col(1), True), call("median", col(2)), call("count"), call("count", col(2), True), call("approx_percentile_cont", col(2), percentile=0.9), call("approx_distinct", col(1)), call("array_agg", col(2), distinct=True, order_by=(asc(col(2)),))]
    whole = (3, 2.0, 15 * 4 + 1, 3, 4.0, 3, [None, 1.0, 2.0, 4.0])
    own = (3, 2.0, 20, 3, 4.0, 3, [None, 1.0, 2.0, 4.0])
    grouped = compile_relation(t.aggregate([col(0)], kinds), c)
    assert grouped.columns == [f"col_{i}" for i in range(8)]
    assert sorted(map(tuple, grouped.collect()), key=str) == sorted([(None, *own), (1, *own), (2, *own), (3, 0, None, 1, 0, None, 0, [None])], key=str)
    sketched = [step for step in plan(grouped).split("\n\n") if "Keys [" in step and ("percentile" in step or "collect_set" in step)]
    assert sketched and all("Keys [1]" in step for step in sketched)
    for strict in (False, True):
        assert rows(c, t.aggregate([], kinds), strict=strict) == [(whole[0] + strict, *whole[1:3], whole[3] + strict, *whole[4:])]
        assert rows(c, t.filter(gt(col(0), 3)).aggregate([], kinds), strict=strict) == ([] if strict else [(0, None, 0, 0, None, 0, [])])
        assert rows(c, t.filter(gt(col(0), 3)).aggregate([col(0)], kinds), strict=strict) == []


def test_rows_that_may_change_are_read_once(spark):
    c = Catalog(spark, {"t": spark.range(1000).selectExpr("id % 10 AS k", "id AS v")})
    t, kinds = scan("t", ["k", "v"]), [call("count", col(1), True), call("median", col(1))]
    for r in (t.paginate(100), t.window(call("row_number", order_by=(asc(col(0)),))), t.filter(lt(call("random"), 0.5))):
        compiled = compile_relation(r.aggregate([], kinds), c)
        assert plan(compiled).count("Range (") == plan(compile_relation(r, c)).count("Range (")
        assert compiled.count() == 1
    assert rows(c, t.paginate(100).aggregate([], [call("count", col(1), True), call("array_agg", col(1))]))[0][0] == 100


def test_approximate_distinct_counts_are_within_a_tenth(spark):
    """Of groups of which sketches of 5 % miss two."""
    df = spark.range(600_000).selectExpr("id div 3000 AS k", "id AS v")
    found = rows(Catalog(spark, {"t": df}), scan("t", ["k", "v"]).aggregate([col(0)], [call("approx_distinct", col(1))]))
    assert len(found) == 200 and [r for r in found if abs(r[1] - 3000) > 300] == []


@pytest.mark.parametrize(("rows", "kind"), [(0, "int"), (1, "date"), (3, "double"), (400, "int"), (400, "double"), (400, "date"), (400, "decimal(12,2)")])
def test_ranks_by_ranges(spark, rows, kind):
    """Ties, nulls on either side, a value that half of the rows have, more tiles than rows."""
    value = "date_add(date'2020-01-01', cast({} AS int))" if kind == "date" else f"cast({{}} AS {kind})"
    x = f"CASE WHEN id % 9 = 0 THEN NULL WHEN id % 2 = 0 THEN {value.format(5)} ELSE {value.format('id * 37 % 101 - 50')} END AS x"
    df = spark.range(rows).selectExpr("id", x).repartition(3)
    catalog = Catalog(spark, {"t": df})
    for order in ((asc(col(1)), asc(col(0))), (desc(col(1)),), (SortKey(col(1), True, False),), (SortKey(col(1), False, True), desc(col(0)))):
        stable = len(order) > 1
        kinds = ["rank", "dense_rank", "percent_rank", "cume_dist", *(["row_number"] if stable else [])]
        ranks = [call(k, order_by=order) for k in kinds] + ([call("n_tile", lit(n), order_by=order) for n in (1, 7, 1000)] if stable else [])
        ranks.append(call("lag", col(0), order_by=(asc(col(0)),)))
        r = scan("t", ["id", "x"]).window(*ranks)
        plain, spread = (sorted(map(tuple, compile_relation(r, catalog, Options(spread_windows=s)).collect()), key=lambda c: c[0]) for s in (False, True))
        rounded = lambda found: [[round(v, 9) if isinstance(v, float) else v for v in c] for c in found]
        assert rounded(plain) == rounded(spread)
