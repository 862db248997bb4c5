"""Document queries, pipelines, mutations and configuration over literal collections."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica import errors as E
from lattica.operators.graph import compile_request, execute_request
from lattica.operators.mutation import VersionedTable, run_mutations
from lattica.operators.pipeline import Pipeline, pipeline_view
from lattica.plans import graph as G
from lattica.plans.templates import interpolate, placeholders
from lattica.sources import config
from lattica.sources.catalog import Catalog
from lattica.sources.schema import capabilities, schema_response
from lattica.types import ListOf, Nullable, Scalar


@pytest.fixture(scope="module")
def catalog(spark):
    c = Catalog(spark)
    crew = "array<struct<name:string>>"
    c.add("boats", spark.createDataFrame([(1, "Heron", [("Ida",), ("Tom",)]), (2, "Plover", [("Mae",)]), (3, "Curlew", [("Ann",), ("Ida",), ("Uwe",)]), (4, "Idle", []), (5, "Sunk", None)], f"_id int, boat string, crew {crew}"))
    c.add("odd", spark.createDataFrame([(1, ("s1",)), (2, (None,)), (3, None)], "_id int, configuration struct<`$schema`:string>"))
    c.add("authors", spark.createDataFrame([(1, "Ann", ("X", [[("t1", 1)], [("t2", 2), ("t3", 3)]])), (2, "Bob", None)], "_id int, name string, info struct<city:string, articles:array<array<struct<title:string, n:int>>>>"))
    c.add("routes", spark.createDataFrame([(1, "Coast", (70, 71)), (2, "Hills", (71, 99))], "_id int, name string, ends struct<first:int, last:int>"))
    c.add("ports", spark.createDataFrame([(70, "Quay"), (71, "Pier")], "_id int, label string"))
    c.add("numbers", spark.createDataFrame([(1, 1.5, None), (2, None, 7), (3, 2.5, 7)], "_id int, x double, y int"))
    c.add("tags", spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "_id int, tags array<string>"))
    return c


def ask(catalog, collection, query, **more):
    return execute_request(G.request(collection, query, **more), catalog)


def ids(catalog, collection, predicate):
    (out,) = ask(catalog, collection, G.query(fields={"i": G.field("_id")}, predicate=predicate, order_by=[G.order("_id")]))
    return [r["i"] for r in out["rows"]]


def test_any_element(catalog):
    name = G.binop("_eq", G.target("crew", "name"), G.value("Ida"))
    assert ids(catalog, "boats", name) == [1, 3]
    assert ids(catalog, "boats", G.not_(name)) == [2, 4, 5]
    assert ids(catalog, "boats", G.exists(G.nested("crew"), G.binop("_regex", G.target("name"), G.value("^A")))) == [3]
    assert ids(catalog, "boats", G.exists(G.nested("crew"))) == [1, 2, 3]
    assert ids(catalog, "boats", G.binop("_in", G.target("crew", "name"), G.value(["Mae", "Uwe"]))) == [2, 3]
    assert ids(catalog, "tags", G.array_contains(G.target("tags"), G.value("b"))) == [1]
    assert ids(catalog, "tags", G.array_is_empty(G.target("tags"))) == [2]
    assert ids(catalog, "tags", G.exists(G.nested_scalars("tags"), G.binop("_eq", G.target("__value"), G.value("a")))) == [1]


def test_null_rules(catalog):
    assert ids(catalog, "numbers", G.is_null(G.target("x"))) == [2]
    assert ids(catalog, "numbers", G.binop("_lt", G.target("x"), G.value(99))) == [1, 3]
    assert ids(catalog, "numbers", G.binop("_neq", G.target("x"), G.value(1.5))) == [2, 3]
    assert ids(catalog, "numbers", G.and_()) == [1, 2, 3] and ids(catalog, "numbers", G.or_()) == []


def test_names_with_dollar(catalog):
    q = G.query(fields={"c": G.field("configuration", G.nested_object(s=G.field("$schema")))}, order_by=[G.order("_id")])
    assert [r["c"] for r in ask(catalog, "odd", q)[0]["rows"]] == [{"s": "s1"}, {"s": None}, None]


def test_nested_arrays_keep_their_depth(catalog):
    picked = G.nested_object(titles=G.field("articles", G.nested_array(G.nested_array(G.nested_object(t=G.field("title"))))))
    (out,) = ask(catalog, "authors", G.query(fields={"info": G.field("info", picked)}, order_by=[G.order("_id")]))
    assert out["rows"] == [{"info": {"titles": [[{"t": "t1"}], [{"t": "t2"}, {"t": "t3"}]]}}, {"info": None}]


def test_relationship_on_nested_key(catalog):
    rel = {"last": G.relationship("ports", {"ends.last": "_id"}, "object")}
    q = G.query(fields={"name": G.field("name"), "last": G.related_field("last", G.query(fields={"l": G.field("label")}))}, order_by=[G.order("_id")])
    (out,) = ask(catalog, "routes", q, relationships=rel)
    assert out["rows"] == [{"name": "Coast", "last": {"rows": [{"l": "Pier"}]}}, {"name": "Hills", "last": {"rows": []}}]


def test_exists_sees_the_rows_around_it(spark):
    c = Catalog(spark)
    c.add("up", spark.createDataFrame([(1, 10), (2, 20), (3, None), (3, None)], "k int, v int"))
    c.add("down", spark.createDataFrame([(1, 10, 5), (2, 99, 5), (3, None, 6), (3, 7, 6)], "k int, v int, w int"))
    rel = {"down": G.relationship("down", {"k": "k"}), "same": G.relationship("down", {"w": "w"})}
    same = G.binop("_eq", G.target("v"), G.column_value("v", scope=1))
    found = lambda p: sorted(r["k"] for r in ask(c, "up", G.query(fields={"k": G.field("k")}, predicate=p), relationships=rel)[0]["rows"])
    assert found(G.exists(G.related("down"), same)) == [1, 3, 3]
    assert found(G.not_(G.exists(G.related("down"), same))) == [2]
    assert found(G.exists(G.related("down"), G.not_(same))) == [2, 3, 3]
    # two steps out: some row with the same w has the first row's v
    twice = G.exists(G.related("same"), G.binop("_eq", G.target("v"), G.column_value("v", scope=2)))
    assert found(G.exists(G.related("down"), twice)) == [1, 3, 3]
    with pytest.raises(E.NotSupported):
        found(G.exists(G.unrelated("down"), same))
    with pytest.raises(E.BadQuery):
        found(G.binop("_eq", G.target("v"), G.column_value("v", scope=1)))


def test_shared_rows_are_released(catalog):
    q = G.query(fields={"i": G.field("_id")}, aggregates={"n": G.star_count()}, order_by=[G.order("_id")], limit=2)
    out = compile_request(G.request("numbers", q), catalog)
    assert out.shared.is_cached and out.rows.count() == 2
    shared = out.shared
    out.release()
    assert not shared.is_cached and out.shared is None and out.rows.count() == 2


def test_arrays_of_all_rows_are_checked(catalog, monkeypatch):
    from lattica.operators import pipeline

    stages = [{"$lookup": {"from": "tags", "pipeline": [{"$project": {"tags": 1}}], "as": "all"}}]
    assert all(len(r["all"]) == 3 for r in run(catalog, "numbers", *stages))
    monkeypatch.setattr(pipeline, "ARRAY_BYTES", 10)
    for s in (stages, [{"$facet": {"a": []}}]):
        with pytest.raises(E.NotSupported):
            run(catalog, "numbers", *s)


def test_stages_of_a_lookup_run_per_key(spark):
    catalog = Catalog(spark)
    parents = [(1, "a", 3), (2, "b", 0), (3, None, 1), (4, "a", 4), (5, "c", 0)]
    children = [(i, "ab"[i % 2] if i % 5 else None, (i * 7) % 6) for i in range(40)]
    catalog.add("parents", spark.createDataFrame(parents, "_id int, k string, least int"))
    catalog.add("children", spark.createDataFrame(children, "_id int, k string, v int").repartition(5))

    def looked(*stages, **more):
        body = {"from": "children", "as": "found", "pipeline": list(stages)} | (more or {"localField": "k", "foreignField": "k"})
        return {r["_id"]: r["found"] for r in run(catalog, "parents", {"$lookup": body})}

    own = lambda k: [c for c in children if c[1] == k]
    order = lambda c: (-c[2], c[0])
    top = looked({"$sort": {"v": -1, "_id": 1}}, {"$skip": 1}, {"$limit": 3}, {"$project": {"_id": 1}})
    assert top == {i: [{"_id": c[0]} for c in sorted(own(k), key=order)[1:4]] for i, k, _ in parents}
    assert looked({"$match": {"v": {"$gt": 2}}}, {"$count": "n"}) == {i: [{"n": n}] if (n := sum(c[2] > 2 for c in own(k))) else [] for i, k, _ in parents}
    first = looked({"$sort": {"v": 1, "_id": 1}}, {"$group": {"_id": None, "first": {"$first": "$_id"}, "sum": {"$sum": "$v"}}})
    assert first == {i: [{"_id": None, "first": min(own(k), key=lambda c: (c[2], c[0]))[0], "sum": sum(c[2] for c in own(k))}] if own(k) else [] for i, k, _ in parents}
    counted = looked({"$sortByCount": "$v"}, {"$limit": 1}, {"$project": {"count": 1, "_id": 0}})
    assert counted[2] == [{"count": max(sum(c[2] == v for c in own("b")) for v in range(6))}]
    above = looked(
        {"$match": {"$expr": {"$and": [{"$eq": ["$k", "$$k"]}, {"$gt": ["$v", "$$least"]}]}}},
        {"$sort": {"_id": 1}},
        {"$project": {"_id": 1, "over": {"$subtract": ["$v", "$$least"]}}},
        let={"k": "$k", "least": "$least"},
    )
    assert above == {i: [{"_id": c[0], "over": c[2] - least} for c in own(k) if c[2] > least] for i, k, least in parents}
    for stage in ({"$sample": {"size": 1}}, {"$unionWith": "parents"}):
        with pytest.raises(E.NotSupported):
            looked(stage)


def test_first_and_last_follow_the_sort(spark):
    df = spark.createDataFrame([(i % 7, (i * 37) % 500, None if i % 90 == 0 else f"v{i}") for i in range(500)], "g int, o int, v string").repartition(9)
    for way in (1, -1):
        out = Pipeline(Catalog(spark)).run([{"$sort": {"o": way}}, {"$group": {"_id": "$g", "a": {"$first": "$v"}, "z": {"$last": "$v"}, "s": {"$addToSet": "$v"}}}], df.repartition(5, "v")).collect()
        rows = sorted(((i * 37) % 500 * way, i) for i in range(500))
        for r in out:
            own = [None if i % 90 == 0 else f"v{i}" for _, i in rows if i % 7 == r["_id"]]
            assert (r["a"], r["z"]) == (own[0], own[-1]) and len(r["s"]) == len(set(own))


def test_documents_are_sampled_from_the_whole_table(spark):
    from lattica.sources.introspect import sample_frame

    rows = spark.range(2000).selectExpr("concat('{\"a\": ', id, if(id >= 1000, ', \"late\": true}', '}')) AS document")
    assert "late" in sample_frame("docs", rows, 50).objects["docs"].fields


def test_facets_share_the_limited_rows(catalog):
    q = G.query(fields={"i": G.field("_id")}, aggregates={"n": G.star_count(), "s": G.column_aggregate("sum", "x"), "d": G.column_count("y", distinct=True)}, groups=G.groups([G.dimension("y")], {"n": G.star_count()}, [G.dimension_order(0)]), order_by=[G.order("_id", descending=True)], limit=2)
    (out,) = ask(catalog, "numbers", q)
    assert out == {"rows": [{"i": 3}, {"i": 2}], "aggregates": {"n": "2", "s": 2.5, "d": "1"}, "groups": [{"dimensions": [7], "aggregates": {"n": "2"}}]}


def test_empty_sets(catalog):
    q = G.query(aggregates={"n": G.star_count(), "m": G.column_aggregate("max", "x")}, predicate=G.binop("_gt", G.target("_id"), G.value(99)))
    assert ask(catalog, "numbers", q) == [{"aggregates": {"n": "0", "m": None}}]


def test_variable_sets(catalog):
    q = G.query(fields={"i": G.field("_id")}, aggregates={"n": G.star_count()}, predicate=G.binop("_eq", G.target("y"), G.variable("v")), order_by=[G.order("_id")])
    out = ask(catalog, "numbers", q, variables=[{"v": 7}, {"v": 1}, {"v": None}])
    assert out == [{"rows": [{"i": 2}, {"i": 3}], "aggregates": {"n": "2"}}, {"rows": [], "aggregates": {"n": "0"}}, {"rows": [{"i": 1}], "aggregates": {"n": "1"}}]
    with pytest.raises(E.MissingArgument):
        ask(catalog, "numbers", q, variables=[{"w": 1}])


def test_request_errors(catalog):
    for query, error in ((G.query(fields={"a": G.field("nope")}), E.UnknownField), (G.query(fields={"a": G.related_field("nope", G.query())}), E.BadQuery), (G.query(predicate=G.binop("_near", G.target("x"), G.value(1))), E.BadQuery), (G.query(fields={"a": G.field("x", arguments={"k": 1})}), E.UnknownArgument)):
        with pytest.raises(error):
            compile_request(G.request("numbers", query), catalog)


def test_explain(catalog):
    assert "== rows ==" in compile_request(G.request("numbers", G.query(fields={"i": G.field("_id")})), catalog).explain()


# -- pipelines ---------------------------------------------------------------------------


def run(catalog, collection, *stages):
    return [r.asDict(recursive=True) for r in Pipeline(catalog).run(list(stages), catalog.open(collection)).collect()]


@pytest.mark.parametrize(
    ("match", "expected"),
    [
        ({"x": {"$gt": 1, "$lte": 2}}, [1]),
        ({"x": None}, [2]),
        ({"x": {"$exists": True}, "y": {"$ne": 7}}, [1]),
        ({"y": {"$in": [7, 8]}}, [2, 3]),
        ({"y": {"$nin": [7]}}, [1]),
        ({"y": {"$not": {"$eq": 7}}}, [1]),
        ({"$and": [{"_id": {"$gte": 2}}, {"$or": [{"x": 2.5}, {"y": None}]}]}, [3]),
        ({"x": {"$type": "double"}}, [1, 3]),
        ({"x": {"$type": "string"}}, []),
        ({"$expr": {"$gt": ["$_id", {"$add": [1, 1]}]}}, [3]),
        ({"missing": 1}, []),
    ],
)
def test_match(catalog, match, expected):
    assert [r["_id"] for r in run(catalog, "numbers", {"$match": match}, {"$sort": {"_id": 1}})] == expected


@pytest.mark.parametrize(("match", "expected"), [({"tags": "a"}, [1]), ({"tags": {"$size": 2}}, [1]), ({"tags": {"$all": ["a", "b"]}}, [1]), ({"tags": {"$elemMatch": {"$eq": "b"}}}, [1]), ({"tags": {"$regex": "^B", "$options": "i"}}, [1]), ({"tags": []}, [2])])
def test_match_arrays(catalog, match, expected):
    assert [r["_id"] for r in run(catalog, "tags", {"$match": match})] == expected


def test_element_match_on_objects(catalog):
    assert [r["_id"] for r in run(catalog, "boats", {"$match": {"crew": {"$elemMatch": {"name": {"$regex": "^T"}}}}})] == [1]


def test_stages(catalog):
    assert run(catalog, "numbers", {"$sort": {"_id": -1}}, {"$skip": 1}, {"$limit": 1}, {"$project": {"x": 1}}) == [{"_id": 2, "x": None}]
    assert run(catalog, "routes", {"$project": {"_id": 0, "a.b": "$ends.last"}}, {"$sort": {"a.b": 1}}) == [{"a": {"b": 71}}, {"a": {"b": 99}}]
    assert run(catalog, "routes", {"$project": {"ends.last": False, "_id": 0}}, {"$limit": 1})[0] == {"name": "Coast", "ends": {"first": 70}}
    assert run(catalog, "routes", {"$addFields": {"ends.via": 5, "n": "$name"}}, {"$match": {"_id": 1}}) == [{"_id": 1, "name": "Coast", "ends": {"first": 70, "last": 71, "via": 5}, "n": "Coast"}]
    assert run(catalog, "tags", {"$unwind": "$tags"}, {"$count": "n"}) == [{"n": 2}]
    kept = run(catalog, "tags", {"$unwind": {"path": "$tags", "preserveNullAndEmptyArrays": True, "includeArrayIndex": "at"}}, {"$sort": {"_id": 1, "at": 1}})
    assert kept == [{"_id": 1, "tags": "a", "at": 0}, {"_id": 1, "tags": "b", "at": 1}, {"_id": 2, "tags": None, "at": None}, {"_id": 3, "tags": None, "at": None}]
    assert run(catalog, "numbers", {"$unwind": "$y"}, {"$count": "n"}) == [{"n": 2}]
    assert run(catalog, "routes", {"$replaceRoot": {"newRoot": "$ends"}}, {"$sort": {"last": 1}}) == [{"first": 70, "last": 71}, {"first": 71, "last": 99}]
    assert run(catalog, "numbers", {"$match": {"_id": 0}}, {"$count": "n"}) == []
    assert run(catalog, "numbers", {"$match": {"_id": 0}}, {"$group": {"_id": None, "n": {"$sum": 1}}}) == []
    grouped = run(catalog, "numbers", {"$sort": {"_id": 1}}, {"$group": {"_id": "$y", "all": {"$push": "$x"}, "set": {"$addToSet": "$y"}, "n": {"$count": {}}}}, {"$sort": {"_id": 1}})
    assert grouped == [{"_id": None, "all": [1.5], "set": [None], "n": 1}, {"_id": 7, "all": [None, 2.5], "set": [7], "n": 2}]
    looked = run(catalog, "routes", {"$lookup": {"from": "ports", "localField": "ends.last", "foreignField": "_id", "as": "m"}}, {"$sort": {"_id": 1}}, {"$project": {"m": 1}})
    assert looked == [{"_id": 1, "m": [{"_id": 71, "label": "Pier"}]}, {"_id": 2, "m": []}]
    both = run(catalog, "numbers", {"$facet": {"a": [{"$match": {"y": 7}}, {"$count": "n"}], "b": [{"$match": {"_id": 9}}, {"$project": {"x": 1}}]}})
    assert both == [{"a": [{"n": 2}], "b": []}]


def test_mixed_projection_is_an_error(catalog):
    with pytest.raises(E.BadQuery):
        run(catalog, "numbers", {"$project": {"x": 1, "y": 0}})
    with pytest.raises(E.NotSupported):
        run(catalog, "numbers", {"$teleport": {}})


def test_templates():
    tree = {"$match": {"{{ key }}": "{{ v }}", "text": "a {{ s | string }} b"}}
    assert placeholders(tree) == {"key", "v", "s"}
    assert interpolate(tree, {"key": "k", "v": [1], "s": "x"}) == {"$match": {"k": [1], "text": "a x b"}}
    with pytest.raises(E.InvalidArgument):
        interpolate("a {{ v }}", {"v": 3})
    with pytest.raises(E.MissingArgument):
        interpolate("{{ v }}", {})


def test_view_with_a_condition(catalog):
    catalog.add_view(pipeline_view("where", [{"$match": "{{ condition }}"}], {"condition": None}, "numbers"))
    assert catalog.open("where", {"condition": F.col("x") > 2}).count() == 1


# -- mutations and configuration ----------------------------------------------------------------


def test_mutations(spark, tmp_path):
    c = Catalog(spark)
    table = VersionedTable(c, "Stock", f"{tmp_path}/stock", spark.createDataFrame([(1, "A", 1.0), (2, "B", 2.0)], "id int, name string, price double"))
    known = {m.name: m for m in (config.mutation_from({"command": {"insert": "Stock", "documents": [{"id": "{{ id }}", "name": "{{ name }}"}]}, "arguments": {"id": {"type": {"scalar": "int"}}, "name": {"type": {"scalar": "string"}}}}, "add"), config.mutation_from({"command": {"update": "Stock", "updates": [{"q": {"id": {"$lte": 2}}, "u": {"$set": {"price": "{{ p }}"}, "$inc": {"id": 10}}, "multi": True}]}, "arguments": {"p": {"type": {"scalar": "double"}}}}, "raise"), config.mutation_from({"command": {"delete": "Stock", "deletes": [{"q": {"name": "A"}, "limit": 0}]}}, "drop"))}
    assert run_mutations({"Stock": table}, c, known, [("add", {"id": 3, "name": "C"})], {"count": "n"}) == [{"count": 1}]
    assert run_mutations({"Stock": table}, c, known, [("raise", {"p": 9.5})]) == [{"ok": 1.0, "n": 2}]
    assert run_mutations({"Stock": table}, c, known, [("drop", {})])[0]["n"] == 1
    assert sorted(map(tuple, c.open("Stock").collect())) == [(3, "C", None), (12, "B", 9.5)]
    for name, arguments, error in (("nope", {}, E.BadQuery), ("add", {"id": 1}, E.MissingArgument), ("drop", {"x": 1}, E.UnknownArgument)):
        with pytest.raises(error):
            run_mutations({"Stock": table}, c, known, [(name, arguments)])


def test_configuration_directory(spark, catalog, tmp_path):
    (tmp_path / "schema").mkdir()
    (tmp_path / "configuration.json").write_text(json.dumps({"introspectionOptions": {"sampleSize": 50}}))
    written, skipped = config.update_schemas(tmp_path, {"numbers": catalog.open("numbers"), "none": catalog.open("numbers").limit(0), "system.views": None})
    assert written == ["numbers"] and skipped == {"none": "empty", "system.views": "reserved for the system"}
    c = Catalog(spark, {"numbers": catalog.open("numbers")})
    config.create_view(tmp_path, c, "least", [{"$match": {"x": {"$gte": "{{ v }}"}}}, {"$project": {"x": 1, "w": {"$multiply": ["$x", 2]}}}], {"v": Scalar("double")}, "numbers")
    found = config.read_configuration(tmp_path)
    assert found.options["introspectionOptions"]["sampleSize"] == 50 and found.options["serializationOptions"]["onResponseTypeMismatch"] == "fail"
    assert set(found.objects["least"].fields) == {"_id", "x", "w"} and found.objects["numbers"].fields["x"] == Nullable(Scalar("double"))
    fresh = Catalog(spark, {"numbers": catalog.open("numbers")})
    found.register(fresh)
    assert fresh.open("least", {"v": 2.0}).collect()[0]["w"] == 5.0
    with pytest.raises(E.SchemaError):
        config.create_view(tmp_path, c, "least", [], {}, "numbers")
    config.delete_view(tmp_path, c, "least")
    assert config.read_configuration(tmp_path).views == {}
    with pytest.raises(E.SchemaError):
        config.options_from({"introspectionOptions": {"size": 1}})
    assert config.view_from({"pipeline": [], "arguments": {"a": {"type": {"arrayOf": {"scalar": "int"}}}}}, "v").arguments == {"a": ListOf(Scalar("int"))}


def test_schema_and_capabilities(catalog):
    found = schema_response(catalog)
    assert "_regex" in found["scalar_types"]["string"]["comparison_operators"]
    assert found["object_types"]["routes"]["fields"]["ends"] == {"type": {"nullable": {"object": "routes_ends"}}}
    flat = schema_response(catalog, relational=True)
    assert flat["object_types"]["routes"]["fields"]["ends"]["type"] == {"scalar": "extendedJSON"}
    assert capabilities()["relational_query"]["join"]["right_semi"] == {}


def test_view_types(spark):
    c = Catalog(spark)
    v = pipeline_view("one", [{"$documents": [{"__value": "{{ n }}"}]}], {"n": T.IntegerType()}, kind="function")
    c.add_view(v)
    assert c.call("one", {"n": 4}).collect()[0][0] == 4
    with pytest.raises(E.InvalidArgument):
        c.call("one", {"n": 2**40})


def test_conditions_reach_the_scan(spark, sf_dir):
    c = Catalog.parquet(spark, sf_dir, ["orders"])
    predicate = G.and_(G.binop("_gt", G.target("o_totalprice"), G.value(10.0)), G.or_(G.binop("_eq", G.target("o_orderstatus"), G.value("F")), G.binop("_in", G.target("o_custkey"), G.value([1, 2]))))
    text = compile_request(G.request("orders", G.query(fields={"k": G.field("o_orderkey")}, predicate=predicate)), c).explain()
    assert "GreaterThan(o_totalprice,10.0)" in text and "Or(EqualTo(o_orderstatus,F),In(o_custkey, [1,2]))" in text
    view = Pipeline(c).run([{"$match": {"o_totalprice": {"$lt": 5.0}, "o_orderstatus": "F"}}], c.open("orders"))
    text = view._jdf.queryExecution().explainString(view._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "LessThan(o_totalprice,5.0)" in text and "EqualTo(o_orderstatus,F)" in text


def test_view_arguments_from_variables(spark, catalog):
    catalog.add_view(pipeline_view("from_x", [{"$match": {"x": {"$gte": "{{ v }}"}}}], {"v": T.DoubleType()}, "numbers"))
    q = G.query(fields={"i": G.field("_id")}, aggregates={"n": G.star_count()}, order_by=[G.order("_id")])
    out = ask(catalog, "from_x", q, arguments={"v": G.variable("least")}, variables=[{"least": 2.0}, {"least": 1.0}, {"least": 9.0}, {"least": 2.0}])
    assert [[r["i"] for r in o["rows"]] for o in out] == [[3], [1, 3], [], [3]] and [o["aggregates"]["n"] for o in out] == ["1", "2", "0", "1"]


def test_rows_that_do_not_match_their_type(catalog):
    request = G.request("numbers", G.query(fields={"x": G.field("x")}, aggregates={"n": G.star_count()}))
    with pytest.raises(E.ResponseMismatch):
        execute_request(request, catalog, {"x": Scalar("double")})
    (out,) = execute_request(request, catalog, {"x": Scalar("double")}, on_mismatch="skipRow")
    assert len(out["rows"]) == 2 and out["aggregates"] == {"n": "3"}


def test_search_reads_every_path(spark):
    df = spark.createDataFrame([(1, "red fox", "blue"), (2, None, "a Fox, a fox"), (3, "fox", "fox"), (4, "none", None)], "k int, a string, b string")
    pipeline = Pipeline(Catalog(spark))
    text = lambda path: {"text": {"query": "fox", "path": path}}
    found = lambda path: {r["k"]: r["searchScore"] for r in pipeline.run([{"$search": text(path)}], df).collect()}
    assert found(["a", "b"]) == found(["b", "a", "b"]) == {1: 1, 2: 2, 3: 2}
    assert found("a") == found(["a"]) == {1: 1, 3: 1}
    assert pipeline.run([{"$searchMeta": text(["a", "b"])}], df).first()["count"] == 3
