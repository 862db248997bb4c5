"""The order of types, their JSON forms, sampling, and event windows."""

import datetime as dt
import decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lattica import errors as E
from lattica import types as Y
from lattica.sources import introspect as I
from lattica.streaming.events import open_stream, windowed, write_stream

scalars = st.sampled_from(sorted(Y.SCALARS)).map(Y.Scalar)
types = st.recursive(scalars, lambda inner: inner.map(Y.ListOf) | inner.map(Y.Nullable) | st.just(Y.Named("thing")), max_leaves=6).map(Y.normalise)


@given(types, types)
def test_commutative(a, b):
    assert Y.unify(a, b) == Y.unify(b, a)


@given(types, types, types)
@settings(max_examples=400)
def test_associative(a, b, c):
    assert Y.unify(Y.unify(a, b), c) == Y.unify(a, Y.unify(b, c))


@given(types)
def test_neutral_idempotent_and_absorbing(t):
    assert Y.unify(t, Y.BOTTOM) == t == Y.unify(t, t)
    assert Y.unify(t, Y.TOP) == Y.TOP
    assert Y.type_from(Y.type_json(t)) == t
    assert Y.normalise(Y.Nullable(Y.Nullable(t))) == Y.normalise(Y.Nullable(t))


@pytest.mark.parametrize(("a", "b", "above"), [("int", "double", "double"), ("uuid", "binData", "binData"), ("int", "long", "extendedJSON"), ("string", "int", "extendedJSON")])
def test_scalar_order(a, b, above):
    assert Y.unify(Y.Scalar(a), Y.Scalar(b)) == Y.Scalar(above)


values = {
    "int": st.integers(-(2**31), 2**31 - 1),
    "long": st.integers(-(2**63), 2**63 - 1),
    "double": st.floats(allow_nan=False, allow_infinity=False),
    "decimal": st.decimals(allow_nan=False, allow_infinity=False, places=3, min_value=-(10**9), max_value=10**9),
    "string": st.text(),
    "bool": st.booleans(),
    "date": st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1)).map(lambda d: d.replace(microsecond=d.microsecond // 1000 * 1000, tzinfo=dt.UTC)),
    "objectId": st.text(alphabet="0123456789abcdef", min_size=24, max_size=24),
    "uuid": st.uuids().map(str),
}


@given(st.sampled_from(sorted(values)).flatmap(lambda n: st.tuples(st.just(n), values[n])))
def test_json_round_trip(pair):
    name, value = pair
    objects = {"o": Y.ObjectType({"a": Y.ListOf(Y.Scalar(name)), "b": Y.Nullable(Y.Scalar(name))})}
    document = {"a": [value, value], "b": None}
    assert Y.from_json(Y.to_json(document, Y.Named("o"), objects), Y.Named("o"), objects) == document


@given(st.recursive(st.none() | st.booleans() | st.integers(-(2**63), 2**63 - 1) | st.floats(allow_nan=False) | st.text(max_size=5) | st.binary(max_size=4), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet="abc", min_size=1, max_size=3), x, max_size=3), max_leaves=8))
def test_extended_json_round_trip(value):
    assert Y.untagged(Y.tagged(value, relaxed=False)) == value


def test_mismatches():
    for value, kind in (("x", "int"), (True, "int"), (1.5, "long"), (3, "string")):
        with pytest.raises(E.ResponseMismatch):
            Y.to_json(value, Y.Scalar(kind), {})
    for value, kind in (("x", "int"), (2**40, "int"), ("zz", "objectId"), (5, "string"), ("no", "uuid"), ("x", "decimal")):
        with pytest.raises(E.InvalidArgument):
            Y.from_json(value, Y.Scalar(kind), {})
    assert Y.to_json(decimal.Decimal("1.50"), Y.Scalar("decimal"), {}) == "1.50" and Y.to_json(float("inf"), Y.Scalar("double"), {}) is None


def test_sampling():
    found = I.sample_documents("c", [{"_id": {"$oid": "0" * 24}, "a": 1, "n": {"x": "s"}}, {"_id": {"$oid": "1" * 24}, "a": 1.5, "l": [1, "x"], "n": {"y": None}}])
    own = found.objects["c"].fields
    assert own["_id"] == Y.Scalar("objectId") and own["a"] == Y.Nullable(Y.Scalar("double")) and own["l"] == Y.Nullable(Y.ListOf(Y.TOP))
    assert found.objects["c_n"].fields == {"x": Y.Nullable(Y.Scalar("string")), "y": Y.Scalar("null")}
    strict = I.sample_documents("c", [{"a": 1, "b": 2}, {"a": 3}], all_nullable=False)
    assert strict.objects["c"].fields == {"a": Y.Scalar("int"), "b": Y.Nullable(Y.Scalar("int"))}
    assert I.sample_documents("c", []) is None


def test_json_column_is_sampled(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": "x", "b": [true]}',), (None,)], "document string")
    own = I.sample_frame("j", df).objects["j"].fields
    assert own == {"a": Y.TOP, "b": Y.Nullable(Y.ListOf(Y.Scalar("bool")))}


def test_schemas_only_grow():
    old = I.CollectionSchema("c", "Custom", {"Custom": Y.ObjectType({"a": Y.Scalar("int"), "gone": Y.Scalar("string")})})
    new = I.CollectionSchema("c", "c", {"c": Y.ObjectType({"a": Y.Scalar("string"), "n": Y.Named("c_n")}), "c_n": Y.ObjectType({"x": Y.Scalar("int")})})
    out = I.keep_compatible(old, new)
    assert out.objects["Custom"].fields == {"a": Y.Scalar("int"), "gone": Y.Scalar("string"), "n": Y.Named("c_n")} and "c_n" in out.objects
    assert I.schema_from(I.schema_json(out))[0].objects == out.objects


def test_validators():
    found = I.from_validator("c", {"$jsonSchema": {"bsonType": "object", "required": ["a"], "properties": {"a": {"bsonType": "int"}, "b": {"bsonType": "object"}, "l": {"bsonType": "array", "items": {"bsonType": "string"}}, "o": {"bsonType": "object", "properties": {"x": {"bsonType": ["double", "null"]}}}}}})
    own = found.objects["c"].fields
    assert own == {"_id": Y.Scalar("objectId"), "a": Y.Scalar("int"), "b": Y.TOP, "l": Y.Nullable(Y.ListOf(Y.Scalar("string"))), "o": Y.Nullable(Y.Named("c_o"))}
    assert found.objects["c_o"].fields == {"x": Y.Nullable(Y.Scalar("double"))}


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.orderBy("ts").repartitionByRange(3, "ts").write.parquet(f"{tmp_path}/in")
    counts = [F.count(F.lit(1)).alias("n")]
    batch = windowed(events, "ts", ["event_type"], counts, "1 day")
    stream = windowed(open_stream(spark, f"{tmp_path}/in", events), "ts", ["event_type"], counts, "1 day", late="40 days")
    query = write_stream(stream, f"{tmp_path}/out", f"{tmp_path}/mark")
    query.awaitTermination()
    closed = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    assert set(map(tuple, closed.collect())) <= set(map(tuple, batch.collect()))
