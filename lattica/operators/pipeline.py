"""Document pipelines: a list of stages, each a DataFrame to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial, reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..errors import BadQuery, NotSupported
from ..functions.aggregates import descending
from ..functions.aggregation import Scope, compile_accumulator, compile_expression
from ..functions.documents import any_of, literal, quoted, resolve, test
from ..plans.templates import interpolate
from ..sources.catalog import Catalog, View

Stage = Callable[["Pipeline", DataFrame, Any], DataFrame]
STAGES: dict[str, Stage] = {}


def stage(*names: str) -> Callable[[Stage], Stage]:
    def add(f: Stage) -> Stage:
        for n in names:
            STAGES[n] = f
        return f

    return add


class Pipeline:
    """Runs stages over the collections of a catalog; ``variables`` are those of $let."""

    def __init__(self, catalog: Catalog, variables: Mapping[str, Column] | None = None):
        self.catalog, self.variables = catalog, dict(variables or {})

    def scope(self, df: DataFrame) -> Scope:
        return Scope(df.schema, self.variables)

    def run(self, stages: Sequence[Mapping[str, Any]], df: DataFrame | None = None) -> DataFrame:
        for s in stages:
            if len(s) != 1:
                raise BadQuery(f"a stage has one name: {s}")
            ((name, body),) = s.items()
            if name not in STAGES:
                raise NotSupported(f"no stage {name}")
            if df is None and name != "$documents":
                raise BadQuery("a pipeline without a collection begins with $documents")
            df = STAGES[name](self, df, body)
        if df is None:
            raise BadQuery("nothing to read")
        return df


# -- match --------------------------------------------------------------------------------------

_TESTS = {"$eq": "eq", "$ne": "neq", "$gt": "gt", "$gte": "gte", "$lt": "lt", "$lte": "lte", "$in": "in", "$nin": "nin"}
_TYPES = {"string": T.StringType, "int": T.IntegerType, "long": T.LongType, "double": T.DoubleType, "bool": T.BooleanType, "date": (T.TimestampType, T.TimestampNTZType, T.DateType), "array": T.ArrayType, "object": T.StructType, "decimal": T.DecimalType, "number": T.NumericType}


def match_document(pipeline: Pipeline, schema: T.StructType, body: Mapping[str, Any], base: Column | None = None, positive: bool = False) -> Column:
    """The condition of a $match document; ``positive`` if null is as good as false there."""
    parts = []
    for key, value in body.items():
        if key in ("$and", "$or", "$nor"):
            each = [match_document(pipeline, schema, b, base, positive and key != "$nor") for b in value]
            joined = reduce(lambda a, b: a & b if key == "$and" else a | b, each)  # noqa: B023
            parts.append(~joined if key == "$nor" else joined)
        elif key == "$expr":
            parts.append(F.coalesce(compile_expression(value, Scope(schema, pipeline.variables)).cast("boolean"), F.lit(False)))
        elif key.startswith("$"):
            raise NotSupported(f"no condition {key}")
        else:
            column, kind = resolve(schema, key.split("."), base, strict=False)
            parts.append(_field_condition(pipeline, column, kind, value, positive))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _element_condition(pipeline: Pipeline, kind: T.DataType, value: Any, x: Column) -> Column:
    return _field_condition(pipeline, x, kind, value)


def _field_condition(pipeline: Pipeline, x: Column, kind: T.DataType, value: Any, positive: bool = False) -> Column:
    if not isinstance(value, Mapping) or not any(k.startswith("$") for k in value):
        return test("eq", x, kind, value, positive)
    parts = []
    for op, v in value.items():
        if isinstance(kind, T.ArrayType) and op in ("$regex", "$mod"):
            own = {k: value[k] for k in (op, "$options") if k in value}
            parts.append(any_of(x, partial(_element_condition, pipeline, kind.elementType, own)))
        elif op in _TESTS:
            parts.append(test(_TESTS[op], x, kind, v, positive))
        elif op == "$not":
            parts.append(~_field_condition(pipeline, x, kind, v))
        elif op == "$exists":
            parts.append(x.isNotNull() if v else x.isNull())
        elif op == "$type":
            named = _TYPES.get(v if isinstance(v, str) else "")
            if named is None:
                raise NotSupported(f"no type {v}")
            parts.append(x.isNotNull() & F.lit(isinstance(kind, named)))
        elif op == "$mod":
            parts.append(F.coalesce(x % F.lit(v[0]) == F.lit(v[1]), F.lit(False)))
        elif op == "$regex":
            flags = "".join(f for f in value.get("$options", "") if f in "imsx")
            parts.append(F.coalesce(F.rlike(x.cast("string"), F.lit((f"(?{flags})" if flags else "") + v)), F.lit(False)))
        elif op == "$options":
            continue
        elif op == "$size":
            parts.append(F.coalesce(F.size(x) == F.lit(v), F.lit(False)))
        elif op == "$all":
            parts.append(reduce(lambda a, b: a & b, [test("eq", x, kind, w) for w in v], F.lit(True)))
        elif op == "$elemMatch":
            if not isinstance(kind, T.ArrayType):
                parts.append(F.lit(False))
                continue
            inner = kind.elementType
            if isinstance(inner, T.StructType) and not all(k.startswith("$") for k in v):
                parts.append(any_of(x, partial(match_document, pipeline, inner, v)))
            else:
                parts.append(any_of(x, partial(_element_condition, pipeline, inner, v)))
        else:
            raise NotSupported(f"no condition {op}")
    return reduce(lambda a, b: a & b, parts, F.lit(True))


@stage("$match")
def _match(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    where = body if isinstance(body, Column) else match_document(p, df.schema, body, positive=True)
    return _sorted_by(df.filter(where), getattr(df, "_lattica_sort", None))


# -- columns --------------------------------------------------------------------------------------


def _set_path(schema: T.StructType, path: list[str], value: Column | None, base: Column | None = None) -> list[Column]:
    """The fields of a document with one replaced, added, or (None) dropped."""
    out, name = [], path[0]
    get = lambda f: quoted(f) if base is None else base.getField(f)
    for f in schema.fields:
        if f.name != name:
            out.append(get(f.name).alias(f.name))
        elif len(path) > 1 and isinstance(f.dataType, T.StructType):
            inner = _set_path(f.dataType, path[1:], value, get(name))
            if inner:
                out.append(F.struct(*inner).alias(name))
        elif value is not None:
            out.append(_wrapped(path[1:], value).alias(name))
        elif len(path) > 1:
            out.append(get(name).alias(name))
    if name not in schema.fieldNames() and value is not None:
        out.append(_wrapped(path[1:], value).alias(name))
    return out


def _wrapped(path: Sequence[str], value: Column) -> Column:
    return reduce(lambda inner, name: F.struct(inner.alias(name)), reversed(path), value)


@stage("$addFields", "$set")
def _add_fields(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    before = p.scope(df)  # all values are of the document as it came
    for key, value in body.items():
        df = df.select(*_set_path(df.schema, key.split("."), compile_expression(value, before)))
    return df


@stage("$unset")
def _unset(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    for key in [body] if isinstance(body, str) else body:
        df = df.select(*_set_path(df.schema, key.split("."), None))
    return df


def _is_off(value: Any) -> bool:
    return value is False or isinstance(value, (int, float)) and not isinstance(value, bool) and value == 0


def _is_on(value: Any) -> bool:
    return value is True or isinstance(value, (int, float)) and not isinstance(value, bool) and value != 0


@stage("$project")
def _project(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    """All entries off: those go.  Else what is named stays; ``_id`` too unless it is off."""
    flat = dict(_flat(body))
    if all(_is_off(v) for v in flat.values()):
        return _unset(p, df, list(flat))
    if any(_is_off(v) for k, v in flat.items() if k != "_id"):
        raise BadQuery("a projection takes fields in or leaves them out, not both")
    scope, tree = p.scope(df), {}
    if "_id" in df.columns and "_id" not in flat:
        flat = {"_id": 1, **flat}
    for key, value in flat.items():
        if _is_off(value):
            continue
        path = key.split(".")
        if _is_on(value):
            column, kind = resolve(df.schema, path, strict=False)
            if isinstance(kind, T.NullType):
                continue
        else:
            column = compile_expression(value, scope)
        node = tree
        for part in path[:-1]:
            node = node.setdefault(part, {})
        node[path[-1]] = column
    return df.select(*[_of_tree(v).alias(k) for k, v in tree.items()])


def _flat(body: Mapping[str, Any], above: str = "") -> list[tuple[str, Any]]:
    out = []
    for key, value in body.items():
        if isinstance(value, Mapping) and value and not any(k.startswith("$") for k in value):
            out += _flat(value, f"{above}{key}.")
        else:
            out.append((above + key, value))
    return out


def _of_tree(node: Any) -> Column:
    return F.struct(*[_of_tree(v).alias(k) for k, v in node.items()]) if isinstance(node, dict) else node


@stage("$replaceRoot", "$replaceWith")
def _replace_root(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    tree = body["newRoot"] if isinstance(body, Mapping) and set(body) == {"newRoot"} else body
    if isinstance(tree, Mapping) and not any(k.startswith("$") for k in tree):
        return df.select(*[compile_expression(v, p.scope(df)).alias(k) for k, v in tree.items()])
    return df.select(compile_expression(tree, p.scope(df)).alias("__root")).select("__root.*")


# -- rows --------------------------------------------------------------------------------------


@stage("$documents")
def _documents(p: Pipeline, df: DataFrame | None, body: Any) -> DataFrame:
    """Documents from the query itself; fields that some lack are null."""
    rows = compile_rows(body)
    names = list(dict.fromkeys(k for r in rows for k in r))
    parts = [p.catalog.spark.range(1).select(*[literal(r.get(n)).alias(n) for n in names]) for r in rows]
    return reduce(DataFrame.union, parts) if parts else p.catalog.spark.createDataFrame([], T.StructType([]))


def compile_rows(body: Any) -> list[dict]:
    if not isinstance(body, (list, tuple)) or not all(isinstance(r, Mapping) for r in body):
        raise BadQuery("$documents takes a list of documents")
    return [dict(r) for r in body]


@stage("$sort")
def _sort(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    keys = []
    for key, way in body.items():
        x = resolve(df.schema, key.split("."), strict=False)[0]
        keys.append(x.asc_nulls_first() if way == 1 else x.desc_nulls_last())
    return _sorted_by(df.orderBy(*keys), body)


def _sorted_by(df: DataFrame, body: Mapping[str, Any] | None) -> DataFrame:
    """Notes the sort that a $group behind it relies on."""
    df._lattica_sort = body
    return df


def _place(df: DataFrame) -> Column | None:
    """One value that orders rows as the sort before did, or None: with it the first and last
    of a group need no order of rows in a task, which no shuffle keeps."""
    body = getattr(df, "_lattica_sort", None)
    if not body:
        return None
    parts = []
    for i, (key, way) in enumerate(body.items()):
        x, kind = resolve(df.schema, key.split("."), strict=False)
        parts.append(F.when(x.isNull(), F.lit(0 if way == 1 else 2)).otherwise(F.lit(1)).alias(f"n{i}"))
        parts.append((x if way == 1 else descending(kind, x)).alias(f"k{i}"))
    return F.struct(*parts)


@stage("$limit")
def _limit(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    return _sorted_by(df.limit(int(body)), getattr(df, "_lattica_sort", None))


@stage("$skip")
def _skip(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    return _sorted_by(df.offset(int(body)), getattr(df, "_lattica_sort", None))


@stage("$count")
def _count(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    """No row for no documents."""
    return df.agg(F.count(F.lit(1)).alias(body)).filter(quoted(body) > 0)


@stage("$group")
def _group(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    edges = any(set(v) & {"$first", "$last"} for k, v in body.items() if k != "_id")
    scope = Scope(df.schema, p.variables, _place(df) if edges else None)
    own = [compile_accumulator(v, scope).alias(k) for k, v in body.items() if k != "_id"]
    key = body.get("_id")
    if key is None:
        grouped = df.agg(*own, F.count(F.lit(1)).alias("__n")).filter("__n > 0").drop("__n") if own else df.limit(1).select()
        return grouped.select(F.lit(None).alias("_id"), "*")
    id_column = compile_expression(key, scope).alias("_id")
    return df.groupBy(id_column).agg(*own) if own else df.select(id_column).distinct()


@stage("$sortByCount")
def _sort_by_count(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    return _sort(p, _group(p, df, {"_id": body, "count": {"$count": {}}}), {"count": -1})


@stage("$unwind")
def _unwind(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    spec = {"path": body} if isinstance(body, str) else body
    path = spec["path"].removeprefix("$").split(".")
    index, keep = spec.get("includeArrayIndex"), spec.get("preserveNullAndEmptyArrays", False)
    column, kind = resolve(df.schema, path, strict=False)
    if not isinstance(kind, T.ArrayType):  # a single value unwinds to itself
        out = df if keep else df.filter(column.isNotNull())
        return out.withColumn(index, F.lit(None).cast("long")) if index else out
    made = (F.posexplode_outer if keep else F.posexplode)(column).alias("__at", "__value")
    rows = df.select("*", made)
    plain = [f for f in rows.schema.fields if f.name not in ("__at", "__value")]
    columns = _set_path(T.StructType(plain), path, F.col("__value"))
    return rows.select(*columns, *([F.col("__at").cast("long").alias(index)] if index else []))


@stage("$unionWith")
def _union_with(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    spec = {"coll": body} if isinstance(body, str) else body
    other = p.catalog.open(spec["coll"]) if "coll" in spec else None
    return df.unionByName(p.run(spec.get("pipeline", ()), other), allowMissingColumns=True)


@stage("$sample")
def _sample(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    return df.orderBy(F.rand()).limit(int(body["size"]))


@stage("$lookup")
def _lookup(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    """Rows of another collection whose field equals a field of this one, as an array; with
    ``pipeline`` after its stages.  Stages with ``let`` variables are joined on the equalities
    of their first $match that name them; where stages name a variable otherwise, the rows
    meet each distinct combination of such values that their key goes with.

    The other side is grouped by its key first, so each document meets one row.
    """
    other = p.catalog.open(body["from"])
    as_name, stages = body["as"], list(body.get("pipeline") or ())
    pairs = []
    if "localField" in body:
        pairs.append((resolve(df.schema, body["localField"].split("."), strict=False)[0], body["foreignField"].split(".")))
    mine = {k: compile_expression(v, p.scope(df)) for k, v in (body.get("let") or {}).items()}
    if mine:
        found, stages = _take_equalities(stages, mine)
        pairs += [(x, path) for x, path in found]
    named = [k for k in mine if _names(stages, k)]
    if not pairs:
        if named:
            raise NotSupported("a lookup with variables needs an equality with one of them")
        whole = _one_row(p.run(stages, other), as_name)
        return df.crossJoin(F.broadcast(whole))  # one row, of a checked size
    keyed = other.select("*", *[resolve(other.schema, path, strict=False)[0].alias(f"__key{i}") for i, (_, path) in enumerate(pairs)])
    names = [f"__key{i}" for i in range(len(pairs))]
    if named:
        asked = df.select(*[x.alias(f"__ask{i}") for i, (x, _) in enumerate(pairs)], *[mine[k].alias(f"__let_{k}") for k in named]).distinct()
        meets = reduce(lambda a, b: a & b, [F.col(f"__ask{i}").eqNullSafe(F.col(n)) for i, n in enumerate(names)])
        keyed = keyed.join(asked, meets).drop(*[f"__ask{i}" for i in range(len(pairs))])
        names += [f"__let_{k}" for k in named]
    inner = Pipeline(p.catalog, p.variables | {k: F.col(f"__let_{k}") for k in named})
    grouped = _run_by_key(inner, stages, keyed, names).withColumnRenamed("__all", "__rows")
    near = [*[x for x, _ in pairs], *[mine[k] for k in named]]
    condition = reduce(lambda a, b: a & b, [x.eqNullSafe(F.col(n)) for x, n in zip(near, names, strict=True)])
    joined = df.join(grouped, condition, "left")
    kind = grouped.schema["__rows"].dataType
    return joined.select(*[quoted(c) for c in df.columns if c != as_name], F.coalesce("__rows", F.array().cast(kind)).alias(as_name))


#: Stages that take documents one by one, so that those of all keys go through together.
_ONE_BY_ONE = ("$match", "$addFields", "$set", "$project", "$unset", "$replaceRoot", "$replaceWith", "$unwind", "$lookup")
#: Where a row stands after a $sort.
_BY = "__by"


def _run_by_key(p: Pipeline, stages: Sequence[Mapping[str, Any]], df: DataFrame, keys: list[str]) -> DataFrame:
    """What the stages give for the rows of each key, as an array ``__all``, in the order of
    the last $sort.  Sorts, limits and groups are per key: no stage needs a job of its own."""
    ordered = False
    for s in stages:
        ((name, body),) = s.items()
        hidden = [*keys, _BY] if ordered else keys
        own = T.StructType([f for f in df.schema.fields if f.name not in hidden])
        if name in _ONE_BY_ONE:
            df = p.run(_carrying([s], hidden), df)
        elif name == "$sort":
            noted = _sorted_by(df, body)
            df, ordered = df.withColumn(_BY, _place(noted)), True
        elif name in ("$limit", "$skip"):
            over = Window.partitionBy(*keys).orderBy(F.col(_BY) if ordered else F.lit(1))
            place = F.col("__n") <= int(body) if name == "$limit" else F.col("__n") > int(body)
            df = df.withColumn("__n", F.row_number().over(over)).filter(place).drop("__n")
        elif name == "$count":
            df, ordered = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(body)), False
        elif name in ("$group", "$sortByCount"):
            spec = {"_id": body, "count": {"$count": {}}} if name == "$sortByCount" else body
            scope = Scope(own, p.variables, F.col(_BY) if ordered else None)
            id_column = (F.lit(None) if spec.get("_id") is None else compile_expression(spec["_id"], scope)).alias("_id")
            values = [compile_accumulator(v, scope).alias(k) for k, v in spec.items() if k != "_id"]
            by = [*map(F.col, keys), id_column]
            df = df.groupBy(*by).agg(*values) if values else df.select(*by).distinct()
            ordered = name == "$sortByCount"
            if ordered:
                df = df.withColumn(_BY, -F.col("count"))
        else:
            raise NotSupported(f"{name} in the stages of a lookup with keys")
    content = F.struct(*[quoted(c) for c in df.columns if c not in (*keys, _BY)])
    if not ordered:
        return df.groupBy(*keys).agg(F.collect_list(content).alias("__all"))
    listed = F.array_sort(F.collect_list(F.struct(F.col(_BY), content.alias("v"))))
    return df.groupBy(*keys).agg(F.transform(listed, lambda r: r["v"]).alias("__all"))


def _names(tree: Any, variable: str) -> bool:
    """Whether a variable is named somewhere in stages."""
    if isinstance(tree, Mapping):
        return any(_names(v, variable) for v in tree.values())
    if isinstance(tree, (list, tuple)):
        return any(_names(v, variable) for v in tree)
    return isinstance(tree, str) and tree.startswith("$$") and tree[2:].partition(".")[0] == variable


#: Bytes (as JSON) that one array of whole rows may hold.
ARRAY_BYTES = 64 << 20


def _one_row(rows: DataFrame, name: str) -> DataFrame:
    """All rows as one array, which some row then has to hold: an error if they are too large
    for that, found before they are brought together."""
    size = rows.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    if size > ARRAY_BYTES:
        raise NotSupported(f"{name} would be one array of {size} bytes; at most {ARRAY_BYTES} go into one")
    return rows.agg(F.collect_list(F.struct("*")).alias(name))


def _carrying(stages: list, names: list[str]) -> list:
    """The stages, with the keys kept where fields are chosen."""
    out = []
    for s in stages:
        ((name, body),) = s.items()
        if name == "$project" and not all(_is_off(v) for _, v in _flat(body)):
            body = {**body, **dict.fromkeys(names, 1)}
        elif name in ("$replaceWith", "$replaceRoot"):
            tree = body["newRoot"] if set(body) == {"newRoot"} else body
            body = {**tree, **{n: f"${n}" for n in names}}
            name = "$replaceWith"
        out.append({name: body})
    return out


def _take_equalities(stages: list, mine: Mapping[str, Column]) -> tuple[list, list]:
    """(variable, path) pairs of {"$expr": {"$eq": ["$$variable", "$path"]}} in the first
    $match, and the stages without them."""
    if not stages or next(iter(stages[0])) != "$match":
        return [], stages
    body = stages[0]["$match"]
    tests = body.get("$expr")
    if tests is None:
        return [], stages
    each = tests["$and"] if isinstance(tests, Mapping) and "$and" in tests else [tests]
    found, left = [], []
    for t in each:
        pair = t.get("$eq") if isinstance(t, Mapping) else None
        names = [x for x in pair or () if isinstance(x, str)]
        variable = next((x[2:] for x in names if x.startswith("$$") and x[2:] in mine), None)
        path = next((x[1:] for x in names if x.startswith("$") and not x.startswith("$$")), None)
        if variable and path:
            found.append((mine[variable], path.split(".")))
        else:
            left.append(t)
    rest = {k: v for k, v in body.items() if k != "$expr"} | ({"$expr": {"$and": left}} if left else {})
    return found, ([{"$match": rest}] if rest else []) + stages[1:]


@stage("$facet")
def _facet(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    """One row with an array per branch, each the rows of its stages, of a checked size; for
    more see facets()."""
    out = None
    for name, stages in body.items():
        part = _one_row(p.run(stages, df), name)
        out = part if out is None else out.crossJoin(part)  # one row each
    if out is None:
        raise BadQuery("$facet needs a branch")
    return out


def facets(p: Pipeline, df: DataFrame, body: Mapping[str, Sequence]) -> dict[str, DataFrame]:
    """The branches of a $facet as DataFrames of their own, which no single row has to hold."""
    return {name: p.run(stages, df) for name, stages in body.items()}


@stage("$vectorSearch")
def _vector_search(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    """The rows nearest to a vector by cosine, exactly: a scan and a top-k, no sort of all.
    ``filter`` is a $match document; the score comes as ``vectorSearchScore``, from 0 to 1."""
    x, query = resolve(df.schema, body["path"].split("."))[0], [float(v) for v in body["queryVector"]]
    if "filter" in body:
        df = _match(p, df, body["filter"])
    q = F.array(*[F.lit(v) for v in query])
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u.cast("double") * v), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(x, F.transform(x, lambda u: u.cast("double"))))
    norm = sum(v * v for v in query) ** 0.5
    cosine = F.when((size > 0) & F.lit(norm > 0), dot(x, q) / (size * F.lit(norm or 1.0)))
    scored = df.withColumn("vectorSearchScore", (1 + cosine) / 2)
    ties = [quoted(c).asc() for c, t in df.dtypes if t in ("bigint", "int", "string")][:1]
    return scored.orderBy(F.col("vectorSearchScore").desc_nulls_last(), *ties).limit(int(body["limit"]))


def nearest(df: DataFrame, queries: DataFrame, key: str, path: str, limit: int, block: int = 1000) -> DataFrame:
    """query_id and key of the rows of ``df`` nearest to each row of ``queries`` by cosine,
    exactly, ties by key.  The queries are broadcast in blocks of about ``block`` rows; of
    the pairs each task keeps ``limit`` for a query before any is shuffled."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = lambda x: F.sqrt(dot(x, x))
    rows = df.select(F.col(key), F.col(path).alias("x"), size(F.col(path)).alias("xs"))
    asked = queries.select(F.col(key).alias("query_id"), F.col(path).alias("q"), size(F.col(path)).alias("qs"))
    blocks = max(1, -(-queries.count() // block))
    cosine = F.when((F.col("xs") > 0) & (F.col("qs") > 0), dot(F.col("x"), F.col("q")) / (F.col("xs") * F.col("qs")))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), F.col(key))
    out = None
    for n in range(blocks):
        own = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == n)
        pairs = rows.crossJoin(F.broadcast(own)).select("query_id", key, cosine.alias("score"))
        part = pairs.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= limit).select("query_id", key)
        out = part if out is None else out.unionByName(part)
    return out


@stage("$search")
def _search(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    """Rows that hold any of the words of a query, the number of hits in all paths as
    ``searchScore``; a path given twice counts once."""
    spec = body["text"]
    paths = [spec["path"]] if isinstance(spec["path"], str) else list(dict.fromkeys(spec["path"]))
    words = list(dict.fromkeys(w for w in str(spec["query"]).lower().split() if w))
    score = F.lit(0)
    for path in paths:
        tokens = F.split(F.lower(resolve(df.schema, path.split("."))[0]), r"[^\p{L}\p{N}]+")
        hits = F.size(F.filter(tokens, lambda t: t.isin(*words)))
        score += F.when(tokens.isNotNull(), hits).otherwise(0)
    return df.withColumn("searchScore", score).filter(F.col("searchScore") > 0).orderBy(F.col("searchScore").desc())


@stage("$searchMeta")
def _search_meta(p: Pipeline, df: DataFrame, body: Any) -> DataFrame:
    return _search(p, df, body).agg(F.count(F.lit(1)).alias("count"))


# -- views ----------------------------------------------------------------------------------------


def pipeline_view(name: str, stages: Sequence[Mapping[str, Any]], arguments: Mapping[str, T.DataType | None], input_collection: str | None = None, kind: str = "collection") -> View:
    """A view whose rows a pipeline gives, with placeholders for its arguments.  An argument
    may also be a Column: a condition in a $match, say."""

    def make(catalog: Catalog, given: dict[str, Any]) -> DataFrame:
        df = catalog.open(input_collection) if input_collection else None
        return Pipeline(catalog).run(interpolate(list(stages), given), df)

    return View(name, make, arguments, kind=kind)
