"""Scalar expressions.

Null rules: comparisons are two-valued unless ``ansi_nulls`` is set.  Null equals null;
an order comparison with null is false; not of null is true; null may be a list member.
All other functions give null for null, but where their notes say otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import UnsupportedExpression
from ..plans.relational import Expr
from . import literals  # noqa: F401  registers literals and casts
from .context import Context, is_temporal, literal_of, millis, scalar

#: Characters that the trims take off when none are named.
WHITE_SPACE = "\0 \t\n\x0b\x0c\r\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"


def _fields(ctx: Context, e: Expr, *names: str) -> list[Column]:
    return [ctx.compile(e.fields[n]) for n in names]


def _flag(ctx: Context, x: Column) -> Column:
    return x if ctx.options.ansi_nulls or ctx.own_positive else F.coalesce(x, F.lit(False))


@scalar("column")
def _column(ctx: Context, e: Expr) -> Column:
    return ctx.column(e.fields["index"])


# -- logic and comparison ---------------------------------------------------------------


@scalar("and", "or")
def _logic(ctx: Context, e: Expr) -> Column:
    left, right = (_flag(ctx, x.cast("boolean")) for x in _fields(ctx, e, "left", "right"))
    return left & right if e.kind == "and" else left | right


@scalar("not")
def _not(ctx: Context, e: Expr) -> Column:
    return ~_flag(ctx, ctx.compile(e.fields["expr"]).cast("boolean"))


def compare(ctx: Context, kind: str, x: Column, y: Column, plain: bool = False) -> Column:
    if kind in ("eq", "not_eq"):
        same = x == y if ctx.options.ansi_nulls or plain else x.eqNullSafe(y)
        return same if kind == "eq" else ~same
    return _flag(ctx, {"lt": x < y, "lt_eq": x <= y, "gt": x > y, "gt_eq": x >= y}[kind])


@scalar("eq", "not_eq", "lt", "lt_eq", "gt", "gt_eq")
def _compare(ctx: Context, e: Expr) -> Column:
    # in a filter, equality with a value that is not null needs no care for nulls
    plain = ctx.own_positive and e.kind == "eq" and any(literal_of(e.fields[n]) is not None for n in ("left", "right"))
    return compare(ctx, e.kind, *_fields(ctx, e, "left", "right"), plain)


@scalar("is_distinct_from", "is_not_distinct_from")
def _distinct(ctx: Context, e: Expr) -> Column:
    x, y = _fields(ctx, e, "left", "right")
    return ~x.eqNullSafe(y) if e.kind == "is_distinct_from" else x.eqNullSafe(y)


@scalar("is_null", "is_not_null")
def _null(ctx: Context, e: Expr) -> Column:
    x = ctx.compile(e.fields["expr"])
    return x.isNull() if e.kind == "is_null" else x.isNotNull()


@scalar("is_true", "is_false", "is_not_true", "is_not_false")
def _truth(ctx: Context, e: Expr) -> Column:
    held = ctx.compile(e.fields["expr"]).cast("boolean").eqNullSafe(F.lit(e.kind.endswith("true")))
    return ~held if "_not_" in e.kind else held


@scalar("in", "not_in")
def _in(ctx: Context, e: Expr) -> Column:
    x, members = ctx.compile(e.fields["expr"]), e.fields["list"]
    if not members:
        found = F.lit(False)
    elif all(m.kind == "literal" and literal_of(m) is not None for m in members) or ctx.options.ansi_nulls:
        listed = x.isin(*[ctx.compile(m) for m in members])
        found = listed if ctx.options.ansi_nulls or ctx.own_positive and e.kind == "in" else F.coalesce(listed, F.lit(False))
    else:
        found = reduce(lambda a, b: a | b, [x.eqNullSafe(ctx.compile(m)) for m in members])
    return found if e.kind == "in" else ~found


@scalar("between", "not_between")
def _between(ctx: Context, e: Expr) -> Column:
    low, x, high = _fields(ctx, e, "low", "expr", "high")
    return _flag(ctx, (x >= low) & (x <= high)) if e.kind == "between" else _flag(ctx, x < low) | _flag(ctx, x > high)


@scalar("like", "not_like", "i_like", "not_i_like")
def _like(ctx: Context, e: Expr) -> Column:
    """Null for null, also negated; other types are matched as text."""
    x, pattern = ctx.compile(e.fields["expr"]), ctx.compile(e.fields["pattern"])
    x = x if isinstance(ctx.type_of(x), T.StringType) else x.cast("string")
    found = F.call_function("ilike" if "i_like" in e.kind else "like", x, pattern)
    return ~found if e.kind.startswith("not_") else found


@scalar("contains")
def _contains(ctx: Context, e: Expr) -> Column:
    return F.coalesce(F.contains(*_fields(ctx, e, "str", "search_str")), F.lit(False))


@scalar("is_nan")
def _is_nan(ctx: Context, e: Expr) -> Column:
    x = ctx.compile(e.fields["expr"])
    if isinstance(ctx.type_of(x), (T.DoubleType, T.FloatType)):
        return F.coalesce(F.isnan(x), F.lit(False))
    return F.lit(False)


@scalar("is_zero")
def _is_zero(ctx: Context, e: Expr) -> Column:
    return ctx.compile(e.fields["expr"]).eqNullSafe(F.lit(0))


# -- conditional -------------------------------------------------------------------------


@scalar("case")
def _case(ctx: Context, e: Expr) -> Column:
    scrutinee = e.get("scrutinee")
    subject = None if scrutinee is None else ctx.compile(scrutinee)
    out = None
    for when, then in e.fields["when"]:
        test = ctx.compile(when)
        test = test if subject is None else compare(ctx, "eq", subject, test)
        out = (F if out is None else out).when(test, ctx.compile(then))
    default = e.get("default")
    default = F.lit(None) if default is None else ctx.compile(default)
    return default if out is None else out.otherwise(default)


@scalar("coalesce")
def _coalesce(ctx: Context, e: Expr) -> Column:
    return F.coalesce(*[ctx.compile(x) for x in e.fields["exprs"]])


@scalar("null_if")
def _null_if(ctx: Context, e: Expr) -> Column:
    return F.nullif(*_fields(ctx, e, "expr1", "expr2"))


@scalar("nvl")
def _nvl(ctx: Context, e: Expr) -> Column:
    return F.nvl(*_fields(ctx, e, "expr1", "expr2"))


@scalar("greatest", "least")
def _extreme(ctx: Context, e: Expr) -> Column:
    """Nulls are skipped."""
    xs = [ctx.compile(x) for x in e.fields["exprs"]]
    return xs[0] if len(xs) == 1 else F.call_function(e.kind, *xs)


# -- arithmetic and mathematics ------------------------------------------------------------


@scalar("plus", "minus")
def _add(ctx: Context, e: Expr) -> Column:
    """A date and a number: the date so many milliseconds on.  Two dates, subtracted: the
    milliseconds between them."""
    x, y = _fields(ctx, e, "left", "right")
    dates = is_temporal(ctx.type_of(x)), is_temporal(ctx.type_of(y))
    if not any(dates):
        return x + y if e.kind == "plus" else x - y
    if all(dates):
        if e.kind == "plus":
            raise UnsupportedExpression("two dates cannot be added")
        return millis(x) - millis(y)
    if e.kind == "minus" and dates[1]:
        raise UnsupportedExpression("a date cannot be taken from a number")
    a, b = (millis(v) if d else v.cast("bigint") for v, d in zip((x, y), dates, strict=True))
    return F.timestamp_millis(a + b if e.kind == "plus" else a - b)


@scalar("multiply", "divide", "modulo")
def _times(ctx: Context, e: Expr) -> Column:
    x, y = _fields(ctx, e, "left", "right")
    return {"multiply": lambda: x * y, "divide": lambda: x / y, "modulo": lambda: x % y}[e.kind]()


@scalar("negate")
def _negate(ctx: Context, e: Expr) -> Column:
    return -ctx.compile(e.fields["expr"])


_PLAIN = {"abs": "abs", "sqrt": "sqrt", "exp": "exp", "ln": "ln", "log10": "log10", "log2": "log2", "cos": "cos", "tan": "tan", "to_lower": "lower", "to_upper": "upper"}


@scalar(*_PLAIN)
def _plain(ctx: Context, e: Expr) -> Column:
    return F.call_function(_PLAIN[e.kind], ctx.compile(e.fields["expr"]))


#: From here on every double is a whole number, and soon too large for the 64 bits of one.
WHOLE_FROM = float(2**53)


def _unless_whole(own: T.DataType, x: Column, size: Column, made: Column) -> Column:
    """``made``, or ``x`` itself if it is a double of a size (of NaN too) that has no fraction."""
    return F.when(size >= WHOLE_FROM, x).otherwise(made) if isinstance(own, (T.DoubleType, T.FloatType)) else made


@scalar("ceil", "floor")
def _whole(ctx: Context, e: Expr) -> Column:
    """Of the type of the argument."""
    x = ctx.compile(e.fields["expr"])
    own = ctx.type_of(x)
    return _unless_whole(own, x, F.abs(x), F.call_function(e.kind, x).cast(own))


@scalar("round")
def _round(ctx: Context, e: Expr) -> Column:
    """Halves go to the even digit."""
    x, places = ctx.compile(e.fields["expr"]), e.get("prec")
    return F.call_function("bround", x, F.lit(0) if places is None else ctx.compile(places))


@scalar("trunc")
def _trunc(ctx: Context, e: Expr) -> Column:
    x, places = ctx.compile(e.fields["expr"]), e.get("prec")
    own = ctx.type_of(x)
    if places is None:
        return _unless_whole(own, x, F.abs(x), F.signum(x) * F.floor(F.abs(x)))
    by = F.pow(F.lit(10.0), ctx.compile(places))
    return _unless_whole(own, x, F.abs(x) * by, F.signum(x) * F.floor(F.abs(x) * by) / by)


@scalar("power")
def _power(ctx: Context, e: Expr) -> Column:
    return F.pow(*_fields(ctx, e, "base", "exp"))


@scalar("log")
def _log(ctx: Context, e: Expr) -> Column:
    """Base 10 unless one is given."""
    x, base = ctx.compile(e.fields["expr"]), e.get("base")
    return F.log10(x) if base is None else F.call_function("log", ctx.compile(base), x)


@scalar("random")
def _random(ctx: Context, e: Expr) -> Column:
    return F.rand()


# -- strings -------------------------------------------------------------------------------


@scalar("concat")
def _concat(ctx: Context, e: Expr) -> Column:
    return F.concat(*[ctx.compile(x).cast("string") for x in e.fields["exprs"]])


@scalar("binary_concat")
def _binary_concat(ctx: Context, e: Expr) -> Column:
    return F.concat(*[x.cast("binary") for x in _fields(ctx, e, "left", "right")])


@scalar("character_length")
def _length(ctx: Context, e: Expr) -> Column:
    return F.char_length(ctx.compile(e.fields["str"]))


@scalar("substr")
def _substr(ctx: Context, e: Expr) -> Column:
    """Places count from 1."""
    s, start = _fields(ctx, e, "str", "start_pos")
    length = e.get("len")
    return F.substr(s, start) if length is None else F.substr(s, start, ctx.compile(length))


@scalar("str_pos")
def _str_pos(ctx: Context, e: Expr) -> Column:
    s, part = _fields(ctx, e, "str", "substr")
    return F.call_function("instr", s, part)


@scalar("l_trim", "r_trim", "b_trim")
def _trim(ctx: Context, e: Expr) -> Column:
    s, chars = ctx.compile(e.fields["str"]), e.get("trim_str")
    chars = F.lit(WHITE_SPACE) if chars is None else ctx.compile(chars)
    return {"l_trim": F.ltrim, "r_trim": F.rtrim, "b_trim": F.btrim}[e.kind](s, chars)


@scalar("replace")
def _replace(ctx: Context, e: Expr) -> Column:
    return F.replace(*_fields(ctx, e, "str", "substr", "replacement"))


@scalar("left", "right")
def _side(ctx: Context, e: Expr) -> Column:
    return F.call_function(e.kind, *_fields(ctx, e, "str", "n"))


@scalar("reverse")
def _reverse(ctx: Context, e: Expr) -> Column:
    return F.reverse(ctx.compile(e.fields["str"]))


@scalar("l_pad", "r_pad")
def _pad(ctx: Context, e: Expr) -> Column:
    s, n = _fields(ctx, e, "str", "n")
    pad = e.get("padding_str")
    return F.call_function(e.kind.replace("_", ""), s, n, F.lit(" ") if pad is None else ctx.compile(pad))


@scalar("substr_index")
def _substr_index(ctx: Context, e: Expr) -> Column:
    return F.call_function("substring_index", *_fields(ctx, e, "str", "delim", "count"))


# -- nested values and JSON ------------------------------------------------------------------


@scalar("get_field")
def _get_field(ctx: Context, e: Expr) -> Column:
    x, name = ctx.compile(e.fields["column"]), e.fields["field"]
    own = ctx.type_of(x)
    if isinstance(own, T.VariantType):
        return F.variant_get(x, _path([name]), "variant")
    if isinstance(own, T.StringType):
        return F.variant_get(F.try_parse_json(x), _path([name]), "variant")
    if isinstance(own, T.MapType):
        return F.try_element_at(x, F.lit(name))
    if isinstance(own, T.StructType) and name not in own.fieldNames():
        return F.lit(None)
    return x.getField(name)


@scalar("array_element")
def _element(ctx: Context, e: Expr) -> Column:
    """Counts from 0; null when out of range."""
    return F.get(*_fields(ctx, e, "column", "index"))


def _path(keys: list) -> str:
    out = "$"
    for k in keys:
        if isinstance(k, int):
            out += f"[{k}]"
        else:
            out += "['" + str(k).replace("\\", "\\\\").replace("'", "\\'") + "']"
    return out


def _literal_keys(keys: list[Expr]) -> list | None:
    out: list = []
    for k in keys:
        value = literal_of(k)
        if value is None:
            return None
        if isinstance(value, str) and value.startswith("$."):
            out += value[2:].split(".")
        else:
            out.append(value)
    return out


def variant_of(ctx: Context, x: Column) -> Column:
    own = ctx.type_of(x)
    if isinstance(own, T.VariantType):
        return x
    return F.try_parse_json(x) if isinstance(own, T.StringType) else F.to_variant_object(x)


def _at(ctx: Context, json: Column, keys: list[Expr], kind: str, soft: bool) -> Column:
    """The value at a path: keys are names, "$.a.b" paths, places, or expressions."""
    get = F.try_variant_get if soft else F.variant_get
    known = _literal_keys(keys)
    if known is not None:
        return get(json, _path(known), kind)
    for k in keys:  # step by step: a key that is not a literal picks from an object's fields
        name = literal_of(k)
        if name is not None:
            json = F.variant_get(json, _path(_literal_keys([k])), "variant")
        else:
            json = F.try_element_at(F.try_variant_get(json, "$", "map<string,variant>"), ctx.compile(k).cast("string"))
    return get(json, "$", kind)


_JSON = {
    "json_get": ("variant", True),
    "json_get_json": ("variant", True),
    "json_get_str": ("string", True),
    "json_as_text": ("string", True),
    "json_get_int": ("int", False),
    "json_get_float": ("double", False),
}


@scalar(*_JSON)
def _json_get(ctx: Context, e: Expr) -> Column:
    kind, soft = _JSON[e.kind]
    return _at(ctx, variant_of(ctx, ctx.compile(e.fields["json"])), e.fields["keys"], kind, soft)


@scalar("json_get_bool")
def _json_bool(ctx: Context, e: Expr) -> Column:
    """Numbers are true unless zero."""
    json = variant_of(ctx, ctx.compile(e.fields["json"]))
    found = _at(ctx, json, e.fields["keys"], "variant", True)
    number = F.schema_of_variant(found).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)")
    return F.when(number, F.try_variant_get(found, "$", "double") != F.lit(0.0)).otherwise(F.variant_get(found, "$", "boolean"))


@scalar("json_length")
def _json_length(ctx: Context, e: Expr) -> Column:
    json = variant_of(ctx, ctx.compile(e.fields["json"]))
    found = _at(ctx, json, e.fields["keys"], "array<variant>", False)
    return F.when(found.isNotNull(), F.size(found))


@scalar("json_contains")
def _json_contains(ctx: Context, e: Expr) -> Column:
    """The last key is the value that the array at the other keys is asked for."""
    *keys, value = e.fields["keys"] or [None]
    if value is None:
        raise UnsupportedExpression("json_contains needs a value")
    wanted = ctx.compile(value)
    kind = ctx.type_of(wanted).simpleString()
    found = F.try_variant_get(variant_of(ctx, ctx.compile(e.fields["json"])), _path(_literal_keys(keys) or []), "array<variant>")
    return F.coalesce(F.exists(found, lambda x: F.try_variant_get(x, "$", kind).eqNullSafe(wanted)), F.lit(False))


# -- dates and times ---------------------------------------------------------------------------


@scalar("current_date")
def _current_date(ctx: Context, e: Expr) -> Column:
    return F.date_trunc("day", F.current_timestamp())


@scalar("current_timestamp")
def _now(ctx: Context, e: Expr) -> Column:
    return F.current_timestamp()


@scalar("current_time")
def _current_time(ctx: Context, e: Expr) -> Column:
    return F.date_format(F.current_timestamp(), "HH:mm:ss.SSS")


#: Parts of a duration in milliseconds: unit, and the count at which the next begins.
_DURATION = {"day": (86_400_000, None), "hour": (3_600_000, 24), "minute": (60_000, 60), "second": (1000, 60), "millisecond": (1, 1000), "week": (604_800_000, None)}


def week_of_year(x: Column) -> Column:
    """Weeks begin on Sunday; days before the first Sunday are in week 0."""
    return F.floor((F.dayofyear(x) + 6 - (F.dayofweek(x) - 1)) / 7).cast("int")


@scalar("date_part")
def _date_part(ctx: Context, e: Expr) -> Column:
    """Of a date, or of a duration in milliseconds if the argument is a number."""
    x, part = ctx.compile(e.fields["expr"]), str(e.fields["part"]).lower()
    own = ctx.type_of(x)
    if isinstance(own, T.NumericType) and part in _DURATION:
        unit, next_one = _DURATION[part]
        whole = F.signum(x) * F.floor(F.abs(x) / unit)
        return (whole if next_one is None else whole % next_one).cast("bigint")
    if isinstance(own, T.NumericType):
        x = F.timestamp_millis(x.cast("bigint"))
    simple = {"year": F.year, "quarter": F.quarter, "month": F.month, "day_of_week": F.dayofweek, "day_of_year": F.dayofyear, "day": F.dayofmonth, "hour": F.hour, "minute": F.minute, "second": F.second, "week": week_of_year}
    if part in simple:
        return simple[part](x)
    if part == "millisecond":
        return F.pmod(millis(x), F.lit(1000)).cast("int")
    if part == "epoch":
        return millis(x) / 1000
    raise UnsupportedExpression(f"no date part {part}: times have milliseconds")


@scalar("date_trunc")
def _date_trunc(ctx: Context, e: Expr) -> Column:
    """Weeks begin on Sunday.  The unit may be an expression; null for one that is unknown."""
    x, unit = ctx.compile(e.fields["expr"]), e.fields["part"]
    day = F.make_dt_interval(F.lit(1))
    week = F.date_trunc("week", x.cast("timestamp") + day) - day
    known = literal_of(unit) if isinstance(unit, Expr) else unit
    if isinstance(known, str):
        return week if known.lower() == "week" else F.date_trunc(known, x)
    if not isinstance(unit, Expr) or not isinstance(ctx.type_of(named := ctx.compile(unit)), T.StringType):
        raise UnsupportedExpression("date_trunc needs a text as its unit")
    return F.when(F.lower(named) == "week", week).otherwise(F.call_function("date_trunc", named, x))


@scalar("to_date", "to_timestamp")
def _to_timestamp(ctx: Context, e: Expr) -> Column:
    """Numbers are milliseconds since the epoch; dates keep their time of day."""
    x = ctx.compile(e.fields["expr"])
    return F.timestamp_millis(x.cast("bigint")) if isinstance(ctx.type_of(x), T.NumericType) else x.cast("timestamp")
