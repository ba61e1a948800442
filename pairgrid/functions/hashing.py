"""Content hashes: of bytes, of canonical JSON, and of whole tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from functools import reduce
from operator import add, and_

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T


def sha(c: Column) -> Column:
    return F.sha2(c, 256)


def canonical_json(c: Column) -> Column:
    """Compact JSON of a struct, array or map, nulls kept.

    Struct fields must already be in name order. The JVM writes control
    characters with capital hex digits; the canonical form has small ones.
    """
    return _small_escapes(F.to_json(c, {"ignoreNullFields": "false"}))


def _small_escapes(out: Column) -> Column:
    lowered = out
    for digit in "ABCDEF":
        lowered = F.regexp_replace(
            lowered, rf"(?<!\\)((?:\\\\)*)\\u00([01]){digit}", rf"$1\\u00$2{digit.lower()}"
        )
    return F.when(out.contains("\\u00"), lowered).otherwise(out)


def canonical_sha(c: Column) -> Column:
    return sha(canonical_json(c))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def float_text(x: Column) -> Column:
    """Shortest decimal digits that read back as the same double, noted as JSON writers of scripting languages do.

    Exponents from -4 to 15 give plain notation with at least one digit behind the
    point, others a mantissa and a signed exponent of two digits or more. The digits are
    Spark's own, which may be one or two too many; they are cut as long as they read
    back. Null for values that are not finite.
    """
    x = x.cast("double")

    def read(s: Column, k: Column) -> Column:
        return F.concat(s.cast("string"), F.lit("E"), k.cast("string")).cast("double")

    def shorter(v: Column) -> Column:
        shown, k = v["m"].cast("string"), v["k"] + 1
        down = F.concat(F.lit("0"), F.substring(shown, F.lit(1), F.length(shown) - 1)).cast("bigint")
        up = v["m"] - down * 10 >= 5
        nearest, other = F.when(up, down + 1).otherwise(down), F.when(up, down).otherwise(down + 1)
        fits = lambda m: F.struct(m.alias("m"), k.alias("k"), v["x"].alias("x"))
        return F.when(read(nearest, k) == v["x"], fits(nearest)).when(read(other, k) == v["x"], fits(other)).otherwise(v)

    def nearest(v: Column) -> Column:
        """Whole numbers over 2**53: of the last digits that read back, the one nearest to the exact value."""
        p = F.greatest(F.floor(F.log2(v["x"])).cast("int") - 53, F.lit(0))
        wide = "decimal(19,0)"
        value = (v["x"] / F.pow(F.lit(2.0), p)).cast("bigint").cast(wide) * F.pow(F.lit(2.0), p).cast("bigint").cast(wide)
        tens = F.rpad(F.lit("1"), v["k"] + 1, F.lit("0")).cast(wide)
        near = lambda m: F.struct(F.abs(m.cast(wide) * tens - value).alias("off"), m.alias("m"))
        tried = F.filter(F.array(v["m"] - 1, v["m"], v["m"] + 1), lambda m: read(m, v["k"]) == v["x"])
        return F.struct(F.array_min(F.transform(tried, near))["m"].alias("m"), v["k"].alias("k"), v["x"].alias("x"))

    def noted(v: Column) -> Column:
        digits = F.rtrim(v["m"].cast("string"), F.lit("0"))
        e = F.length(v["m"].cast("string")) + v["k"] - 1
        n = F.length(digits)
        plain = F.when(n <= e + 1, F.concat(F.rpad(digits, e + 1, F.lit("0")), F.lit(".0"))).otherwise(
            F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."), F.substring(digits, e + 2, n))
        )
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
        power = F.concat(F.when(e < 0, "-").otherwise("+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
        mantissa = F.concat(F.substring(digits, 1, 1), F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), n))).otherwise(""))
        return F.when((e >= 0) & (e < 16), plain).when((e < 0) & (e >= -4), small).otherwise(F.concat(mantissa, F.lit("e"), power))

    def parts(t: Column) -> Column:
        body, power = F.substring_index(t, "E", 1), F.when(F.contains(t, F.lit("E")), F.substring_index(t, "E", -1).cast("int")).otherwise(F.lit(0))
        behind = F.length(F.substring_index(body, ".", -1))
        return F.struct(F.replace(body, F.lit("."), F.lit("")).cast("bigint").alias("m"), (power - behind).alias("k"), F.abs(x).alias("x"))

    long = lambda v: (v["m"] >= 10**15) | (v["x"] < 1e-300)
    cut = lambda v: F.when(long(v), shorter(v)).otherwise(v)
    large = lambda v: (v["m"] >= 10**15) & v["x"].between(1e16, 1e34) & (v["k"] > 0)
    def settled(own: Column) -> Column:
        """Plain notation whose last digit is needed: neither of the two numbers with a digit less reads back."""
        digits = F.replace(F.ltrim(own, F.lit("-")), F.lit("."), F.lit("")).cast("bigint")
        less = F.struct(F.call_function("div", digits, F.lit(10)).alias("m"), (F.lit(1) - F.length(F.substring_index(own, ".", -1))).alias("k"))
        fits = _let(less, lambda v: (read(v["m"], v["k"]) == F.abs(own.cast("double"))) | (read(v["m"] + 1, v["k"]) == F.abs(own.cast("double"))))
        return ~F.contains(own, F.lit("E")) & ~own.endswith("0") & ~fits

    def text(own: Column) -> Column:
        exact = _let(_let(_let(parts(F.abs(x).cast("string")), cut), cut), lambda v: F.when(large(v), nearest(v)).otherwise(v))
        sign = F.when(own.startswith("-"), "-").otherwise("")
        return F.when(_short(own) | settled(own), own).otherwise(F.concat(sign, _let(exact, noted)))

    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), _let(x.cast("string"), text))


# A JSON text in parts: numbers that may be noted otherwise, and runs of up to 64 of all else (strings, other numbers, what
# stands between). Strings are read without backtracking, so long ones need no deep stack.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_FLOAT = r"-?[0-9]++\.[0-9]++(?:E-?[0-9]++)?+"
_OTHER = r"-?[0-9]++(?![.E])|(?=[-0-9.]{1,16}+(?![0-9.E]))-?[0-9]++\.[0-9]++"
_PARTS = rf'(?:{_STRING}|[^"0-9-]++|{_OTHER}){{1,64}}+|{_FLOAT}'


# A float is written as a string between these, which JSON shows as six letters each.
_OPEN, _CLOSE = "\x01", "\x02"
_SHOWN_OPEN, _SHOWN_CLOSE = '"\\u0001', '\\u0002"'


def _ordered(c: Column, kind: T.DataType, without: str = "", floats: Callable[[Column], Column] = lambda x: x) -> Column:
    """The value with its struct fields and map keys in order, and floats as doubles, or as ``floats`` gives them."""
    inner = lambda v, k: _ordered(v, k, floats=floats)
    if isinstance(kind, T.StructType):
        fields = sorted((f for f in kind.fields if f.name != without), key=lambda f: f.name)
        return F.when(c.isNotNull(), F.struct(*[inner(c[f.name], f.dataType).alias(f.name) for f in fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda v: inner(v, kind.elementType)) if isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType, T.FloatType, T.DoubleType)) else c
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        keys = F.array_sort(F.map_keys(c))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: inner(c[k], kind.valueType)))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return floats(c.cast("double"))
    if isinstance(kind, (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.NullType)):
        return c
    raise TypeError(f"no JSON form for {kind.simpleString()}")


def _floats(c: Column, kind: T.DataType, without: str = "") -> list[Column]:
    """Numbers of floats of the value that are not null, to be added up."""
    one = F.lit(1)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [F.when(c.isNull(), 0).otherwise(one)]
    if isinstance(kind, T.StructType):
        return [x for f in kind.fields if f.name != without for x in _floats(c[f.name], f.dataType)]
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType if isinstance(kind, T.MapType) else None
    if inner is None or not _floats(F.lit(None), inner):
        return []
    values = F.map_values(c) if isinstance(kind, T.MapType) else c
    if isinstance(inner, (T.FloatType, T.DoubleType)):
        return [F.coalesce(F.size(F.array_compact(values)), F.lit(0))]
    return [F.coalesce(F.aggregate(values, F.lit(0), lambda n, v: n + reduce(add, _floats(v, inner))), F.lit(0))]


def _finite(c: Column, kind: T.DataType, without: str = "", rule: Callable[[Column], Column] | None = None) -> list[Column]:
    """Conditions that hold where no float of the value is infinite or not a number, or where ``rule`` holds for all."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [F.coalesce(rule(c) if rule else ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(True))]
    if isinstance(kind, T.StructType):
        return [x for f in kind.fields if f.name != without for x in _finite(c[f.name], f.dataType, rule=rule)]
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType if isinstance(kind, T.MapType) else None
    if inner is None or not _finite(F.lit(None), inner):
        return []
    values = F.map_values(c) if isinstance(kind, T.MapType) else c
    return [F.coalesce(F.forall(values, lambda v: reduce(and_, _finite(v, inner, rule=rule))), F.lit(True))]


def _short(own: Column) -> Column:
    """Spark's text of a double that can't be shortened: up to 15 digits in plain notation."""
    return ~F.contains(own, F.lit("E")) & (F.length(own) <= 16)


def canonical_text(c: Column, kind: T.DataType, without: str = "") -> Column:
    """Compact JSON of a value of the given type: keys in order, nulls kept, floats by :func:`float_text`.

    ``without`` names a field of the outermost struct that is left out. Null where a
    float is not finite. Decimals, dates, times and bytes have no JSON form here. The
    value is written once, its floats as marked strings whose marks are then taken off.
    Where a text of the value looks like a mark, its numbers are sought in the JSON.
    """
    as_json = lambda v: F.to_json(F.array(v), {"ignoreNullFields": "false"})
    unwrapped = lambda out: F.substring(out, F.lit(2), F.length(out) - 2)
    counts = _floats(c, kind, without)
    if not counts:
        return _let(_let(as_json(_ordered(c, kind, without)), _small_escapes), unwrapped)
    is_float = lambda x: (F.length(x) <= 30) & x.rlike(f"^{_FLOAT}$") & (F.contains(x, F.lit("E")) | (F.length(x) > 16))
    renoted = lambda x: F.when(is_float(x), _let(x.cast("double"), float_text)).otherwise(x)
    parts = lambda out: F.transform(F.regexp_extract_all(out, F.lit(_PARTS), F.lit(0)), renoted)
    sought = _let(_let(as_json(_ordered(c, kind, without)), _small_escapes), lambda out: F.array_join(parts(out), ""))
    marked = as_json(_ordered(c, kind, without, lambda x: _let(x, lambda v: F.concat(F.lit(_OPEN), float_text(v), F.lit(_CLOSE)))))
    unmarked = lambda out: F.replace(F.replace(out, F.lit(_SHOWN_OPEN), F.lit("")), F.lit(_SHOWN_CLOSE), F.lit(""))
    marks = len(_SHOWN_OPEN) + len(_SHOWN_CLOSE)
    told = _let(
        F.struct(marked.alias("out"), reduce(add, counts).alias("n")),
        lambda v: _let(unmarked(v["out"]), lambda bare: F.when(F.length(v["out"]) - F.length(bare) == v["n"] * marks, _small_escapes(bare))),
    )
    # Most values have short numbers only: their JSON stands as it is.
    short = reduce(and_, _finite(c, kind, without, lambda x: _let(x.cast("double").cast("string"), _short)))
    plain = _let(as_json(_ordered(c, kind, without)), _small_escapes)
    bare = _let(F.when(short, plain).otherwise(F.coalesce(told, sought)), unwrapped)
    return F.when(reduce(and_, _finite(c, kind, without)), bare)


def value_sha(c: Column, kind: T.DataType, without: str = "") -> Column:
    """Hash of the canonical JSON of a value, without one field of a struct if named."""
    return sha(canonical_text(c, kind, without))


def bound_to_itself(c: Column, kind: T.StructType, field: str = "decision_sha256") -> Column:
    """Does a struct carry, in ``field``, the hash of its other fields? False for a null struct or without such a field."""
    if field not in kind.names:
        return F.lit(False)
    return F.coalesce(c[field] == value_sha(c, kind, field), F.lit(False))


def signed(df: DataFrame, c: Column, field: str = "decision_sha256") -> Column:
    """A struct of ``df`` with the hash of its other fields in ``field``; a null struct stays null.

    Whoever reads another field of it alone does not pay for the hash.
    """
    return c.withField(field, value_sha(c, kind_of(df, c), field))


def kind_of(df: DataFrame, c: Column) -> T.DataType:
    """Type of a column of ``df``."""
    return df.select(c.alias("c")).schema["c"].dataType


def object_sha(df: DataFrame, fields: dict[str, Column]) -> Column:
    """Canonical hash of an object given by name."""
    body = F.struct(*[fields[n].alias(n) for n in sorted(fields)])
    return value_sha(body, kind_of(df, body))


def _raw_hash(line: str | None, dropped: str) -> str | None:
    try:
        value = json.loads(line)
        if dropped:
            value.pop(dropped, None)
        body = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)
    except (TypeError, ValueError, AttributeError):
        return None
    return hashlib.sha256(body.encode("utf-8", "surrogatepass")).hexdigest()


def raw_sha(line: Column, dropped: str = "") -> Column:
    """Canonical hash of a JSON source line, without one field if named."""

    @F.pandas_udf(T.StringType())
    def hashed(lines: pd.Series) -> pd.Series:
        return lines.map(lambda s: _raw_hash(s, dropped))

    return hashed(line)


def self_hash_ok(line: Column, field: str) -> Column:
    """Does the object carry the hash of itself without that field?"""
    claimed = F.coalesce(F.get_json_object(line, f"$.{field}"), F.lit(""))
    return F.coalesce(claimed == raw_sha(line, field), F.lit(False))


def manifest_digest(df: DataFrame, fields: list[str]) -> DataFrame:
    """One-row digest of a table, independent of row order.

    Row hashes are summed as four 60-bit lanes, so the partial sums combine on
    the map side and no task ever holds more than one running total.
    """
    return lanes_digest(df.agg(*digest_lanes(fields)))


def lanes_digest(sums: DataFrame) -> DataFrame:
    """row_count and digest of the row that :func:`digest_lanes` gives."""
    lanes = ["row_count", *[F.coalesce(F.col(f"lane{i}"), F.lit(0)).cast("string") for i in range(4)]]
    return sums.select("row_count", sha(F.concat_ws("|", *lanes)).alias("digest"))


def digest_lanes(fields: list[str]) -> list[Column]:
    """Aggregates that fix a table's rows: row_count, and lane0 to lane3."""
    row = sha(F.concat_ws("\x1f", *[F.coalesce(F.col(f).cast("string"), F.lit("\x1e")) for f in fields]))
    lane = lambda i: F.conv(F.substring(row, 1 + 15 * i, 15), 16, 10).cast("decimal(28,0)")
    return [F.count(F.lit(1)).alias("row_count"), *[F.sum(lane(i)).alias(f"lane{i}") for i in range(4)]]
