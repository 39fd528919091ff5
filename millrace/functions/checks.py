"""Predicates on values, contracts of fields, and reasons of rejection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .coerce import FALSE_WORDS, TRUE_WORDS, quoted
from .layouts import CZ, DATE_LAYOUTS, ISO, TIMESTAMP_LAYOUTS, parse, parse_date
from .text import trim_edges, trim_unicode

#: Contract type names and the kind that is checked; any other kind is accepted.
CONTRACT_KINDS = {
    **dict.fromkeys(("bigint", "int8", "integer", "int4", "int2", "int"), "int"),
    **dict.fromkeys(("boolean", "bool"), "bool"),
    **dict.fromkeys(("date", "timestamp", "timestamptz"), "date"),
    **dict.fromkeys(("text", "string", ""), "string"),
}
#: Words that inference takes for booleans; fixed values.
PROBE_WORDS = ("true", "false", "t", "f", "yes", "no", "y", "n", "1", "0")


def contract_kind(name: str) -> str:
    name = name.strip().lower()
    return CONTRACT_KINDS.get(name, name)


def is_filled(c: Column) -> Column:
    """Neither null nor ''."""
    return c.isNotNull() & (c.cast("string") != "")


def plain_int(c: Column) -> Column:
    """Whether a text is nothing but the digits of an integer that surely fits: most are, and need neither trimming nor a cast that can fail."""
    return F.rlike(c, F.lit(r"\A[+-]?[0-9]{1,18}\z"))


def as_int(c: Column) -> Column:
    """The value of a trimmed base-10 integer of 64 bits, else null."""
    t = trim_unicode(c)
    return F.when(plain_int(c), c.try_cast("bigint")).when(F.rlike(t, F.lit(r"\A[+-]?[0-9]+\z")), t.try_cast("bigint"))


def is_int(c: Column) -> Column:
    """A trimmed base-10 integer of 64 bits."""
    return as_int(c).isNotNull()


def is_real(c: Column) -> Column:
    """A number that isn't an integer in form."""
    t = trim_unicode(c)
    number = F.rlike(t, F.lit(r"(?i)\A[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|nan|inf(inity)?|0x[0-9a-f]+(\.[0-9a-f]*)?p[+-]?[0-9]+)\z"))
    return F.coalesce(number & ~is_int(c), F.lit(False))


def is_bool_word(c: Column, words: Sequence[str] = PROBE_WORDS) -> Column:
    return F.coalesce(F.lower(trim_unicode(c)).isin(*words), F.lit(False))


def is_date(c: Column) -> Column:
    """By any of the date layouts, which all begin with a digit and have 8 to 11 characters."""
    t = trim_unicode(c)
    fits = F.length(t).between(8, 11) & F.left(t, F.lit(1)).between("0", "9")
    return F.coalesce(F.when(fits, F.coalesce(*[parse_date(t, x) for x in DATE_LAYOUTS]).isNotNull()), F.lit(False))


def is_timestamp(c: Column) -> Column:
    """By any of the timestamp layouts, which all begin with a digit and have 19 characters or more."""
    t = trim_unicode(c)
    fits = (F.length(t) >= 19) & F.left(t, F.lit(1)).between("0", "9")
    return F.coalesce(F.when(fits, F.coalesce(*[parse(t, x) for x in TIMESTAMP_LAYOUTS]).isNotNull()), F.lit(False))


def int_like(c: Column, kind: T.DataType) -> Column:
    """Integers, whole floats, base-10 texts; the empty text passes."""
    if isinstance(kind, T.IntegralType):
        return F.lit(True)
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.floor(c) == c
    if isinstance(kind, T.StringType):
        return (c == "") | F.coalesce(F.rlike(c, F.lit(r"\A[+-]?[0-9]+\z")) & c.try_cast("bigint").isNotNull(), F.lit(False))
    return F.lit(False)


def bool_like(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.lit(True)
    if isinstance(kind, T.StringType):
        low = F.lower(trim_unicode(c))
        return (low == "") | low.isin(*TRUE_WORDS, *FALSE_WORDS)
    return F.lit(False)


def date_like(c: Column, kind: T.DataType) -> Column:
    """Typed dates and timestamps; of texts only the empty one."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(True)
    return c == "" if isinstance(kind, T.StringType) else F.lit(False)


def shown(c: Column, kind: T.DataType) -> Column:
    """A value as text: numbers in their shortest form, times in RFC 3339."""
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd'T'00:00:00'Z'")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.regexp_replace(c.cast("string"), r"\.0\z", "")
    return c.cast("string")


def require(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows in which every field exists and is neither null nor ''.  A field that isn't a column drops all rows."""
    if any(f not in df.columns for f in fields):
        return df.limit(0)
    return df.filter(reduce(lambda a, b: a & b, (is_filled(F.col(f"`{f}`")) for f in fields), F.lit(True)))


def stream_reason(df: DataFrame, required: Sequence[str], kinds: dict[str, str]) -> Column:
    """Why a typed row fails, else null: required columns in order, then the kinds in the order of the columns."""
    checks = {"int": int_like, "bool": bool_like, "date": date_like}
    tests = [F.when(F.col(f"`{f}`").isNull(), F.lit(f'required field "{f}" missing')) for f in required if f in df.columns]
    for name in df.columns:
        kind = contract_kind(kinds.get(name, ""))
        if kind in checks:
            c = F.col(f"`{name}`")
            ok = checks[kind](c, df.schema[name].dataType)
            tests.append(F.when(c.isNotNull() & ~ok, F.concat(F.lit(f'field "{name}": '), quoted(c), F.lit(f" not a valid {kind}"))))
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


@dataclass(frozen=True)
class Field:
    """One field of a contract."""

    name: str
    type: str = "text"
    required: bool = False
    nullable: bool = False
    enum: tuple[str, ...] = ()
    layout: str = ""
    truthy: tuple[str, ...] = ()
    falsy: tuple[str, ...] = ()

    @staticmethod
    def of(d: dict) -> "Field":
        return Field(d.get("name", ""), d.get("type", ""), bool(d.get("required")), bool(d.get("nullable")), *(tuple(d.get(k) or ()) if k != "layout" else d.get(k) or "" for k in ("enum", "layout", "truthy", "falsy")))


def contract_reason(df: DataFrame, fields: Sequence[Field], layout: str = CZ) -> Column:
    """Why a row breaks the contract, else null: the first field, in order, that is missing, of another kind or outside its enum."""
    tests = []
    for f in fields:
        there = f.name in df.columns
        c = F.col(f"`{f.name}`") if there else F.lit(None).cast("string")
        kind, filled = df.schema[f.name].dataType if there else T.StringType(), is_filled(c)
        if f.required:
            tests.append(F.when(~filled, F.lit(f'required field "{f.name}" missing')))
        text, what = shown(c, kind), contract_kind(f.type)
        fail = lambda bad, tail: F.when(filled & bad, F.concat(F.lit(f'field "{f.name}": '), tail))  # noqa: B023, E731
        is_text = isinstance(kind, T.StringType)
        if what == "int" and is_text:
            t = trim_edges(c)
            ok = F.coalesce(F.rlike(t, F.lit(r"\A[+-]?[0-9]+\z")) & t.try_cast("bigint").isNotNull(), F.lit(False))
            tests.append(fail(~ok, F.concat(quoted(c), F.lit(" not an int"))))
        elif what == "int" and not isinstance(kind, T.NumericType):
            tests.append(fail(F.lit(True), F.lit("type not int-convertible")))
        elif what == "bool" and not isinstance(kind, T.BooleanType):
            yes, no = (f.truthy, f.falsy) if f.truthy or f.falsy else (TRUE_WORDS, FALSE_WORDS)
            low = F.lower(trim_edges(text))
            tests.append(fail((low != "") & ~low.isin(*[w.lower() for w in (*yes, *no)]), F.concat(quoted(text), F.lit(" not a recognized boolean"))))
        elif what == "date" and is_text:
            t = trim_edges(c)
            tries = [parse_date(t, x) for x in dict.fromkeys(filter(None, (f.layout, ISO, layout)))]
            tests.append(fail((t != "") & F.coalesce(*tries).isNull(), F.concat(F.lit("invalid date "), quoted(t))))
        elif what == "date" and not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            tests.append(fail(F.lit(True), F.lit("type not date-convertible")))
        if f.enum:
            tests.append(fail(~text.isin(*f.enum), F.concat(quoted(text), F.lit(f" not in enum [{' '.join(f.enum)}]"))))
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")
