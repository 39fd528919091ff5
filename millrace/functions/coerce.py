"""Typed coercion of strings, with the reason of the first failure in a row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .layouts import CZ, ISO, parse, parse_date
from .text import trim_edges, trim_unicode

#: Words for true and false; fixed values.
TRUE_WORDS = ("1", "t", "true", "yes", "y", "ano")
FALSE_WORDS = ("0", "f", "false", "no", "n", "ne")
#: Type names and the kind that coerces them; all others are text.
KINDS = {
    **dict.fromkeys(("int", "integer", "bigint", "int2", "int4", "int8"), "int"),
    **dict.fromkeys(("bool", "boolean"), "bool"),
    "date": "date",
    **dict.fromkeys(("float", "real", "double"), "float"),
    **dict.fromkeys(("timestamp", "timestamptz"), "timestamp"),
}
#: The narrow vocabulary, for exact compatibility.
EXACT_KINDS = {"int": "int", "bool": "bool", "date": "date"}
REJECT = "_reject_reason"


def prepared(c: Column) -> Column:
    """Trimmed, with '' as null: what every coercion starts from."""
    return F.nullif(trim_edges(c.cast("string")), F.lit(""))


def to_int(c: Column) -> Column:
    """A base-10 64-bit integer; text with a point counts when its value is whole."""
    d = c.try_cast("double")
    whole = d.try_cast("bigint")
    return F.when(F.rlike(c, F.lit(r"\A[+-]?[0-9]+\z")), c.try_cast("bigint")).when(
        F.rlike(c, F.lit(r"\A[+-]?([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z")) & (whole.cast("double") == d), whole
    )


def to_float(c: Column) -> Column:
    return F.when(F.rlike(c, F.lit(r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z")), c.try_cast("double"))


def to_bool(c: Column, truthy: Sequence[str] = (), falsy: Sequence[str] = ()) -> Column:
    """By vocabulary; either list given replaces both defaults."""
    yes, no = (truthy, falsy) if truthy or falsy else (TRUE_WORDS, FALSE_WORDS)
    low = F.lower(c)
    return F.when(low.isin(*[w.lower() for w in yes]) if yes else F.lit(False), True).when(low.isin(*[w.lower() for w in no]) if no else F.lit(False), False)


def to_date_cz(c: Column) -> Column:
    """``dd.mm.yyyy`` at the start; days past the month's end roll over and text behind is ignored."""
    # only digits are cast: a cast that fails, even a tolerant one, costs an exception
    shaped = F.when(F.rlike(c, F.lit(r"\A[0-9]{2}\.[0-9]{2}\.[0-9]{4}")), c)
    part = lambda at, n: F.substring(shaped, at, n).cast("int")
    day, month, year = part(1, 2), part(4, 2), part(7, 4)
    return F.when(month.between(1, 12) & day.between(1, 31) & (year > 0), F.date_add(F.make_date(year, month, F.lit(1)), day - 1))


def to_date(c: Column, layout: str = CZ) -> Column:
    """The tolerant day-first form first if it is the layout (or none is given), then the layout, ISO, and day-first at last."""
    tries = []
    if layout in ("", CZ):
        tries.append(to_date_cz(c))
    if layout and layout != CZ:
        tries.append(parse_date(c, layout))
    if layout != ISO:
        tries.append(parse_date(c, ISO))
    if layout not in ("", CZ):
        tries.append(to_date_cz(c))
    return F.coalesce(*tries)


def to_timestamp(c: Column, layout: str = "") -> Column:
    from .layouts import RFC3339, TIMESTAMP_LAYOUTS

    order = dict.fromkeys(([layout] if layout else []) + [RFC3339, *TIMESTAMP_LAYOUTS[2:]])
    return F.coalesce(*[parse(c, x) for x in order], parse(c, ISO))


@dataclass(frozen=True)
class Coercion:
    """How one column is typed."""

    kind: str = "text"
    layout: str = CZ
    truthy: tuple[str, ...] = field(default=())
    falsy: tuple[str, ...] = field(default=())

    def apply(self, c: Column) -> Column:
        if self.kind == "int":
            return to_int(c)
        if self.kind == "bool":
            return to_bool(c, self.truthy, self.falsy)
        if self.kind == "date":
            return to_date(c, self.layout)
        if self.kind == "float":
            return to_float(c)
        if self.kind == "timestamp":
            return to_timestamp(c, self.layout if ":" in self.layout else "")
        return c


def quoted(c: Column) -> Column:
    """The value in double quotes with backslash escapes."""
    text = c.cast("string")
    for raw, shown in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(shown))
    return F.concat(F.lit('"'), text, F.lit('"'))


def coerce(df: DataFrame, plan: dict[str, Coercion], empty_rejects: bool = False) -> DataFrame:
    """All columns of ``df`` typed by ``plan`` (text where it has none), and the reason of the first failing column.

    Null and empty values stay null and don't fail, unless ``empty_rejects``,
    with which an empty text fails for every kind but text.  A projection only.
    """
    # one projection for each step, as each refers to the one before more than once
    names = df.columns
    df = df.select(*[F.col(f"`{c}`") for c in names], *[prepared(F.col(f"`{c}`")).alias(f"_text {c}") for c in names])
    typed = [plan.get(c, Coercion()).apply(F.col(f"`_text {c}`")).alias(f"_typed {c}") for c in names]
    df = df.select(*[F.col(f"`{c}`").alias(f"_raw {c}") for c in names], *[F.col(f"`_text {c}`") for c in names], *typed)
    reasons = []
    for c in names:
        if plan.get(c, Coercion()).kind != "text":
            text = F.col(f"`_text {c}`")
            failed = text.isNotNull() & F.col(f"`_typed {c}`").isNull()
            if empty_rejects:
                failed = failed | (trim_unicode(F.col(f"`_raw {c}`").cast("string")) == "")
            reasons.append(F.when(failed, F.concat(F.lit(f'field "{c}": cannot coerce '), quoted(F.coalesce(text, F.lit(""))))))
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    return df.select(*[F.col(f"`_typed {c}`").alias(c) for c in names], reason.alias(REJECT))


def where(df: DataFrame, condition: Column) -> DataFrame:
    """A filter that stays above the projections below it.

    Pushed down, a test of a reason would repeat every expression behind it;
    a value that isn't deterministic keeps it in place.
    """
    return df.withColumn("_fence", F.monotonically_increasing_id()).filter(condition & (F.col("_fence") >= 0)).drop("_fence")


def coerce_keep(c: Column, kind: str, layout: str = ISO) -> Column:
    """Record-style coercion: the typed value as text, or the text itself where it can't be typed.  Kind names are case-sensitive."""
    if kind == "int":
        typed = F.when(F.rlike(c, F.lit(r"\A[+-]?[0-9]+\z")), c.try_cast("bigint"))
    elif kind == "bool":
        typed = F.when(c.isin("1", "t", "T", "TRUE", "true", "True"), True).when(c.isin("0", "f", "F", "FALSE", "false", "False"), False)
    elif kind == "date":
        typed = parse_date(c, layout)
    else:
        return c
    return F.coalesce(typed.cast("string"), c)
