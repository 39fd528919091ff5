"""Date and timestamp layouts, written by example (``02.01.2006``) as pipeline specs do."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO, CZ = "2006-01-02", "02.01.2006"
#: Layouts tried for dates and timestamps, in order.
DATE_LAYOUTS = ("2006-01-02", "02.01.2006", "01.02.2006", "02/01/2006", "01/02/2006", "2 Jan 2006", "02-Jan-2006", "2006/01/02", "20060102")
RFC3339_NANO, RFC3339 = "2006-01-02T15:04:05.999999999Z07:00", "2006-01-02T15:04:05Z07:00"
TIMESTAMP_LAYOUTS = (
    RFC3339_NANO,
    RFC3339,
    "2006-01-02 15:04:05",
    "2006-01-02 15:04:05.999999999",
    "2006/01/02 15:04:05",
    "02/01/2006 15:04:05",
    "01/02/2006 15:04:05",
    "2006-01-02T15:04:05Z0700",
    "2006-01-02 15:04:05 -0700",
)
#: Pieces of a layout: example text, Java pattern, expression that the text must match.
PIECES = (
    (".999999999", "", ""),
    ("2006", "yyyy", "[0-9]{4}"),
    ("Jan", "MMM", "[A-Za-z]{3}"),
    ("Z07:00", "XXX", "(?:Z|[+-][0-9]{2}:[0-9]{2})"),
    ("Z0700", "XX", "(?:Z|[+-][0-9]{4})"),
    ("-0700", "xx", "[+-][0-9]{4}"),
    ("01", "MM", "[0-9]{2}"),
    ("02", "dd", "[0-9]{2}"),
    ("15", "HH", "[0-9]{2}"),
    ("04", "mm", "[0-9]{2}"),
    ("05", "ss", "[0-9]{2}"),
    ("2", "d", "[0-9]{1,2}"),
)


@dataclass(frozen=True)
class Layout:
    """A layout as a Java pattern and an anchored guard."""

    pattern: str
    guard: str
    has_time: bool
    has_month_name: bool
    has_fraction: bool


def compile_layout(layout: str) -> Layout:
    """Reads a layout piece by piece; fractions of a second are allowed after any seconds."""
    pattern, guard, at, fraction = "", "", 0, False
    while at < len(layout):
        for text, java, expression in PIECES:
            if layout.startswith(text, at):
                pattern, guard, at = pattern + java, guard + expression, at + len(text)
                if text == "05":
                    pattern, guard, fraction = pattern + "[.SSSSSSSSS][.SSSSSS][.SSS]", guard + r"(?:\.[0-9]+)?", True
                break
        else:
            ch = layout[at]
            pattern += f"'{ch}'" if ch.isalpha() else ch
            guard += f"\\{ch}" if not ch.isalnum() and ch != " " else ch
            at += 1
    return Layout(pattern, rf"\A{guard}\z", "15" in layout, "Jan" in layout, fraction)


def parse(c: Column, layout: str) -> Column:
    """The value as a timestamp by one layout, null where it doesn't follow it.  Strict: no roll-over, no trailing text."""
    spec = compile_layout(layout)
    text = F.initcap(c) if spec.has_month_name else c
    if spec.has_fraction:  # fractions to nine digits, as one pattern can't take any number of them
        base = F.regexp_replace(text, r"(:[0-9]{2})\.[0-9]+", "$1")
        digits = F.left(F.rpad(F.regexp_extract(text, r":[0-9]{2}\.([0-9]+)", 1), 6, "0"), F.lit(6)).try_cast("bigint")
        whole = F.try_to_timestamp(base, F.lit(spec.pattern.replace("[.SSSSSSSSS][.SSSSSS][.SSS]", "")))
        value = F.timestamp_micros(F.unix_micros(whole) + F.coalesce(digits, F.lit(0)))
    else:
        value = F.try_to_timestamp(text, F.lit(spec.pattern))
    return F.when(F.rlike(c, F.lit(spec.guard)), value)


def parse_date(c: Column, layout: str) -> Column:
    return parse(c, layout).cast("date")


def preference(layout: str) -> int:
    """Weight between layouts that fit equally often; fixed values."""
    if layout in TIMESTAMP_LAYOUTS:
        return {RFC3339_NANO: 3, RFC3339: 2}.get(layout, 1)
    day_first, iso, month_first = ("02.01.2006", "02/01/2006", "2 Jan 2006", "02-Jan-2006"), ("2006-01-02", "2006/01/02", "20060102"), ("01.02.2006", "01/02/2006")
    return 3 if layout in day_first else 2 if layout in iso else 1 if layout in month_first else 0


def best_layout(scores: dict[str, int]) -> str:
    """The layout with the most matches, then preference, then order; '' if none matched."""
    order = list(scores)
    best = max(order, key=lambda x: (scores[x], preference(x), -order.index(x)), default="")
    return best if best and scores[best] > 0 else ""
