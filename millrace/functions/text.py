"""Text functions as column expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_edge_space(c: Column) -> Column:
    """True when the first or last character is a blank, tab or line end."""
    return F.left(c, F.lit(1)).isin(" ", "\t", "\n", "\r") | F.right(c, F.lit(1)).isin(" ", "\t", "\n", "\r")


#: Unicode's white space; fixed values.
WHITE = "\t\n\x0b\x0c\r \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def trim_unicode(c: Column) -> Column:
    """Strips every Unicode white space character from both ends."""
    return F.trim(c, F.lit(WHITE))


def trim_edges(c: Column) -> Column:
    """``trim_unicode`` for values with an ASCII blank at an edge; others stay as they are."""
    return F.when(has_edge_space(c), trim_unicode(c)).otherwise(c)


def normalize(c: Column) -> Column:
    """No-break spaces become blanks, then the edges are trimmed."""
    return trim_edges(F.replace(c, F.lit("\u00a0"), F.lit(" ")))


def strip_html(c: Column) -> Column:
    """Drops tags, stray ``>`` and whatever follows an unclosed ``<``."""
    return F.regexp_replace(c, r"(?s)<[^>]*>|>|<[^>]*\z", "")


def collapse_whitespace(c: Column) -> Column:
    """Runs of blanks, tabs and line ends become one blank; the edges are trimmed."""
    return trim_unicode(F.regexp_replace(c, r"[ \t\n\r]+", " "))


def normalize_text(c: Column) -> Column:
    return collapse_whitespace(strip_html(c))


def extract_between(c: Column, start: str, end: str) -> Column:
    """What stands between the first ``start`` and the next ``end``; null when either is missing or nothing is between.

    An empty marker means that edge of the text.
    """
    after = c if not start else F.when(F.locate(start, c) > 0, F.substring(c, F.locate(start, c) + len(start), F.length(c)))
    got = after if not end else F.when(F.locate(end, after) > 0, F.substring(after, F.lit(1), F.locate(end, after) - 1))
    return F.nullif(got, F.lit(""))


def extract_ints(c: Column) -> Column:
    """All maximal digit runs as integers; null when one of them doesn't fit 64 bits or isn't ASCII."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{Nd}+)"), F.lit(1))
    ints = F.transform(runs, lambda x: F.when(F.rlike(x, F.lit(r"\A[0-9]+\z")), x.try_cast("bigint")))
    return F.when(~F.exists(ints, lambda x: x.isNull()), ints)


def safe_filename(url: Column) -> Column:
    """The query part with every run of other than ASCII letters and digits replaced by ``_``; without one the SHA-1 of the url."""
    query = F.regexp_extract(url, r"\A[^?#]*\?([^#]*)", 1)
    return F.coalesce(F.nullif(F.regexp_replace(query, "[^a-zA-Z0-9]+", "_"), F.lit("")), F.sha1(url.cast("binary")))


def truncate_name(c: Column) -> Column:
    """Names of more than 63 bytes keep their first 10 and last 53 characters."""
    return F.when(F.octet_length(c) > 63, F.concat(F.left(c, F.lit(10)), F.right(c, F.lit(53)))).otherwise(c)


def detect_format(c: Column) -> Column:
    """json, xml, csv or unknown, from how a sample begins."""
    t = trim_unicode(c)
    head = F.left(t, F.lit(256))
    return (
        F.when(t == "", "unknown")
        .when(F.left(t, F.lit(1)).isin("{", "["), "json")
        .when(F.startswith(t, F.lit("<")), "xml")
        .when(F.contains(head, F.lit("<")) & F.contains(head, F.lit(">")), "xml")
        .otherwise("csv")
    )


def strip_line_end(c: Column) -> Column:
    """Drops a final newline, then a final carriage return."""
    return F.regexp_replace(F.regexp_replace(c, r"\n\z", ""), r"\r\z", "")


def split_name(c: Column) -> Column:
    """The non-empty parts of a dotted name."""
    return F.filter(F.split(c, r"\."), lambda x: x != "")


def field_name(name: str) -> str:
    """A header as a field name: lower case, no accents, other characters dropped, separators to one ``_``; ``col`` if nothing is left."""
    plain = "".join(ch for ch in unicodedata.normalize("NFD", name.strip().lower()) if unicodedata.category(ch) != "Mn")
    kept = re.sub(r"[^a-z0-9_ .\-]", "", unicodedata.normalize("NFC", plain))
    return re.sub(r"[_ .\-]+", "_", kept).strip("_") or "col"


def short_name(name: str) -> str:
    """Driver-side ``truncate_name``."""
    return name[:10] + name[-53:] if len(name.encode()) > 63 else name


@F.pandas_udf(T.StringType())
def field_name_column(names: pd.Series) -> pd.Series:
    """``field_name`` on a column; Spark has no built-in decomposition of accents."""
    return names.map(lambda n: None if n is None else field_name(n))


def ascii_field_name(c: Column) -> Column:
    """``field_name`` for ASCII text, without leaving the JVM."""
    kept = F.regexp_replace(F.lower(trim_unicode(c)), r"[^a-z0-9_ .\-]", "")
    name = F.regexp_replace(F.regexp_replace(kept, r"[_ .\-]+", "_"), r"\A_+|_+\z", "")
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("col"))


def delimiter(text: str) -> str:
    """The first character, or a comma."""
    return text[0] if text and text[0] != "\ufffd" else ","
