"""XML files: records by tag, fields and lists by path."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tags
from .csv import ERROR

BLANK = " \t\r\n"


@dataclass(frozen=True)
class XmlOptions:
    """``fields`` and ``lists`` give a path for each column, such as ``A/B[@k='v']``, that ends an element's own path."""

    record_tag: str
    fields: dict[str, str] = field(default_factory=dict)
    lists: dict[str, str] = field(default_factory=dict)
    encoding: str = "UTF-8"


@dataclass(frozen=True)
class Path:
    names: tuple[str, ...]
    attr: str = ""
    value: str = ""


def compile_path(path: str) -> Path:
    """Names and, on the last of them only, a test of an attribute."""
    m = re.fullmatch(r"([^\[\]]+?)(?:\[@([^=\]]+)=([^\]]*)\])?", path.strip())
    if not m or not all(m[1].split("/")):
        raise ValueError(f"not a path: {path!r}")
    return Path(tuple(m[1].split("/")), m[2] or "", (m[3] or "").strip("'\""))


def shard_column(c: Column, tag: str) -> Column:
    """Records by plain search for the tag's ends, as an array; nested same-named elements end early."""
    return F.regexp_extract_all(c, F.lit(rf"(?s)(<{tag}(?=[>/ \t\n\r]).*?</{tag}>)"), F.lit(1))


def extract(record: str, fields: dict[str, Path], lists: dict[str, Path]) -> dict[str, object]:
    """First non-empty text of each field and all of each list, in document order; a text holds all descendants' texts."""
    wanted: dict[str, list[tuple[str, bool, Path]]] = {}
    for many, paths in ((False, fields), (True, lists)):
        for name, p in paths.items():
            wanted.setdefault(p.names[-1], []).append((name, many, p))
    taken: list[tuple[str, bool, int, list[str]]] = []  # in the order in which elements begin
    live: list[tuple[str, bool, int, list[str]]] = []
    for kind, path, text in tags.nodes(record):
        if kind == "open":
            for name, many, p in wanted.get(path[-1], ()):
                if path[-len(p.names) :] == p.names and (not p.attr or tags.attributes(text).get(p.attr) == p.value):
                    live.append((name, many, len(path), []))
                    taken.append(live[-1])
        elif kind == "text":
            for *_, parts in live:
                parts.append(text)
        elif live:
            live = [x for x in live if x[2] < len(path)]
    found: dict[str, object] = {}
    for name, many, _, parts in taken:
        text = "".join(parts).strip(BLANK)
        if text and many:
            found.setdefault(name, []).append(text)
        elif text:
            found.setdefault(name, text)
    return found


def read_xml(spark: SparkSession, path: str, options: XmlOptions, columns: Sequence[str] | None = None) -> DataFrame:
    """Declared columns (texts; lists as arrays), ``_line``, which orders a file's records, and ``_parse_error``.

    A record is an outermost element of the local name, whatever its prefix, declared or not.  Records are read
    leniently: unknown entities and a bare ``&`` stay as they are, an end tag closes what was left open inside its
    element, attributes need no quotes.  A record that can't be read so, or that nothing closes, has an error and nulls.
    Files in UTF-8 are split (see ``tags``); others are read whole, one task each.
    Suffix paths over mixed content are beyond the built-in XPath functions, so this runs in Python.
    """
    columns = list(columns or [*options.fields, *options.lists])
    fields = {k: compile_path(p) for k, p in options.fields.items()}
    lists = {k: compile_path(p) for k, p in options.lists.items()}
    schema = ", ".join([f"`{c}` {'array<string>' if c in lists else 'string'}" for c in columns] + ["_line bigint", f"{ERROR} string"])

    def row(text: str, line: int, error: str | None) -> tuple:
        found: dict[str, object] = {}
        if error is None:
            try:
                found = extract(text, fields, lists)
            except tags.Malformed as e:
                error = str(e)
        return (*(found.get(c) for c in columns), line, error)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([row(*r) for r in zip(batch["value"], batch["line"], batch["error"])], columns=[*columns, "_line", ERROR])

    if options.encoding.upper().replace("-", "") in ("UTF8", "ASCII", "USASCII"):
        return tags.records(spark, path, options.record_tag).mapInPandas(parse, schema)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mark = tags.marks(options.record_tag)
        none = tags.cut(tags.Edges({}, {}), mark, "", False)
        for batch in batches:
            for content in batch["content"]:
                part = pa.RecordBatch.from_pydict({"file": [0], "block": [0], "value": [bytes(content).decode(options.encoding)], "single": [True]})
                yield from parse(b.to_pandas() for b in none(iter([part])))

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(whole, schema)


#: Tags of one public bibliography's articles and the columns they give; fixed values.
ARTICLE_TAGS = {"pmid": "PMID", "article_title": "ArticleTitle", "journal_title": "Title", "publication_year": "Year", "country": "Country"}


def articles(records: DataFrame, xml: str = "value", authors: int = 16) -> DataFrame:
    """Fixed fields of article records by regular expressions, in the JVM."""
    one = lambda tag, more="": F.nullif(F.trim(F.regexp_extract(xml, rf"(?s)<{tag}{more}[^>]*>(.*?)</{tag}>", 1)), F.lit(""))
    names = F.slice(F.regexp_extract_all(xml, F.lit(r"(?s)<LastName>(.*?)</LastName>"), F.lit(1)), 1, authors)
    return records.select(*[one(tag).alias(c) for c, tag in ARTICLE_TAGS.items()], one("ArticleId", r"\s[^>]*IdType=\"doi\"").alias("doi"), names.alias("authors"))
