"""CSV files as text columns in a declared order."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import trim_edges
from . import quotes
from .text import BROKEN_NOTES, scrub, strip_bom

LINE, ERROR = "_line", "_parse_error"


@dataclass(frozen=True)
class CsvOptions:
    """``fields_per_record`` (else ``expected_fields``), if positive, is the width each row must have; 0 takes any.

    ``multi_line``: False promises that no quoted value holds a line end, which saves the scan that looks for them.
    """

    has_header: bool = True
    comma: str = ","
    trim_space: bool = True
    expected_fields: int = 0
    fields_per_record: int = 0
    header_map: dict[str, str] = field(default_factory=dict)
    lazy_quotes: bool = False
    scrub: bool = False
    scrub_pairs: tuple[tuple[str, str], ...] = BROKEN_NOTES
    multi_line: bool | None = None


def header_name(header: str, header_map: dict[str, str]) -> str:
    """A header's target: by the map (edges trimmed on both sides), else lower case with ``_`` for blanks."""
    trimmed = header.lstrip("\ufeff").strip()
    known = {k.strip(): v for k, v in header_map.items()}
    return known.get(trimmed, trimmed.lower().replace(" ", "_"))


def _lines(spark: SparkSession, path: str, has_header: bool) -> DataFrame:
    """Lines that aren't blank, without the first of each file if that is a header: a csv read of one column that has no separator or quote."""
    whole = {"header": has_header, "enforceSchema": True, "sep": "\uffff", "quote": "", "escape": "", "comment": "", "emptyValue": "", "maxCharsPerColumn": -1, "lineSep": "\n"}
    line = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    return spark.read.options(**whole).schema("value string").csv(path).select("value", line.alias("line"))


def read_csv(spark: SparkSession, path: str, options: CsvOptions = CsvOptions(), columns: Sequence[str] | None = None, line: bool = False) -> DataFrame:
    """Declared columns (or all) as text, nulls for '' and for what a file lacks, and ``_parse_error``.

    The error is null for good rows.  Rows of another width than asked for
    have one, and, unless quotes are lazy, rows with a quote inside an
    unquoted value or with text behind a closing one: such an error ends its row at the line's end.
    A quoted value may hold line ends; one that nothing closes makes one row with an error, of its first line, and takes
    the rest of its file, but no other file.  Lines end with a line feed, before which a carriage return doesn't count.
    Without a required width short rows are padded and long ones cut.
    Blank lines don't count; of each file the first other record is the header.
    A header without any of the declared columns is an error, as then every value would be null.

    With ``line`` there is a column ``_line`` too, by which rows sort as they stand in their files.
    Files are split, also where values span lines: then one scan finds at which parts' edges a value is open (see ``quotes``).
    """
    value = F.when(F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    mended = strip_bom(scrub(value, options.scrub_pairs) if options.scrub else value)
    head = spark.read.option("lineSep", "\n").text(path).select(mended.alias("value")).filter(F.trim("value") != "").head()
    if head is None:
        names = [*(columns or []), ERROR]
        schema = ", ".join([f"`{c}` string" for c in names] + [f"{LINE} struct<file: bigint, block: bigint, place: bigint>"] * line)
        return spark.createDataFrame([], schema)
    first = next(csv.reader([head["value"]], delimiter=options.comma), [])
    names = [header_name(h, options.header_map) for h in first] if options.has_header else list(columns or [f"col_{i}" for i in range(max(len(first), options.expected_fields))])
    if columns and options.has_header and not set(columns) & set(names):
        raise ValueError(f"{path}: the header has none of the columns {', '.join(columns)}")
    width = options.fields_per_record or options.expected_fields
    # the corrupt-record column marks rows of another width than the schema's
    fields = [f"f{i}" for i in range(width if width > 0 else max(1, len(names)))]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in [*fields, "_bad"]])
    parse = {"sep": options.comma, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE", "emptyValue": "", "nullValue": None, "maxCharsPerColumn": "-1"}
    edges, lazy = None, options.lazy_quotes
    if options.multi_line is not False:
        lines = quotes.quoted_lines(spark, path, mended, options.comma, lazy)
        edges = quotes.find_edges(lines, lazy)
    if edges:
        records = quotes.spanning_records(lines, edges, options.has_header)
    else:
        records = _lines(spark, path, options.has_header).select(mended.alias("value"), F.lit(False).alias("unclosed"), "line")
    parsed = F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {k: v for k, v in parse.items() if v is not None})
    ok = F.lit(True) if lazy else ~F.contains("value", F.lit('"')) | F.rlike("value", F.lit(quotes.whole(options.comma)))
    rows = records.select(parsed.alias("p"), ok.alias("_ok"), "unclosed", "line").select("p.*", "_ok", "unclosed", "line")
    error = F.when(F.col("unclosed"), F.lit("a quote is never closed")).when(~F.col("_ok"), F.lit("bare quote in a value"))
    if width > 0:
        error = error.when(F.col("_bad").isNotNull(), f"expected {width} fields")
    place = {n: f"f{i}" for i, n in enumerate(names) if i < len(fields)}  # the last of several equal names wins

    def value_of(name: str) -> Column:
        if name not in place:
            return F.lit(None).cast("string").alias(name)
        c = F.col(place[name])
        return F.nullif(trim_edges(c) if options.trim_space else c, F.lit("")).alias(name)

    return rows.select(*[value_of(c) for c in (columns or list(dict.fromkeys(names)))], error.alias(ERROR), *([F.col("line").alias(LINE)] if line else []))
