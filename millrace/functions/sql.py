"""The package's functions for SQL users: coercers, checks and text functions by name, and record parsers as table functions.

A scalar function is registered as SQL text made from its own expression, so
it is inlined and runs in the JVM like any other expression.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from . import checks, text
from .coerce import to_bool, to_date, to_float, to_int, to_timestamp

PREFIX = "millrace_"
#: Functions of one text, by their names behind the prefix.
FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    "to_int": to_int,
    "to_float": to_float,
    "to_bool": to_bool,
    "to_date": to_date,
    "to_timestamp": to_timestamp,
    "is_filled": checks.is_filled,
    "is_int": checks.is_int,
    "is_real": checks.is_real,
    "is_bool": checks.is_bool_word,
    "is_date": checks.is_date,
    "is_timestamp": checks.is_timestamp,
    "normalize": text.normalize,
    "normalize_text": text.normalize_text,
    "strip_html": text.strip_html,
    "safe_filename": text.safe_filename,
    "detect_format": text.detect_format,
}


def register_function(spark: SparkSession, name: str, f: Callable[[Column], Column]) -> None:
    """Names an expression of one text for this session's SQL. Expressions with lambdas have no SQL text and are refused."""
    df = spark.createDataFrame([], "v string").select(f(F.col("v")).alias("o"))
    body = df._jdf.queryExecution().analyzed().expressions().head().child().sql()
    if "lambdafunction(" in body:
        raise ValueError(f"{name}: an expression with a lambda can't be a SQL function")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v STRING) RETURNS {df.schema[0].dataType.simpleString()} RETURN {body}")


@udtf(returnType="number int, fields map<string, string>, error string")
class XmlRecords:
    """Outermost elements of a name in a text, with the first text at each path: ``(text, tag, map(column, path, ...))``."""

    def eval(self, text: str | None, tag: str, paths: dict) -> Iterator[tuple]:
        from ..sources import tags, xml

        wanted = {k: xml.compile_path(p) for k, p in paths.items()}
        for number, record in enumerate(tags.shards(text or "", tag), 1):
            try:
                yield number, xml.extract(record, wanted, {}), None
            except tags.Malformed as e:
                yield number, {}, str(e)


@udtf(returnType="number int, fields map<string, string>, error string")
class JsonRecords:
    """Records of a JSON text of any shape, with their fields as texts."""

    def eval(self, text: str | None) -> Iterator[tuple]:
        from ..sources import json as source

        number = 0
        try:
            for value in source.values_of(text or ""):
                for record in source.expand(value):
                    number += 1
                    yield number, {k: source.text_of(v) for k, v in record.items()}, None
        except json.JSONDecodeError as e:
            yield number + 1, {}, str(e)


def register(spark: SparkSession, prefix: str = PREFIX) -> list[str]:
    """Registers all functions for this session and returns their names; a null or odd argument gives what the expression gives for it."""
    for name, f in FUNCTIONS.items():
        register_function(spark, prefix + name, f)
    tables = {"xml_records": XmlRecords, "json_records": JsonRecords}
    for name, f in tables.items():
        spark.udtf.register(prefix + name, f)
    return [prefix + name for name in (*FUNCTIONS, *tables)]
