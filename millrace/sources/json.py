"""JSON files of any of four shapes: array, envelope, single object, concatenated objects."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import elements


def values_of(text: str) -> Iterator[object]:
    """Top-level values that follow each other."""
    decoder, at, end = json.JSONDecoder(parse_float=str), 0, len(text)
    while True:
        while at < end and text[at] in elements.SEPARATORS:
            at += 1
        if at >= end:
            return
        value, at = decoder.raw_decode(text, at)
        yield value


def expand(value: object) -> list[dict]:
    """Records of one value: objects of an array, those of the largest array of objects in it (ties: by name), or itself."""
    if isinstance(value, list):
        return [x for x in value if isinstance(x, dict)]
    if not isinstance(value, dict):
        return []
    inner = {k: [x for x in v if x is not None] for k, v in value.items() if isinstance(v, list)}
    inner = {k: v for k, v in inner.items() if v and all(isinstance(x, dict) for x in v)}
    if inner:
        return inner[min(inner, key=lambda k: (-len(inner[k]), k))]
    return [value]


def text_of(value: object) -> str | None:
    """A scalar as text, anything nested as JSON."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    return json.dumps(value, ensure_ascii=False) if isinstance(value, (dict, list)) else str(value)


def read_json(spark: SparkSession, path: str, columns: Sequence[str], header_map: dict[str, str] | None = None, strict: bool = False, whole_bytes: int = 1 << 26) -> DataFrame:
    """Declared columns as text and ``_line``, which orders a file's records; keys are renamed by the map.

    Each file's own shape counts: an array of records, one or many objects that follow each other, with or without line
    ends, where one that holds arrays of objects is an envelope of the largest.  Files of any shape are split (see
    ``elements``): a task holds one record or small envelope at a time.  A file with an object that fills parts of more than
    ``whole_bytes`` together is taken for one envelope, whose records are read one by one.  A file that
    doesn't begin with a record, that isn't JSON, or with ``strict`` an array's element that isn't an object, is an error.
    """
    names, rename = list(columns), dict(header_map or {})

    def rows(text: str, expands: bool, line: int) -> Iterator[tuple]:
        value = json.loads(text, parse_float=str)
        for k, r in enumerate(expand(value) if expands else [value]):
            r = {rename.get(x, x): v for x, v in r.items()}
            yield (*(text_of(r.get(n)) for n in names), line, k)

    def frame(found: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(found, columns=[*names, "_line", "_k"], dtype=object)

    def of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for records in elements.Cutter(edges, strict).run(batches):
            yield pa.RecordBatch.from_pandas(frame([r for text, expands, line, *_ in records for r in rows(text, expands, line)]), arrow, preserve_index=False)

    def of_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        for records in elements.Cutter(edges, strict, pieces=True).run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*records), kinds)], names=["value", "expands", "line", "file", "origin", "block"])

    def of_joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:  # the rest is no object
            yield frame([r for text, expands, line in zip(b["value"], b["expands"], b["line"]) if text.startswith("{") for r in rows(text, expands, line)])

    schema = ", ".join([f"`{n}` string" for n in names] + ["_line bigint, _k bigint"])
    arrow = pa.schema([*((n, pa.string()) for n in names), ("_line", pa.int64()), ("_k", pa.int64())])
    parts = elements.parts_of(spark, path)
    edges = elements.find_edges(parts, whole_bytes)
    got = parts.mapInArrow(of_parts, schema)
    if files := elements.crossed(edges):
        some = parts.filter("NOT single")
        pieces = (some.filter(F.col("file").isin(files)) if len(files) <= 1000 else some).mapInArrow(of_pieces, "value string, expands boolean, line long, file long, origin long, block long")
        joined = pieces.groupBy("file", "origin").agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("all"), F.max("expands").alias("expands"), F.max("line").alias("line"))
        got = got.unionByName(joined.select(F.array_join("all.value", "").alias("value"), "expands", "line").mapInPandas(of_joined, schema))
    # an envelope has more bytes than records, so numbers don't meet
    return got.select(*[F.col(f"`{n}`") for n in names], (F.col("_line") + F.col("_k")).alias("_line"))


def read_ndjson(spark: SparkSession, path: str, columns: Sequence[str], header_map: dict[str, str] | None = None) -> DataFrame:
    """One object a line, parsed in the JVM on splittable files; lines that aren't objects are dropped."""
    names = {v: k for k, v in (header_map or {}).items()}
    rows = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("m")).filter(F.size("m") > 0)
    return rows.select(*[F.col("m").getItem(names.get(c, c)).alias(c) for c in columns])


def json_field(c, name: str):
    """One top-level field of a JSON text, by variant."""
    return F.try_variant_get(F.try_parse_json(c), f"$.{name}", "string")
