"""Profiles of samples: types, layouts, error buckets, XML paths, HTML windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.checks import is_bool_word, is_date, is_int, is_real, is_timestamp
from ..functions.coerce import where
from ..functions.layouts import DATE_LAYOUTS, TIMESTAMP_LAYOUTS, parse
from ..functions.text import collapse_whitespace, strip_html, trim_unicode

#: Tests in the order in which inference takes the first that all values pass.
TESTS = (("integer", is_int), ("boolean", is_bool_word), ("real", is_real))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, type, filled, all_filled): one pass, one row for each column.

    Blank values say nothing; a column of blanks only is text.  Dates and
    times: all values are dates or timestamps; ``timestamp`` if any has a time.
    """
    columns = list(columns or df.columns)
    # values of all columns under each other: the tests are compiled once, not once for each column
    values = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(columns)])).alias("x")).select("x.i", trim_unicode(F.col("x.v")).alias("v"))
    filled = F.coalesce(F.col("v") != "", F.lit(False))
    tested = values.select("i", filled.alias("filled"), *[test(F.col("v")).alias(k) for k, test in TESTS], is_date(F.col("v")).alias("date"), is_timestamp(F.col("v")).alias("time"))
    every = lambda test: F.bool_and(F.when(F.col("filled"), test))
    kinds = [every(F.col(k)).alias(k) for k, _ in TESTS] + [every(F.col("date")).alias("date"), every(F.col("date") | F.col("time")).alias("timestamp")]
    found = tested.groupBy("i").agg(*kinds, F.count_if("filled").alias("n"), F.bool_and("filled").alias("all_filled"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "i int, column string")
    kind = F.when(F.coalesce("n", F.lit(0)) == 0, "text")
    for k in ("integer", "boolean", "real", "date", "timestamp"):
        kind = kind.when(F.col(k), k)
    return names.join(found, "i", "left").select("column", kind.otherwise("text").alias("type"), F.coalesce("n", F.lit(0)).cast("bigint").alias("filled"), F.coalesce("all_filled", F.lit(False)).alias("all_filled"))


def layout_scores(df: DataFrame, column: str, layouts: Sequence[str] = (*DATE_LAYOUTS, *TIMESTAMP_LAYOUTS)) -> DataFrame:
    """(layout, matches): how many values follow each layout, in one pass."""
    c = trim_unicode(F.col(f"`{column}`").cast("string"))
    one = df.agg(*[F.count_if(parse(c, x).isNotNull()).alias(str(i)) for i, x in enumerate(layouts)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(x).alias("layout"), F.col(f"`{i}`").cast("bigint").alias("matches")) for i, x in enumerate(layouts)])).alias("r")).select("r.*")


def error_buckets(df: DataFrame, reason: str = "_reject_reason", order_by: Sequence[str] = ("_line",), keep: int = 3) -> DataFrame:
    """(reason, n, rank, and the columns of order_by): the first few rows of each reason and the reason's count.

    Both parts combine before the shuffle: counts as partial sums, first rows as a group limit.
    """
    rows = where(df, F.col(reason).isNotNull())
    counts = rows.groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("n"))
    first = rows.select(F.col(reason).alias("reason"), *order_by, F.row_number().over(Window.partitionBy(reason).orderBy(*order_by)).cast("bigint").alias("rank")).filter(F.col("rank") <= keep)
    return first.join(counts, "reason")


def html_window(pages: DataFrame, key: str, html: str, start: str = "", end: str = "") -> DataFrame:
    """(key, pos, line): cleaned, non-empty lines from the first with ``start`` to the first with ``end``, both included.

    Markers are looked for after tags are stripped.  An ``end`` before any
    start leaves nothing; a missing end runs to the last line, a missing start leaves nothing.  All
    of it works inside a row: no shuffle.
    """
    lines = F.filter(F.transform(F.split(html, "\n"), lambda x, i: F.struct(collapse_whitespace(strip_html(x)).alias("line"), i.alias("pos"))), lambda s: s["line"] != "")
    rows = pages.select(key, lines.alias("lines"))
    where = lambda marker: F.array_min(F.transform(F.filter("lines", lambda s: F.contains(s["line"], F.lit(marker))), lambda s: s["pos"]))
    first = where(start) if start else F.lit(0)
    last = F.coalesce(where(end), F.lit(2**31 - 1)) if end else F.lit(2**31 - 1)
    rows = rows.select(key, "lines", first.alias("first"), last.alias("last")).filter(F.col("first").isNotNull())
    kept = F.filter("lines", lambda s: (s["pos"] >= F.col("first")) & (s["pos"] <= F.col("last")))
    return rows.select(key, F.explode(kept).alias("s")).select(key, "s.pos", "s.line")


# ---- XML --------------------------------------------------------------------


def _profile_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (record, path, text, attr, value) of each record's elements."""
    from xml.etree import ElementTree

    local = lambda tag: tag.rsplit("}", 1)[-1]
    for batch in batches:
        out = []
        for record, xml in zip(batch["record"], batch["xml"]):
            try:
                root = ElementTree.fromstring(xml)
            except ElementTree.ParseError:
                continue  # not fully closed
            todo = [(root, "")]
            while todo:
                node, path = todo.pop()
                if path:
                    direct = ((node.text or "") + "".join(c.tail or "" for c in node)).strip(" \t\r\n")
                    out.append((record, path, direct, None, None))
                    out += [(record, path, None, local(a), v) for a, v in node.attrib.items()]
                todo += [(c, f"{path}/{local(c.tag)}" if path else local(c.tag)) for c in reversed(node)]
        yield pd.DataFrame(out, columns=["record", "path", "text", "attr", "value"])


def xml_elements(records: DataFrame, record: str = "record", xml: str = "xml") -> DataFrame:
    """Every element and attribute of XML records; Spark has no built-in walk over a tree of unknown shape."""
    return records.select(F.col(record).cast("bigint").alias("record"), F.col(xml).alias("xml")).mapInPandas(_profile_records, "record bigint, path string, text string, attr string, value string")


def xml_paths(elements: DataFrame) -> DataFrame:
    """(path, total_count, records_with, max_per_record, examples): up to three different texts, the smallest."""
    nodes = elements.filter("attr is null")
    per = nodes.groupBy("path", "record").agg(F.count("*").alias("n"))
    counts = per.groupBy("path").agg(F.sum("n").alias("total_count"), F.count("*").alias("records_with"), F.max("n").alias("max_per_record"))
    texts = nodes.filter("text <> ''").select("path", "text").distinct()
    ranked = texts.withColumn("k", F.row_number().over(Window.partitionBy("path").orderBy("text"))).filter("k <= 3")
    examples = ranked.groupBy("path").agg(F.sort_array(F.collect_list("text")).alias("examples"))
    return counts.join(examples, "path", "left").withColumn("examples", F.coalesce("examples", F.array().cast("array<string>")))


def xml_attributes(elements: DataFrame) -> DataFrame:
    """(path, attr, value, n)."""
    return elements.filter("attr is not null").groupBy("path", "attr", "value").agg(F.count("*").alias("n"))


def split_paths(paths: DataFrame) -> DataFrame:
    """(path, role): ``field`` where a record has it once at most, else ``list``; only paths with text."""
    role: Column = F.when(F.col("max_per_record") <= 1, "field").otherwise("list")
    return paths.filter(F.size("examples") > 0).select("path", role.alias("role"))


def guess_record_tag(documents: DataFrame, xml: str = "value") -> DataFrame:
    """(tag, n): children of the roots by frequency, then name; the first row is the guess."""

    def children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from io import BytesIO
        from xml.etree import ElementTree

        for batch in batches:
            out = []
            for text in batch["xml"]:
                depth = 0
                try:
                    for event, node in ElementTree.iterparse(BytesIO(text.encode()), ("start", "end")):
                        depth += 1 if event == "start" else -1
                        if event == "start" and depth == 2:
                            out.append(node.tag.rsplit("}", 1)[-1])
                        elif event == "end" and depth == 1:
                            node.clear()
                except ElementTree.ParseError:
                    pass  # a truncated sample counts as far as it goes
            yield pd.DataFrame({"tag": out})

    return documents.select(F.col(xml).alias("xml")).mapInPandas(children, "tag string").groupBy("tag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag")
