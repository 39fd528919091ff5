"""Queries that write files and read them back, and queries over specifications; with SQL that gives the same rows.

Files are written from whole test tables to the folder of ``spark.checkpoint.dir``
(a temporary one in local runs without it) and read by the readers under test.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sql
from ..functions.checks import Field
from ..functions.layouts import TIMESTAMP_LAYOUTS, best_layout, parse, preference
from ..operators import dedup, order, profile
from ..sinks import bulk, ddl
from ..sinks.writers import execute, writer
from ..sources import csv, http, json, text, xml
from . import probe, runner, spec
from .catalog import _REASONS, dirty_date, dirty_int, query, table


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(root or 'file://' + tempfile.mkdtemp(prefix='millrace-')).rstrip('/')}/readback-{uuid.uuid4().hex}"


def put(lines: DataFrame, spark: SparkSession) -> str:
    """Writes one text column as lines."""
    path = scratch(spark)
    lines.write.text(path)
    return path


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def literal(*names: str, rows: list[tuple]) -> str:
    """SQL for a few rows written out."""
    cell = lambda v: "NULL" if v is None else f"'{v.replace(chr(39), chr(39) * 2)}'" if isinstance(v, str) else str(v)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) v({', '.join(names)})"


# ---- CSV --------------------------------------------------------------------


@query("""SELECT CAST(c_custkey AS VARCHAR) AS cust_key, CASE WHEN c_custkey % 3 = 0 THEN c_name || ' "x", y' ELSE c_name END AS who,
  CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment, CAST(NULL AS VARCHAR) AS absent, CAST(NULL AS VARCHAR) AS error FROM customer""")
def csv_read(spark, sf_dir):
    """Several files with headers: names by map and rule, quotes, edges, empty values, an absent column."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("Cust Key"), F.when(k % 3 == 0, F.concat(F.lit("  "), "c_name", F.lit(' "x", y '))).otherwise(F.col("c_name")).alias("Name"), F.when(k % 4 != 0, F.col("c_mktsegment")).otherwise("").alias(" Segment "))
    path = scratch(spark)
    rows.repartition(3, "Cust Key").write.csv(path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    got = csv.read_csv(spark, path, csv.CsvOptions(header_map={"Name ": "who"}), ["cust_key", "who", "segment", "absent"])
    return got.withColumnRenamed(csv.ERROR, "error")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS a, CASE WHEN s_suppkey % 4 <> 1 THEN s_name END AS b, CASE WHEN s_suppkey % 4 IN (1, 2) THEN 'expected 2 fields' END AS error FROM supplier""")
def csv_widths(spark, sf_dir):
    """Rows that are too short or too long are marked."""
    k = F.col("s_suppkey")
    line = F.when(k % 4 == 1, k.cast("string")).when(k % 4 == 2, F.concat_ws(",", k, "s_name", F.lit("more"))).otherwise(F.concat_ws(",", k, "s_name"))
    path = put(table(spark, sf_dir, "supplier").select(line), spark)
    return csv.read_csv(spark, path, csv.CsvOptions(has_header=False, expected_fields=2), ["a", "b"]).withColumnRenamed(csv.ERROR, "error")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS a, CASE WHEN s_suppkey % 4 <> 1 THEN s_name END AS b FROM supplier""")
def csv_tolerant_widths(spark, sf_dir):
    """Without a width short rows are padded and long ones cut; another separator."""
    k = F.col("s_suppkey")
    line = F.when(k % 4 == 1, k.cast("string")).when(k % 4 == 2, F.concat_ws(";", k, "s_name", F.lit("more"))).otherwise(F.concat_ws(";", k, "s_name"))
    path = put(table(spark, sf_dir, "supplier").select(line), spark)
    return csv.read_csv(spark, path, csv.CsvOptions(has_header=False, comma=";"), ["a", "b"]).select("a", "b")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS a, CASE WHEN s_suppkey % 5 = 0 THEN 'na"me' ELSE 'q"q' END AS b, CASE WHEN s_suppkey % 5 = 0 THEN 'bare quote in a value' END AS error FROM supplier""")
def csv_quotes(spark, sf_dir):
    k = F.col("s_suppkey")
    path = put(table(spark, sf_dir, "supplier").select(F.concat_ws(",", k, F.when(k % 5 == 0, 'na"me').otherwise('"q""q"'))), spark)
    return csv.read_csv(spark, path, csv.CsvOptions(has_header=False), ["a", "b"]).withColumnRenamed(csv.ERROR, "error")


@query("SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_partkey % 3 = 0 THEN p_name || chr(10) || p_brand ELSE p_name END AS name FROM part")
def csv_line_ends(spark, sf_dir):
    """Quoted values that hold line ends."""
    path = scratch(spark)
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat_ws("\n", "p_name", "p_brand")).otherwise(F.col("p_name"))
    table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), name.alias("name")).write.csv(path, header=True, quoteAll=True, escape='"')
    return csv.read_csv(spark, path, csv.CsvOptions(), ["key", "name"]).select("key", "name")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS a, CASE WHEN r = 190 THEN 'open' WHEN r % 10 = 3 THEN p_name || chr(10) || p_brand WHEN r % 10 = 5 THEN 'b"x' WHEN r % 10 = 7 THEN 'a' || chr(13) || 'b' WHEN r % 10 = 8 THEN p_brand || ' (v likvidaci)' ELSE p_name END AS b,
  CASE WHEN r = 190 THEN 'a quote is never closed' WHEN r % 10 = 5 THEN 'bare quote in a value' END AS error FROM (SELECT *, p_partkey % 200 AS r FROM part) WHERE r <= 190""")
def csv_broken_quotes(spark, sf_dir):
    """Files with quoted line ends, bare quotes, lone carriage returns and a broken sequence; in each a quote that nothing closes takes what follows, no more."""
    k, r = F.col("p_partkey"), F.col("p_partkey") % 200
    text = F.when(r == 190, '"open').when(r > 190, F.col("p_name")).when(r % 10 == 3, F.concat(F.lit('"'), "p_name", F.lit("\n"), "p_brand", F.lit('"')))
    text = text.when(r % 10 == 5, 'b"x').when(r % 10 == 7, "a\rb").when(r % 10 == 8, F.concat(F.lit('"'), "p_brand", F.lit(' "v likvidaci""'))).otherwise(F.col("p_name"))
    lines = table(spark, sf_dir, "part").select(F.floor(k / 200).alias("file"), k, F.concat(k.cast("string"), F.lit(","), text, F.lit("\r")).alias("value"))
    path = scratch(spark)
    lines.repartition("file").sortWithinPartitions("file", "p_partkey").select("file", "value").write.partitionBy("file").text(path)
    return csv.read_csv(spark, path, csv.CsvOptions(has_header=False, scrub=True), ["a", "b"]).withColumnRenamed(csv.ERROR, "error")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS a, s_name || CASE WHEN s_suppkey % 2 = 0 THEN ' (v likvidaci)' ELSE '' END AS b FROM supplier")
def csv_scrub(spark, sf_dir):
    """The broken sequence of one register's files is mended before lines are cut."""
    k = F.col("s_suppkey")
    line = F.concat(k.cast("string"), F.lit(',"'), F.col("s_name"), F.when(k % 2 == 0, ' "v likvidaci""').otherwise('"'))
    path = put(table(spark, sf_dir, "supplier").select(line), spark)
    return csv.read_csv(spark, path, csv.CsvOptions(has_header=False, scrub=True), ["a", "b"]).select("a", "b")


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation UNION ALL SELECT 'id', 'name' FROM region r WHERE EXISTS (SELECT 1 FROM nation WHERE n_regionkey = r_regionkey)""")
def csv_headers(spark, sf_dir):
    """Files that begin with a mark and blank lines; rows equal to the header are data."""
    row = F.concat_ws(",", F.col("n_nationkey").cast("string"), "n_name")
    files = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.concat(F.lit("﻿\n\nid,name\nid,name\n"), F.concat_ws("\n\n", F.collect_list(row))).alias("value"))
    path = scratch(spark)
    files.write.partitionBy("n_regionkey").text(path)
    return csv.read_csv(spark, path, csv.CsvOptions(), ["id", "name"]).select("id", "name")


# ---- JSON, XML, text --------------------------------------------------------


@query("SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name, CAST(NULL AS VARCHAR) AS absent FROM nation")
def json_shapes(spark, sf_dir):
    """Files with an array, an envelope, concatenated objects, and an object a line."""
    all_ = F.collect_list(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("The Name")))
    each = F.transform("all", lambda x: F.to_json(x))
    shape = F.col("n_regionkey") % 4
    body = F.when(shape == 0, F.to_json("all")).when(shape == 1, F.to_json(F.struct(F.struct(F.lit(1).alias("v")).alias("meta"), F.col("all").alias("items")))).when(shape == 2, F.array_join(each, " ")).otherwise(F.array_join(each, "\n"))
    path = scratch(spark)
    table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(all_.alias("all")).select("n_regionkey", body.alias("value")).write.partitionBy("n_regionkey").text(path)
    return json.read_json(spark, path, ["key", "name", "absent"], {"The Name": "name"}).drop("_line")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, 'a}"[' || o_orderkey AS note, '{"k": [{}, ' || o_custkey || ']}' AS inner_, row_number() OVER (PARTITION BY o_orderkey // 20000 ORDER BY o_orderkey) AS place FROM orders""")
def json_files(spark, sf_dir):
    """Files of four shapes in one folder, each over many lines: an array, an envelope beside other arrays, objects a line, objects over lines; in their order."""
    k = F.col("o_orderkey")
    file = F.floor(k / 20000)
    shape = F.col("file") % 4
    record = F.concat(F.expr("left(r, length(r) - 1)"), F.lit(', "inner_": {"k": [{}, '), F.col("o_custkey").cast("string"), F.lit("]}}"))
    rows = table(spark, sf_dir, "orders").select(file.alias("file"), k, "o_custkey", F.to_json(F.struct(k.cast("string").alias("id"), F.concat(F.lit('a}"['), k.cast("string")).alias("note"))).alias("r"))
    body = rows.select("file", k.alias("at"), F.when(shape < 2, F.concat(record, F.lit(","))).when(shape == 2, record).otherwise(F.concat(F.replace(record, F.lit(", "), F.lit("\n,\n")), F.lit(" "))).alias("value"))
    files = rows.select("file").distinct()
    heads = files.filter(shape < 2).select("file", F.lit(-1).cast("long").alias("at"), F.when(shape == 0, "[").otherwise('{"meta": {"n": [1, 2]}, "few": [{"id": "x"}], "rows": [').alias("value"))
    tails = files.filter(shape < 2).select("file", F.lit(1 << 60).alias("at"), F.when(shape == 0, "null]").otherwise('null]\n, "odd": [{}, 1]}').alias("value"))
    path = scratch(spark)
    body.unionByName(heads).unionByName(tails).repartition("file").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").text(path)
    got = json.read_json(spark, path, ["id", "note", "inner_"])
    place = F.row_number().over(Window.partitionBy(F.floor(F.col("id").cast("long") / 20000)).orderBy("_line"))
    return got.select("id", "note", "inner_", place.cast("long").alias("place"))


@query("""SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS kind, '{"id": ' || user_id || '}' AS who FROM events""")
def json_lines(spark, sf_dir):
    """An object a line, in files that split."""
    path = scratch(spark)
    table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("Kind"), F.struct(F.col("user_id").alias("id")).alias("who")).write.json(path)
    return json.read_json(spark, path, ["event_id", "kind", "who"], {"Kind": "kind"}).drop("_line")


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS kind FROM events")
def json_lines_in_the_jvm(spark, sf_dir):
    path = scratch(spark)
    table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("Kind")).write.json(path)
    return json.read_ndjson(spark, path, ["event_id", "kind"], {"Kind": "kind"})


def _xml_lines(spark, sf_dir) -> DataFrame:
    line = F.concat(F.lit('<P id="'), "p_partkey", F.lit('"><Name> '), F.split("p_name", " ")[0], F.lit(" <b>"), F.split("p_name", " ")[1], F.lit("</b></Name><In><Tag k='a'>"), "p_brand", F.lit("</Tag><Tag k='b'>"), "p_type", F.lit("</Tag></In></P>"))
    return table(spark, sf_dir, "part").select(line)


@query("SELECT p_name AS name, p_type AS kind, p_brand || '|' || p_type AS tags FROM part")
def xml_records(spark, sf_dir):
    """Suffix paths, a test of an attribute, a list; files are split at end tags."""
    options = xml.XmlOptions("P", {"name": "P/Name", "kind": "Tag[@k='b']"}, {"tags": "In/Tag"})
    got = xml.read_xml(spark, put(_xml_lines(spark, sf_dir), spark), options)
    return got.select("name", "kind", F.array_join("tags", "|").alias("tags"))


@query("SELECT p_name AS name, p_brand || '|' || p_type || '|' || p_brand || '|' || p_type AS tags FROM part")
def xml_nested_records(spark, sf_dir):
    """Records inside records of one name stay with the outer one."""
    lines = _xml_lines(spark, sf_dir).toDF("value").select(F.concat(F.regexp_replace("value", "</P>\\z", ""), "value", F.lit("</P><!-- <P> -->")))
    options = xml.XmlOptions("P", {"name": "P/Name"}, {"tags": "In/Tag"})
    return xml.read_xml(spark, put(lines, spark), options).select("name", F.array_join("tags", "|").alias("tags"))


@query("""SELECT CASE WHEN p_partkey % 6 <> 4 THEN CAST(p_partkey AS VARCHAR) END AS id, CASE p_partkey % 6 WHEN 2 THEN p_brand || ' &nbsp; & more' WHEN 4 THEN NULL ELSE p_brand END AS brand,
  CASE WHEN p_partkey % 6 = 4 THEN 'unexpected end element </x>' END AS error FROM part""")
def xml_lenient_records(spark, sf_dir):
    """Prefixes, declared or not, unknown entities, missing end tags and quotes are read; what can't be read has an error, beside comments and sections with end tags."""
    k = F.col("p_partkey") % 6
    tag = F.when(k == 0, "n:P").when(k == 1, "z:P").otherwise("P")
    brand = F.when(k == 2, F.concat("p_brand", F.lit(" &nbsp; & more"))).when(k == 3, F.concat(F.lit("<![CDATA["), "p_brand", F.lit("]]>"))).otherwise(F.col("p_brand"))
    inner = F.concat(F.lit(" id="), F.when(k == 5, F.col("p_partkey").cast("string")).otherwise(F.concat(F.lit("'"), "p_partkey", F.lit("'"))), F.lit("><n:K>"), "p_partkey", F.lit("</n:K><B>"), brand, F.when(k == 4, "</B></x>").when(k == 5, "<i>").otherwise("</B>"))
    line = F.concat(F.lit("<!-- </P> -->"), F.lit("<"), tag, inner, F.lit("</"), tag, F.lit(" >"))
    options = xml.XmlOptions("P", {"id": "K", "brand": "B"})
    got = xml.read_xml(spark, put(table(spark, sf_dir, "part").select(line), spark), options)
    return got.select("id", "brand", F.col(csv.ERROR).alias("error"))


@query("""SELECT CAST(p_partkey AS BIGINT) AS id, p_brand AS brand, make_date(2020, 1 + CAST(p_partkey % 12 AS INT), 5) AS day, p_partkey % 2 = 0 AS ok FROM part WHERE p_partkey % 7 <> 3""")
def sql_views(spark, sf_dir):
    """Views by SQL alone: records of XML texts by a table function, typed and checked by SQL functions, all under the package's prefix."""
    sql.register(spark)
    k = F.col("p_partkey")
    day = F.concat(F.lit("05."), F.lpad((1 + k % 12).cast("string"), 2, "0"), F.lit(".2020"))
    line = F.concat(F.lit("<P><Id> "), F.when(k % 7 == 3, "none").otherwise(k.cast("string")), F.lit(" </Id><n:B>"), "p_brand", F.lit("</n:B><D>"), day, F.lit("</D><Ok>"), F.when(k % 2 == 0, "ano").otherwise("ne"), F.lit("</Ok></P>"))
    name = f"raw_{uuid.uuid4().hex}"
    spark.read.text(put(table(spark, sf_dir, "part").select(line), spark)).createOrReplaceTempView(name)
    return spark.sql(f"""
        SELECT millrace_to_int(r.fields['id']) AS id, millrace_normalize(r.fields['brand']) AS brand, millrace_to_date(r.fields['day']) AS day, millrace_to_bool(r.fields['ok']) AS ok
        FROM {name}, LATERAL millrace_xml_records(value, 'P', map('id', 'Id', 'brand', 'B', 'day', 'D', 'ok', 'Ok')) r
        WHERE r.error IS NULL AND millrace_is_int(r.fields['id'])""")


@query("SELECT CAST(p_partkey AS VARCHAR) AS pmid, p_name AS article_title, p_brand AS journal_title, CAST(NULL AS VARCHAR) AS country, '10/' || p_partkey AS doi, p_type || ',' || p_brand AS authors FROM part")
def xml_articles(spark, sf_dir):
    line = F.concat(F.lit("<A><PMID V='1'>"), "p_partkey", F.lit("</PMID><Title>"), "p_brand", F.lit("</Title><ArticleTitle> "), "p_name", F.lit("</ArticleTitle><LastName>"), "p_type", F.lit("</LastName><LastName>"), "p_brand", F.lit('</LastName><ArticleId IdType="doi">10/'), "p_partkey", F.lit("</ArticleId></A>"))
    got = xml.articles(spark.read.text(put(table(spark, sf_dir, "part").select(line), spark)))
    return got.select("pmid", "article_title", "journal_title", "country", "doi", F.array_join("authors", ",").alias("authors"))


@query("SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS line, CAST(o_orderkey AS VARCHAR) AS value FROM orders")
def ordered_write(spark, sf_dir):
    """Lines of several files, numbered, shuffled, and written in their order: the files read one after the other are as before."""
    k = F.col("o_orderkey")
    path, again = scratch(spark), scratch(spark)
    order.in_order(table(spark, sf_dir, "orders").select(k), ["o_orderkey"], 3).select(k.cast("string")).write.text(path)
    shuffled = order.numbered_lines(spark, path).repartition(8, F.xxhash64("value"))
    order.in_order(shuffled, ["line"], 5).select("value").write.text(again)
    return order.numbered_lines(spark, again)


@query("SELECT s_name AS value FROM supplier WHERE s_suppkey % 3 = 1")
def list_file(spark, sf_dir):
    k = F.col("s_suppkey")
    path = put(table(spark, sf_dir, "supplier").select(F.when(k % 3 == 0, F.concat(F.lit(" # "), "s_name")).when(k % 3 == 1, F.concat(F.lit("\t "), "s_name", F.lit(" "))).otherwise("  ")), spark)
    return text.read_list(spark, path)


@query("SELECT substr(string_agg(n_name || chr(10), '' ORDER BY n_nationkey), 1, 25) AS start FROM nation")
def first_bytes(spark, sf_dir):
    path = put(table(spark, sf_dir, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select("n_name"), spark)
    file = spark.read.text(path).select("_metadata.file_path").head()[0]
    return values(spark, [(probe.sample_of(spark, file, 25).decode(),)], "start string")


@query("""SELECT 'name_' || s_suppkey AS file, CAST(8 + length(CAST(s_suppkey AS VARCHAR)) AS BIGINT) AS download_size, 200 AS code, 'of name=' || s_suppkey AS body, 'of ' AS start FROM supplier""")
def downloads(spark, sf_dir):
    """Urls of files that tasks made of a table in the shared folder, fetched by tasks: the log, the files and the first bytes of each."""
    folder = scratch(spark)
    folder = folder if "://" in folder else f"file://{re.sub('^file:/*', '/', folder)}"
    at = f"{folder}-served"

    def serve(batches):
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(at)
        files.create_dir(root, recursive=True)
        for b in batches:
            for k in b["k"]:
                with files.open_output_stream(f"{root}/{k}") as f:
                    f.write(f"of name={k}".encode())
            yield b.assign(url=[f"{at}/{k}?name={k}" for k in b["k"]])[["url"]]

    made = f"{folder}-urls"
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("k")).mapInPandas(serve, "url string").write.parquet(made)
    urls = spark.read.schema("url string").parquet(made)
    log = http.download(spark, urls, folder)
    path = f"{folder}-starts"
    http.first_bytes(spark, urls, 3).write.parquet(path)
    files = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("body"))
    log = log.select("url", F.element_at(F.split("file", "/"), -1).alias("file"), "download_size", F.col("http_response_code").alias("code"))
    return log.join(files, "file").join(spark.read.parquet(path), "url").select("file", "download_size", "code", "body", F.col("start").cast("string").alias("start"))


# ---- layouts, types, dedup order --------------------------------------------

#: Each layout of timestamps: Spark's pattern for writing, a suffix, and seconds by which the suffix shifts it.
_WRITTEN = (("yyyy-MM-dd'T'HH:mm:ss", ".25Z", 0), ("yyyy-MM-dd'T'HH:mm:ss", "+01:00", -3600), ("yyyy-MM-dd HH:mm:ss", "", 0), ("yyyy-MM-dd HH:mm:ss", ".125", 0), ("yyyy/MM/dd HH:mm:ss", "", 0), ("dd/MM/yyyy HH:mm:ss", "", 0), ("MM/dd/yyyy HH:mm:ss", "", 0), ("yyyy-MM-dd'T'HH:mm:ss", "-0230", 9000), ("yyyy-MM-dd HH:mm:ss", " +0200", -7200))


@query("SELECT o_orderkey, CAST([0, -3600, 0, 0, 0, 0, 0, 9000, -7200][1 + o_orderkey % 9] AS BIGINT) AS shift, o_orderkey % 86400 AS second, TRUE AS known, FALSE AS wrong FROM orders")
def timestamp_layouts(spark, sf_dir):
    """Values of all nine layouts are parsed by their own, known as timestamps, and not by a layout of dates."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 9
    at = F.timestamp_seconds(F.unix_timestamp(F.col("o_orderdate").cast("date").cast("timestamp")) + F.col("o_orderkey") % 86400)
    rows = o.select("o_orderkey", k.alias("k"), at.alias("at")).select("*", F.coalesce(*[F.when(F.col("k") == i, F.concat(F.date_format("at", p), F.lit(s))) for i, (p, s, _) in enumerate(_WRITTEN)]).alias("raw"))
    parsed = F.coalesce(*[F.when(F.col("k") == i, parse(F.col("raw"), x)) for i, x in enumerate(TIMESTAMP_LAYOUTS)])
    zone = F.unix_timestamp("at") - F.unix_timestamp(F.to_utc_timestamp("at", F.current_timezone()))  # offsets count from UTC
    shift = F.unix_timestamp(parsed) - F.unix_timestamp("at") - F.when(F.col("k").isin(0, 1, 7, 8), zone).otherwise(0)
    second = F.unix_timestamp("at") - F.unix_timestamp(F.col("at").cast("date").cast("timestamp"))
    return rows.select("o_orderkey", shift.alias("shift"), second.alias("second"), profile.is_timestamp(F.col("raw")).alias("known"), profile.is_date(F.col("raw")).alias("wrong"))


@query(literal("layout", "weight", rows=[("2006-01-02T15:04:05.999999999Z07:00", 3), ("2006-01-02T15:04:05Z07:00", 2), ("2006/01/02 15:04:05", 1), ("02.01.2006", 3), ("02/01/2006", 3), ("2006-01-02", 2), ("20060102", 2), ("01.02.2006", 1), ("01/02/2006", 1), ("other", 0)]) + " UNION ALL SELECT * FROM (VALUES ('best of 5, 5, 2: 02.01.2006', -1), ('majority: 02.01.2006', -1))")
def layout_preferences(spark, sf_dir):
    """Weights between layouts, the best of one column's, the majority's of several columns."""
    rows = [(x, preference(x)) for x in ("2006-01-02T15:04:05.999999999Z07:00", "2006-01-02T15:04:05Z07:00", "2006/01/02 15:04:05", "02.01.2006", "02/01/2006", "2006-01-02", "20060102", "01.02.2006", "01/02/2006", "other")]
    best = best_layout({"2006-01-02": 5, "02.01.2006": 5, "01.02.2006": 2})
    most = probe.majority_layout({"a": "02.01.2006", "b": "2006-01-02", "c": "2006-01-02", "d": "02.01.2006", "e": ""})
    return values(spark, [*rows, (f"best of 5, 5, 2: {best}", -1), (f"majority: {most}", -1)], "layout string, weight int")


@query("""WITH o AS (SELECT *, o_orderkey % 7 = 3 AS lacks FROM orders)
SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM o WHERE NOT lacks GROUP BY o_custkey UNION ALL SELECT o_custkey, o_orderkey FROM o WHERE lacks""")
def dedup_passthrough(spark, sf_dir):
    """Rows whose record lacks the key pass through; the others' last row for each key stays."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return dedup.dedup(o, ["o_custkey"], dedup.KEEP_LAST, ("o_orderkey",), missing=F.col("o_orderkey") % 7 == 3, ordered=True)


@query(literal("path", "role", rows=[("Name", "field"), ("Name/b", "field"), ("In/Tag", "list"), ("guess", "P")]))
def xml_roles(spark, sf_dir):
    """Fields and lists of records, and the tag taken for a record."""
    lines = _xml_lines(spark, sf_dir).toDF("xml").withColumn("record", F.monotonically_increasing_id())
    roles = profile.split_paths(profile.xml_paths(profile.xml_elements(lines)))
    whole = lines.agg(F.concat(F.lit("<R><Odd/>"), F.array_join(F.collect_list("xml"), ""), F.lit("<Odd/>")).alias("value"))
    return roles.select("path", "role").unionByName(profile.guess_record_tag(whole).limit(1).select(F.lit("guess").alias("path"), F.col("tag").alias("role")))


# ---- sinks, specifications, whole pipelines ---------------------------------

_FIELDS = [Field("id", "int", required=True), Field("day", "timestamp"), Field("ok", "bool")]
_DDL = {
    "generic": "CREATE TABLE s.t (\n  id TEXT NOT NULL,\n  day TEXT,\n  ok TEXT,\n  amount TEXT,\n  rest TEXT\n);",
    "postgres": 'CREATE TABLE IF NOT EXISTS "s"."t" (\n  "id" BIGINT NOT NULL,\n  "day" TIMESTAMPTZ,\n  "ok" BOOLEAN,\n  "amount" TEXT,\n  "rest" TEXT\n);',
    "mssql": "IF OBJECT_ID(N'[s].[t]', N'U') IS NULL\nBEGIN\n  CREATE TABLE [s].[t] (\n    [id] BIGINT NOT NULL,\n    [day] DATETIME2,\n    [ok] BIT,\n    [amount] DECIMAL(38,10),\n    [rest] NVARCHAR(MAX)\n  );\nEND;",
    "sqlite": 'CREATE TABLE IF NOT EXISTS "s"."t" (\n  "id" INTEGER NOT NULL,\n  "day" TEXT,\n  "ok" INTEGER,\n  "amount" REAL,\n  "rest" TEXT\n);',
    "mysql": "CREATE TABLE IF NOT EXISTS `s`.`t` (\n  `id` BIGINT NOT NULL,\n  `day` DATETIME,\n  `ok` TINYINT(1),\n  `amount` TEXT,\n  `rest` TEXT\n);",
}


@query(literal("dialect", "statement", rows=list(_DDL.items())))
def create_table_statements(spark, sf_dir):
    """Types by contract, else by coercion, in every dialect."""
    tables = {d: ddl.infer_table("s.t", ["id", "day", "ok", "amount", "rest"], d, _FIELDS, {"amount": "float"}) for d in ddl.DIALECTS}
    return values(spark, [(d, ddl.create_table(t, d)) for d, t in tables.items()], "dialect string, statement string")


@query(literal("severity", "path", rows=[("error", "job"), ("error", "source.file.path"), ("warning", "parser.options"), ("warning", "transform[0].kind"), ("warning", "transform[1].options.contract"), ("error", "storage.db.table"), ("error", "runtime.reader_workers"), ("error", "undeclared: nope")]))
def lint_issues(spark, sf_dir):
    d = {"source": {"kind": "file", "file": {}}, "parser": {"kind": "csv"}, "transform": [{"kind": "odd"}, {"kind": "validate"}], "storage": {"kind": "sqlite", "db": {"dsn": "x", "columns": ["a"]}}, "runtime": {"batch_size": 1, "reader_workers": -1}}
    rows = [(i.severity, i.path) for i in spec.lint(spec.Pipeline.of(d))]
    try:
        coerce = spec.Pipeline.of({"transform": [{"kind": "coerce", "options": {"types": {"nope": "int"}}}]})
        runner.transform(coerce, values(spark, [("x", 0, None)], "a string, _line int, _parse_error string"))
    except ValueError as e:
        rows.append(("error", f"undeclared: {str(e).split(': ')[1]}"))
    return values(spark, rows, "severity string, path string")


@query(literal("setting", "value", rows=[("reader_workers", 1), ("transform_workers", 4), ("loader_workers", 3), ("batch_size", 10000), ("channel_buffer", 4096)]))
def runtime_settings(spark, sf_dir):
    p = spec.Pipeline.of({"runtime": {"loader_workers": 3, "batch_size": 0}})
    return values(spark, [(k, p.setting(k)) for k in spec.RUNTIME], "setting string, value int")


@query(literal("name", "kind", "layout", "required", rows=[("o_orderkey", "bigint", None, 1), ("day", "date", "02.01.2006", 0), ("at", "timestamp", "2006-01-02 15:04:05", 0), ("price", "float", None, 0), ("status", "text", None, 0), ("ok", "bool", None, 0), ("*", "main.orders", "02.01.2006", 0)]).replace("main.orders", "public.my_orders"))
def probe_csv(spark, sf_dir):
    """The specification that is inferred from a sample of a file."""
    o = table(spark, sf_dir, "orders")
    path = scratch(spark)
    rows = o.select("o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy").alias("Day"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("at"), (F.col("o_totalprice").cast("decimal(20,2)") + F.lit("0.25").cast("decimal(3,2)")).cast("string").alias("price"), F.col("o_orderstatus").alias("Status"), F.when(F.col("o_orderkey") % 2 == 0, "yes").otherwise("no").alias("ok"))
    rows.coalesce(1).write.csv(path, header=True)
    file = spark.read.text(path).select("_metadata.file_path").head()[0]
    found = probe.probe(spark, file, "My Orders", 50_000, backend="postgresql")
    fields = [(f["name"], f["type"], f.get("layout"), int(f.get("required", False))) for f in found["transform"][1]["options"]["contract"]["fields"]]
    return values(spark, [*fields, ("*", found["storage"]["db"]["table"], found["transform"][0]["options"]["layout"], 0)], "name string, kind string, layout string, required int")


def _database(spark: SparkSession) -> str:
    """A path for a database file that all workers see."""
    folder = re.sub(r"^file:/+", "/", scratch(spark))
    if not folder.startswith("/"):
        raise ValueError(f"a database file needs a shared folder that is mounted, not {folder}")
    Path(folder).mkdir(parents=True, exist_ok=True)
    return f"{folder}/a.db"


@query("SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sqlite_round_trip(spark, sf_dir):
    """Two bulk loads append to one table, whose statement is made once; read back by ranges of its rows."""
    path = _database(spark)
    t = ddl.TableDef("people", (ddl.ColumnDef("c_custkey", "INTEGER"), ddl.ColumnDef("c_name", "TEXT"), ddl.ColumnDef("c_acctbal", "REAL")))
    parts = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), table(spark, sf_dir, "supplier").toDF("c_custkey", "c_name", "n", "c_acctbal").drop("n")
    for df in parts:
        writer("sqlite")(df, f"file:{path}", "people", 64, t)
    return bulk.read_sqlite(spark, path, "people", "c_custkey bigint, c_name string, c_acctbal double")


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'N' ELSE o_orderstatus END AS status FROM orders UNION ALL SELECT -o_orderkey, 'new' FROM orders WHERE o_orderkey % 5 = 0""")
def sqlite_upsert(spark, sf_dir):
    """Rows put in place of those with equal keys, twice with the same result; a column id is left to the table."""
    path, o = _database(spark), table(spark, sf_dir, "orders")
    t = ddl.TableDef("o", (ddl.ColumnDef("id", "INTEGER", primary_key=True), ddl.ColumnDef("k", "INTEGER"), ddl.ColumnDef("status", "TEXT")))
    write = lambda df, keys: writer("sqlite")(df.withColumn("id", F.lit(7)), path, "o", 5000, t, keys)
    writer("sqlite")(o.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status")), path, "o", 5000, t)
    changed = o.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("k"), F.lit("N").alias("status"))
    for _ in range(2):
        write(changed.unionByName(o.filter("o_orderkey % 5 = 0").select((-F.col("o_orderkey")).alias("k"), F.lit("new").alias("status"))), ["k"])
    return bulk.read_sqlite(spark, path, "o", "id bigint, k bigint, status string").select("k", "status")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def jdbc_round_trip(spark, sf_dir):
    """Two loads in batches over JDBC append to a table that a statement made; into the database that comes with Spark, which lives in one process."""
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("this query's database lives in the driver: run it in local mode")
    url = f"jdbc:derby:memory:m{uuid.uuid4().hex};create=true"
    t = ddl.TableDef("people", (ddl.ColumnDef("c_custkey", "BIGINT", nullable=False), ddl.ColumnDef("c_name", "VARCHAR(200)"), ddl.ColumnDef("c_acctbal", "DOUBLE")))
    execute(spark, url, {}, ddl.create_table(t, "generic"))
    parts = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), table(spark, sf_dir, "supplier").toDF("c_custkey", "c_name", "n", "c_acctbal").drop("n")
    for df in parts:
        writer("postgres")(df, url, "people", 64)
    return spark.read.jdbc(url, "people").toDF("c_custkey", "c_name", "c_acctbal")


@query("SELECT 'json' AS sink, s_suppkey, s_name FROM supplier UNION ALL SELECT 'parquet', s_suppkey, s_name FROM supplier UNION ALL SELECT 'text', CAST(NULL AS BIGINT), s_name FROM supplier")
def file_sinks(spark, sf_dir):
    folder, rows = scratch(spark), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    writer("json")(rows, folder, "j")
    writer("parquet")(rows, folder, "p")
    writer("text")(rows.select("s_name"), folder, "t")
    read: list[tuple[str, DataFrame]] = [("json", spark.read.schema("s_suppkey bigint, s_name string").json(f"{folder}/j")), ("parquet", spark.read.parquet(f"{folder}/p")), ("text", spark.read.text(f"{folder}/t").select(F.lit(None).cast("bigint").alias("s_suppkey"), F.col("value").alias("s_name")))]
    one, *more = [df.select(F.lit(k).alias("sink"), "s_suppkey", "s_name") for k, df in read]
    return one.unionByName(more[0]).unionByName(more[1])


def _order_lines() -> Column:
    k = F.col("o_orderkey")
    return F.concat_ws(",", dirty_int(k), dirty_date(F.col("o_orderdate"), k), F.col("o_orderstatus"))


@query(f"""SELECT CAST(count(*) AS BIGINT) AS processed, CAST(0 AS BIGINT) AS parse_errors, CAST(count(reason) AS BIGINT) AS transform_rejected,
  CAST(count(*) FILTER (reason IS NULL AND key IS NULL) AS BIGINT) AS validate_dropped, CAST(count(*) FILTER (reason IS NULL AND key IS NOT NULL) AS BIGINT) AS inserted, CAST(count(*) FILTER (reason IS NULL AND key IS NOT NULL) AS BIGINT) AS stored FROM ({_REASONS})""")
def pipeline_run(spark, sf_dir):
    """A whole declared pipeline from a file to a sink, with its counts and what the sink holds."""
    path, out = put(table(spark, sf_dir, "orders").select(_order_lines()), spark), scratch(spark)
    p = spec.Pipeline.of({
        "job": "orders", "source": {"kind": "file", "file": {"path": path}}, "parser": {"kind": "csv", "options": {"has_header": False}},
        "transform": [{"kind": "coerce", "options": {"types": {"key": "int", "day": "date"}}}, {"kind": "require", "options": {"fields": ["key"]}}],
        "storage": {"kind": "parquet", "db": {"dsn": out, "table": "orders", "columns": ["key", "day", "status"]}}, "runtime": {"batch_size": 100},
    })
    done = runner.run(spark, p)
    names = ("processed", "parse_errors", "transform_rejected", "validate_dropped", "inserted")
    return values(spark, [(*(done.counts[n] for n in names), spark.read.parquet(f"{out}/orders").count())], ", ".join(f"{n} bigint" for n in (*names, "stored")))


@query(literal("kind", "n", rows=[("inserted", 3), ("parse_errors", 1)]))
def metrics_text(spark, sf_dir):
    """Counters in the text that a gateway takes."""
    from ..sinks.metrics import Metrics

    m = Metrics("j")
    m.records("inserted", 3)
    m.records("parse_errors", 1)
    lines = [x for x in m.text().splitlines() if x.startswith("etl_records_total{")]
    return values(spark, [(x.split('kind="')[1].split('"')[0], int(x.rsplit(" ", 1)[1])) for x in lines], "kind string, n int")


@query(literal("attempt", "wait_ms", "again", rows=[(0, 200, 1), (1, 400, 1), (4, 3200, 1), (9, 5000, 1), (404, 0, 0), (429, 0, 1), (500, 0, 1), (599, 0, 1), (600, 0, 0)]))
def retries(spark, sf_dir):
    """Waits after attempts, and statuses that are tried again."""
    rows = [(a, int(1000 * http.backoff(a)), 1) for a in (0, 1, 4, 9)] + [(s, 0, int(http.retriable(s))) for s in (404, 429, 500, 599, 600)]
    return values(spark, rows, "attempt int, wait_ms int, again int")
