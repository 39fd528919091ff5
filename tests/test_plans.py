"""Operators, sources, sinks, probing and whole pipelines."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from millrace.__main__ import main
from millrace.functions.checks import Field
from millrace.operators import dedup, profile, sets
from millrace.plans import probe, runner
from millrace.plans.spec import Options, Pipeline, lint
from millrace.sinks import ddl, writers
from millrace.sinks.metrics import Metrics
from millrace.sources import csv, http, json as js, text, xml


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---- operators --------------------------------------------------------------


def test_dedup_policies(spark):
    df = spark.createDataFrame([(0, "1", "a", None), (1, "1", "a", "x"), (2, "1", "a", None), (3, None, "a", None), (4, None, "a", None)], "_line int, k1 string, k2 string, v string")
    lines = lambda policy, **kw: sorted(r["_line"] for r in dedup.dedup(df, ["k1", "k2"], policy, **kw).collect())
    assert lines("keep-first") == [0, 3] and lines("KEEP-LAST ") == [2, 4] and lines("most-complete") == [1, 4] and lines("?") == [2, 4]
    assert dedup.dedup(df, []).count() == 5 and dedup.dedup(df, ["no"]).count() == 5


def test_distinct_first(spark):
    df = spark.createDataFrame([(0, " 5", "1"), (1, "05", "1"), (2, "5", ""), (3, "-1", "1"), (4, "-1", "1"), (5, "x", "1"), (6, "900", "2"), (7, "900", "2")], "l int, id string, c string")
    assert sorted(r["text"] for r in dedup.distinct_first(df, "id", "c", ["l"], max_id=100).collect()) == ["-1", "-1", "5", "900", "900"]
    assert rows(dedup.distinct_counts(df, "id", "c")) == [(8, 3, 2)]


def test_sets(spark):
    lines = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    assert sorted(r["value"] for r in sets.keep_known(lines("a12b34", "a12b34", "99", "12 99999999999999999999", "none"), sets.parse_ids(lines("12", " 99", "x", "7"))).collect()) == ["a12b34", "a12b34"]
    assert rows(sets.snapshot_diff_files(lines("h", "1", "3", "3", ""), lines("h", "1\r", "2"), "h"), F.desc("is_header")) == [("h", True), ("3", False), ("3", False)]
    ids = spark.createDataFrame([(0,), (63,), (64,), (-1,), (5,), (5,)], "id bigint")
    assert rows(sets.id_set(ids, "id", 64), "id") == [(0,), (5,), (63,)]
    target, source = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(sets.upsert(target, source, ["k"]), "k") == [(1, "a"), (2, "c"), (3, "d")]


def test_realign(spark):
    df = spark.createDataFrame([("1", "x", "y", "RSV", "z"), ("1", "x", "RSV", "y", "z"), ("RSV", "x", "y", "w", "z"), ("1", "x", None, "w", "z"), ("1", "x", None, None, "RSV")], "a string, b string, m string, c string, d string")
    assert rows(sets.realign(df, "m", "RSV")) == [("1", "x", "RSV", "z", None), ("1", "x", "RSV", "y", "z"), ("RSV", "x", "y", "w", "z"), ("1", "x", None, "w", "z"), ("1", "x", "RSV", None, None)]


def test_inference(spark):
    df = spark.createDataFrame([("1", "true", "1.1", "2024-01-02", "2024-01-02T00:00:00Z", "1", "", "1"), ("0", "FALSE", "2e3", "02.01.2024", "2024-01-02T00:00:00+01:00", "2.5", " ", "")], "i string, b string, r string, d string, t string, m string, e string, s string")
    got = {r["column"]: (r["type"], r["all_filled"]) for r in profile.infer_types(df).collect()}
    assert got == {"i": ("integer", True), "b": ("boolean", True), "r": ("real", True), "d": ("date", True), "t": ("timestamp", True), "m": ("text", True), "e": ("text", False), "s": ("integer", False)}


def test_html_window_and_buckets(spark):
    page = spark.createDataFrame([(1, "<b>x</b>\n start <i>here</i>\n\nmid\nthe end\nafter"), (2, "end\nstart"), (3, "nothing")], "k int, h string")
    assert rows(profile.html_window(page, "k", "h", "start", "end"), "k", "pos") == [(1, 1, "start here"), (1, 3, "mid"), (1, 4, "the end")]
    assert [r["line"] for r in profile.html_window(page, "k", "h").orderBy("k", "pos").collect()][-1] == "nothing"
    bad = spark.createDataFrame([(i, "r" if i % 2 else None) for i in range(20)], "_line int, _reject_reason string")
    assert rows(profile.error_buckets(bad), "rank") == [("r", 1, 1, 10), ("r", 3, 2, 10), ("r", 5, 3, 10)]


def test_xml_profile(spark):
    records = spark.createDataFrame([(1, "<Rec><A>1</A><B x='y'>t</B></Rec>"), (2, "<Rec><A>2</A><A>3</A></Rec>"), (3, "<Rec><A>cut")], "record bigint, xml string")
    e = profile.xml_elements(records)
    assert rows(profile.xml_paths(e).select("path", "total_count", "records_with", "max_per_record", "examples"), "path") == [("A", 3, 2, 2, ["1", "2", "3"]), ("B", 1, 1, 1, ["t"])]
    assert rows(profile.xml_attributes(e)) == [("B", "x", "y", 1)]
    assert rows(profile.split_paths(profile.xml_paths(e)), "path") == [("A", "list"), ("B", "field")]
    assert rows(profile.guess_record_tag(spark.createDataFrame([("<R><Item/><Other/><Item><Other/></Item><Item>",)], "value string")))[0] == ("Item", 3)


# ---- sources ----------------------------------------------------------------


def put(tmp_path, name, content):
    (tmp_path / name).write_text(content, encoding="utf-8")
    return str(tmp_path / name)


def test_csv_header_and_width(spark, tmp_path):
    path = put(tmp_path, "a.csv", '\ufeffFirst Name ,Last Name,age\nJohn ,"Do ""e""",\nA,B\nC,D,5,6\nbad"quote,x,1\n')
    o = csv.CsvOptions(header_map={"First Name": "first"})
    got = rows(csv.read_csv(spark, path, o, ["first", "last_name", "age", "none"]))
    assert got == [("John", 'Do "e"', None, None, None), ("A", "B", None, None, None), ("C", "D", "5", None, None), ('bad"quote', "x", "1", None, "bare quote in a value")]
    strict = csv.read_csv(spark, path, csv.CsvOptions(expected_fields=3, lazy_quotes=True), ["age"])
    assert [r["_parse_error"] for r in strict.collect()] == [None, "expected 3 fields", "expected 3 fields", None]


def test_csv_without_header_quoted_lines_and_scrub(spark, tmp_path):
    path = put(tmp_path, "b.csv", '1;"two\nlines";x\n2;b;y\n')
    assert rows(csv.read_csv(spark, path, csv.CsvOptions(has_header=False, comma=";"), ["c1", "c2"]), "c1") == [("1", "two\nlines", None), ("2", "b", None)]
    path = put(tmp_path, "c.csv", 'name,n\n"Acme "v likvidaci"",1\nB,2\n')
    got = rows(csv.read_csv(spark, path, csv.CsvOptions(scrub=True), ["name", "n"]), "name")
    assert got[1][0] == "B" and got[0][0].startswith("Acme (v likvidaci)")
    assert csv.read_csv(spark, put(tmp_path, "d.csv", ""), csv.CsvOptions(), ["a"]).count() == 0


@pytest.mark.parametrize(
    "content, expected",
    [
        ('[{"id": 1, "name": "a"}, {"id": 2.50}]', [("1", "a"), ("2.50", None)]),
        ('{"meta": {"x": 1}, "records": [{"id": true, "name": ["x"]}, null, {"id": null}]}', [("true", '["x"]'), (None, None)]),
        ('{"id": "x", "name": {"a": 1}}', [("x", '{"a": 1}')]),
        ('{"id": 1}\n{"id": 2}\n{"id": 3}', [("1", None), ("2", None), ("3", None)]),
    ],
)
def test_json_shapes(spark, tmp_path, content, expected):
    assert [r[:2] for r in rows(js.read_json(spark, put(tmp_path, "a.json", content), ["id", "name"]), "_line")] == expected


def test_json_errors_renames_and_lines(spark, tmp_path):
    for content in ("42", "[1, 2, 3]"):
        with pytest.raises(Exception, match="no records"):
            js.read_json(spark, put(tmp_path, "b.json", content), ["id"]).collect()
    path = put(tmp_path, "c.json", '{"Název": "x"}\n{"other": 1}\nnot json\n')
    assert rows(js.read_ndjson(spark, path, ["nazev"], {"Název": "nazev"})) == [("x",), (None,)]


def test_xml(spark, tmp_path):
    content = "<?xml version='1.0'?><Root><Rec id='1'><A>1<i>x</i></A><L><N k='v'>p</N><N k='w'>q</N></L><Rec><A>in</A></Rec></Rec><!-- <Rec> --><Rec/><Rec><A> </A><A>2</A><N k='v'>r</N></Rec><Rec><A>cut"
    o = xml.XmlOptions("Rec", {"a": "A", "n": "L/N[@k='w']"}, {"ns": "N"})
    got = rows(xml.read_xml(spark, put(tmp_path, "a.xml", content), o), "_line")
    assert got == [("1x", "q", ["p", "q"], 1, None), (None, None, None, 2, None), ("2", None, ["r"], 3, None), (None, None, None, 4, "the record is never closed")]
    with pytest.raises(ValueError):
        xml.compile_path("A[@k='v']/B")
    article = "<Article><PMID Version='1'>7</PMID><ArticleTitle>T</ArticleTitle><LastName>A</LastName><LastName>B</LastName><ArticleId IdType=\"doi\">10/x</ArticleId></Article>"
    r = xml.articles(spark.createDataFrame([(article,)], "value string")).head()
    assert (r["pmid"], r["article_title"], r["doi"], r["authors"], r["country"]) == ("7", "T", "10/x", ["A", "B"], None)


def test_csv_headers(spark, tmp_path):
    """The first line that isn't blank is the header, of each file; lines equal to it are data."""
    read = lambda text, **more: rows(csv.read_csv(spark, put(tmp_path, "h.csv", text), csv.CsvOptions(**more), ["id", "name"]).select("id", "name"))
    assert read("\nid,name\n1,x\n2,y") == [("1", "x"), ("2", "y")]
    assert read("id,name\n1,x\nid,name\n2,y\n") == [("1", "x"), ("id", "name"), ("2", "y")]
    assert read('\ufeffid,name\n1,"a\nb"\nid,name\n') == [("1", "a\nb"), ("id", "name")]
    with pytest.raises(ValueError, match="none of the columns"):
        read("a,b\n1,x\n")
    (tmp_path / "many").mkdir()
    put(tmp_path / "many", "a.csv", "\n\nid,name\n1,x\n")
    put(tmp_path / "many", "b.csv", "id,name\n2,y\nid,name\n")
    assert sorted(rows(csv.read_csv(spark, str(tmp_path / "many"), csv.CsvOptions(), ["id", "name"]).select("id", "name"))) == [("1", "x"), ("2", "y"), ("id", "name")]


def test_large_files_are_split(spark, tmp_path):
    """XML and JSON lines of a few hundred parts' size give all records, in order, from many tasks."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        path = put(tmp_path, "big.xml", "<R>" + "".join(f"<I><id>{i}</id><n>{'z' * 40}</n></I>\n" for i in range(8000)) + "</R>")
        got = xml.read_xml(spark, path, xml.XmlOptions("I", {"id": "id"}))
        assert got.rdd.getNumPartitions() > 4
        assert [r["id"] for r in got.orderBy("_line").collect()] == [str(i) for i in range(8000)]
        path = put(tmp_path, "big.json", "".join(f'{{"id": {i}, "n": "{"z" * 40}"}}\n' for i in range(8000)))
        got = js.read_json(spark, path, ["id"])
        assert got.rdd.getNumPartitions() > 4
        assert [r["id"] for r in got.orderBy("_line").collect()] == [str(i) for i in range(8000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_dedup_passes_rows_without_a_key(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, None, 1), (3, "a", 0), (4, "b", 1), (5, "b", 0)], "_line long, k string, lacks int")
    got = dedup.dedup(df, ["k"], "keep-first", missing=F.col("lacks") == 1, ordered=True)
    assert [r["_line"] for r in got.collect()] == [1, 5, 2, 4]
    assert got.columns == df.columns


def test_lists_and_bytes(spark, tmp_path):
    path = put(tmp_path, "l.txt", " a \n\n# c\nb\n")
    assert rows(text.read_list(spark, path)) == [("a",), ("b",)]
    assert text.first_bytes(spark, path, 3) == b" a "
    with pytest.raises(ValueError):
        text.first_bytes(spark, path, 0)


def test_http_retries(monkeypatch, spark, tmp_path):
    import io
    import urllib.error

    answers = [urllib.error.HTTPError("u", 503, "", {}, io.BytesIO(b"")), OSError("down"), b"body"]

    class Answer(io.BytesIO):
        status = 200

    def open_(request, timeout, context=None):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return Answer(a)

    waits = []
    monkeypatch.setattr(http.urllib.request, "urlopen", open_)
    assert http.Client(sleep=waits.append).fetch("http://h/?q=1", to=lambda: (tmp_path / "q_1").open("wb")) == (200, b"")
    assert waits == [0.2, 0.4] and (tmp_path / "q_1").read_bytes() == b"body"
    assert http.backoff(10) == 5.0 and http.retriable(429) and not http.retriable(404)


# ---- sinks and specifications -----------------------------------------------


def test_create_table():
    t = ddl.TableDef("s.t", (ddl.ColumnDef("b", "BIGINT", False, True), ddl.ColumnDef('a"', "TEXT", True, True, "'x'")))
    assert ddl.create_table(t, "postgres") == 'CREATE TABLE IF NOT EXISTS "s"."t" (\n  "b" BIGINT NOT NULL,\n  "a""" TEXT NOT NULL DEFAULT \'x\',\n  PRIMARY KEY ("a""", "b")\n);'
    assert ddl.create_table(ddl.TableDef("dbo.t", (ddl.ColumnDef("x]", "BIT"),)), "mssql") == "IF OBJECT_ID(N'[dbo].[t]', N'U') IS NULL\nBEGIN\n  CREATE TABLE [dbo].[t] (\n    [x]]] BIT\n  );\nEND;"
    assert ddl.create_table(ddl.TableDef("t", (ddl.ColumnDef("x", "INT", False),)), "generic") == "CREATE TABLE t (\n  x INT NOT NULL\n);"
    got = ddl.infer_table("t", ["id", "d", "f", "n"], "mssql", [Field("id", "int", required=True), Field("d", "timestamp", nullable=True)], {"f": "float"})
    assert [(c.sql_type, c.nullable) for c in got.columns] == [("BIGINT", False), ("DATETIME2", True), ("DECIMAL(38,10)", True), ("NVARCHAR(MAX)", True)]
    assert ddl.DIALECTS["sqlite"].type_of("BOOL") == "INTEGER"
    with pytest.raises(ValueError):
        ddl.create_table(ddl.TableDef("", ()), "postgres")


def test_writers_and_metrics(spark):
    assert {"postgres", "mssql", "sqlite", "mysql", "parquet"} <= set(writers.kinds())
    with pytest.raises(ValueError):
        writers.writer("?")
    assert writers.jdbc_url("postgres", "postgresql://u:p@h:1/d?x=1") == ("jdbc:postgresql://h:1/d", {"user": "u", "password": "p"})
    assert writers.jdbc_url("mssql", "sqlserver://u:p@h:1?database=d")[0] == "jdbc:sqlserver://h:1;databaseName=d"
    m = Metrics("j")
    m.records("inserted", 3)
    with m.step("load"):
        pass
    assert 'etl_records_total{kind="inserted"} 3' in m.text() and m.frame(spark).count() == 5


def test_options():
    o = Options({"s": "x", "b": True, "i": 2.0, "m": {"a": "b", "c": 1}, "l": ["a", 1], "n": None})
    assert (o.string("s"), o.string("b", "d"), o.boolean("b"), o.integer("i"), o.integer("b", 7), o.string_map("m"), o.strings("l"), o.character("s"), o.string("n")) == ("x", "d", True, 2, 7, {"a": "b"}, ["a"], "x", "")


def test_lint():
    found = {(i.severity, i.path) for i in lint(Pipeline.of({}))}
    assert found == {("error", "job"), ("error", "source.kind"), ("error", "parser.kind"), ("warning", "transform"), ("error", "storage.kind"), ("warning", "runtime.batch_size")}
    d = {"job": "j", "source": {"kind": "file", "file": {}}, "parser": {"kind": "csv"}, "transform": [{"kind": ""}, {"kind": "odd"}, {"kind": "validate"}, {"kind": "validate", "options": {"contract": 5}}, {"kind": "validate", "options": {"contract": {}}}, {"kind": "dedup"}, {"kind": "dedupe"}], "storage": {"kind": "x", "db": {"auto_create_table": True}}, "runtime": {"batch_size": 1, "reader_workers": -1}}
    found = [(i.severity, i.path) for i in lint(Pipeline.of(d))]
    assert found == [
        ("error", "source.file.path"), ("warning", "parser.options"), ("error", "transform[0].kind"), ("warning", "transform[1].kind"), ("warning", "transform[2].options.contract"), ("error", "transform[3].options.contract"), ("warning", "transform[4].options.contract"),
        ("warning", "storage.kind"), ("error", "storage.db.dsn"), ("error", "storage.db.table"), ("error", "storage.db.columns"), ("error", "storage.db.auto_create_table"), ("error", "runtime.reader_workers"),
    ]


def test_settings(monkeypatch):
    p = Pipeline.of({"runtime": {"batch_size": 5}})
    monkeypatch.setenv("ETL_LOADER_WORKERS", "3")
    assert (p.setting("batch_size"), p.setting("loader_workers"), p.setting("reader_workers")) == (5, 3, 1)


# ---- whole pipelines --------------------------------------------------------


def spec(path, dsn, **more):
    return {
        "job": "items", "source": {"kind": "file", "file": {"path": path}},
        "parser": {"kind": "csv", "options": {"header_map": {"PČV": "pcv", "Datum od": "day", "Mark": "mark"}, "expected_fields": 4}},
        "transform": [
            {"kind": "normalize"},
            {"kind": "coerce", "options": {"layout": "02.01.2006", "types": {"pcv": "bigint", "day": "date"}, "anchor": {"field": "mark", "value": "RSV"}}},
            {"kind": "validate", "options": {"contract": {"name": "x", "fields": [{"name": "pcv", "type": "int", "required": True}, {"name": "day", "type": "date"}, {"name": "mark", "type": "text", "enum": ["RSV", "ABC"]}]}}},
            {"kind": "require", "options": {"fields": ["mark"]}},
            {"kind": "dedupe", "options": {"keys": ["pcv"], "policy": "keep-last"}},
        ],
        "storage": {"kind": "sqlite", "db": {"dsn": dsn, "table": "main.items", "columns": ["pcv", "day", "mark", "note"], "auto_create_table": True}},
        "runtime": {"batch_size": 2}, **more,
    }


CONTENT = "\ufeffPČV,Datum od,Mark,Note\n1,07.10.2011,RSV,a\n1,31.02.2024,RSV,b\n2,,junk,RSV\nx,07.10.2011,RSV,c\n,07.10.2011,RSV,d\n3,07.10.2011,BAD,e\n4,07.10.2011,,f\n5,short\n6,2024-01-02,ABC, g \n"


def test_pipeline_to_sqlite(spark, tmp_path):
    p = Pipeline.of(spec(put(tmp_path, "in.csv", CONTENT), f"file:{tmp_path}/out.db?cache=shared"))
    done = runner.run(spark, p)
    stored = sorted(sqlite3.connect(tmp_path / "out.db").execute("select * from items").fetchall())
    assert stored == [(1, "2024-03-02", "RSV", "b"), (2, None, "RSV", None), (6, "2024-01-02", "ABC", "g")]
    assert {k: done.counts[k] for k in ("parse_errors", "transform_rejected", "validate_dropped", "inserted", "batches")} == {"parse_errors": 1, "transform_rejected": 1, "validate_dropped": 3, "inserted": 3, "batches": 2}
    assert sorted((r["stage"], r["reason"]) for r in done.rejected.collect()) == [
        ("coerce", 'field "pcv": cannot coerce "x"'), ("parse", "expected 4 fields"), ("require", "required field empty"), ("validate", 'field "mark": "BAD" not in enum [RSV ABC]'), ("validate", 'required field "pcv" missing'),
    ]


def test_pipeline_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="job"):
        runner.run(spark, Pipeline.of({}))
    d = spec(put(tmp_path, "in.csv", CONTENT), "x")
    d["transform"] = [{"kind": "coerce", "options": {"types": {"nope": "int"}}}]
    with pytest.raises(ValueError, match="nope"):
        runner.plan(spark, Pipeline.of(d))
    d["transform"] = [{"kind": "odd"}]
    with pytest.raises(ValueError, match="odd"):
        runner.plan(spark, Pipeline.of(d))


def test_probe_then_run(spark, tmp_path):
    path = put(tmp_path, "sample.csv", "id,Shape Ž,volume,when,ok\n1,cube,1.5,02.01.2024,yes\n2,ball,2.5,03.01.2024,no\n")
    found = probe.probe(spark, path, "Sample", backend="sqlite")
    fields = {f["name"]: f for f in found["transform"][1]["options"]["contract"]["fields"]}
    assert {n: f["type"] for n, f in fields.items()} == {"id": "bigint", "shape_z": "text", "volume": "float", "when": "date", "ok": "bool"}
    assert fields["id"]["required"] and fields["when"]["layout"] == "02.01.2006" and fields["ok"]["truthy"][0] == "1"
    assert found["transform"][0]["options"]["layout"] == "02.01.2006"
    found["source"]["file"]["path"] = path
    found["storage"]["db"]["dsn"] = f"{tmp_path}/p.db"
    (tmp_path / "p.json").write_text(json.dumps(found))
    assert main(["run", "--config", str(tmp_path / "p.json"), "--validate"]) == 0
    assert main(["run", "--config", str(tmp_path / "p.json")], spark) == 0
    assert sqlite3.connect(tmp_path / "p.db").execute("select * from sample order by id").fetchall() == [(1, "cube", 1.5, "2024-01-02", 1), (2, "ball", 2.5, "2024-01-03", 0)]


def test_probe_json_and_xml(spark):
    found = probe.probe_sample(spark, b'{"items": [{"a": {"b": 1}, "c": "x"}, {"a": {"b": 2}}]}', "j", backend="sqlserver")
    assert found["storage"]["kind"] == "mssql" and found["storage"]["db"]["columns"] == ["a_b", "c"]
    assert [f["type"] for f in found["transform"][1]["options"]["contract"]["fields"]] == ["bigint", "text"]
    found = probe.probe_sample(spark, b"<R><I><a>1</a><b>x</b><b>y</b></I><I><a>2</a></I></R>", "x")
    assert found["parser"]["options"] == {"record_tag": "I", "fields": {"a": "a"}, "lists": {"b": "b"}}
    with pytest.raises(ValueError):
        probe.probe_sample(spark, b" ", "e")


def test_json_and_xml_pipelines(spark, tmp_path):
    base = {"job": "j", "source": {"kind": "file"}, "transform": [{"kind": "coerce", "options": {"types": {"id": "int"}}}], "storage": {"kind": "parquet", "db": {"dsn": str(tmp_path), "table": "t", "columns": ["id", "name"]}}}
    base["source"]["file"] = {"path": put(tmp_path, "a.json", '[{"id": 1, "name": "a"}, {"id": "x"}]')}
    done = runner.run(spark, Pipeline.of(base | {"parser": {"kind": "json"}}))
    assert done.counts["inserted"] == 1 and rows(spark.read.parquet(f"{tmp_path}/t")) == [(1, "a")]
    base["source"]["file"] = {"path": put(tmp_path, "a.xml", "<R><I><id>3</id><name>z</name></I></R>")}
    out = runner.plan(spark, Pipeline.of(base | {"parser": {"kind": "xml", "options": {"record_tag": "I", "fields": {"id": "id", "name": "name"}}}}))
    assert rows(out.accepted) == [(3, "z")]


def test_tools(spark, tmp_path):
    ids = put(tmp_path, "ids.csv", "5,a,b,c,1\n5,a,b,c,1\nx,a,b,c,1\n7,a\n8,a,b,c, 9 \n")
    assert main(["ids", ids, str(tmp_path / "ids")], spark) == 0
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "ids")).collect()) == ["5", "8"]
    lines = put(tmp_path, "lines.txt", "h\nrow 5\nrow 6\n")
    assert main(["keep", str(tmp_path / "ids"), lines, str(tmp_path / "kept")], spark) == 0
    assert [r["value"] for r in spark.read.text(str(tmp_path / "kept")).collect()] == ["row 5"]
    assert main(["diff", put(tmp_path, "old.txt", "h\nrow 6\n"), lines, str(tmp_path / "diff")], spark) == 0
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "diff")).collect()) == ["h", "row 5"]
    assert main(["strip-html", put(tmp_path, "p.html", "<a>x</a>\n<b>go</b>\n y \n"), str(tmp_path / "plain"), "--start", "go"], spark) == 0
    assert [r["value"] for r in spark.read.text(str(tmp_path / "plain")).collect()] == ["go", "y"]


def test_stream(spark, tmp_path):
    from millrace.functions.coerce import Coercion
    from millrace.streaming.files import read_stream, write_stream

    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "a.csv", "id,name\n1,a\nx,b\n")
    df = read_stream(spark, str(tmp_path / "in"), ["id", "name"])
    write_stream(df, {"id": Coercion("int")}, f"{tmp_path}/ok", f"{tmp_path}/bad", f"{tmp_path}/cp").awaitTermination(60)
    assert rows(spark.read.parquet(f"{tmp_path}/ok").select("id", "name")) == [(1, "a")]
    assert spark.read.parquet(f"{tmp_path}/bad").head()["_reject_reason"] == 'field "id": cannot coerce "x"'
