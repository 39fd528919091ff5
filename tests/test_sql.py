"""SQL functions and table functions against the expressions and the runner."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import sql, text
from millrace.plans import runner, spec

VALUES = [" 12 ", "1.0", "x", "31.02.2020", "01.03.2020", "2020-03-01T10:00:00Z", "true", "ne", "", "<b>x</b> y 7", None, "it's", "a\\b", " n\n"]


def test_functions_equal_their_expressions(spark):
    names = sql.register(spark)
    assert len(names) == len(sql.FUNCTIONS) + 2
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v string")
    for name, f in sql.FUNCTIONS.items():
        got = df.orderBy("i").selectExpr(f"millrace_{name}(v) AS o").collect()
        assert got == df.orderBy("i").select(f(F.col("v")).alias("o")).collect(), name
    sql.register_function(spark, "shout", lambda c: F.upper(c))
    assert spark.sql("SELECT shout('a') AS o").head()["o"] == "A"
    with pytest.raises(ValueError, match="lambda"):
        sql.register_function(spark, "ints", text.extract_ints)


def test_a_view_by_sql_alone_is_the_runners_result(spark, tmp_path):
    sql.register(spark)
    (tmp_path / "a.xml").write_text("<R>" + "".join(f"<P><id> {i} </id><d>0{1 + i % 9}.02.2020</d></P>" for i in range(40)) + "<n:P><id>x</id></n:P><P></y></P></R>")
    (tmp_path / "b.json").write_text('{"items": [{"id": 1, "d": "01.02.2020"}, {"id": "x"}, {"id": 2.0, "d": null}]}')
    steps = [{"kind": "coerce", "options": {"types": {"id": "int", "d": "date"}}}, {"kind": "require", "options": {"fields": ["id"]}}]
    for file, parser, call in (("a.xml", {"kind": "xml", "options": {"record_tag": "P", "fields": {"id": "id", "d": "d"}}}, "millrace_xml_records(value, 'P', map('id', 'id', 'd', 'd'))"), ("b.json", {"kind": "json"}, "millrace_json_records(value)")):
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW raw USING text OPTIONS (path '{tmp_path}/{file}', wholetext 'true')")
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW typed AS SELECT millrace_to_int(r.fields['id']) AS id, millrace_to_date(r.fields['d']) AS d FROM raw, LATERAL {call} r WHERE r.error IS NULL AND millrace_to_int(r.fields['id']) IS NOT NULL")
        p = {"job": "j", "source": {"kind": "file", "file": {"path": f"{tmp_path}/{file}"}}, "parser": parser, "transform": steps, "storage": {"kind": "none", "db": {"dsn": "x", "table": "t", "columns": ["id", "d"]}}}
        got = sorted(map(str, spark.table("typed").collect()))
        assert got == sorted(map(str, runner.plan(spark, spec.Pipeline.of(p)).accepted.collect())) and got
    bad = spark.sql("SELECT r.* FROM VALUES ('{\"id\": 1} {') AS t(v), LATERAL millrace_json_records(v) r").collect()
    assert [r["number"] for r in bad] == [1, 2] and bad[1]["error"]
    assert spark.sql("SELECT r.error FROM VALUES ('<P></x></P>') AS t(v), LATERAL millrace_xml_records(v, 'P', map('a', 'b')) r").head()[0] == "unexpected end element </x>"
