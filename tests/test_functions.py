"""Column functions on tables of small cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import checks, coerce, layouts, text


def values(spark, cases, f):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s string")
    return [r["v"] for r in rows.select("i", f(F.col("s")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "f, cases",
    [
        (text.trim_edges, {" a ": "a", " a": " a", "  a \n": "a", "": "", "a b": "a b"}),
        (text.normalize, {" a b ": "a b", "x": "x"}),
        (text.strip_html, {"a<b c>d>e<f": "ade", "1 < 2 and 3 > 2": "1  2", "<p>x</p>": "x", "a\n<b\n>c": "a\nc"}),
        (text.collapse_whitespace, {" a \t\n b c ": "a b c", "\n": ""}),
        (text.normalize_text, {"<p> a\n<b>b</b></p>": "a b"}),
        (lambda c: text.extract_between(c, "[", "]"), {"a[b]c": "b", "[]": None, "a]b[c": None, "x": None, "[a][b]": "a"}),
        (lambda c: text.extract_between(c, "", "]"), {"ab]c": "ab", "x": None}),
        (lambda c: text.extract_between(c, "[", ""), {"a[bc": "bc", "a[": None}),
        (text.extract_ints, {"a12b34c 56": [12, 34, 56], "": [], "9223372036854775808 1": None, "٣": None, "-5": [5]}),
        (text.safe_filename, {"http://h/p?a=1&b=2#f": "a_1_b_2"}),
        (text.truncate_name, {"x" * 64: "x" * 63, "ab" * 40: "ab" * 5 + ("ab" * 40)[-53:], "short": "short"}),
        (text.detect_format, {" {": "json", "[1": "json", "<?xml?>": "xml", "a <b> c": "xml", "a,b": "csv", " ": "unknown"}),
        (text.ascii_field_name, {"Hello World": "hello_world", "A-B.C": "a_b_c", "__": "col", " x ": "x"}),
        (text.field_name_column, {"PČV": "pcv", "Straße": "strae", "Hello World": "hello_world", "__": "col", "É": "e"}),
        (text.strip_line_end, {"a\r\n": "a", "a\r": "a", "a\n": "a", "a": "a"}),
        (coerce.to_int, {"42": 42, "+7": 7, "42.0": 42, "42.5": None, "x": None, "9223372036854775808": None, "1e3": None, "1.0e2": 100, "4_2": None}),
        (coerce.to_bool, {"Ano": True, "NE": False, "1": True, "maybe": None}),
        (coerce.to_float, {"1": 1.0, "1.5": 1.5, ".5": 0.5, "1d": None, "x": None}),
        (coerce.to_date_cz, {"31.02.2024": datetime.date(2024, 3, 2), "07.10.2011 x": datetime.date(2011, 10, 7), "1.1.2020": None, "01.13.2020": None}),
        (lambda c: coerce.to_date(c, "02/01/2006"), {"03/04/2024": datetime.date(2024, 4, 3), "2024-01-02": datetime.date(2024, 1, 2), "05.06.2024": datetime.date(2024, 6, 5), "x": None}),
        (lambda c: coerce.coerce_keep(c, "int"), {"1": "1", "x": "x", "+1": "1"}),
        (lambda c: coerce.coerce_keep(c, "Int"), {"+1": "+1"}),
        (checks.is_int, {" 1 ": True, "1.0": False, "": False}),
        (checks.is_real, {"1.1": True, "2e3": True, "1": False, "NaN": True, "1d": False}),
        (checks.is_bool_word, {"Yes": True, "ano": False}),
        (checks.is_date, {"2024-01-02": True, "31.02.2024": False, "2 Jan 2024": True, "02-JAN-2024": True, "20240102": True}),
        (checks.is_timestamp, {"2024-01-02T03:04:05Z": True, "2024-01-02T03:04:05.123456789+01:00": True, "2024-01-02 03:04:05": True, "2024-01-02": False}),
    ],
)
def test_values(spark, f, cases):
    assert values(spark, list(cases), f) == list(cases.values())


def test_filename_without_query_is_a_hash(spark):
    from millrace.sources.http import file_name

    urls = ["http://h/p", "http://h/?", "http://h/?a=ž", "x?&&"]
    assert values(spark, urls, text.safe_filename) == [file_name(u) for u in urls]


def test_layouts_parse_their_own_example(spark):
    cases = {
        "2006-01-02": "2024-02-29", "02.01.2006": "29.02.2024", "01/02/2006": "02/29/2024", "2 Jan 2006": "9 feb 2024", "02-Jan-2006": "09-Feb-2024", "20060102": "20240229",
        layouts.RFC3339: "2024-02-29T01:02:03+01:00", "2006-01-02 15:04:05.999999999": "2024-02-29 01:02:03.5", "2006-01-02T15:04:05Z0700": "2024-02-29T01:02:03+0100", "2006-01-02 15:04:05 -0700": "2024-02-29 01:02:03 +0100",
    }
    for layout, example in cases.items():
        got = values(spark, [example, example + "x", "2024-2-9", "31.02.2024"], lambda c: layouts.parse(c, layout))
        assert got[0] is not None and got[1:] == [None] * 3, layout
    assert values(spark, ["2024-02-29T01:02:03.5Z"], lambda c: layouts.parse(c, layouts.RFC3339))[0].microsecond == 500000


def test_best_layout_prefers_day_first():
    assert layouts.best_layout({"2006-01-02": 2, "02.01.2006": 2, "01.02.2006": 2}) == "02.01.2006"
    assert layouts.best_layout({"2006-01-02": 0}) == ""


def test_coerce_gives_the_first_reason(spark):
    df = spark.createDataFrame([("1", "x", "07.10.2011", "True"), ("z", 'q"', "soon", "True"), (" ", "", "", "")], "pcv string, typ string, day string, ok string")
    plan = {"pcv": coerce.Coercion("int"), "day": coerce.Coercion("date"), "ok": coerce.Coercion("bool")}
    got = coerce.coerce(df, plan).collect()
    assert tuple(got[0]) == (1, "x", datetime.date(2011, 10, 7), True, None)
    assert got[1]["_reject_reason"] == 'field "pcv": cannot coerce "z"'
    assert tuple(got[2]) == (None,) * 5
    assert coerce.coerce(df, plan, empty_rejects=True).collect()[2]["_reject_reason"] == 'field "pcv": cannot coerce ""'


CONTRACT = [checks.Field("id", "int", required=True), checks.Field("flag", "bool"), checks.Field("d1", "date", layout="02.01.2006"), checks.Field("d2", "date"), checks.Field("status", "text", enum=("new", "ok", "done")), checks.Field("note", "text")]


def test_contract(spark):
    rows = [
        ("1", "true", "02.01.2006", "2024-01-02", "ok", "n"),
        ("2", "ANO", "", None, "new", None),
        (None, "true", "", "", "ok", ""),
        ("x", "true", "", "", "ok", ""),
        ("4", "perhaps", "", "", "ok", ""),
        ("5", "ne", "2024/01/02", "", "ok", ""),
        ("6", "0", "", "", "bad", ""),
        (" 7 ", " yes ", " 02.01.2006 ", "", "done", ""),
    ]
    df = spark.createDataFrame(rows, "id string, flag string, d1 string, d2 string, status string, note string")
    got = [r[0] for r in df.select(checks.contract_reason(df, CONTRACT)).collect()]
    assert got == [None, None, 'required field "id" missing', 'field "id": "x" not an int', 'field "flag": "perhaps" not a recognized boolean', 'field "d1": invalid date "2024/01/02"', 'field "status": "bad" not in enum [new ok done]', None]


def test_typed_columns_pass_their_kinds(spark):
    df = spark.createDataFrame([(1, True, datetime.date(2024, 1, 1), 1.5, "x")], "i bigint, b boolean, d date, f double, s string")
    reason = lambda kinds: df.select(checks.stream_reason(df, [], kinds)).head()[0]
    assert reason({"i": "bigint", "b": "bool", "d": "timestamp"}) is None
    assert reason({"f": "int"}) == 'field "f": "1.5" not a valid int'
    assert reason({"s": "date"}) == 'field "s": "x" not a valid date'


def test_require_of_an_unknown_field_drops_all(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "x string")
    assert [r["x"] for r in checks.require(df, ["x"]).collect()] == ["a"]
    assert checks.require(df, ["y"]).count() == 0
