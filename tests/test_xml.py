"""The XML reader against an element tree, on files split at any place, and on what only a lenient reader reads."""

import random
from xml.etree import ElementTree

import pytest

from millrace.plans import runner, spec
from millrace.sources import tags, xml

NS = 'xmlns="u:d" xmlns:n="u:n" xmlns:q="u:q"'


def document(seed, n):
    """Records that nest, under two prefixes and none, beside comments, sections, instructions and attributes that look like them."""
    rnd = random.Random(seed)
    hidden = ["<!-- <P> </P> -->", "<![CDATA[</P> ]] <P>]]>", "<?go <P> ?>", "<n:XP a='P>'/>", "<!-- P> -->", "<PX>y</PX>", "&amp;&#65;", "\n"]

    def record(depth):
        p = rnd.choice(("P", "n:P", "q:P"))
        attrs = rnd.choice(("", " a='x>P>'", ' b="/>"', "\n", " q:k='P>\"'"))
        if rnd.random() < 0.1:
            return f"<{p}{attrs}/>"
        inner = "".join(rnd.choice((f"<id>{rnd.randrange(99)}</id>", rnd.choice(hidden), record(depth + 1) if depth < 2 else "z")) for _ in range(rnd.randrange(4)))
        return f"<{p}{attrs}>{inner}</{p}{rnd.choice(('', ' '))}>"

    return f"<?xml version='1.0'?><R {NS}>" + "".join(rnd.choice((record(0), record(0), rnd.choice(hidden))) for _ in range(n)) + "</R>"


def expected(text):
    """The ids in each outermost P."""
    name = lambda e: e.tag.rsplit("}", 1)[-1]

    def outermost(e):
        for c in e:
            if name(c) == "P":
                yield ["".join(x.itertext()) for x in c.iter() if name(x) == "id"]
            else:
                yield from outermost(c)

    return list(outermost(ElementTree.fromstring(text)))


def read(spark, path, part, **more):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    try:
        return xml.read_xml(spark, str(path), xml.XmlOptions("P", {"id": "id"}, {"ids": "id"}), **more).orderBy("_line").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("seed", range(4))
def test_records_in_any_parts_are_those_of_the_tree(spark, tmp_path, seed):
    text = document(seed, 60)
    (tmp_path / "a.xml").write_text(text)
    want = expected(text)
    for part in ("128m", "700b", "60b"):
        got = read(spark, tmp_path / "a.xml", part)
        assert [r["ids"] or [] for r in got] == want and not any(r["_parse_error"] for r in got)
    assert len(list(tags.shards(text, "P"))) == len(want)


def test_what_a_strict_reader_refuses(spark, tmp_path):
    good = ["<z:P><id>1</id></z:P>", "<P><id>a &nbsp; b & c</id></P>", "<P><w><id>2</P>", "<P x=1 y><id k>3</id></P >", "<n:P><n:id>4</n:id></n:P>"]
    bad = ["<P><id>5</id></x></P>", "<P>a < b<id>6</id></P>"]
    (tmp_path / "a.xml").write_text("<R></P>" + "".join(good + bad) + "</R><P><id>cut")
    for part in ("128m", "40b"):
        got = read(spark, tmp_path / "a.xml", part)
        assert [r["id"] for r in got] == ["1", "a &nbsp; b & c", "2", "3", "4", None, None, None]
        assert [r["_parse_error"] for r in got] == [None] * 5 + ["unexpected end element </x>", "expected an element's name after <", "the record is never closed"]


def test_what_cannot_be_read_is_counted(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<R><n:P><id>1</id></n:P><P></y></P><P><id>2</id></P><P>")
    done = runner.run(spark, spec.Pipeline.of({
        "job": "j", "source": {"kind": "file", "file": {"path": str(tmp_path / "a.xml")}}, "parser": {"kind": "xml", "options": {"record_tag": "P", "fields": {"id": "id"}}},
        "storage": {"kind": "parquet", "db": {"dsn": str(tmp_path / "out"), "table": "t", "columns": ["id"]}},
    }))
    assert (done.counts["processed"], done.counts["parse_errors"], done.counts["inserted"]) == (4, 2, 2)
    assert sorted(r["reason"] for r in done.rejected.collect()) == ["the record is never closed", "unexpected end element </y>"]


def test_one_record_over_many_parts(spark, tmp_path):
    body = "".join(f"<id>{i}</id><P/>" for i in range(3000))
    (tmp_path / "a.xml").write_text(f"<R><P>{body}</P><P><id>x</id></P></R>", encoding="utf-8")
    (tmp_path / "b.xml").write_text(f"<R><P>{body}", encoding="utf-8")
    for part in ("128m", "2k"):
        got = read(spark, tmp_path, part)
        assert sorted(len(r["ids"] or []) for r in got) == [0, 1, 3000] and sum(r["_parse_error"] is not None for r in got) == 1
    (tmp_path / "c.xml").write_bytes("<R><P><id>é</id></P></R>".encode("latin-1"))
    got = xml.read_xml(spark, str(tmp_path / "c.xml"), xml.XmlOptions("P", {"id": "id"}, encoding="latin-1")).collect()
    assert [tuple(r) for r in got] == [("é", 1, None)]
