"""Order of lines and rows over files that are split."""

from millrace.operators import order
from millrace.plans import runner, spec
from millrace.sources import csv


def test_lines_are_numbered_and_written_in_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [[f"{f} {i}" * (1 + i % 7) for i in range(n)] for f, n in (("a", 500), ("b", 1), ("c", 900))]
    for name, some in zip("abc", lines):
        (tmp_path / "in" / f"{name}.txt").write_text("\n".join(some) + ("" if name == "b" else "\n"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = order.numbered_lines(spark, str(tmp_path / "in"))
        want = sum(lines, [])
        assert [r["value"] for r in got.orderBy("line").collect()] == want and sorted(r["line"] for r in got.collect()) == list(range(len(want)))
        order.in_order(got.repartition(5), ["line"], 4).select("value").write.text(str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len(files) > 1 and "".join(f.read_text() for f in files).splitlines() == want


def test_rows_of_split_files_keep_their_order(spark, tmp_path):
    """The last part of a file is small, and readers take large parts first: order must come from the places, not the tasks."""
    rows = [f'{i % 5},"{"x" * (i % 9)}{chr(10) if i % 4 == 0 else ""}{i}"' for i in range(400)]
    (tmp_path / "a.csv").write_text("k,v\n" + "\n".join(rows) + "\n")
    (tmp_path / "b.csv").write_text("k,v\n" + "\n".join(r.replace("\n", " ") for r in rows) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        for name, gap in (("a.csv", "\n"), ("b.csv", " ")):
            got = csv.read_csv(spark, str(tmp_path / name), csv.CsvOptions(trim_space=False), ["k", "v"], line=True)
            assert [r["v"] for r in got.orderBy("_line").collect()] == ["x" * (i % 9) + (gap if i % 4 == 0 else "") + str(i) for i in range(400)]
            p = {"job": "j", "source": {"kind": "file", "file": {"path": str(tmp_path / name)}}, "parser": {"kind": "csv", "options": {}}, "storage": {"kind": "none", "db": {"dsn": "x", "table": "t", "columns": ["k", "v"]}}}
            for policy, at in (("keep-first", 0), ("keep-last", 395)):
                done = runner.plan(spark, spec.Pipeline.of(p | {"transform": [{"kind": "dedup", "options": {"keys": ["k"], "policy": policy}}]}))
                assert {r["k"]: int(r["v"].split(gap)[-1].lstrip("x")) for r in done.accepted.collect()} == {str(k): at + k for k in range(5)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
