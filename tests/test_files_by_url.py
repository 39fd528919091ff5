"""Downloads by urls of files, which need no server and so run on a cluster."""

import pytest

import __spark_entry__ as entry
from millrace.plans import readback
from millrace.sources import http

SF = "/root/testdata/sf0.001"


def test_files_are_fetched(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"abcdef")
    url = f"file://{tmp_path}/a?name=1"
    client = http.Client(retries=0)
    assert client.fetch(url) == (200, b"abcdef") and client.fetch(url, limit=2) == (200, b"ab") and client.first_bytes(url, 3) == b"abc"
    assert client.fetch(f"file://{tmp_path}/none?a=1")[0] == 404
    log = http.download(spark, [url], str(tmp_path / "to")).head()
    assert (log["download_size"], log["http_response_code"]) == (6, 200) and (tmp_path / "to" / "name_1").read_bytes() == b"abcdef"
    with pytest.raises(Exception, match="status 404"):
        http.download(spark, [f"file://{tmp_path}/none?a=1"], str(tmp_path / "to"), http.Client(retries=0)).collect()


def test_the_query_needs_no_local_mode(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere")
    monkeypatch.setattr(readback, "scratch", lambda _: f"file://{tmp_path}/shared")
    got = {r["file"]: (r["download_size"], r["code"], r["body"], r["start"]) for r in entry.queries()["downloads"](spark, SF).collect()}
    keys = [r[0] for r in spark.read.parquet(f"{SF}/supplier.parquet").select("s_suppkey").collect()]
    assert got == {f"name_{k}": (8 + len(str(k)), 200, f"of name={k}", "of ") for k in keys}
