"""Downloads by tasks, and metrics as datagrams, against servers on this machine."""

import json
import socket
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from millrace.plans import runner, spec
from millrace.sinks import statsd
from millrace.sinks.metrics import Metrics
from millrace.sources import http


@pytest.fixture
def server():
    class Pages(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            self.send_response(404 if "missing" in self.path else 200)
            self.end_headers()
            self.wfile.write(b"body of " + self.path.encode())

        def log_message(self, *args):
            pass

    made = ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}"
    made.shutdown()
    made.server_close()


def test_downloads_by_tasks(spark, tmp_path, server):
    urls = spark.createDataFrame([(f"{server}/x?name={i}",) for i in range(20)] + [(None,)], "url string")
    log = http.download(spark, urls, str(tmp_path / "to"), workers=3).collect()
    assert sorted(r["url"] for r in log) == sorted(f"{server}/x?name={i}" for i in range(20)) and {r["http_response_code"] for r in log} == {200}
    files = {p.name: p.read_text() for p in (tmp_path / "to").iterdir() if p.is_file()}
    assert files == {f"name_{i}": f"body of /x?name={i}" for i in range(20)}
    assert http.download(spark, [f"{server}/y?z=1"], f"file://{tmp_path}/uri").head()["download_size"] == len("body of /y?z=1")
    got = http.first_bytes(spark, urls, 6).collect()
    assert len(got) == 20 and {bytes(r["start"]) for r in got} == {b"body o"}


def test_a_failing_download_leaves_no_part(spark, tmp_path, server):
    with pytest.raises(Exception, match="status 404"):
        http.download(spark, [f"{server}/x?name=1", f"{server}/missing?a=1"], str(tmp_path / "to"), workers=1)
    assert [p.name for p in (tmp_path / "to").iterdir() if p.is_file()] in ([], ["name_1"])


def received(sock):
    out = []
    sock.settimeout(2)
    try:
        while True:
            out += sock.recv(65536).decode().split("\n")
    except TimeoutError:
        return out


@pytest.fixture
def agent():
    with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as s:
        s.bind(("127.0.0.1", 0))
        yield s, f"127.0.0.1:{s.getsockname()[1]}"


def test_datagrams(agent):
    sock, address = agent
    m = Metrics("j|x")
    m.records("inserted", 3)
    m.durations["load"] = [0.25, 2.0]
    statsd.Statsd(address, "app.", {"env": "t,1"}).push(m)
    assert received(sock) == ["app.etl_records_total:3|c|#env:t_1,job:j_x,kind:inserted", "app.etl_step_duration_seconds:0.25|h|#env:t_1,job:j_x,step:load", "app.etl_step_duration_seconds:2|h|#env:t_1,job:j_x,step:load"]
    assert [len(p) for p in statsd.packets(["x" * 600] * 3 + ["y" * 2000])] == [1201, 600, 2000] and list(statsd.packets([])) == []
    for bad in ("", "host", ":1", "h:x"):
        with pytest.raises(ValueError):
            statsd.Statsd(bad)


def test_counters_of_a_run_and_a_stream(spark, tmp_path, agent):
    sock, address = agent
    (tmp_path / "in.csv").write_text("k\n1\n2\n")
    done = runner.run(spark, spec.Pipeline.of({
        "job": "j", "source": {"kind": "file", "file": {"path": str(tmp_path / "in.csv")}}, "parser": {"kind": "csv", "options": {"has_header": True}},
        "storage": {"kind": "sqlite", "db": {"dsn": f"{tmp_path}/o.db", "table": "t", "columns": ["k"], "key_columns": ["k"], "upsert": True, "auto_create_table": True}},
    }), statsd=address)
    lines = received(sock)
    assert done.counts["inserted"] == 2 and "etl_records_total:2|c|#job:j,kind:inserted" in lines and any(x.startswith("etl_step_duration_seconds:") for x in lines)
    listener = statsd.StreamEvents(statsd.Statsd(address))
    spark.streams.addListener(listener)
    try:
        (tmp_path / "s").mkdir()
        (tmp_path / "s" / "a.json").write_text("".join(json.dumps({"x": i}) + "\n" for i in range(5)))
        q = spark.readStream.schema("x int").json(str(tmp_path / "s")).writeStream.queryName("q").format("noop").trigger(availableNow=True).start()
        q.awaitTermination()
        lines = received(sock)
    finally:
        spark.streams.removeListener(listener)
    assert "etl_records_total:5|c|#job:q,kind:processed" in lines
