"""Metrics as datagrams: counters and histograms with tags, of runs and of streaming queries as they go."""

from __future__ import annotations

import re
import socket
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql.streaming import StreamingQueryListener

from .metrics import BATCHES, DURATION, RECORDS, Metrics


def _plain(text: str) -> str:
    """A name or tag without the characters that part a datagram."""
    return re.sub(r"[\s|#,:@]+", "_", text)


def datagram(name: str, value: float, kind: str, tags: Mapping[str, str] | None = None) -> str:
    line = f"{_plain(name)}:{value:g}|{kind}" if value % 1 else f"{_plain(name)}:{int(value)}|{kind}"
    return line + ("|#" + ",".join(f"{_plain(k)}:{_plain(str(v))}" for k, v in tags.items()) if tags else "")


def packets(lines: Iterable[str], most: int = 1432) -> Iterable[bytes]:
    """Lines put together into packets that fit a frame; a longer line is a packet of its own."""
    held: list[bytes] = []
    for line in lines:
        data = line.encode()
        if held and sum(map(len, held)) + len(held) + len(data) > most:
            yield b"\n".join(held)
            held = []
        held.append(data)
    if held:
        yield b"\n".join(held)


@dataclass(frozen=True)
class Statsd:
    """``address``: host:port of the agent.  Tags hold for everything sent. Datagrams aren't answered, so a missing agent goes unnoticed."""

    address: str
    namespace: str = ""
    tags: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.address.rpartition(":")[2].isdigit() or not self.address.rpartition(":")[0]:
            raise ValueError(f"not host:port: {self.address!r}")

    def send(self, rows: Iterable[tuple[str, float, str, Mapping[str, str]]]) -> None:
        host, _, port = self.address.rpartition(":")
        lines = [datagram(self.namespace + name, value, kind, {**self.tags, **tags}) for name, value, kind, tags in rows]
        with socket.socket(socket.AF_INET6 if ":" in host else socket.AF_INET, socket.SOCK_DGRAM) as s:
            for packet in packets(lines):
                s.sendto(packet, (host, int(port)))

    def push(self, metrics: Metrics) -> None:
        """The counters of a run, rounded down to whole numbers, and each duration of its steps."""
        tags = lambda labels: {"job": metrics.job} | dict(re.findall(r'(\w+)="([^"]*)"', labels))
        rows = [(name, float(int(n)), "c", tags(labels)) for (name, labels), n in sorted(metrics.counts.items())]
        self.send([*rows, *((DURATION, x, "h", tags(f'step="{step}"')) for step, values in sorted(metrics.durations.items()) for x in values)])


class StreamEvents(StreamingQueryListener):
    """Counts what each batch of a streaming query reads, and times it; add it by ``spark.streams.addListener``."""

    def __init__(self, to: Statsd):
        self.to = to

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        tags = {"job": p.name or str(p.id)}
        self.to.send([(RECORDS, float(p.numInputRows), "c", tags | {"kind": "processed"}), (BATCHES, 1.0, "c", tags), (DURATION, p.batchDuration / 1000, "h", tags | {"step": "batch"})])

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
