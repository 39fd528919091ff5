"""Run metrics: counters and step durations, as a DataFrame or in the text format of push gateways."""

from __future__ import annotations

import time
import urllib.request
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

#: Names of the series; fixed values.
STEPS, RECORDS, BATCHES, DURATION = "etl_step_total", "etl_records_total", "etl_batches_total", "etl_step_duration_seconds"


@dataclass
class Metrics:
    job: str = ""
    counts: Counter = field(default_factory=Counter)
    durations: dict[str, list[float]] = field(default_factory=dict)

    def records(self, kind: str, n: int) -> None:
        self.counts[(RECORDS, f'kind="{kind}"')] += n

    def batches(self, n: int) -> None:
        self.counts[(BATCHES, "")] += n

    @contextmanager
    def step(self, name: str) -> Iterator[None]:
        """Times a step and counts it as a success or a failure."""
        began, status = time.monotonic(), "failure"
        try:
            yield
            status = "success"
        finally:
            self.counts[(STEPS, f'step="{name}",status="{status}"')] += 1
            self.durations.setdefault(name, []).append(time.monotonic() - began)

    def rows(self) -> list[tuple[str, str, float]]:
        out = [(name, labels, float(n)) for (name, labels), n in sorted(self.counts.items())]
        for step, values in sorted(self.durations.items()):
            values = sorted(values)
            out += [(DURATION, f'step="{step}",quantile="{q}"', values[min(len(values) - 1, int(q * len(values)))]) for q in (0.5, 0.9, 0.99)]
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "name string, labels string, value double")

    def text(self) -> str:
        return "".join(f"{name}{{{labels}}} {value:g}\n" if labels else f"{name} {value:g}\n" for name, labels, value in self.rows())

    def push(self, gateway: str) -> None:
        request = urllib.request.Request(f"{gateway.rstrip('/')}/metrics/job/{self.job}", data=self.text().encode(), method="PUT")
        urllib.request.urlopen(request, timeout=10).close()
