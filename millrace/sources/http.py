"""Downloads by tasks: requests with retries, first bytes, lists of urls."""

from __future__ import annotations

import os
import shutil
import ssl
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "url string, duration_ms bigint, download_size bigint, http_response_code int, file string"


def backoff(attempt: int, first: float = 0.2, most: float = 5.0) -> float:
    """Seconds to wait after an attempt (from 0): doubling, up to a bound."""
    return min(most, first * 2 ** max(0, attempt))


def retriable(status: int) -> bool:
    return status == 429 or 500 <= status <= 599


@dataclass
class Client:
    """Retries failures to connect, 429 and 5xx.  Without ``verify`` certificates aren't checked."""

    timeout: float = 30.0
    retries: int = 3
    first: float = 0.2
    most: float = 5.0
    sleep: Callable[[float], None] = time.sleep
    verify: bool = True

    def _context(self) -> ssl.SSLContext:
        context = ssl.create_default_context()
        if not self.verify:
            context.check_hostname, context.verify_mode = False, ssl.CERT_NONE
        return context

    def _file(self, url: str, limit: int | None, to: Callable[[], BinaryIO] | None) -> tuple[int, bytes]:
        """A file of a file system that Arrow knows, as an answer: 200, or 404 where none is; a query isn't part of its path."""
        files, path = fs.FileSystem.from_uri(url.partition("?")[0])
        if files.get_file_info(path).type != fs.FileType.File:
            return 404, b""
        with files.open_input_stream(path) as answer:
            if to is None:
                return 200, answer.read() if limit is None else answer.read(limit)
            with to() as f:
                shutil.copyfileobj(answer, f)
            return 200, b""

    def fetch(self, url: str, method: str = "GET", data: bytes | None = None, headers: dict[str, str] | None = None, limit: int | None = None, to: Callable[[], BinaryIO] | None = None) -> tuple[int, bytes]:
        """Status and body; with ``to`` a good answer's body goes to the file that it opens, piece by piece, instead.

        Urls of other schemes than http and https name files.
        """
        for attempt in range(self.retries + 1):
            try:
                if urlsplit(url).scheme.lower() not in ("", "http", "https"):
                    return self._file(url, limit, to)
                request = urllib.request.Request(url, data=data, method=method, headers=headers or {})
                with urllib.request.urlopen(request, timeout=self.timeout, context=self._context()) as answer:
                    if to is not None and 200 <= answer.status <= 299:
                        with to() as f:
                            shutil.copyfileobj(answer, f)
                        return answer.status, b""
                    return answer.status, answer.read() if limit is None else answer.read(limit)
            except urllib.error.HTTPError as e:
                if not retriable(e.code) or attempt == self.retries:
                    return e.code, e.read()
            except OSError:
                if attempt == self.retries:
                    raise
            self.sleep(backoff(attempt, self.first, self.most))
        raise AssertionError

    def first_bytes(self, url: str, n: int) -> bytes:
        """At most n bytes: asked for by range, and cut here if the server sends more."""
        if n <= 0:
            raise ValueError("the number of bytes must be positive")
        status, body = self.fetch(url, headers={"Range": f"bytes=0-{n - 1}"}, limit=n)
        if status not in (200, 206):
            raise OSError(f"{url}: status {status}")
        return body[:n]


def file_name(url: str) -> str:
    """The name a url's download gets: its cleaned query, else the SHA-1 of the url."""
    import hashlib
    import re

    clean = re.sub("[^a-zA-Z0-9]+", "_", urlsplit(url).query)
    return clean or hashlib.sha1(url.encode()).hexdigest()


def _urls(spark: SparkSession, urls: DataFrame | Iterable[str], tasks: int) -> DataFrame:
    """One text column ``url``, dealt to the tasks."""
    if not isinstance(urls, DataFrame):
        urls = spark.createDataFrame([(u,) for u in urls], "url string")
    return urls.select(F.col(urls.columns[0]).cast("string").alias("url")).filter("url IS NOT NULL").repartition(tasks)


def download(spark: SparkSession, urls: DataFrame | Iterable[str], folder: str, client: Client | None = None, workers: int = 4) -> DataFrame:
    """Fetches all urls (the first column) by ``workers`` tasks into a folder that all of them see, and returns the log.

    Each file is written beside its place and then renamed, so one that stands there is whole, and a task that runs again
    writes the same files.  The first failure fails the job, which stops what hasn't begun.  The log is written to the
    folder too, as an object a line, and read from there: nothing passes through the driver.  Folders may be local
    paths or uris of any file system that Arrow knows.
    """
    client = client or Client()

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = (fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder))
        files.create_dir(root, recursive=True)
        for batch in batches:
            for url in batch["url"]:
                began, name = time.monotonic(), file_name(url)
                place, part = f"{root.rstrip('/')}/{name}", f"{root.rstrip('/')}/.{name}.{uuid.uuid4().hex}"
                try:
                    status, _ = client.fetch(url, to=lambda: files.open_output_stream(part))
                    if not 200 <= status <= 299:
                        raise OSError(f"{url}: status {status}")
                    files.move(part, place)
                finally:
                    if files.get_file_info(part).type != fs.FileType.NotFound:
                        files.delete_file(part)
                yield pd.DataFrame([(url, int(1000 * (time.monotonic() - began)), files.get_file_info(place).size, status, place)], columns=["url", "duration_ms", "download_size", "http_response_code", "file"])

    log = f"{folder.rstrip('/')}/_log-{uuid.uuid4().hex}"
    log = log if "://" in log else f"file://{os.path.abspath(log)}"
    _urls(spark, urls, workers).mapInPandas(fetch, LOG_SCHEMA).write.json(log)
    return spark.read.schema(LOG_SCHEMA).json(log)


def first_bytes(spark: SparkSession, urls: DataFrame | Iterable[str], n: int, client: Client | None = None, workers: int = 4) -> DataFrame:
    """(url, start): at most n bytes of each url's body, fetched by tasks."""
    client = client or Client()

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(u, client.first_bytes(u, n)) for u in batch["url"]], columns=["url", "start"])

    return _urls(spark, urls, workers).mapInPandas(fetch, "url string, start binary")
