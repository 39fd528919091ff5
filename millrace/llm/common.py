"""Shared pieces of the training-data operators: shared tables, words, hashes.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``, which
every executor can read.  Only when that setting is absent (tests, local runs)
is a temporary folder chosen.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, and words, as the operators define them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables, read lazily by Spark from any file system."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that all executors and the driver see."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
    spark.conf.set("spark.checkpoint.dir", made)
    return made


class Shared:
    """Intermediate tables of one operator call, written once and reread.

    A written table cuts the lineage: a lost executor costs the recomputation
    of at most one stage, and what a table was made from is not run again.
    Operators drop the tables that their result doesn't read; the others stay,
    since results are lazy, until the folder is cleared.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Removes tables that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


def power_of_two(n: float, least: int = 1) -> int:
    """The smallest power of two that is no less than n and least."""
    k = least
    while k < n:
        k *= 2
    return k


def in_training(doc_id: Column) -> Column:
    """False for the held-out fifth: crc32 of the id as text, modulo 5, is 0. A null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 0


def draw(doc_id: Column, seed: str) -> Column:
    """A uniform number in [0, 1) fixed by the id and the seed."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")), 1, 13), 16, 10).cast("double") / float(16**13)


# ---- vectorised word hashes -------------------------------------------------

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLY = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * _MULTIPLY
    x = x ^ (x >> np.uint64(29))
    x = x * _ODD
    return x ^ (x >> np.uint64(32))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    have = 1
    step = np.array(base)  # an array wraps silently
    while have < n:  # doubling
        take = min(have, n - have)
        out[have : have + take] = out[:take] * step
        have += take
        step = np.multiply(step, step, dtype=np.uint64)
    return out


_POW = _powers(1 << 12, _ODD)


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes folded to lower case, and the start and end of each word in them."""
    buffer = _FOLD[np.frombuffer(data, dtype=np.uint8)]
    gap = np.ones(len(buffer) + 2, dtype=bool)
    gap[1:-1] = _SPACE[buffer]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return buffer, edge[::2], edge[1::2]


def word_hashes(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over random byte values, then mixed."""
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    long = end - start
    at = np.arange(len(buffer)) - np.repeat(start, np.diff(np.concatenate(([0], start[1:], [len(buffer)]))))
    at[: start[0]] = 0
    power = _POW if int(long.max()) <= len(_POW) else _powers(int(long.max()), _ODD)
    value = _BYTE[buffer] * power[np.minimum(at, len(power) - 1)]
    total = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(value, out=total[1:])
    return mix((total[end] - total[start]) ^ (long.astype(np.uint64) << np.uint64(48)))


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each tuple of hashes; order counts."""
    out = np.zeros(len(parts[0]), dtype=np.uint64)
    for p in parts:
        out = mix(out * _ODD + p)
    return out


def shingle_sets(texts: list[bytes], width: int = 5, step: int = 1 << 20) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of ``width`` words.

    A text with fewer words has its whole sequence as its one shingle; without
    words the set is empty.  Texts are hashed together, about ``step`` bytes
    at a time.
    """
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= step):
            size += len(texts[j]) + 1
            j += 1
        buffer, start, end = words_of(b"\n".join(texts[i:j]))
        hashes = word_hashes(buffer, start, end)
        edge = np.cumsum([0, *(len(t) + 1 for t in texts[i:j])])
        at = np.searchsorted(start, edge)
        many = combine([hashes[k : len(hashes) - width + 1 + k] for k in range(width)]) if len(hashes) >= width else hashes[:0]
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= width:
                yield np.unique(many[a : b - width + 1])
            elif b > a:
                yield combine([hashes[k : k + 1] for k in range(a, b)])
            else:
                yield hashes[:0]
        i = j


def texts_of(column) -> Iterator[bytes]:
    """UTF-8 bytes of each value of an Arrow string column; null as empty."""
    import pyarrow as pa

    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        for x in chunk.cast(pa.large_binary()):
            yield x.as_py() or b""


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that gives freed memory back at its end, as worker processes outlive tasks."""

    def wrapped(batches: Iterator) -> Iterator:
        import ctypes

        import pyarrow as pa

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # not every C library has it
            pass

    return wrapped


def named_words(text: str) -> list[str]:
    """Plain form of the words, for brute-force checks."""
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))
