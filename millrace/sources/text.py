"""Text lines, list files, first bytes, and the replacement of broken sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import trim_unicode

#: The broken sequence that one public register's files hold, and its repair; fixed values.
BROKEN_NOTES = ((' "v likvidaci""', ' (v likvidaci)"'),)


def read_lines(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """(value): lines, or whole files."""
    return spark.read.text(path, wholetext=whole)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a list file: trimmed, without blank ones and ``#`` comments."""
    line = trim_unicode(F.col("value"))
    return read_lines(spark, path).select(line.alias("value")).filter((F.col("value") != "") & ~F.startswith("value", F.lit("#")))


def scrub(c: Column, pairs: Sequence[tuple[str, str]] = BROKEN_NOTES) -> Column:
    """Every pattern replaced, in order."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, "\\A\ufeff", "")


def first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    """The first n bytes of a file in any file system that Spark reads; only these are transferred."""
    if n <= 0:
        raise ValueError("the number of bytes must be positive")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()
