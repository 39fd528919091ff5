"""Total order: the place of each line among all lines of its files, and writing in an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value): all lines with their numbers from 0, files in the order of their paths.

    One scan counts the lines of each part of a file (nothing is shuffled but the counts, one row a part for the driver);
    a line's number is its part's first one plus its place in the part.
    """
    own = F.monotonically_increasing_id()
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), own.alias("own"), "value")
    parts = sorted(lines.groupBy("file", "block").agg(F.min("own").alias("first"), F.count("*").alias("n")).collect())
    before, total = [], 0
    for file, block, first, n in parts:
        before.append((file, block, first, n, total))
        total += n
    known = spark.createDataFrame(before, "file string, block long, first long, n long, before long")
    place = F.col("own") - F.col("first")
    same = place.between(0, F.col("n") - 1)
    number = F.when(same, F.col("before") + place).otherwise(F.raise_error(F.lit("the files are split in other places than when their lines were counted")).cast("long"))
    return lines.join(known, ["file", "block"], "left").select(number.alias("line"), "value")


def in_order(df: DataFrame, by: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """Rows dealt to ranges and sorted in each, so that what is written, file after file, is in order: no task holds more than its range."""
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    dealt = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)
