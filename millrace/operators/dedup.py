"""Deduplication by business key, and validated distinct ids.

Winners are chosen by an aggregation, not a window: each task first reduces
its own rows of a key to one, so a key with very many rows doesn't meet in a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checks import as_int, is_filled, is_int, plain_int
from ..functions.coerce import where
from ..functions.text import trim_unicode

KEEP_FIRST, KEEP_LAST, MOST_COMPLETE = "keep-first", "keep-last", "most-complete"


def completeness(df: DataFrame, prefer: Sequence[str] = (), ignore: Sequence[str] = ()) -> Column:
    """Ten for each filled field and one more for each filled preferred field."""
    one = lambda name: F.when(is_filled(F.col(f"`{name}`")), 1).otherwise(0)
    all_ = [10 * one(c) for c in df.columns if c not in ignore]
    more = [one(c) for c in prefer if c in df.columns]
    return reduce(lambda a, b: a + b, [*all_, *more], F.lit(0))


def dedup(df: DataFrame, keys: Sequence[str], policy: str = KEEP_LAST, order_by: Sequence[str] = ("_line",), prefer: Sequence[str] = (), missing: Column | None = None, ordered: bool = False) -> DataFrame:
    """One row for each key.

    Keys compare as text and nulls equal each other.  ``order_by`` is the
    rows' order (make it total); the policies take the first or last row, or
    the most complete, of which the later.  An unknown policy means the last;
    without keys, or with one that isn't a column, nothing is dropped.

    ``missing`` tells rows whose record lacks a key altogether (a null is a
    key like others); they pass through.  ``ordered`` gives the winners in the
    rows' order, then what passed through in that order; it sorts, so leave it off where order doesn't matter.
    """
    if missing is not None or ordered:
        flagged = df.withColumn("_passed", F.coalesce(missing, F.lit(False)) if missing is not None else F.lit(False))
        won = dedup(flagged.filter(~F.col("_passed")).drop("_passed"), keys, policy, order_by, prefer)
        out = won.withColumn("_passed", F.lit(False)).unionByName(flagged.filter("_passed"))
        return (out.orderBy("_passed", *order_by) if ordered else out).drop("_passed")
    if not keys or any(k not in df.columns for k in keys):
        return df
    policy = policy.strip().lower()
    line = F.struct(*[F.col(f"`{c}`") for c in order_by])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    key = [F.col(f"`{k}`").cast("string").alias(f"key {i}") for i, k in enumerate(keys)]
    if policy == KEEP_FIRST:
        best = F.min_by(row, line)
    elif policy == MOST_COMPLETE:
        best = F.max_by(row, F.struct(completeness(df, prefer, ignore=[c for c in order_by if c.startswith("_")]).alias("score"), line.alias("line")))
    else:
        best = F.max_by(row, line)
    return df.groupBy(*key).agg(best.alias("row")).select("row.*")


def distinct_first(df: DataFrame, id_col: str, check_col: str, order_by: Sequence[str], max_id: int | None = None) -> DataFrame:
    """The first text of each valid id: (id, text), in no order.

    Rows count when both columns are trimmed integers.  Ids outside 0 to
    ``max_id`` aren't remembered, so each of their rows stays.
    """
    c = F.col(f"`{id_col}`").cast("string")
    text = F.when(plain_int(c), c).otherwise(trim_unicode(c))
    ok = is_int(F.col(f"`{check_col}`").cast("string"))
    rows = df.select(F.when(ok, as_int(c)).alias("id"), text.alias("text"), F.struct(*[F.col(f"`{x}`") for x in order_by]).alias("at"))
    rows = where(rows, F.col("id").isNotNull())
    if max_id is None:
        return rows.filter("id >= 0").groupBy("id").agg(F.min_by("text", "at").alias("text"))
    # a row that isn't remembered is a group of its own, so one scan serves both
    own = F.when(~F.col("id").between(0, max_id), F.struct("at", F.monotonically_increasing_id()))
    return rows.withColumn("own", own).groupBy("id", "own").agg(F.min_by("text", "at").alias("text")).drop("own")


def distinct_counts(df: DataFrame, id_col: str, check_col: str) -> DataFrame:
    """One row: processed, written (different valid ids), malformed."""
    ok = is_int(F.col(f"`{id_col}`").cast("string")) & is_int(F.col(f"`{check_col}`").cast("string"))
    id_ = trim_unicode(F.col(f"`{id_col}`").cast("string")).try_cast("bigint")
    per = df.groupBy(F.when(ok, id_).alias("id")).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("processed"), F.count("id").alias("written"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("malformed"))
