"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, Shared, power_of_two

#: Weights of the sources in code-point order (null last), repeating.
WEIGHTS = (3, 1, 2)


def count_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # every word but a leading one follows white space, so the words are the pieces that aren't empty
    return F.when(F.rlike(text, F.lit(WORD)), F.size(F.split(F.regexp_replace(text, rf"^{SPACE}|{SPACE}\z", ""), SPACE))).otherwise(0).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_share: float = 1.5, most_epochs: int = 2) -> DataFrame:
    """One row for each source: source, source_size, target.

    ``sizes`` has source and source_size, one row each.  The budget of
    total_share times all sizes is shared by weight; a source stops at
    most_epochs times its size and the excess is shared again by weight.
    That settles in one pass: with sources ordered by cap/weight, a source is
    capped exactly when its cap/weight is at most the water level that its
    predecessors leave.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    sizes = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(every) - 1) % len(weights) + 1))
    cap = F.col("source_size") * most_epochs
    order = Window.orderBy((cap / F.col("weight")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = sizes.select(
        "source",
        "source_size",
        "weight",
        cap.alias("cap"),
        (F.sum("source_size").over(whole) * F.lit(total_share) - F.coalesce(F.sum(cap).over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_left"),
    )
    full = F.col("cap") / F.col("weight") <= F.col("left") / F.col("weight_left")
    sizes = sizes.withColumn("full", full)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(whole)
    open_budget = F.sum("source_size").over(whole) * F.lit(total_share) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * open_budget / open_weight)
    return sizes.select("source", "source_size", target.cast("double").alias("target"))


def mix_sources(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, total_share: float = 1.5, most_epochs: int = 2, seed: str = "mix", bucket_rows: int = 20_000, carry: tuple[str, ...] = (), broadcast_rows: int = 100_000) -> DataFrame:
    """Words each document gives to a mix of the sources at their target weights.

    Returns doc_id, size, source, source_size, target, taken, and the columns
    of ``docs`` named in ``carry``.  Documents of a
    source are laid out in the order of a hash of id (of the text for a null id) and seed; whole epochs
    are repeated while they fit the budget (the target rounded down), and the
    last epoch is cut at the exact word.  A null source is a source of its
    own; null and empty texts have size 0 and give nothing; rows repeated under
    one id follow each other, and rows equal in id and size are
    interchangeable; a text of any length is only counted; an empty table gives no rows.  Only the columns named are read.

    The leading bits of the key split each source into ranges of about
    ``bucket_rows`` rows.  Sums of the ranges and their prefix sums name the
    one range of each source in which its last epoch ends.  Only that range is
    sorted and summed row by row; all other rows learn from one row a
    source whether they lie before or behind it, in a narrow pass.  Sources are taken to be few:
    their targets come from one task.
    """
    shared = Shared(spark, "mixing")
    name = F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col).cast("string").cast("binary")), F.lit(""))
    key = F.md5(F.concat(name, F.lit(f":{seed}")).cast("binary"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), count_words(F.col(text_col)).alias("size"), key.alias("key"), *[F.col(c).alias(f"carried {c}") for c in carry])
    slim = shared.keep(rows.select("doc_id", "source", "size", "key"), "sizes")
    if not carry:
        rows = slim  # else texts are read again, not written
    bits = min(32, power_of_two(slim.count() / bucket_rows, 1).bit_length() - 1)
    bucket = F.shiftrightunsigned(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), 32 - bits).alias("bucket")
    ranges = shared.keep(slim.groupBy("source", bucket).agg(F.sum("size").alias("range_size")), "ranges")
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, total_share, most_epochs)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long")
    targets = shared.keep(targets.select("source", "source_size", "target", epochs.alias("epochs"), (budget - epochs * F.col("source_size")).alias("rest")), "targets")
    # the first range that isn't taken whole in the last epoch, and what lies ahead of it
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = ranges.select("source", "bucket", "range_size", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("ahead")).alias("e").join(targets.alias("t"), F.col("e.source").eqNullSafe(F.col("t.source")))
    ends = ends.filter(F.col("ahead") + F.col("range_size") > F.col("rest")).groupBy(F.col("e.source").alias("e_source")).agg(F.min(F.struct("bucket", "ahead")).alias("end"))
    plan = targets.join(ends, F.col("source").eqNullSafe(F.col("e_source")), "left").select(F.col("source").alias("p_source"), "source_size", "target", "epochs", "rest", F.coalesce("end.bucket", F.lit(1 << 32)).alias("end"), "end.ahead")
    if targets.count() <= broadcast_rows:  # one row a source; beyond that the join shuffles
        plan = F.broadcast(plan)
    rows = rows.withColumn("bucket", bucket).join(plan, F.col("source").eqNullSafe(F.col("p_source")))
    last = F.when(F.col("bucket") < F.col("end"), F.col("size")).otherwise(0)
    inside = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    within = F.col("rest") - F.col("ahead") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), within))
    out = lambda df, taken: df.select("doc_id", "size", "source", "source_size", "target", (F.col("epochs") * F.col("size") + taken).cast("long").alias("taken"), *[F.col(f"carried {c}").alias(c) for c in carry])
    return out(rows.filter(F.col("bucket") != F.col("end")), last).unionByName(out(rows.filter(F.col("bucket") == F.col("end")), cut))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), md5(text), '') || ':mix') AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, 2 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS budget,
         CAST(coalesce(sum(2 * source_size) OVER b, 0) AS BIGINT) AS cap_before, coalesce(sum(w) OVER b, 0) AS w_before, sum(w) OVER () AS w_all
  FROM s WINDOW b AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, cap / w <= (budget - cap_before) / (w_all - w_before) AS filled FROM o
), t AS (
  SELECT source, source_size,
         CASE WHEN filled THEN CAST(cap AS DOUBLE)
              ELSE w * (budget - CAST(sum(CASE WHEN filled THEN cap ELSE 0 END) OVER () AS BIGINT)) / sum(CASE WHEN filled THEN 0 ELSE w END) OVER () END AS target
  FROM f
), p AS (
  SELECT d.doc_id, d.size, t.source, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // greatest(source_size, 1) ELSE 0 END AS epochs FROM p
)
SELECT doc_id, size, source, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - ahead)) AS BIGINT) AS taken
FROM e
"""
