"""Exact dedup by exchange of Golomb-coded fingerprints.

1. A slim table holds each row's id and the SHA-256 of its text.
2. Every partition of it sends its sorted, distinct 64-bit fingerprints to
   their owners (the top bits name the owner), Golomb-Rice coded, with one bit
   for each that says whether the sender has it more than once.
3. Each owner decodes what it got, finds the fingerprints held twice or more
   and returns a bitmap to each sender, which so learns its suspects.
4. Only suspects' texts are shuffled, and grouped by their bytes, so equal
   fingerprints alone never make two texts equal.

A group of copies costs each sender one fingerprint and one text, since both
the exchange and the verification combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, power_of_two


def rice_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Golomb-Rice code of sorted distinct unsigned 64-bit values: the parameter and the bytes.

    The bytes are the unary quotients, padded to whole bytes, then the
    remainders of ``k`` bits each.
    """
    delta = np.diff(values, prepend=np.uint64(0))
    k = max(0, int(np.log2(max(1.0, float(values[-1]) / len(values)))))
    quotient = (delta >> np.uint64(k)).astype(np.int64)
    ones = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
    unary[ones] = 1
    bits = ((delta[:, None] >> np.arange(k - 1, -1, -1, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes() + np.packbits(bits).tobytes()


def rice_decode(n: int, k: int, code: bytes) -> np.ndarray:
    """The values that ``rice_encode`` was given."""
    rest = (n * k + 7) // 8
    split = len(code) - rest
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(code, dtype=np.uint8, count=split)))[:n]
    quotient = (np.diff(ones, prepend=-1) - 1).astype(np.uint64)
    delta = quotient << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(code, dtype=np.uint8, offset=split), count=n * k).reshape(n, k)
        for j in range(k):
            delta |= bits[:, j].astype(np.uint64) << np.uint64(k - 1 - j)
    return np.cumsum(delta, dtype=np.uint64)


def _sender(owner_bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b.column(0).to_numpy(zero_copy_only=False) for b in batches if b.num_rows]
        if not got:
            return
        prints, times = np.unique(np.concatenate(got).view(np.uint64), return_counts=True)
        shift = np.uint64(64 - owner_bits)
        owner = (prints >> shift).astype(np.int64)
        me = TaskContext.get().partitionId()
        rows = []
        for one in np.split(np.arange(len(prints)), np.flatnonzero(np.diff(owner)) + 1):
            k, code = rice_encode(prints[one] & np.uint64((1 << (64 - owner_bits)) - 1))
            rows.append((int(owner[one[0]]), me, len(one), k, code, np.packbits(times[one] > 1).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["owner", "sender", "n", "k", "code", "twice"])

    return send


def _own(sent: pd.DataFrame) -> pd.DataFrame:
    """The bitmaps that one owner returns, one for each sender."""
    parts = [rice_decode(n, k, code) for n, k, code in zip(sent.n, sent.k, sent.code)]
    every, times = np.unique(np.concatenate(parts), return_counts=True)
    local = np.concatenate([p[np.unpackbits(np.frombuffer(t, np.uint8), count=len(p)).astype(bool)] for p, t in zip(parts, sent.twice)])
    doubled = np.union1d(every[times > 1], local)
    bitmaps = [np.packbits(np.isin(p, doubled, assume_unique=True)).tobytes() for p in parts]
    return pd.DataFrame({"owner": sent.owner, "sender": sent.sender, "bitmap": bitmaps})


def _suspects(owner_bits: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for owner, n, k, code, bitmap in zip(*(b.column(c).to_pylist() for c in ("owner", "n", "k", "code", "bitmap"))):
                marked = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=n).astype(bool)
                prints = rice_decode(n, k, code)[marked] | (np.uint64(owner) << np.uint64(64 - owner_bits))
                if len(prints):
                    yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64))], names=["print"])

    return read


def exact_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_rows: int = 16_000_000, sender_rows: int = 4_000_000, broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row for each document with the copy that stays.

    Returns doc_id, keep_id, group_size, kept, text_sha256.  Equal means the
    same bytes; a null text equals the empty one.  Of equal texts the largest
    id stays (nulls count as smallest), and of rows that repeat that id too, one.
    Other columns of ``docs`` are not read, so their names can't clash.  An
    empty table gives no rows, and a text of any length is hashed whole.

    ``owner_rows``: fingerprints an owner decodes at once; ``sender_rows``:
    about as many are sent from one task once there are more than 256 tasks' worth, so messages hold hundreds of
    fingerprints at any size.  The suspects' fingerprints and the groups are broadcast only when a count shows at most
    ``broadcast_rows`` of them; else the join shuffles.  Nothing is ordered or gathered by group: minima combine before they are sent.
    """
    shared = Shared(spark, "exact_dedup")
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    slim = shared.keep(own.select("doc_id", digest.alias("sha"), F.monotonically_increasing_id().alias("row")), "slim")
    total = slim.count()
    bits = power_of_two(total / owner_rows, 16).bit_length() - 1
    sent = shared.keep(slim.select(F.xxhash64("sha").alias("print")).coalesce(max(256, total // sender_rows)).mapInArrow(_sender(bits), "owner long, sender long, n long, k int, code binary, twice binary"), "sent")
    bitmaps = sent.groupBy("owner").applyInPandas(_own, "owner long, sender long, bitmap binary")
    suspects = shared.keep(sent.join(bitmaps, ["owner", "sender"]).mapInArrow(_suspects(bits), "print long").distinct(), "suspects")
    if suspects.count() <= broadcast_rows:
        suspects = F.broadcast(suspects)
    texts = own.withColumn("sha", digest).withColumn("print", F.xxhash64("sha")).join(suspects, "print")
    groups = texts.groupBy("sha", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = shared.keep(groups.filter("group_size > 1").select("sha", "keep_id", "group_size"), "groups")
    small = groups.count() <= broadcast_rows
    sized = lambda df: F.broadcast(df) if small else df
    # of the rows with the id that stays, which may repeat, the first written one
    first = slim.join(sized(groups), "sha").filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("sha").agg(F.min("row").alias("first"))
    groups = shared.keep(groups.join(first, "sha"), "firsts")
    shared.drop("sent", "suspects", "groups")
    both = slim.join(sized(groups), "sha", "left")
    alone = F.col("group_size").isNull()
    return both.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"), (alone | (F.col("row") == F.col("first"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
