"""A count table of fixed size, filled by all tasks: how many documents have a hash, on a logarithmic scale.

Each task counts into 2**bits counters and sends them block by block, empty
blocks left out.  Hashes that share a counter are counted together, so a count
is never too low; the table's size doesn't depend on the input's.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared

BLOCK_BITS = 16
#: Steps of the scale to a factor of two.
SCALE = 8
#: Parts of the table summed at once.
FAN_IN = 64


def packed(counts: np.ndarray) -> bytes:
    """One block of counts: a bitmap of the filled slots, the values up to 254 in a byte each, then larger ones."""
    filled = counts[counts > 0].astype(np.uint64)
    return zlib.compress(np.packbits(counts > 0).tobytes() + np.minimum(filled, 255).astype(np.uint8).tobytes() + filled[filled > 254].tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    """The counts of a block, all slots."""
    data = zlib.decompress(data)
    there = np.unpackbits(np.frombuffer(data, np.uint8, (1 << BLOCK_BITS) // 8)).astype(bool)
    n, at = int(there.sum()), (1 << BLOCK_BITS) // 8
    filled = np.frombuffer(data, np.uint8, n, at).astype(np.uint64)
    filled[filled == 255] = np.frombuffer(data[at + n :], np.uint64)
    out = np.zeros(1 << BLOCK_BITS, dtype=np.uint64)
    out[there] = filled
    return out


def _add(part: pd.DataFrame) -> pd.DataFrame:
    """The sum of a few tasks' counts of one block."""
    counts = np.zeros(1 << BLOCK_BITS, dtype=np.uint64)
    for x in part["counts"]:
        counts += unpacked(x)
    return pd.DataFrame({"block": part["block"].iloc[:1], "part": part["part"].iloc[:1] // FAN_IN, "counts": [packed(counts)]})


def count_table(shared: Shared, parts: DataFrame, bits: int) -> np.ndarray:
    """The table of all tasks from rows (block, part, counts): a byte each, ``SCALE`` times the logarithm to base two, 0 where none.  Sums are taken ``FAN_IN`` parts at a time."""
    left, level = 1 + (parts.agg(F.max("part").alias("m")).collect()[0]["m"] or 0), 0
    while level == 0 or left > 1:
        parts = parts.groupBy("block", F.floor(F.col("part") / FAN_IN).alias("group")).applyInPandas(_add, "block int, part int, counts binary")
        left, level = -(-left // FAN_IN), level + 1
        if left > 1:
            parts = shared.keep(parts, f"counts{level}")
    table = np.zeros((1 << (bits - BLOCK_BITS), 1 << BLOCK_BITS), dtype=np.uint8)
    for r in parts.toLocalIterator():
        table[r["block"]] = np.minimum(255, np.ceil(SCALE * np.log2(np.maximum(unpacked(r["counts"]), 1))))
    return table.reshape(-1)
