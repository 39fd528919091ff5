"""Sharding by a k-d tree: weighted medians along the widest dimension until leaves reach their bytes.

A node of the tree holds a number of shards.  It is cut along its widest
dimension (its range over the whole corpus's range) at the weighted quantile
that leaves half its shards, rounded down, on the left.  One aggregation serves
all nodes of a level and all dimensions: histograms with the least and greatest
value of each bin, which give weights, ranges, and most cuts.  A cut that they
leave open is refined inside its bin, again for all nodes at once, until it is exact
enough; at most about ``SUMS`` sums come to the driver each time.  Built-in functions only.

Dimensions are metadata of the text (its size, lines, and bytes beyond ASCII),
so equal texts have equal coordinates.  Where one value weighs too much for a
balanced cut, the cut goes on inside it by the text's hash; equal texts stay together unless they weigh
more than a shard, and are then cut by the id's hash.  Where a group of equal
texts lies across the quantile, the next widest dimension is tried, and at
last the hash; the best balanced of these cuts is taken.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Shared, power_of_two

#: Range of the ties, which are hashes.
HASHES = (0, 2**32 - 1)
#: Sums of an aggregation, shared by its searches, each of which has at least ``BINS``.
SUMS, BINS = 1 << 16, 256
#: Nodes searched in one aggregation.
NODES = 256


@dataclass
class Cut:
    """Left: rows whose keys, compared in order, are no greater than the values."""

    keys: list[str]
    values: list[int]

    def left(self) -> str:
        *before, (key, value) = zip(self.keys, self.values)
        out = f"{key} <= {value}L"
        for key, value in reversed(before):
            out = f"({key} < {value}L OR ({key} = {value}L AND {out}))"
        return out


@dataclass
class Search:
    """For the quantile of one node along one dimension: the values [low, high] of a key that it lies in."""

    keys: list[str]
    low: int
    high: int
    held: int  # rows in [low, high]
    fixed: list[int] = field(default_factory=list)  # values of the keys before
    below: int = 0  # weight and rows below low
    rows_below: int = 0
    found: tuple[float, Cut, int] | None = None  # what the cut misses the quantile by, and its rows on the left

    def width(self, bins: int) -> int:
        """Of a bin; one value each when no more rows than bins are left."""
        return 1 if self.held <= bins else (self.high - self.low) // bins + 1

    def narrow(self, bins: list[tuple], goal: float, share: float, tolerance: float, ties: list[str]) -> None:
        """Goes into the bin of the quantile, or settles. ``bins``: weight, rows, least and greatest value, in order of values."""
        under, rows = self.below, self.rows_below
        for w, held, lo, hi in bins:
            if under + w >= goal:
                break
            under, rows = under + w, rows + held
        over, near = under + w, min(goal - under, under + w - goal)
        self.below, self.rows_below, self.held = under, rows, held
        if near > tolerance * share and lo < hi:
            self.low, self.high = lo, hi
            return
        key = self.keys[len(self.fixed)]
        if near > tolerance * share and (key not in ties or (key == ties[0] and w > share)) and len(self.fixed) + 1 < len(self.keys):
            self.fixed, (self.low, self.high) = [*self.fixed, lo], HASHES  # on inside the value
            return
        value, left = (hi, rows + held) if over - goal <= goal - under else (lo - 1, rows)
        self.found = near, Cut(self.keys[: len(self.fixed) + 1], [*self.fixed, value]), left


@dataclass
class Node:
    first: int
    shards: int
    rows: int
    ranges: dict[str, tuple[int, int]]
    cut: Cut | None = None
    left_rows: int = 0
    left: "Node | None" = None
    right: "Node | None" = None
    weight: int = 0
    searches: list[Search] = field(default_factory=list)

    def choose(self, miss: float) -> None:
        """Takes the cut of the first search that misses by no more, or the nearest when none does; searches behind the first such are dropped."""
        for i, s in enumerate(self.searches):
            if s.found and s.found[0] <= miss * self.weight / self.shards:
                del self.searches[i + 1 :]
                break
        if all(s.found for s in self.searches):
            _, self.cut, self.left_rows = min((s.found for s in self.searches), key=lambda f: f[0])


def leaf_of(root: Node, value) -> Column:
    """The value (an integer) of the leaf that a row falls in; written as SQL, since a tree has many comparisons."""

    def text(node: Node) -> str:
        return str(value(node)) if node.left is None else f"CASE WHEN {node.cut.left()} THEN {text(node.left)} ELSE {text(node.right)} END"

    return F.expr(text(root))


def _histograms(rows: DataFrame, root: Node, open_: list[tuple[Node, Search]]) -> dict[int, list[tuple]]:
    """Weight, rows, least and greatest value of each bin in order, by the number of the search."""
    nodes = {id(n): i for i, n in enumerate({id(n): n for n, _ in open_}.values())}
    slots: dict[str, dict[int, int]] = {}  # searches by first key and node
    for i, (n, s) in enumerate(open_):
        slots.setdefault(s.keys[0], {})[nodes[id(n)]] = i
    bins, stacked = max(BINS, SUMS // len(open_)), []
    for slot in slots.values():
        of = {k: open_[i][1] for k, i in slot.items()}
        keys = next(iter(of.values())).keys

        def by_node(value, none=-1):
            return f"get(array({', '.join(f'{value(of[k]) if k in of else none}L' for k in range(len(nodes)))}), node)"

        deepest = max(len(s.fixed) for s in of.values())
        depth, low, high = by_node(lambda s: len(s.fixed)), by_node(lambda s: s.low), by_node(lambda s: s.high)
        value = f"CASE {depth} {' '.join(f'WHEN {d} THEN CAST({k} AS BIGINT)' for d, k in enumerate(keys[: deepest + 1]))} END"
        inside = [f"{value} BETWEEN {low} AND {high}"]
        for d, k in enumerate(keys[:deepest]):
            inside.append(f"({depth} <= {d} OR {k} = {by_node(lambda s: s.fixed[d] if d < len(s.fixed) else -1)})")
        number = {id(s): slot[k] for k, s in of.items()}
        stacked += [f"CASE WHEN {' AND '.join(inside)} THEN {by_node(lambda s: number[id(s)])} END", f"({value} - {low}) DIV {by_node(lambda s: s.width(bins), 1)}", value]
    rows = rows.withColumn("node", leaf_of(root, lambda n: nodes.get(id(n), -1)).cast("int")).filter("node >= 0")
    rows = rows.select("size", F.expr(f"stack({len(slots)}, {', '.join(stacked)}) AS (search, bin, value)")).filter("search is not null")
    out: dict[int, list[tuple]] = {}
    sums = F.sum("size").alias("w"), F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    for r in sorted(rows.groupBy("search", "bin").agg(*sums).collect(), key=lambda r: r["lo"]):
        out.setdefault(r["search"], []).append((r["w"], r["n"], r["lo"], r["hi"]))
    return out


def grow(rows: DataFrame, shards: int, dims: list[str], ties: list[str], tolerance: float = 0.002, miss: float = 0.01) -> Node:
    """The tree.  ``rows``: size and integer columns dims and ties: hashes of the text, then of the row.

    A cut may miss its quantile by ``tolerance`` of a shard; one that misses it by more than ``miss`` has other dimensions tried.
    """
    whole = rows.agg(F.count("*").alias("n"), *(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max)))).collect()[0]
    root = Node(0, shards, whole["n"], {d: (whole[f"lo_{d}"], whole[f"hi_{d}"]) for d in dims})
    spread = {d: max(1, hi - lo) for d, (lo, hi) in root.ranges.items() if lo is not None}
    level = [root] if root.rows and shards > 1 else []
    while level:
        for part in [level[i : i + NODES] for i in range(0, len(level), NODES)]:
            for n in part:
                n.searches = [Search([key, *(t for t in ties if t != key)], *n.ranges.get(key, HASHES), n.rows) for key in [*dims, ties[0]]]
            open_ = [(n, s) for n in part for s in n.searches]
            while open_:
                found = _histograms(rows, root, open_)
                new = {id(n) for n, _ in open_ if not n.weight}  # the first histograms hold all rows of their node
                for i, (n, s) in enumerate(open_):
                    if id(n) in new:
                        n.weight = sum(b[0] for b in found[i])
                        if s.keys[0] in dims:
                            n.ranges[s.keys[0]] = found[i][0][2], found[i][-1][3]
                    s.narrow(found[i], n.weight * (n.shards // 2) / n.shards, n.weight / n.shards, tolerance, ties)
                searching = [n for n in part if n.cut is None]
                for n in searching:
                    n.searches.sort(key=lambda s: (0, (n.ranges[s.keys[0]][0] - n.ranges[s.keys[0]][1]) / spread[s.keys[0]], dims.index(s.keys[0])) if s.keys[0] in dims else (1, 0, 0))
                    n.choose(miss)
                open_ = [(n, s) for n in searching if n.cut is None for s in n.searches if s.found is None]
        for n in level:
            half = n.shards // 2
            n.left, n.right = Node(n.first, half, n.left_rows, dict(n.ranges)), Node(n.first + half, n.shards - half, n.rows - n.left_rows, dict(n.ranges))
        level = [c for n in level for c in (n.left, n.right) if c.shards > 1 and c.rows]
    return root


def shard_documents(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 40, slot_rows: int = 50_000) -> DataFrame:
    """One row for each document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: shards' sizes are near equal.  Size is the UTF-8
    bytes of the text plus 16; a null text has none and the checksum 0.  Slots
    number a shard's rows from 0 without gaps, by ranges of a hash of checksum
    and id and by these two inside a range, so no shard needs to fit a task;
    rows equal in both are interchangeable.  Equal texts share a shard unless they weigh more than one.  Rows repeat as given; other
    columns are not read; an empty table gives no rows.  The tree becomes one
    expression: for thousands of shards, call this again inside each shard.
    """
    shared = Shared(spark, "sharding")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    data = text.cast("binary")
    log = lambda c: F.floor(F.log2(c + 1) * 65536).cast("long")
    metadata = [log(F.octet_length(data)).alias("log_size"), log(F.size(F.split(text, "\n"))).alias("log_lines"), log(F.octet_length(data) - F.length(text)).alias("log_high")]
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("crc"), *metadata)
    rows = rows.withColumn("tie_id", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    rows = shared.keep(rows, "rows")
    root = grow(rows.withColumn("tie_hash", F.col("crc")), shards, ["log_size", "log_lines", "log_high"], ["tie_hash", "tie_id"])
    placed = rows.withColumn("tie_hash", F.col("crc")).withColumn("shard", leaf_of(root, lambda n: n.first).cast("int"))
    bits = min(24, power_of_two(root.rows / shards / slot_rows, 1).bit_length() - 1)
    placed = placed.withColumn("range", F.shiftrightunsigned(F.xxhash64("crc", "doc_id"), 64 - bits) if bits else F.lit(0).cast("long"))
    ranges = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
    ranges = ranges.select(F.col("shard").alias("r_shard"), F.col("range").alias("r_range"), F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    numbered = placed.withColumn("within", F.row_number().over(Window.partitionBy("shard", "range").orderBy("crc", "doc_id", "size")) - 1)
    numbered = numbered.join(ranges, (F.col("shard") == F.col("r_shard")) & (F.col("range") == F.col("r_range")))
    return numbered.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("ahead") + F.col("within")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
