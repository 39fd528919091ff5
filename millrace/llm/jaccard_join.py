"""N-gram Jaccard join: near duplicates by prefix filtering, verified exactly.

A document is the set of its word n-grams, as 64-bit hashes.  A count table of
fixed size, filled from all documents, orders n-grams by frequency, rare first
(ties by hash); any one order gives exact results, a good one small buckets.

Two sets of sizes a <= b with Jaccard similarity of at least t share an n-gram
within the first ``a - ceil(2t/(1+t) a) + 1`` of the smaller and the first
``b - ceil(t b) + 1`` of the larger.  So each document posts its prefix, and
only documents that meet in a bucket (one n-gram) can be linked.

1. Documents with equal sets are one node from the start: their copies are
   dropped from each task's postings, and repeated ones in the bucket.
2. Stars: in each bucket, members are paired with a leader only, so a bucket
   of m members costs m pairs.  The leader is the member with the most frequent
   n-grams, which in a group of near copies is the least changed one.  Pairs
   pass length, positional and suffix filters, then are verified from their
   texts, and linked nodes get components.
3. Gaps: buckets that still hold different components give the pairs between
   different components (never inside one) that pass the filters and weren't
   verified before; these are verified too.  What is then not linked has no path of links.

The suffix filter compares histograms of the sets' hashes over fixed ranges,
which bound what two sets can share, before any text is fetched.  A set's text
is that of one row that has it, named by id and text together, so rows without
an id or under one id count like others.

Very frequent n-grams are known from the count table; their buckets are dealt
over several tasks, whose leaders are paired in turn.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, combine, mix, power_of_two, released, shingle_sets, texts_of
from .components import connected_components
from .counts import BLOCK_BITS, SCALE, count_table, packed

#: The count table has 2**SLOT_BITS counters, one byte each when shared out.
SLOT_BITS = 24
#: Ranges of a set's histogram.
RANGE_BITS = 6


def need_prefix(n: int, percent: int) -> int:
    """Length of the prefix that a set of n posts."""
    return n - -(-percent * n // 100) + 1


def overlap_needed(a, b, percent: int):
    """The least intersection of sets of sizes a and b with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def signature(h: np.ndarray) -> int:
    """A 64-bit hash of a set given as its sorted members; 0 only for the empty set."""
    if not len(h):
        return 0
    spot = mix(h + np.arange(1, len(h) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = int(combine([np.bitwise_xor.reduce(spot, keepdims=True), np.add.reduce(spot, keepdims=True, dtype=np.uint64), np.array([len(h)], np.uint64)])[0])
    return (out or 1) - (1 << 64) * (out >= 1 << 63)


def _parts(b: pa.RecordBatch, width: int):
    texts = list(texts_of(b.column("text")))
    return zip(b.column("doc_id").to_pylist(), shingle_sets(texts, width))


def histogram(h: np.ndarray) -> bytes:
    """How many members of a sorted set lie in each of 2**RANGE_BITS equal ranges; 255 stands for any more."""
    return np.minimum(255, np.bincount((h >> np.uint64(64 - RANGE_BITS)).astype(np.int64), minlength=1 << RANGE_BITS)).astype(np.uint8).tobytes()


def _survey(width: int):
    """Rows of documents, then of the counts of this task's distinct sets, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, met = np.zeros(1 << SLOT_BITS, dtype=np.uint32), set()
        names = ["doc_id", "text_hash", "n", "sig", "hist", "block", "part", "counts"]
        for b in batches:
            ns, sigs, hists = [], [], []
            for _, h in _parts(b, width):
                s = signature(h)
                ns.append(len(h))
                sigs.append(s)
                hists.append(histogram(h) if len(h) else None)
                if s not in met:
                    met.add(s)
                    np.add.at(counts, (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)
            none = pa.nulls(len(ns), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(ns, pa.int64()), pa.array(sigs, pa.int64()), pa.array(hists, pa.binary()), none, none, pa.nulls(len(ns), pa.binary())], names=names)
        me = TaskContext.get().partitionId()
        for k, part in enumerate(counts.reshape(-1, 1 << BLOCK_BITS)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * 4 + [pa.nulls(1, pa.binary()), pa.array([k], pa.int32()), pa.array([me], pa.int32()), pa.array([packed(part)], pa.binary())], names=names)

    return run, "doc_id long, text_hash long, n long, sig long, hist binary, block int, part int, counts binary"


def ordered(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Keys that sort by frequency, then hash: the scaled count in the top byte, 56 bits of hash below."""
    return (table[(h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (mix(h) >> np.uint64(8))


def _post(width: int, percent: int, owner_bits: int, hot_rows: int, shared_table, flush: int = 500_000):
    """Blobs of postings (key, sig, n, hub, position) for the owners of their keys.

    A position past 65 535 is sent as that: filters only get looser by it.
    ``hub`` is the mean frequency of all of a document's n-grams: in a group
    of near copies, the one with the fewest changes of its own has the highest.
    """

    def blobs(held: list[tuple[np.ndarray, int, int, int]]) -> pa.RecordBatch:
        long = [len(x[0]) for x in held]
        key = np.concatenate([x[0] for x in held])
        sig, n, hub = (np.repeat(np.array([x[i] for x in held], t), long) for i, t in ((1, np.int64), (2, np.int32), (3, np.uint16)))
        at = np.concatenate([np.minimum(np.arange(x), 65535).astype(np.uint16) for x in long])
        pieces = np.ceil(np.exp2((key >> np.uint64(56)).astype(np.float64) / SCALE) / hot_rows).astype(np.int64)
        salt = np.where(pieces > 1, sig % np.maximum(pieces, 1), 0)
        owner = (mix(key + salt.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - owner_bits)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        columns = [owner[order], *(x[order] for x in (key, sig, n, hub, at))]
        cut = np.flatnonzero(np.diff(columns[0], prepend=-1))
        rows = [(int(columns[0][a]), *(x[a:b].tobytes() for x in columns[1:])) for a, b in zip(cut, [*cut[1:], len(key)])]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] + [pa.binary()] * 5)], names=["owner", "key", "sig", "n", "hub", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zlib.decompress(shared_table.value), np.uint8)
        held, size, met = [], 0, set()
        for b in batches:
            for _, h in _parts(b, width):
                s = signature(h)
                if not len(h) or s in met:
                    continue
                met.add(s)
                p = need_prefix(len(h), percent)
                k = ordered(h, table)
                hub = int(256 * (k >> np.uint64(56)).mean())
                held.append((np.sort(np.partition(k, p - 1)[:p]) if p < len(k) else np.sort(k), s, len(h), hub))
                size += p
                if size >= flush:
                    yield blobs(held)
                    held, size = [], 0
        if held:
            yield blobs(held)

    return run


def leaders(start: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Index of each member's leader, in runs of members that begin where ``start`` is true.

    A run's first member leads all whose sizes let it link with them, the
    first of the others leads what it may link with of these, and so on.
    """
    lead, left, run = np.full(len(n), -1), np.arange(len(n)), np.cumsum(start)
    n = n.astype(np.int64)
    while len(left):
        first = np.ones(len(left), dtype=bool)
        first[1:] = run[left][1:] != run[left][:-1]
        head = np.maximum.accumulate(np.where(first, left, 0))
        near = 100 * np.minimum(n[left], n[head]) >= percent * np.maximum(n[left], n[head])
        lead[left[near]] = head[near]
        left = left[~near]
    return lead


def _bucket(percent: int, hot_rows: int):
    """Members of buckets with company, and their leaders: those of the highest hub."""

    def run(blobs: pd.DataFrame) -> pd.DataFrame:
        key, sig, n, hub, at = (np.frombuffer(b"".join(blobs[c]), t) for c, t in (("key", np.uint64), ("sig", np.int64), ("n", np.int32), ("hub", np.uint16), ("at", np.uint16)))
        order = np.argsort(key, kind="stable")
        start = np.ones(len(key), dtype=bool)
        start[1:] = key[order][1:] != key[order][:-1]
        company = ~start | np.append(~start[1:], False)
        company |= np.exp2((key[order] >> np.uint64(56)).astype(np.float64) / SCALE) > hot_rows  # may have company elsewhere
        order = order[company]  # most postings have none and needn't be sorted further
        order = order[np.lexsort((sig[order], -hub[order].astype(np.int32), key[order]))]
        key, sig, n, hub, at = (x[order] for x in (key, sig, n, hub, at))
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])  # equal sets posted by several tasks
        key, sig, n, hub, at = (x[fresh] for x in (key, sig, n, hub, at))
        start = np.ones(len(key), dtype=bool)
        start[1:] = key[1:] != key[:-1]
        alone = start & np.append(start[1:], True) & (np.exp2((key >> np.uint64(56)).astype(np.float64) / SCALE) <= hot_rows)
        key, sig, n, hub, at, start = (x[~alone] for x in (key, sig, n, hub, at, start))
        lead = leaders(start, n, percent)
        return pd.DataFrame({"key": key.view(np.int64), "sig": sig, "n": n, "hub": hub.astype(np.int32), "at": at.astype(np.int32), "leader": sig[lead], "leader_n": n[lead], "leader_at": at[lead].astype(np.int32)})

    return run


def may_link(a_n: str, a_at: str, b_n: str, b_at: str, percent: int):
    """Length and positional filters, for a pair whose first common key stands at these positions.

    A pair that reaches the similarity passes at its first common key; what
    fails at a later one isn't lost, since pairs are kept if any bucket passes them.
    """
    a, b = F.col(a_n).cast("long"), F.col(b_n).cast("long")
    need = F.ceil(percent * (a + b) / (100 + percent))
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (1 + F.least(a - F.col(a_at) - 1, b - F.col(b_at) - 1) >= need)


def _may_share(percent: int):
    """Pairs (a, b) whose histograms leave room for the overlap that they need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, 1 << RANGE_BITS).astype(np.int64) for c in ("a_hist", "b_hist"))
            a_n, b_n = (b.column(c).to_numpy().astype(np.int64) for c in ("a_n", "b_n"))
            most = np.where((x < 255) | (y < 255), np.minimum(x, y), 1 << 40).sum(1)
            keep = pa.array(most >= overlap_needed(a_n, b_n, percent))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    return run


def _verify(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, None
        for b in batches:
            a_sig, b_sig = b.column("a").to_numpy(), b.column("b").to_numpy()
            keep = []
            sets = shingle_sets(list(texts_of(b.column("b_text"))), width)
            for i, (t, y) in enumerate(zip(texts_of(b.column("a_text")), sets)):
                if last != t:
                    last, x = t, next(shingle_sets([t], width))
                if signature(x) != a_sig[i] or signature(y) != b_sig[i]:
                    continue
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                spot = np.minimum(np.searchsorted(large, small), len(large) - 1)
                if int((large[spot] == small).sum()) >= overlap_needed(len(x), len(y), percent):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(a_sig[keep]), pa.array(b_sig[keep])], names=["a", "b"])

    return run


def _links(shared: Shared, docs: DataFrame, sets: DataFrame, pairs: DataFrame, width: int, percent: int, broadcast_rows: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) of set signatures that reach the similarity, from whole texts; and all pairs tried, each once."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    of = lambda c: sets.select(F.col("sig").alias(c), F.col("n").alias(f"{c}_n"), F.col("hist").alias(f"{c}_hist"))
    pairs = shared.keep(pairs.join(of("a"), "a").join(of("b"), "b").mapInArrow(_may_share(percent), "a long, b long"), f"{name}_pairs")
    wanted = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    wanted = shared.keep(sets.join(wanted, "sig", "left_semi").select("sig", F.col("row.doc_id").alias("w_id"), F.col("row.text_hash").alias("w_hash")), f"{name}_wanted")
    count = wanted.count()
    if not count:
        return pairs, pairs
    if count <= broadcast_rows:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, (F.col("text_hash") == F.col("w_hash")) & F.col("doc_id").eqNullSafe(F.col("w_id")))
    texts = texts.groupBy("sig").agg(F.first("text").alias("text"))  # rows may repeat; each task sends one
    near = pairs.join(texts.select(F.col("sig").alias("b"), F.col("text").alias("b_text")), "b")
    both = near.join(texts.select(F.col("sig").alias("a"), F.col("text").alias("a_text")), "a")
    found = both.select("a", "b", "a_text", "b_text").mapInArrow(released(_verify(width, percent)), "a long, b long")
    return shared.keep(found, f"{name}_links"), pairs


def jaccard_components(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, owner_rows: int = 400_000, hot_rows: int = 100_000, broadcast_rows: int = 500_000, block_rows: int = 2_000) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, text_hash, representative.

    Two documents link when 100 * intersection >= percent * union of their
    shingle sets; component_id is the smallest doc_id that links reach.  Null
    and empty texts have no shingles and link with nothing; a text with fewer words than
    ``width`` has one shingle, its whole sequence.  Rows repeat as given.  A row
    with a null doc_id links like others and gets the smallest id that it
    reaches, null if none; rows under one id are documents of their own.  Of each component the
    row with the smallest id (ties: the smallest xxhash64 of the text, ``text_hash``) is its
    representative, and so are its repetitions.  A text of any length is one set.  An empty table gives no
    rows; other columns are not read.

    No bucket, component or table of signatures comes to the driver; it
    gets counts and the count table (a fixed 2**24 bytes), which is broadcast.
    ``owner_rows`` postings share a task, and a bucket of more than
    ``hot_rows`` is dealt over several; one that still holds several components
    is paired in blocks of ``block_rows``.  Names of texts to verify are broadcast
    only when a count shows at most ``broadcast_rows``.  Buckets of frequent n-grams
    whose members are all unlike cost pairs of slim rows, which the filters thin out before texts are read.
    """
    shared = Shared(spark, "jaccard")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    survey, schema = _survey(width)
    survey = shared.keep(docs.mapInArrow(released(survey), schema), "survey")
    # of each set its size, histogram, rows, least id and a row that has it
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    sets = survey.filter("n > 0").groupBy("sig").agg(F.first("n").alias("n"), F.first("hist").alias("hist"), F.count("*").alias("rows"), F.min(row).alias("row"))
    sets = shared.keep(sets, "sets")
    table = count_table(shared, survey.filter("block is not null").select("block", "part", "counts"), SLOT_BITS)
    shared_table = spark.sparkContext.broadcast(zlib.compress(table.tobytes(), 1))
    postings = survey.filter("n > 0").agg(F.sum(F.col("n") * (100 - percent) / 100 + 1).alias("p")).collect()[0]["p"] or 0
    bits = power_of_two(postings / owner_rows, 128).bit_length() - 1
    posted = docs.mapInArrow(released(_post(width, percent, bits, hot_rows, shared_table)), "owner long, key binary, sig binary, n binary, hub binary, at binary")
    members = posted.groupBy("owner").applyInPandas(_bucket(percent, hot_rows), "key long, sig long, n int, hub int, at int, leader long, leader_n int, leader_at int")
    members = shared.keep(members, "members")
    shared_table.destroy()

    # leaders of one key in several tasks: each is paired with the first of about its size, or of the next sizes
    heads = members.filter(F.col("sig") == F.col("leader")).filter(F.shiftrightunsigned("key", 56) > SCALE * float(np.log2(hot_rows)))
    heads = heads.select("key", "sig", "n", "hub", "at", F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent))).alias("class"))
    top = heads.groupBy("key", "class").agg(F.max(F.struct("hub", "sig", "n", "at")).alias("t"))
    top = top.select("key", F.explode(F.sequence(F.col("class") - 1, F.col("class") + 1)).alias("class"), F.col("t.sig").alias("a"), F.col("t.n").alias("a_n"), F.col("t.at").alias("a_at"))
    across = heads.join(top, ["key", "class"]).filter((F.col("sig") != F.col("a")) & may_link("a_n", "a_at", "n", "at", percent)).select("a", F.col("sig").alias("b"))
    stars = members.filter((F.col("sig") != F.col("leader")) & may_link("leader_n", "leader_at", "n", "at", percent)).select(F.col("leader").alias("a"), F.col("sig").alias("b"))
    links, tried = _links(shared, docs, sets, stars.unionByName(across), width, percent, broadcast_rows, "star")
    parts = shared.keep(connected_components(shared, links, "star_cc"), "star_parts")

    # buckets that hold more than one component: pairs between different ones
    placed = members.select("key", "sig", "n", "at").join(parts.select(F.col("node").alias("sig"), "root"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    blocks = F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")
    open_keys = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), blocks).filter("lo <> hi").select("key", "blocks")
    placed = shared.keep(placed.join(open_keys, "key"), "open")
    if not placed.isEmpty():
        # the smaller of two sets shares a key within its shorter prefix; it meets every block of its bucket
        first = placed.filter(F.col("at") <= F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)))
        first = first.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        a = first.select("key", "block", *(F.col(c).alias(f"a_{c}") for c in ("sig", "n", "at", "root")))
        b = placed.select("key", F.pmod("sig", "blocks").cast("int").alias("block"), *(F.col(c).alias(f"b_{c}") for c in ("sig", "n", "at", "root")))
        smaller = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_sig") < F.col("b_sig")))
        gaps = a.join(b, (a["key"] == b["key"]) & (a["block"] == b["block"]) & (F.col("a_root") != F.col("b_root")) & smaller & may_link("a_n", "a_at", "b_n", "b_at", percent))
        gaps = gaps.select(F.least("a_sig", "b_sig").alias("a"), F.greatest("a_sig", "b_sig").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
        more, _ = _links(shared, docs, sets, gaps, width, percent, broadcast_rows, "gap")
        if not more.isEmpty():
            edges = parts.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
            parts = shared.keep(connected_components(shared, edges, "cc"), "parts")

    rooted = sets.select("sig", F.col("row.doc_id").alias("least"), "rows", "row").join(parts.select(F.col("node").alias("sig"), "root"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("rows"), F.min("row").alias("first"))
    # only sets with company need a name of their own
    names = shared.keep(rooted.select("sig", "root").join(named.filter("rows > 1"), "root").select("sig", "component_id", "first"), "names")
    shared.drop("sets", "members", "open", "parts", "star_parts", *(f"{step}_{x}" for step in ("star", "gap") for x in ("pairs", "wanted", "links")))
    out = survey.filter("n is not null").select("doc_id", "text_hash", "n", "sig").join(names, "sig", "left")
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "text_hash", (F.col("first").isNull() | own).alias("representative"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS g
  FROM d
), x AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS node, doc_id AS reached FROM s UNION SELECT r.node, e.b FROM r JOIN e ON r.reached = e.a
)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT node, min(reached) AS component_id FROM r GROUP BY node) c ON c.node = s.doc_id
"""
