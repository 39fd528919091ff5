"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, these into longer phrases, and so on up to one.
At each level a run of one symbol becomes one symbol.  Then deterministic coin
tossing gives each symbol a label: the lowest bit in which its name differs
from its left neighbour's, and that bit.  Four tosses bring any names down to
six labels, of which neighbours still differ, and phrases begin at their local
maxima.  A phrase's name is a hash of the names in it.

So where a phrase begins hangs on a few symbols around it alone, and equal
substrings have the same phrases but at their ends, wherever they stand.

A fingerprint is a sketch of the set of all phrases: the ``size`` least ranks,
where a phrase's rank is a uniform hash of its name divided by the phrase's
weight, the square of its length up to ``reach`` code points.  Short phrases,
which unrelated texts share, so count little where there are longer ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, mix, released

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)
#: Mixed names of the code points of the first plane, and powers of an odd base and of its inverse modulo 2**64, which grow at need.
_MIXED = mix(np.arange(1 << 16, dtype=np.uint64) + _ODD)
_BASE = 0xD6E8FEB86659FD93
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
        while len(_powers[k]) < n:
            have = len(_powers[k])
            _powers[k] = np.concatenate((_powers[k], _powers[k] * np.array(pow(base, have, 1 << 64), dtype=np.uint64)))
    return _powers


def _lowest_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Twice the lowest bit in which names differ, plus that bit of ``a``."""
    x = a ^ b
    low = np.bitwise_count((x & -x) - x.dtype.type(1))
    bit = (a >> low.astype(a.dtype, copy=False)).astype(np.uint8, copy=False) & np.uint8(1)
    return (low << np.uint8(1)) | bit


def _tossed(names: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Labels below six, different for neighbours; a text's first symbol is taken to differ from its left in the lowest bit."""
    label = names
    for _ in range(4):
        left = np.empty_like(label)
        left[1:] = label[:-1]
        left[begin] = label[begin] ^ label.dtype.type(1)
        label = _lowest_difference(label, left)
    return label


def _mixed(names: np.ndarray) -> np.ndarray:
    """Mixed names of code points and their runs: most by look-up."""
    out = _MIXED.take(names, mode="clip")
    rare = np.flatnonzero(names >> np.uint32(16))
    out[rare] = mix(names[rare].astype(np.uint64) + _ODD)
    return out


def _phrases(names: np.ndarray, start: np.ndarray | None, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level: the phrases' names, the code points they start at (None: each its own), and where each text's phrases begin."""
    same = names[1:] == names[:-1]
    same[begin[1:] - 1] = False
    again = np.flatnonzero(same) + 1
    if len(again):  # runs become symbols of their own
        stay = np.append(True, ~same)
        head, times = np.unique(again - np.arange(1, len(again) + 1), return_counts=True)
        names, start = names[stay], np.flatnonzero(stay) if start is None else start[stay]
        run = mix(names[head].astype(np.uint64) * _ODD + (times + 1).astype(np.uint64))
        names[head] = run if names.itemsize == 8 else run >> np.uint64(33) | np.uint64(1 << 31)
        begin = begin - np.searchsorted(again, begin)
    label = _tossed(names, begin)
    cut = np.zeros(len(names), dtype=bool)
    up = label[1:] > label[:-1]
    cut[1:-1] = up[:-1] & ~up[1:]  # neighbours differ
    cut[begin[1:] - 1] = False  # a text's last symbol begins no phrase
    cut[begin] = True
    at = np.flatnonzero(cut)
    power, inverse = _powers_to(len(names))
    total = np.zeros(len(names) + 1, dtype=np.uint64)
    value = mix(names + _ODD) if names.itemsize == 8 else _mixed(names)
    value *= power[: len(names)]
    np.cumsum(value, out=total[1:])
    total = total[np.append(at, len(names))]
    return mix((total[1:] - total[:-1]) * inverse[at]), at if start is None else start[at], np.searchsorted(at, begin)


def parse(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level (which text, name, length) of its phrases; each text is parsed by itself up to one phrase."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    which = np.flatnonzero(size)
    if not len(which):
        return
    names, start = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4"), None
    begin, end = (np.cumsum(size) - size)[which], len(names)
    go = np.ones(len(which), dtype=bool)
    while go.any():
        names, start, begin = _phrases(names, start, begin)
        many = np.diff(begin, append=len(names))
        long = np.diff(start, append=end)
        if go.all():
            yield np.repeat(which, many), names, long
        else:
            of = np.repeat(go, many)
            yield np.repeat(which[go], many[go]), names[of], long[of]
        go = many > 1


def sketches(texts: list[str], size: int = 64, reach: int = 32) -> list[np.ndarray]:
    """Each text's ``size`` least ranks, sorted and distinct; of a text with fewer phrases all, of an empty one none.

    Ranks come from integers by one division, which rounds alike everywhere, and are compared as bits of single-precision numbers.
    """
    weight_of = np.minimum(np.arange(reach + 1), reach).astype(np.float64) ** 2
    levels = [(which, (names >> np.uint64(11)).astype(np.float64) + 1.0, weight_of[np.minimum(long, reach)]) for which, names, long in parse(texts)]
    if not levels:
        return [np.zeros(0, np.uint32) for _ in texts]
    weight = sum(np.bincount(which, w, len(texts)) for which, _, w in levels)
    count = sum(np.bincount(which, minlength=len(texts)) for which, _, _ in levels)
    # most ranks of a long text are far above the last that counts; where the bound was too low, all are taken
    bound, edges = np.where(count > 8 * size, np.float64(3 * size * 2**53) / np.maximum(weight, 1), np.inf), np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32)

    def least(bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = []
        for which, u, w in levels:
            rank = u / w
            low = np.flatnonzero(rank <= bound[which])
            keys.append((which[low].astype(np.uint64) << np.uint64(32)) | rank[low].astype(np.float32).view(np.uint32))
        key = np.sort(np.concatenate(keys))
        key = key[np.append(True, key[1:] != key[:-1])]
        return key, np.searchsorted(key, edges)

    key, edge = least(bound)
    if (few := (np.diff(edge) < size) & (bound < np.inf)).any():
        key, edge = least(np.where(few, np.inf, bound))
    return [key[a : min(b, a + size)].astype(np.uint32) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


def alike(a: np.ndarray, b: np.ndarray, size: int = 64) -> float:
    """The share of the ``size`` least ranks of both together that both have: an estimate of the weight that the sets share. Two empty ones are alike."""
    every = np.union1d(a, b)[:size]
    if not len(every):
        return 1.0
    return float(np.count_nonzero(np.intersect1d(a, b, assume_unique=True) <= every[-1]) / len(every))


def likeness(a: Column, b: Column, size: int = 64) -> Column:
    """``alike`` of two fingerprints, as an expression."""
    ranks = lambda c: F.regexp_extract_all(c, F.lit("(.{8})"), F.lit(1))
    every = F.slice(F.array_sort(F.array_union(ranks(a), ranks(b))), 1, size)
    both = F.size(F.filter(F.array_intersect(ranks(a), ranks(b)), lambda x: x <= F.element_at(every, -1)))
    return F.when(F.size(every) == 0, 1.0).otherwise(both / F.size(every))


def _packed(sketch: np.ndarray) -> bytes:
    return sketch.astype(">u4").tobytes()


def _decoded(data: bytes | None) -> str:
    return (data or b"").decode("utf-8", "surrogateescape")


def _encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


def _parts(sizes: list[int], step: int) -> Iterator[slice]:
    """Consecutive slices of about ``step`` in all, one at least in each."""
    first = held = 0
    for k, n in enumerate(sizes):
        if k > first and held + n > step:
            yield slice(first, k)
            first, held = k, 0
        held += n
    if first < len(sizes):
        yield slice(first, len(sizes))


def fingerprint_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 64, reach: int = 32, step: int = 1 << 19) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of each row, without a shuffle.

    A fingerprint is the ranks as eight hexadecimal digits each.  Equal texts have equal ones, a null or empty text has the
    empty one, and repeated rows repeat.  Only id and text are read, so other columns can't clash; an empty table gives no
    rows.  Texts are parsed about ``step`` code points together; a longer one is parsed whole, in about 60 bytes a code point.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_decoded(x.as_py()) for x in b.column(1)]
            for part in _parts([len(t) for t in texts], step):
                found = [_packed(s) for s in sketches(texts[part], size, reach)]
                yield pa.RecordBatch.from_arrays([b.column(0)[part], pa.array([len(t) for t in texts[part]], pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "n_chars", "fingerprint"])

    out = rows.mapInArrow(released(run), "doc_id long, n_chars long, fingerprint binary")
    return out.withColumn("fingerprint", F.lower(F.hex("fingerprint")))


_COMPARED = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_KINDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_ENDS = [("part", pa.int64()), ("first", pa.binary()), ("last", pa.binary())]


def _compare(pairs: list[tuple], size: int, reach: int) -> list[tuple]:
    """Rows for (doc_id, text, sketch, next text, next sketch): the text's last quarter is replaced by the start of the next."""
    edited = [t[: len(t) - len(t) // 4] + following[: len(t) // 4] for _, t, _, following, _ in pairs]
    out = []
    for (doc_id, text, own, _, other), new, changed in zip(pairs, edited, sketches(edited, size, reach)):
        out.append((doc_id, len(text), hashlib.sha256(_encoded(new)).digest(), _packed(own), _packed(changed), alike(own, changed, size), alike(own, other, size)))
    return out


def _walk(size: int, reach: int, step: int):
    """Compares each row of a sorted part with the row behind it; the part's first and last rows bring their texts along."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), _KINDS + _ENDS)], names=[n for n, _ in _KINDS + _ENDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, open_row = TaskContext.get().partitionId(), None
        for b in batches:
            ids, texts = b.column(0).to_pylist(), [_decoded(x.as_py()) for x in b.column(1)]
            for k in _parts([len(t) for t in texts], step):
                known = list(zip(ids[k], texts[k], sketches(texts[k], size, reach)))
                out = []
                if open_row is None:  # the first row of all
                    doc_id, text, own = known[0]
                    out.append((doc_id, len(text), None, _packed(own), None, None, None, part, _encoded(text), None))
                row = [*([open_row] if open_row else []), *known]
                out += [(*r, part, None, None) for r in _compare([(*a, c[1], c[2]) for a, c in zip(row, row[1:])], size, reach)]
                open_row = row[-1]
                if out:
                    yield batch(out)
        if open_row is not None:
            doc_id, text, own = open_row
            yield batch([(doc_id, len(text), None, _packed(own), None, None, None, part, None, _encoded(text))])

    return run


def _border(size: int, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, text, own, following, other in zip(*(b.column(c).to_pylist() for c in ("doc_id", "last", "fingerprint", "first", "next_fingerprint"))):
                rows = _compare([(doc_id, _decoded(text), np.frombuffer(own, ">u4").astype(np.uint32), _decoded(following), np.frombuffer(other, ">u4").astype(np.uint32))], size, reach)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), _KINDS)], names=[n for n, _ in _KINDS])

    return run


def fingerprint_edits(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 64, reach: int = 32, step: int = 1 << 19) -> DataFrame:
    """Each text's fingerprint beside those of the next document and of an edit that borrows from it.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.  The edited text has its
    last quarter replaced by as many code points of the next document (or all it has).  Documents follow each other by id,
    nulls last, and rows of one id by their texts' hashes; after the last comes the first, so a single row is its own next.
    Null texts are empty, other columns are not read, and an empty table gives no rows.

    Texts are shuffled once, into ranges of (id, hash, row), so many rows of one id are dealt over several tasks; each task
    walks its sorted rows with two texts in hand.  Only the first and the last row of each range meet later, by a join of
    as many rows as there are ranges, whose numbers alone reach the driver.
    """
    shared = Shared(spark, "fingerprints")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("h"), F.col("row")]
    walked = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    done = shared.keep(walked.mapInArrow(released(_walk(size, reach, step)), f"{_COMPARED}, part long, first binary, last binary"), "walked")
    parts = [r["part"] for r in done.filter("last IS NOT NULL").select("part").orderBy("part").collect()]
    names = [n for n, _ in _KINDS]
    inner = done.filter("first IS NULL AND last IS NULL").select(*names)
    if not parts:
        return _hexed(inner)
    following = spark.createDataFrame(list(zip(parts, [*parts[1:], parts[0]])), "part long, next_part long")
    heads = done.filter("first IS NOT NULL").select(F.col("part").alias("next_part"), "first", F.col("fingerprint").alias("next_fingerprint"))
    tails = done.filter("last IS NOT NULL").select("part", "doc_id", "last", "fingerprint")
    borders = tails.join(following, "part").join(heads, "next_part").mapInArrow(_border(size, reach), _COMPARED)
    return _hexed(inner.unionByName(borders))


def _hexed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})
