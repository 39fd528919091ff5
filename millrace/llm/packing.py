"""Packing by lexical retrieval: BM25 neighbours of seed documents share their sequences.

1. Documents are tokenised once; words (runs of ids) are counted in one table
   of fixed size over all documents, which gives BM25 its document frequencies.
2. Documents are dealt to the shards of an inverted index by a lexical key, so
   neighbours meet: the order in which a document is near to reference vectors
   (a permutation index), then its least word hash.  Shards are ranges of the key.
3. In a shard, the first unused document seeds, BM25 with all of its words
   ranks the unused ones, and these follow until its window is full.

A shard's sequences are all full but the last.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, draw, mix, released
from .counts import BLOCK_BITS, SCALE, count_table, packed
from .tokens import binary_of, spread, tokenizer_at, word_terms

#: Id that ends every document.
END_ID = 2
#: BM25's constants.
K1, B = 1.2, 0.75
#: Counters of words are 2**SLOT_BITS; reference vectors have 2**FEATURE_BITS entries.
SLOT_BITS, FEATURE_BITS = 22, 12
#: References, how many of the nearest make up a key, and bits of the key for each, for the least word hash and for the row.
REFERENCES, NEAREST, REFERENCE_BITS, LEAST_BITS, ROW_BITS = 32, 4, 5, 24, 19


def features(ids: np.ndarray) -> np.ndarray:
    """The entry of each token id in a reference vector."""
    return (ids.astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(32 - FEATURE_BITS)).astype(np.int64)


def halves(x: np.ndarray, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The means of two groups of like unit vectors, begun from the one farthest from all and the one farthest from that."""
    one = x[(x @ x.mean(0)).argmin()]
    means = np.stack([one, x[(x @ one).argmin()]])
    for _ in range(rounds):
        near = (x @ means.T).argmax(1)
        means = np.stack([x[near == k].mean(0) if (near == k).any() else means[k] for k in (0, 1)])
        means /= np.maximum(1e-9, np.linalg.norm(means, axis=1, keepdims=True))
    return means, (x @ means.T).argmax(1)


def references(docs: list[np.ndarray]) -> np.ndarray:
    """Reference vectors (entries, references), weighted for a sum over a document's ids; ``docs`` are the entries of sampled documents.

    They are the means of groups of a sample that is halved again and again,
    so references of near numbers are alike.
    """
    n, depth = 1 << FEATURE_BITS, REFERENCE_BITS
    x = np.zeros((max(1, len(docs)), n), dtype=np.float32)
    for i, d in enumerate(docs):
        x[i] = np.bincount(d, minlength=n)
    weight = np.log1p(len(x) / (1.0 + (x > 0).sum(0))).astype(np.float32)
    x *= weight
    x /= np.maximum(1e-9, np.linalg.norm(x, axis=1, keepdims=True))
    groups = [(x.mean(0), np.arange(len(x)))]
    for _ in range(depth):
        halved = []
        for mean, own in groups:
            means, near = halves(x[own]) if len(own) > 1 else (np.stack([mean, mean]), np.zeros(len(own)))
            halved += [(means[k], own[near == k]) for k in (0, 1)]
        groups = halved
    return np.ascontiguousarray(np.stack([mean for mean, _ in groups], axis=1) * weight[:, None])


def lexical_keys(ids: np.ndarray, long: np.ndarray, least: np.ndarray, vectors: np.ndarray, row: np.ndarray, together: int = 128) -> np.ndarray:
    """A key of 63 bits for each document: its nearest references in order, its least word hash, its row."""
    near, edge, entry, n = np.zeros((len(long), REFERENCES), dtype=np.float32), np.append(0, np.cumsum(long)), features(ids), len(vectors)
    for i in range(0, len(long), together):
        some = long[i : i + together]
        at = entry[edge[i] : edge[i + len(some)]] + np.repeat(np.arange(len(some)) * n, some)
        near[i : i + len(some)] = np.bincount(at, minlength=len(some) * n).reshape(len(some), n).astype(np.float32) @ vectors
    order = np.argsort(-near, axis=1, kind="stable")[:, :NEAREST]
    key = np.zeros(len(long), dtype=np.int64)
    for k in range(NEAREST):
        key = key << REFERENCE_BITS | order[:, k]
    return (key << LEAST_BITS | (least >> np.uint64(64 - LEAST_BITS)).astype(np.int64)) << ROW_BITS | (mix(row.astype(np.uint64)) >> np.uint64(64 - ROW_BITS)).astype(np.int64)


def _tokenised(path: str, texts: pa.Array, step: int = 1 << 22) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ids and their numbers of texts [i, j), about ``step`` bytes at a time."""
    size = np.append(0, np.cumsum(pa.compute.binary_length(texts).to_numpy().astype(np.int64)))
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(size, size[i] + step, side="right")) - 1)
        yield i, j, *tokenizer_at(path).encode(texts.slice(i, j - i))
        i = j


def _entries(path: str):
    """Of each document, the entries of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, ids, long in _tokenised(path, b.column("text")):
                yield pa.RecordBatch.from_arrays([binary_of(features(ids).astype("<u2"), long).cast(pa.binary())], names=["entries"])
        tokenizer_at(path).forget()  # a worker that waits for its next task holds no words

    return run


def _survey(path: str, shared_vectors):
    """Rows of documents, then this task's counts of documents by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me, at, counts, final = TaskContext.get().partitionId(), 0, np.zeros(1 << SLOT_BITS, dtype=np.uint32), tokenizer_at(path).final
        names = ["doc_id", "ids", "tokens", "words", "key", "block", "part", "counts"]
        for b in batches:
            for i, j, ids, long in _tokenised(path, b.column("text")):
                terms, words = word_terms(ids, long, final)
                doc = np.repeat(np.arange(j - i), words)
                slots = np.unique(doc << SLOT_BITS | (terms >> np.uint64(64 - SLOT_BITS)).astype(np.int64)) & ((1 << SLOT_BITS) - 1)
                np.add.at(counts, slots, np.uint32(1))
                least = np.zeros(j - i, dtype=np.uint64)
                if len(terms):
                    least[words > 0] = np.minimum.reduceat(terms, (np.cumsum(words) - words)[words > 0])
                key = lexical_keys(ids, long, least, shared_vectors.value, (me << 32) + at + np.arange(j - i))
                at += j - i
                none = pa.nulls(j - i, pa.int32())
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), binary_of(ids, long).cast(pa.binary()), pa.array(long), pa.array(words), pa.array(key), none, none, pa.nulls(j - i, pa.binary())], names=names)
        tokenizer_at(path).forget()
        for k, part in enumerate(counts.reshape(-1, 1 << BLOCK_BITS)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), *[pa.nulls(1, pa.int64())] * 3, pa.array([k], pa.int32()), pa.array([me], pa.int32()), pa.array([packed(part)], pa.binary())], names=names)

    return run, "doc_id long, ids binary, tokens long, words long, key long, block int, part int, counts binary"


def postings(terms: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, term (numbered), and frequency of each distinct pair, by document; and each term's hash.  Terms are the leading 40 bits of their hashes."""
    pair = np.repeat(np.arange(len(words)) << 40, words)
    pair |= (terms >> np.uint64(24)).view(np.int64)
    pair, tf = np.unique(pair, return_counts=True)
    names, term = np.unique(pair & ((1 << 40) - 1), return_inverse=True)
    return (pair >> 40).astype(np.int32), term.astype(np.int32), tf.astype(np.float32), names.astype(np.uint64) << np.uint64(24)


def shard_postings(ids: np.ndarray, long: np.ndarray, final: np.ndarray, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The postings of a shard's documents and each one's number of words, from about ``step`` ids at a time: all that is held of the others are their postings."""
    edge, i, found, words = np.append(0, np.cumsum(long)), 0, [], [np.zeros(0, np.int64)]
    while i < len(long):
        j = max(i + 1, int(np.searchsorted(edge, edge[i] + step, side="right")) - 1)
        terms, own = word_terms(ids[edge[i] : edge[j]], long[i:j], final)
        doc, *more = postings(terms, own)
        found.append((doc + np.int32(i), *more))
        words.append(own)
        i = j
    names = np.unique(np.concatenate([np.zeros(0, np.uint64), *(f[3] for f in found)]))
    doc = np.concatenate([np.zeros(0, np.int32), *(f[0] for f in found)])
    term = np.concatenate([np.zeros(0, np.int32), *(np.searchsorted(names, f[3]).astype(np.int32)[f[1]] for f in found)])
    return doc, term, np.concatenate([np.zeros(0, np.float32), *(f[2] for f in found)]), names, np.concatenate(words)


class Bm25:
    """Inverted index of some documents' postings; a query has all distinct terms of an indexed document.

    Terms in more than a ``dense``-th of the documents are rows of a matrix,
    so several queries share one product; the others have postings.
    """

    def __init__(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, dense: int = 16):
        self.n, df = n, np.bincount(term) if len(term) else np.zeros(1, np.int64)
        row = np.full(len(df), -1, dtype=np.int32)
        often = np.flatnonzero(df * dense > n) if n > dense else np.zeros(0, np.int64)
        row[often] = np.arange(len(often))
        common = row[term] >= 0
        self.matrix = np.zeros((len(often), n), dtype=np.float32)
        self.matrix[row[term[common]], doc[common]] = weight[common]
        edges = np.arange(n + 1, dtype=doc.dtype)  # of one type with what they are sought in, which else is copied
        self.common, self.common_of = row[term[common]], np.searchsorted(doc[common], edges)
        own = ~common & (df > 1)[term]  # a term of one document finds no other
        del common
        doc, term, weight = doc[own], term[own], weight[own]
        self.term, self.term_of = term, np.searchsorted(doc, edges)
        self.of = np.append(0, np.cumsum(np.bincount(term, minlength=len(df))))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]

    def scores(self, seeds: list[int]) -> Iterator[np.ndarray]:
        """BM25 of all documents for each seed."""
        ask = np.zeros((len(seeds), len(self.matrix)), dtype=np.float32)
        for i, s in enumerate(seeds):
            ask[i, self.common[self.common_of[s] : self.common_of[s + 1]]] = 1
        for s, score in zip(seeds, ask @ self.matrix):
            terms = self.term[self.term_of[s] : self.term_of[s + 1]]
            at = spread(self.of[terms], self.of[terms + 1] - self.of[terms])
            yield score + np.bincount(self.doc[at], self.weight[at], self.n)


def best_first(score: np.ndarray, few: int = 64) -> Iterator[int]:
    """Places of the scores above 0 by falling score (ties: the earlier); all are sorted only when a few don't do."""
    given = 0
    for k in (few, len(score)):
        least = np.partition(score, len(score) - k)[len(score) - k] if k < len(score) else 0.0
        some = np.flatnonzero((score >= least) & (score > 0))
        some = some[np.argsort(-score[some], kind="stable")]
        yield from some[given:].tolist()
        given = len(some)
        if k >= len(score) or least <= 0:
            break


def chain(doc: np.ndarray, term: np.ndarray, weight: np.ndarray, long: np.ndarray, window: int, filled: int = 0, together: int = 16) -> np.ndarray:
    """The order in which a shard's documents, of ``long`` tokens with their ends, are laid out in windows of which the first holds ``filled`` already.

    The first unused document seeds; its unused neighbours follow by falling
    score until the window that holds its end is full or none shares a term,
    then the next seed comes.  The index is made anew each time half of its documents are used.
    """
    n = len(long)
    order, used = [], np.zeros(n, dtype=bool)
    while len(order) < n:
        live = np.flatnonzero(~used)
        index = None  # before the next is made
        if order:
            keep = ~used[doc]
            doc, term, weight = doc[keep], term[keep], weight[keep]
            del keep
        place = np.full(n, -1, dtype=np.int32)
        place[live] = np.arange(len(live))
        index, ready, at, left = Bm25(place[doc], term, weight, len(live)), {}, 0, len(live)
        while left and (left > len(live) // 2 or left < 64):
            while used[live[at]]:
                at += 1
            seed = int(live[at])
            used[seed], left = True, left - 1
            order.append(seed)
            filled = (filled + int(long[seed])) % window
            if not filled or not left:
                continue
            if at not in ready:
                ahead = at + np.flatnonzero(~used[live[at : at + 4 * together]])[: together - 1]
                asked = [at, *ahead.tolist()]
                ready = dict(zip(asked, index.scores(asked)))
            score = ready.pop(at)
            score[used[live]] = 0
            for i in best_first(score):
                d = int(live[i])
                used[d], left = True, left - 1
                order.append(d)
                filled += int(long[d])
                if filled >= window:
                    filled %= window
                    break
    return np.array(order, dtype=np.int64)


def bm25_weights(doc: np.ndarray, term: np.ndarray, tf: np.ndarray, names: np.ndarray, words: np.ndarray, table: np.ndarray, documents: int, mean: float, step: int = 1 << 19) -> np.ndarray:
    """Weight of each posting, ``step`` of them at a time; document frequencies are those of the count table over all documents."""
    df = np.exp2(table[(names >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.float64) / SCALE)
    idf = np.log1p(np.maximum(0.0, documents - df + 0.5) / (df + 0.5))
    out = np.empty(len(tf), dtype=np.float32)
    for i in range(0, len(tf), step):
        d, t, f = doc[i : i + step], term[i : i + step], tf[i : i + step]
        out[i : i + step] = idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * words[d] / max(1e-9, mean)))
    return out


def _pack(path: str, window: int, shard_tokens: int, shared_table, documents: int, mean: float, rows: int = 10_000):
    """Lays out a range of keys, given in order of the key, as one shard, or as several in turn where it holds twice the tokens of a shard.

    A shard ends with the document that brings it there, wherever a batch ends, so a task holds no more than that, however many rows come at once.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def lay(held: list[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
        tok = tokenizer_at(path)
        shard = pa.Table.from_batches(held)
        held.clear()
        doc_ids, column = shard.column("doc_id").to_pylist(), shard.column("ids")
        long = pa.compute.binary_length(column).to_numpy().astype(np.int64) // tok.dtype.itemsize
        ids = np.concatenate([np.zeros(0, tok.dtype), *(np.frombuffer(x.as_buffer(), tok.dtype) for x in column)])
        del shard, column

        def weighted() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            doc, term, tf, terms, words = shard_postings(ids, long, tok.final)
            return doc, term, bm25_weights(doc, term, tf, terms, words, np.frombuffer(zlib.decompress(shared_table.value), np.uint8), documents, mean)

        order = chain(*weighted(), long + 1, window, at % window)  # which drops postings as it goes: none is named here
        edge, out, base = np.append(0, np.cumsum(long)), [], TaskContext.get().partitionId() << 32
        for i in order.tolist():
            whole, start = np.append(ids[edge[i] : edge[i + 1]].astype("<u4"), np.uint32(END_ID)).astype("<u4"), 0
            while start < len(whole):
                n = min(len(whole) - start, window - at % window)
                out.append((doc_ids[i], start, n, zlib.crc32(whole[start : start + n]), len(whole), base + at // window, at % window))
                start, at = start + n, at + n
            if len(out) >= rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens, at = [], 0, 0
        for b in batches:
            i, size = 0, np.append(0, np.cumsum(b.column("tokens").to_numpy()))
            while i < b.num_rows:
                j = min(b.num_rows, int(np.searchsorted(size, size[i] + 2 * shard_tokens - tokens)))
                held.append(b.slice(i, j - i))
                tokens, i = tokens + int(size[j] - size[i]), j
                if tokens >= 2 * shard_tokens:
                    yield from lay(held, at)
                    at, tokens = at + tokens, 0
        if held and sum(b.num_rows for b in held):
            yield from lay(held, at)

    return run, ", ".join(f"{n} long" for n in names)


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 4096, shard_tokens: int = 6_000_000, sample_rows: int = 2_000) -> DataFrame:
    """One row for each piece of a document in a sequence.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    Every id of every document, its end id included, lies in one piece.  Null
    and empty texts are their end id alone.  Rows that repeat an id or a text are documents of their own, ties in score fall to the one that
    comes first in its shard; a text longer than a window is cut into as many pieces as it needs; an
    empty table gives no rows; other columns are not read.  A sequence's number is its shard's times 2**32 plus
    its place there.

    Every document is indexed in one shard of about ``shard_tokens`` tokens,
    and a seed's neighbours are the best of its shard, so work grows in
    proportion to the input.  Up to that many tokens there is one shard and the
    search is exact; beyond, neighbours are as good as the lexical key brings
    them together (measured in the README).  The reference vectors behind the
    key are fitted on about ``sample_rows`` documents drawn by a hash of the id (of the text where it is null), twice as many at most;
    document frequencies count all documents, with words that share one of
    2**22 counters counted together.
    """
    shared = Shared(spark, "packing")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    total = rows.count()
    drawn = F.coalesce(F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))
    sample = rows.filter(draw(drawn, "packing") < sample_rows / max(1, total)).limit(2 * sample_rows)
    found = sample.mapInArrow(released(_entries(tokenizer_path)), "entries binary").toLocalIterator()
    vectors = spark.sparkContext.broadcast(references([np.frombuffer(r["entries"], "<u2") for r in found]))
    survey, schema = _survey(tokenizer_path, vectors)
    surveyed = shared.keep(rows.mapInArrow(released(survey), schema), "survey")
    tokens = surveyed.filter("block is null")
    size = tokens.agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).collect()[0]
    table = spark.sparkContext.broadcast(zlib.compress(count_table(shared, surveyed.filter("block is not null").select("block", "part", "counts"), SLOT_BITS).tobytes(), 1))
    shards = max(1, -(-((size["tokens"] or 0) + total) // shard_tokens))
    pack, schema = _pack(tokenizer_path, window, shard_tokens, table, total, (size["words"] or 0) / max(1, total))
    # ranges hold as many rows each, so one of long documents is cut again in its task, at places in the order of the key
    tokens = tokens.select("doc_id", "ids", (F.col("tokens") + 1).alias("tokens"), "key")
    return tokens.repartitionByRange(shards, "key").sortWithinPartitions("key").mapInArrow(released(pack), schema)
