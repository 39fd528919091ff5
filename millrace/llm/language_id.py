"""Language ID by prediction by partial matching over byte contexts.

Each language has a context tree learned from a bounded sample: how often each
byte follows each context of up to ``ORDER`` bytes.  Depth varies: a context
is a node of the tree only when it was met at least ``LEAST`` times.  A byte not seen in a context is
reached through an escape to the next shorter one (method C: an escape counts
as often as there are different bytes), with the bytes already ruled out
excluded, so each context's probabilities sum to one; the last resort gives
all 256 bytes the same.  Statistics are then frozen, and the exact code length
of a whole text under each language is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import draw, in_training, mix, texts_of

#: Longest context in bytes; times that a context must be met to be in a tree; what stands before a text.
ORDER, LEAST, BEFORE = 4, 2, b" " * 4


class KeyTable:
    """Places of 64-bit keys by open addressing, for many keys at once; filled a quarter at most."""

    def __init__(self, keys: np.ndarray):
        bits = max(8, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.place = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.key[at] < 0)
            _, first = np.unique(at[free], return_index=True)  # one key for each free slot
            won = free[first]
            self.key[at[won]], self.place[at[won]] = keys[left[won]], left[won]
            lost = np.ones(len(left), dtype=bool)
            lost[won] = False
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place, -1 for those that aren't there."""
        at = self._slot(keys)
        got = self.key[at]
        out = np.where(got == keys, self.place[at], -1)
        left = np.flatnonzero((got != keys) & (got >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            got = self.key[at[left]]
            out[left] = np.where(got == keys[left], self.place[at[left]], -1)
            left = left[(got != keys[left]) & (got >= 0)]
        return out


@dataclass(frozen=True)
class Model:
    """Code lengths, one for each language, of bytes after contexts, and of escapes from contexts.

    The key of either has the context's length in its sixth byte and the bytes below.
    """

    languages: tuple[str, ...]
    entries: KeyTable
    bits: np.ndarray
    contexts: KeyTable
    escapes: np.ndarray


def _tagged(order: int, key: np.ndarray) -> np.ndarray:
    return key | (order << 40)


def _counts(key: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, ...]:
    """A language's bytes after contexts of one order that are in its tree: keys, counts, number of the context; and contexts, their totals and kinds."""
    own, inverse = np.unique(key & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
    n = np.bincount(inverse, n, len(own))
    context, of = np.unique(own >> 8, return_inverse=True)
    keep = (np.bincount(of, n, len(context)) >= LEAST)[of] | (order == 0)
    context, of = np.unique(own[keep] >> 8, return_inverse=True)
    return own[keep], n[keep], of, context, np.bincount(of, n[keep], len(context)), np.bincount(of, minlength=len(context))


def build(grams: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Model from counts of ``ORDER`` bytes and the next one (keys, counts) by language."""
    languages = tuple(sorted(grams, key=lambda s: s.encode()))
    all_keys, all_bits, all_contexts, all_escapes = [], [], [], []
    keys, bits = np.arange(256), np.full((256, len(languages)), 8.0)
    for order in range(ORDER + 1):
        parts = [_counts(*grams[lang], order) for lang in languages]
        shorter, shorter_bits = keys, bits
        keys = np.unique(np.concatenate([np.arange(256 if order == 0 else 0), *(p[0] for p in parts)]))
        contexts = np.unique(np.concatenate([np.zeros(0, np.int64), *(p[3] for p in parts)]))
        # what follows a context follows the shorter one too
        bits = shorter_bits[np.searchsorted(shorter, keys & ((1 << 8 * max(1, order)) - 1))].copy()
        escapes = np.zeros((len(contexts), len(languages)))
        for j, (own, n, of, context, total, kinds) in enumerate(parts):
            at = np.searchsorted(keys, own)
            rest = 1 - np.bincount(of, np.exp2(-bits[at, j]), len(context))
            escape = np.where(rest > 1e-12, kinds / (total + kinds), 0.0)
            cost = np.where(rest > 1e-12, np.log2(np.maximum(rest, 1e-300)) - np.log2(np.maximum(escape, 1e-300)), 0.0)
            escapes[np.searchsorted(contexts, context), j] = cost
            place = np.minimum(np.searchsorted(context, keys >> 8), max(0, len(context) - 1))
            if len(context):
                bits[:, j] += np.where(context[place] == keys >> 8, cost[place], 0.0)
            bits[at, j] = -np.log2(n / total[of] * (1 - escape[of]))
        for held, x in zip((all_keys, all_bits, all_contexts, all_escapes), (_tagged(order, keys), bits, _tagged(order, contexts), escapes)):
            held.append(x)
    return Model(languages, KeyTable(np.concatenate(all_keys)), np.concatenate(all_bits).astype(np.float32), KeyTable(np.concatenate(all_contexts)), np.concatenate(all_escapes).astype(np.float32))


def keys_of(data: np.ndarray) -> np.ndarray:
    """The key of each byte with the ``ORDER`` bytes before it, from the first that has so many."""
    key = np.zeros(max(0, len(data) - ORDER), dtype=np.int64)
    for k in range(ORDER + 1):
        key = key << 8 | data[k : k + len(key)]
    return key


def costs(model: Model, key: np.ndarray) -> np.ndarray:
    """Code lengths (keys, languages) of bytes in their contexts."""
    out = np.zeros((len(key), len(model.languages)), dtype=np.float32)
    left = np.arange(len(key))
    for order in range(ORDER, -1, -1):
        now = key[left]
        found = model.entries.find(_tagged(order, now & ((1 << 8 * (order + 1)) - 1)))
        there = found >= 0
        out[left[there]] += model.bits[found[there]]
        left, now = left[~there], now[~there]
        if not len(left):
            break
        context = model.contexts.find(_tagged(order, now >> 8 & ((1 << 8 * order) - 1)))
        there = context >= 0
        out[left[there]] += model.escapes[context[there]]
    return out


def code_lengths(model: Model, texts: list[bytes], step: int = 1 << 17) -> np.ndarray:
    """Bits of each whole text under each language, (texts, languages), about ``step`` bytes at a time; long texts are summed piece by piece."""
    out = np.zeros((len(texts), len(model.languages)))
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= step):
            size += len(texts[j]) + ORDER
            j += 1
        joined = np.frombuffer(b"".join(BEFORE + t for t in texts[i:j]), np.uint8)
        begin = np.cumsum([0, *(len(t) + ORDER for t in texts[i:j])])
        for a in range(0, len(joined), step):  # one piece unless a single text is longer
            first = max(0, a - ORDER) + ORDER  # position of the first costed byte
            cost = costs(model, keys_of(joined[first - ORDER : a + step]))
            lo = np.clip(begin[:-1] + ORDER - first, 0, len(cost))
            hi = np.clip(begin[1:] - first, 0, len(cost))
            for k in np.flatnonzero(hi > lo):
                out[i + k] += cost[lo[k] : hi[k]].sum(0, dtype=np.float64)
        i = j
    return out


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of keys of each batch by language."""
    for b in batches:
        by: dict[str, list[np.ndarray]] = {}
        for lang, t in zip(b.column("lang").to_pylist(), texts_of(b.column("text"))):
            by.setdefault(lang, []).append(keys_of(np.frombuffer(BEFORE + t, np.uint8)))
        for lang, parts in by.items():
            key, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key), pa.array(n)], names=["lang", "gram", "n"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = 400) -> Model:
    """Learns from about ``sample_rows`` whole documents of each language.

    Only documents outside the held-out fifth with a language and a text
    count.  They are drawn by a hash of the id at the rate that gives that
    many of all such documents of the language, so the sample doesn't grow
    with the input, nor do the counts that come to the driver; twice as many
    rows at most are taken of a language, should ids repeat.  Repeated rows count each.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    own = own.filter(F.col("lang").isNotNull() & in_training(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return build({})
    rate = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, sample_rows / n))])
    sample = own.filter((draw(F.col("doc_id"), "language") < F.element_at(rate, F.col("lang"))) & F.col("text").isNotNull())
    sample = sample.limit(2 * sample_rows * len(sizes))
    counted = sample.select("lang", "text").mapInArrow(_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    grams: dict[str, list[tuple[int, int]]] = {}
    for r in counted.toLocalIterator():
        grams.setdefault(r["lang"], []).append((r["gram"], r["n"]))
    return build({lang: tuple(np.array(x, np.int64) for x in zip(*rows)) for lang, rows in grams.items()})


def identify(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns doc_id, held_out, lang_pred, score for each document, from its whole text only.

    The prediction has the shortest code length (ties: the first language by
    code point); ``score`` is its posterior probability under equal priors.
    ``und`` with score 0 where the text is null or has no letter, or where
    no language was learned; the text's letters are those of Unicode.  Rows repeat as given, other columns are not
    read, an empty table gives no rows, and a very long text is summed piece
    by piece.  A narrow pass: no shuffle.  The model is
    broadcast; its size is bounded by the contexts of the sample.
    """
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts, letter = list(texts_of(b.column("text"))), b.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            lang, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            at = np.flatnonzero(letter) if m.languages else []
            if len(at):
                bits = code_lengths(m, [texts[i] for i in at])
                best = bits.argmin(1)
                lang[at] = np.array(m.languages, dtype=object)[best]
                score[at] = 1 / np.exp2((bits.min(1, keepdims=True) - bits).clip(-1000, 0)).sum(1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (~in_training(F.col(id_col))).alias("held_out"), text.alias("text"), F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False)).alias("letter"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
