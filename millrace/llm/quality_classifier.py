"""Quality classifier: Bradley-Terry ranking on preference pairs, cut at a score quantile.

Each preference pair is a document of label 1 and one of label 0; the
probability that the first is preferred is the logistic function of the
difference of their scores, a linear function of text features.  Weights
minimise the logistic loss on feature differences.  The score quantile that
separates the labels of the sample best becomes the threshold, which a
logistic curve maps to ``cut``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import combine, draw, in_training, released, texts_of, word_hashes, words_of

FEATURES = ("empty", "log_words", "word_length", "symbols", "bars", "shouts", "capitals", "digits", "other", "high", "lines", "distinct", "repeats", "dup_lines", "sentences", "commas")


def features(data: bytes) -> np.ndarray:
    """Feature vector of one whole text; zeros but for ``empty`` where there is no word."""
    out = np.zeros(len(FEATURES))
    buffer, start, end = words_of(data)
    n = len(start)
    if not n:
        out[0] = 1
        return out
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    of = lambda chars: count[np.frombuffer(chars, np.uint8)].sum()
    letters = max(1, count[65:91].sum() + count[97:123].sum())
    hashes = word_hashes(buffer, start, end)
    lines = [x for x in data.split(b"\n") if x.strip()]
    if n > 2:
        _, times = np.unique(combine([hashes[:-2], hashes[1:-1], hashes[2:]]), return_counts=True)
        out[12] = times[times > 1].sum() / (n - 2)
    out[1:12] = (
        np.log1p(n) / 5,
        np.log((end - start).mean()),
        min(3, of(b"#*$%&<>") / n),
        min(3, of(b"|~^{}[]\\=_@") / n),
        min(3, of(b"!?") / n),
        count[65:91].sum() / letters,
        min(3, count[48:58].sum() / n),
        min(3, (count[:9].sum() + count[14:32].sum() + of(b"()/;:+`\"'-")) / n),
        count[128:].sum() / len(data),
        np.log1p(len(lines)) / 5,
        len(np.unique(hashes)) / n,
    )
    out[13] = 1 - len(set(lines)) / max(1, len(lines))
    out[14:] = min(3, 10 * of(b".") / n), min(3, 10 * of(b",") / n)
    return out


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        s = ((x - self.mean) / self.scale).clip(-8, 8) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-(s + np.log(self.cut / (1 - self.cut))).clip(-500, 500)))


def fit(x: np.ndarray, label: np.ndarray, pairs: int = 50_000, ridge: float = 1e-3, cut: float = 0.3, seed: int = 7) -> Ranker:
    """Learns the ranker from a sample of feature vectors with labels 1 and 0.

    With one label or none there is no pair: every score is then 0.5.
    """
    d = x.shape[1]
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranker(np.zeros(d), np.ones(d), np.zeros(d), float(np.log(cut / (1 - cut))), cut)
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = ((x - mean) / scale).clip(-8, 8)
    rng = np.random.default_rng(seed)
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(d)
    for _ in range(30):  # Newton's method
        p = 1 / (1 + np.exp(-(diff @ w).clip(-30, 30)))
        gradient = diff.T @ (p - 1) / pairs + ridge * w
        step = np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / pairs + ridge * np.eye(d), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    at = np.quantile(s, np.linspace(0.005, 0.995, 199))
    share = [((s[good] >= t).mean() + (s[bad] < t).mean()) / 2 for t in at]
    best = np.flatnonzero(np.array(share) >= max(share) - 1e-3)
    return Ranker(mean, scale, w, float(at[best[0]]), cut)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [features(t).tolist() for t in texts_of(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = 6_000, cut: float = 0.3) -> Ranker:
    """Fits on about ``sample_rows`` labelled documents outside the held-out fifth.

    The sample is drawn by a hash of the id at the rate that gives that many
    of all labelled rows, so its size doesn't grow with the input; only
    feature vectors come to the driver, and should ids repeat, of four times as many rows at most.  Null labels aren't used; labels that
    contradict each other for one id are all used, as are rows that repeat.  Without labelled rows every score is 0.5.
    """
    known = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label")).filter(F.col("label").isin(0, 1) & in_training(F.col("l_id")))
    rate = min(1.0, sample_rows / max(1, known.count()))
    known = known.filter(draw(F.col("l_id"), "quality") < rate)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = own.filter(in_training(F.col("doc_id")) & (draw(F.col("doc_id"), "quality") < rate))
    sample = own.join(known, F.col("doc_id") == F.col("l_id")).select("text", "label").limit(4 * sample_rows).mapInArrow(_vectors, "label int, x array<double>").collect()
    sample.sort(key=lambda r: (r["label"], r["x"]))  # the same sample whatever order it comes in
    x = np.array([r["x"] for r in sample]).reshape(len(sample), len(FEATURES))
    return fit(x, np.array([r["label"] for r in sample]), cut=cut)


def score_quality(spark: SparkSession, docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Returns doc_id, held_out, score, predicted for each document, and its columns named in ``carry``.

    The score of a text depends on its bytes only, all of them.  Null and empty texts have
    the score of a text without words.  Rows repeat as given, an empty table gives no rows, and other columns
    are not read unless carried, under their own names.  A narrow pass: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in texts_of(b.column(0))]).reshape(-1, len(FEATURES))
            s = ranker.score(x)
            kept = b.columns[1:]
            yield pa.RecordBatch.from_arrays([*kept[:2], pa.array(s), pa.array((s >= ranker.cut).astype(np.int32)), *kept[2:]], names=["doc_id", "held_out", "score", "predicted", *carry])

    rows = docs.select(F.col(text_col).cast("string").alias("scored text"), F.col(id_col).cast("long").alias("doc_id"), (~in_training(F.col(id_col))).alias("held_out"), *carry)
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), *(docs.schema[c] for c in carry)])
    return rows.mapInArrow(released(run), out)
