"""A corpus pipeline of five operators: filter by quality, drop copies and near copies, mix sources, pack.

Every stage takes (spark, docs, sf_dir) and works on all that the one before
kept.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, jaccard_join, mixing, packing, quality_classifier
from millrace.llm.common import SPACE, Shared, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good; it learns from the labelled ones among them.

    Each row is judged by its text alone: repeated rows stay or go together, a null text counts as an empty one,
    and without labels or rows nothing is learned and all stay.
    """
    ranker = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score_quality(spark, docs, ranker, carry=COLUMNS[1:])
    return scored.filter("predicted = 1").select(*COLUMNS)


def _id_key(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit("null")).alias("id_key")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text the one with the largest id stays, and of its repeated rows one."""
    kept = exact_dedup.exact_dedup(spark, docs).filter("kept").select(_id_key("doc_id"), F.col("text_sha256").alias("sha"))
    own = docs.select("*", _id_key("doc_id"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha"))
    return own.join(kept, ["id_key", "sha"], "left_semi").dropDuplicates(["id_key", "sha"]).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    A row is named by id and text, so rows without an id, or of several texts under one id, are
    decided one by one; rows equal in both stay or go together.  Null and empty texts have no duplicates and stay.
    """
    groups = jaccard_join.jaccard_components(spark, docs)
    gone = groups.filter(~F.col("representative")).select(_id_key("doc_id"), F.col("text_hash").alias("hash")).distinct()
    return docs.select("*", _id_key("doc_id"), F.xxhash64("text").alias("hash")).join(gone, ["id_key", "hash"], "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's words: each document once for every whole epoch, and cut where its source's budget ends.

    A document without words gives nothing, a null source is one of its own; no text is shuffled but those of the
    range of each source in which its budget ends.
    """
    taken = mixing.mix_sources(spark, docs, carry=("text", "lang", "n_chars"))
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rest = F.when(F.col("size") > 0, F.col("taken") - whole * F.col("size")).otherwise(0).cast("int")
    cut = F.when(rest > 0, F.array_join(F.slice(F.filter(F.split("text", SPACE), lambda w: w != ""), F.lit(1), rest), " "))
    copies = F.concat(F.array_repeat(F.col("text"), whole), F.filter(F.array(cut), lambda x: x.isNotNull()))
    out = taken.select("doc_id", F.explode(copies).alias("mixed"), "lang", "source", "n_chars", "text")
    return out.select("doc_id", F.col("mixed").alias("text"), "lang", "source", F.when(F.col("mixed") == F.col("text"), F.col("n_chars")).otherwise(F.length("mixed")).cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, as pieces of documents; repeated rows are documents of their own."""
    import public_tokenizers

    return packing.pack_documents(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read by the next."""
    shared = Shared(spark, "pipeline")

    def step(docs: DataFrame, numbered: tuple) -> DataFrame:
        k, (_, stage) = numbered
        out = stage(spark, docs, sf_dir)
        return out if k == len(STAGES) - 1 else shared.keep(out, f"stage{k}")

    return reduce(step, enumerate(STAGES), table(spark, sf_dir, "documents"))


#: Learned scores and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None
