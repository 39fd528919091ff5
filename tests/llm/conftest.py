import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("size", T.StringType()),
    T.StructField("sig", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("shard", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("kept", T.StringType()),
])
A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
B = "Die Katze und der Hund gehen in den Wald, wo sie mit dem Vogel auf einem Baum sitzen und über das Wetter reden."
ROWS = [
    (1, A, "en", "s1"),
    (2, A, "en", "s2"),
    (3, A + " more", "en", None),
    (4, None, "en", "s1"),
    (5, "", None, "s1"),
    (6, " \n\t ", "de", "s2"),
    (7, "short text", "en", "s2"),
    (8, "SHORT  text", "en", "s2"),
    (9, B, "de", "s3"),
    (9, B, "de", "s3"),
    (None, "no id here\nReleased under the MIT License.", None, "s3"),
    (11, "word " * 30_000, "en", "s3"),
    (12, "All rights reserved. CC BY 4.0, cc\nby; General Public License\ngeneral public license", "en", "s1"),
    (13, "naïve ÉCOLE 日本語 ½ <|endoftext|> it's 'quoted'\u00a0x\u000bfoo\u200b bar", "fr", "s1"),
]


@pytest.fixture(scope="session")
def rows():
    return ROWS


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "x", "x", "x", "x", "x", "x") for i, t, lang, s in ROWS], DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
