"""License scans: an exact set-similarity join of text blocks with license templates.

Tokens of the templates are ordered by their frequency over all documents,
rare first.  A block that contains the needed share of a template's tokens has
at least one of the template's first ``m - need + 1`` tokens (prefix filter),
at least ``need`` template tokens (length filter), and its first common token
stands early enough in both orders (positional filter).  What passes is
verified once for each block and template: containment, and the tokens that
tell the template from its siblings.  Windows of words are looked at
around the template's rare tokens only, for the same reason.  Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii

#: What separates words once A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases looked for word by word, and their labels; fixed values.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Notices looked for by containment, and their labels.
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd"),
    ("this work is licensed under a creative commons attribution license", "cc-by"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this work is dedicated to the public domain", "public-domain"),
    ("copyright all rights reserved", "reserved"),
)
#: Tokens that tell a template from its siblings: those that a block must have, and those that it must not have.
MARKS = {
    "licensed under the apache license version 2 0": ("apache", ""),
    "licensed under cc by nc 4 0": ("nc", "nd sa"),
    "licensed under cc by sa 4 0": ("sa", "nc nd"),
    "licensed under cc by nd 4 0": ("nd", "nc sa"),
    "licensed under cc by nc sa 4 0": ("nc sa", "nd"),
    "licensed under cc by nc nd 4 0": ("nc nd", "sa"),
    "this work is licensed under a creative commons attribution license": ("commons creative", "noncommercial noderivatives noderivs sharealike"),
    "this work is licensed under the gnu general public license version 3": ("gnu", "affero lesser"),
    "released under the mit license": ("mit", ""),
    "this source code form is subject to the terms of the mozilla public license": ("mozilla", ""),
    "this work is dedicated to the public domain": ("domain public", ""),
    "copyright all rights reserved": ("reserved rights", ""),
}
THRESHOLD = 0.8


def needed(m: int, threshold: float) -> int:
    """Tokens a block must share with a template of m distinct tokens."""
    return max(1, math.ceil(round(threshold * m, 9)))


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), GAP), lambda w: w != "")


def token_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The templates' tokens by number of documents that have them, rare first (ties by token).

    Counts cover all documents; one row for each token of the fixed
    vocabulary comes to the driver.
    """
    found = docs.select(F.explode(F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, vocabulary)))).alias("token"))
    counts = {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).limit(len(vocabulary)).collect()}
    return sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))


def scan_licenses(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD, windows: bool = False, marks=MARKS) -> DataFrame:
    """One row for each document with the places of the phrases and all labels.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.  A block is a line; with ``windows`` a line of at most twice a
    template's words, and any run of as many words as the template has, over line ends.  ``marks`` gives by template the tokens that its block
    must have, and those that it must not have.  ``score`` is the largest containment of
    a template, 1 where a phrase stands, else 0.  A null text is empty: no
    words, empty label strings, null places.  Repeated rows are kept apart;
    other columns are not read; an empty table gives no rows.  A very long text is one row's array of words.
    The templates' prefixes are broadcast (a few dozen rows for the fixed ones, 100 000 at most).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sets = [(sorted(set(t.split())), label, len(t.split()), *(m.split() for m in marks.get(t, ("", "")))) for t, label in templates]
    order = token_order(rows, sorted({w for s, _, _, must, without in sets for w in (*s, *must, *without)}))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for k, (tokens, label, long, must, without) in enumerate(sets):
        tokens = sorted(tokens, key=rank.get)
        need = needed(len(tokens), threshold)
        index += [(tokens[i], i, k, tokens, need, label, long, must, without) for i in range(len(tokens) - need + 1)]
    least = min(x[4] for x in index)
    prefix = sorted({x[0] for x in index})
    if len(index) > 100_000:
        raise ValueError("the templates' prefixes are broadcast: 100 000 of their tokens at most")
    templates_by_token = F.broadcast(spark.createDataFrame(index, "t_token string, t_at int, t_id int, t_tokens array<string>, t_need int, t_label string, t_words int, t_must array<string>, t_without array<string>"))

    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("low", lower_ascii(F.col("text")))
    rows = rows.withColumn("words", F.filter(F.split("low", GAP), lambda w: w != ""))

    def here(w: Column, i: Column) -> Column:
        out = None
        for phrase, label in phrases:
            parts = phrase.split()
            met = w == parts[0]
            for j, p in enumerate(parts[1:], 1):
                met = met & (F.get(F.col("words"), i + j) == p)
            value = F.struct(i.alias("at"), F.lit(label).alias("label"))
            out = F.when(met, value) if out is None else out.when(met, value)
        return out

    ordered = F.array(*map(F.lit, order))
    rare, span = F.array(*map(F.lit, prefix)), max(x[6] for x in index)

    def line_block(line: Column) -> Column:
        own = F.split(line, GAP)
        return F.struct(F.array_intersect(ordered, own).alias("tokens"), F.size(F.filter(own, lambda w: w != "")).alias("long"), F.lit(None).cast("array<string>").alias("around"), F.lit(None).cast("int").alias("mid"))

    def around_block(w: Column, i: Column) -> Column:
        start = F.greatest(i + 2 - span, F.lit(1))
        around = F.slice("words", start, i + 1 + span - start)
        return F.when(F.array_contains(rare, w), F.struct(F.array(w).alias("tokens"), F.lit(None).cast("int").alias("long"), around.alias("around"), (i + 2 - start).alias("mid")))

    blocks = F.filter(F.transform(F.split("low", "\n"), line_block), lambda b: (F.size(b["tokens"]) >= least) & F.arrays_overlap(b["tokens"], rare))
    if windows:
        blocks = F.concat(blocks, F.filter(F.transform("words", around_block), lambda b: b.isNotNull() & (F.size(F.array_intersect(ordered, b["around"])) >= least)))
    blocks = F.when(F.arrays_overlap("words", rare), blocks)
    rows = rows.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), F.filter(F.transform("words", here), lambda x: x.isNotNull()).alias("hits"), blocks.alias("blocks"))

    pairs = rows.select("doc_id", "row", "n_words", "hits", F.explode_outer("blocks").alias("b"))
    pairs = pairs.select("doc_id", "row", "n_words", "hits", F.col("b.tokens").alias("b_tokens"), F.col("b.long").alias("b_words"), F.col("b.around").alias("around"), F.col("b.mid").alias("mid"))
    pairs = pairs.select("*", F.explode_outer("b_tokens").alias("b_token"))
    b_at = F.array_position("b_tokens", F.col("b_token")) - 1
    pairs = pairs.join(templates_by_token, F.col("b_token") == F.col("t_token"), "left")
    # at the first common token no more can be shared than stands from it on, in the block and in the template
    possible = (F.size("b_tokens") >= F.col("t_need")) & (F.least(F.size("b_tokens") - b_at, F.size("t_tokens") - F.col("t_at")) >= F.col("t_need"))
    shared = F.array_intersect("t_tokens", "b_tokens")
    first = F.element_at(shared, 1) == F.col("b_token")  # each pair is verified at its first common token only

    def told(tokens: Column | str) -> Column:
        return (F.size(F.array_intersect("t_must", tokens)) == F.size("t_must")) & ~F.arrays_overlap("t_without", tokens)

    met = F.when(possible & first & told("b_tokens"), F.size(shared)).otherwise(0)
    if windows:
        starts = F.sequence(F.greatest(F.col("mid") - F.col("t_words") + 1, F.lit(1)), F.col("mid"))
        runs = F.transform(starts, lambda s: F.slice("around", s, F.col("t_words")))
        best = F.array_max(F.transform(runs, lambda run: F.when(told(run), F.size(F.array_intersect("t_tokens", run))).otherwise(0)))
        near = F.when(F.size(F.array_intersect("t_tokens", "around")) >= F.col("t_need"), best).otherwise(0)
        met = F.when(F.col("mid").isNotNull(), near).when(F.col("b_words") <= 2 * F.col("t_words"), met).otherwise(0)
    match = F.when(met >= F.col("t_need"), F.struct(F.col("t_label").alias("label"), (met / F.size("t_tokens")).alias("share")))
    found = pairs.select("doc_id", "row", "n_words", "hits", match.alias("match"))
    found = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("hits").alias("hits"), F.collect_set("match.label").alias("more"), F.max("match.share").alias("share"))
    base = F.array_sort(F.array_distinct(F.transform("hits", lambda x: x["label"])))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_base"),
        F.array_min(F.transform("hits", lambda x: x["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform("hits", lambda x: x["at"])).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, "more")), ",").alias("labels"),
        F.when(F.size("hits") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def oracle_sql() -> str:
    words = r"regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    at = []
    for phrase, label in PHRASES:
        met = " AND ".join(f"w[i + {j + 1}] = '{p}'" for j, p in enumerate(phrase.split()))
        at.append(f"SELECT r, unnest(list_filter(range(0, len(w)), lambda i: {met})) AS p, '{label}' AS label FROM d")
    listed = lambda words: f"[{', '.join(map(repr, words))}]::VARCHAR[]"
    values = ", ".join(f"({listed(sorted(set(t.split())))}, {needed(len(set(t.split())), THRESHOLD)}, '{label}', {len(t.split())}, {', '.join(listed(m.split()) for m in MARKS.get(t, ('', '')))})" for t, label in TEMPLATES)
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {low} AS low, {words % low} AS w FROM documents),
p AS ({" UNION ALL ".join(at)}),
b AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY r),
t(tokens, need, label, long, must, without) AS (VALUES {values}),
c AS (SELECT d.r, w, list_transform(string_split(low, chr(10)), lambda x: {words % "x"}) AS lines, t.* FROM d, t WHERE len(list_intersect(w, tokens)) >= need),
l AS (SELECT r, tokens, need, label, must, without, unnest(list_concat(list_transform(range(len(w)), lambda i: w[i + 1 : i + long]), list_filter(lines, lambda x: len(x) <= 2 * long))) AS block FROM c),
m AS (
    SELECT r, label, len(list_intersect(block, tokens)) / len(tokens) AS share FROM l
    WHERE len(list_intersect(block, tokens)) >= need AND len(list_intersect(block, must)) = len(must) AND len(list_intersect(block, without)) = 0),
a AS (SELECT r, label FROM p UNION SELECT r, label FROM m),
g AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM a GROUP BY r),
s AS (SELECT r, max(share) AS share FROM m GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN g USING (r) LEFT JOIN s USING (r)
"""


ORACLE_SQL = oracle_sql()
