"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD

#: Frequent words of the languages served; fixed values.
STOP_WORDS = (
    "the of and to in is that it for as with was on be by are this or an at from "
    "der die das und ist nicht ein eine zu von mit den im für auf sich des dem als auch "
    "le la les de des et en un une que est pour dans qui sur par au pas du il elle "
    "el los las que y en un una por con para se del no es su al lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` names a column of counts or ratios; a document passes when least <= measure <= most."""

    measure: str
    least: float | None = None
    most: float | None = None


#: The base rules and those of the method.
BASE = (Rule("n_words", least=50), Rule("repeat_pct", most=50))
METHOD = (
    Rule("n_words", most=1_000_000),
    Rule("mean_word_chars", least=2, most=20),
    Rule("symbol_ratio", most=0.1),
    Rule("dup_line_ratio", most=0.6),
    Rule("stop_ratio", least=0.02),
    Rule("caps_ratio", most=0.5),
)


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """True when every rule holds; a measure that is null passes."""
    out = F.lit(True)
    for r in rules:
        c = F.col(r.measure)
        if r.least is not None:
            out = out & F.coalesce(c >= r.least, F.lit(True))
        if r.most is not None:
            out = out & F.coalesce(c <= r.most, F.lit(True))
    return out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[Rule, ...] = BASE, method: tuple[Rule, ...] = METHOD) -> DataFrame:
    """One row for each document with its counts and the verdict.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and the ratios the rules use.  A null
    text has no words, fails the least length and isn't kept.  Rows repeat as
    given; an empty table gives no rows; other columns are not read.  Everything is a narrow projection: no
    shuffle, no user function, and memory for one row's words, however long its text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    # materialised before use: lambdas below must refer to columns, not to the expressions behind them
    rows = rows.withColumn("w", F.filter(F.split("text", SPACE), lambda w: w != ""))
    rows = rows.withColumn("n", F.size("w"))
    third = F.greatest(F.col("n") - 2, F.lit(0))
    windows = F.zip_with(F.zip_with(F.slice("w", 1, third), F.slice("w", 2, third), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), F.slice("w", 3, third), lambda p, c: F.xxhash64(p["a"], p["b"], c))
    rows = rows.withColumn("s", F.when(F.col("n") >= 3, F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    near = F.greatest(F.size("s") - 1, F.lit(0))
    twice = F.array_distinct(F.flatten(F.zip_with(F.slice("s", 1, near), F.slice("s", 2, near), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]+", ""))
    rows = rows.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        twice.alias("twice"),
        F.size(F.filter("w", lambda w: F.lower(w).isin(sorted(set(STOP_WORDS))))).alias("n_stop"),
        letters.alias("n_letters"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).alias("n_caps"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("twice", lambda i: F.array(i, i + 1, i + 2)))))
    rows = rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        "n_stop",
        "n_letters",
        "n_caps",
    )
    share = lambda a, b: F.try_divide(F.col(a), F.col(b))
    rows = rows.withColumns({
        "repeat_pct": 100 * share("n_repeat_words", "n_words"),
        "mean_word_chars": share("word_chars", "n_words"),
        "symbol_ratio": share("n_symbols", "n_words"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
        "stop_ratio": share("n_stop", "n_words"),
        "caps_ratio": share("n_caps", "n_letters"),
    })
    failed = ~compile_rules(base)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & compile_rules(method)).alias("kept"))


def oracle_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g,
         len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop,
         length(regexp_replace(text, '[^\pL]+', '', 'g')) AS n_letters, length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_caps
  FROM d
), x AS (SELECT doc_id, unnest(g) AS g, unnest(range(0, len(g))) AS i FROM m),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM x) WHERE c > 1) GROUP BY doc_id
), c AS (
  SELECT m.*, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM m LEFT JOIN r USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words <= 1000000 AND word_chars / n_words BETWEEN 2 AND 20 AND n_symbols / n_words <= 0.1
       AND n_dup_lines / n_lines <= 0.6 AND n_stop / n_words >= 0.02 AND coalesce(n_caps / nullif(n_letters, 0) <= 0.5, true) AS kept
FROM b
"""


ORACLE_SQL = oracle_sql()
