"""Spelling variants: words that are one letter apart, grouped under the form that is far more frequent.

1. Words are cut, lower-cased and counted by built-in functions; counts combine before the shuffle.
2. Two words one error apart, the shorter of ``m`` letters, share their first or their last ``m // 2`` letters. So
   each word is posted under its halves: as it stands under a first half, reversed under a last half.
3. A task gets whole groups of words that share a half, and makes a minimal acyclic automaton of them: a forward one
   where words stand as they are, a backward one where they are reversed.  Its states count the words they lead to,
   so a path sums up to the word's number (a perfect hash), which finds the word's count in an array.
4. Each word is looked up in the automaton of its half: the half is matched exactly, the rest with one error.  A pair
   that shares both halves is left to the forward automaton, so none is found twice; neighbours combine to a row for
   each word and half before they are sent.
5. Forms are followed to their roots by doubling: at least tenfold counts at each step keep chains short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, lower_ascii, mix, released

LETTERS = r"[A-Za-zÀ-ÿ]"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 7, every: int = 31) -> DataFrame:
    """(word, n): letter runs of at least ``least_letters``, lower-cased in A-Z, with their occurrences.

    A run whose crc32 with its document's id is a multiple of ``every`` loses one letter first, as a slip of the pen does (0: none does).
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    runs = rows.select("id", F.explode(F.regexp_extract_all("text", F.lit(f"({LETTERS}{{{least_letters},}})"), F.lit(1))).alias("run"))
    runs = runs.withColumn("run", lower_ascii(F.col("run")))
    if every:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = (F.col("h") % F.length("run")).cast("int")
        slip = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, slip).otherwise(F.col("run")).alias("run"))
    return runs.select(F.col("run").alias("word")).filter(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n"))


class Automaton:
    """The minimal acyclic automaton of sorted distinct words, given as rows of code points with zeros after their ends.

    States are the classes of equal right languages, found from the deepest
    letters up.  ``total`` counts the words a state leads to, and each
    transition holds how many words come before those behind it, so the sums
    along a word's path are its number in the order of the rows.
    """

    def __init__(self, rows: np.ndarray, long: np.ndarray):
        n, width = rows.shape
        same = np.zeros((n, width), dtype=bool)
        same[1:] = rows[1:] == rows[:-1]
        shared = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
        first = [np.flatnonzero((shared < d) & (long >= d)) if d else np.zeros(1, np.int64) for d in range(int(long.max()) + 1)]
        print_, labels, parents, totals, finals = [None] * len(first), [], [], [None] * len(first), [None] * len(first)
        # prints of right languages, deepest letters first
        for d in range(len(first) - 1, -1, -1):
            final = long[first[d]] == d
            value, total = mix(final.astype(np.uint64) + _ODD), final.astype(np.int64)
            if d + 1 < len(first):
                label = rows[first[d + 1], d]
                parent = np.searchsorted(first[d], first[d + 1], "right") - 1
                np.add.at(value, parent, mix(mix(label.astype(np.uint64)) + print_[d + 1]))
                np.add.at(total, parent, totals[d + 1])
                labels.insert(0, label)
                parents.insert(0, parent)
            print_[d], totals[d], finals[d] = mix(value), total, final
        edge = np.cumsum([0, *(len(x) for x in first)])
        _, node, state = np.unique(np.concatenate(print_), return_index=True, return_inverse=True)
        self.states, self.root = len(node), int(state[0])
        self.total, self.final = np.concatenate(totals)[node], np.concatenate(finals)[node]
        # the transitions of one node of each class
        kept = np.zeros(edge[-1], dtype=bool)
        kept[node] = True
        origin = np.concatenate([p + edge[d] for d, p in enumerate(parents)]) if parents else np.zeros(0, np.int64)
        target = np.arange(1, edge[-1])
        label = np.concatenate(labels) if labels else np.zeros(0, rows.dtype)
        origin, target, label = (x[kept[origin]] for x in (origin, target, label))
        key = (state[origin].astype(np.uint64) << np.uint64(21)) | label.astype(np.uint64)
        order = np.argsort(key)
        self.key, self.target, self.label = key[order], state[target][order], label[order]
        self.begin = np.searchsorted(self.key, np.arange(self.states + 1, dtype=np.uint64) << np.uint64(21))
        ahead = np.append(0, np.cumsum(self.total[self.target]))
        own = (self.key >> np.uint64(21)).astype(np.int64)
        self.ahead = ahead[:-1] - ahead[self.begin[own]] + self.final[own]

    def step(self, state: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The transitions of states by labels, and which exist."""
        key = (state.astype(np.uint64) << np.uint64(21)) | label.astype(np.uint64)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return at, self.key[at] == key

    def near(self, rows: np.ndarray, long: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, number) of the words that differ by one letter from each query, behind its first ``exact`` letters; each once."""
        query, state, number = np.arange(len(rows)), np.full(len(rows), self.root), np.zeros(len(rows), np.int64)
        parts = []
        for at in range(int(long.max(initial=0)) + 1):
            here = exact[query] <= at
            q, s, k = query[here], state[here], number[here]
            parts.append((q[long[q] > at], np.full(int((long[q] > at).sum()), at + 1), s[long[q] > at], k[long[q] > at]))  # a letter too many
            out = self.begin[s + 1] - self.begin[s]
            edge = np.repeat(self.begin[s] - (np.cumsum(out) - out), out) + np.arange(int(out.sum()))
            q, k = np.repeat(q, out), np.repeat(k, out) + self.ahead[edge]
            parts.append((q, np.full(len(q), at), self.target[edge], k))  # one too few
            other = (long[q] > at) & (self.label[edge] != rows[q, min(at, rows.shape[1] - 1)])
            parts.append((q[other], np.full(int(other.sum()), at + 1), self.target[edge][other], k[other]))  # another one
            more = long[query] > at
            query, state, number = query[more], state[more], number[more]
            if not len(query):
                break
            edge, there = self.step(state, rows[query, at])
            query, state, number = query[there], self.target[edge[there]], number[there] + self.ahead[edge[there]]
        query, at, state, number = (np.concatenate(x) for x in zip(*parts))
        found = []
        while len(query):  # the rest exactly
            ended = (long[query] == at) & self.final[state]
            found.append((query[ended], number[ended]))
            more = long[query] > at
            query, at, state, number = query[more], at[more], state[more], number[more]
            edge, there = self.step(state, rows[query, at])
            query, at, state, number = query[there], at[there] + 1, self.target[edge[there]], number[there] + self.ahead[edge[there]]
        query, number = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        both = np.unique(query * len(rows) + number) if len(query) else query
        return both // max(1, len(rows)), both % max(1, len(rows))


def matrix(words: list[str], front: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words behind the given symbols as rows, and the rows' lengths."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    head = np.array(front, dtype=np.uint32).reshape(len(words), -1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    rows = np.zeros((len(words), head.shape[1] + int(size.max(initial=0))), dtype=np.uint32)
    rows[:, : head.shape[1]] = head
    rows[:, head.shape[1] :][np.arange(rows.shape[1] - head.shape[1]) < size[:, None]] = letters
    return rows, size + head.shape[1]


#: How a posting writes its word: first letters as they are, then the rest forward or backward; whole words backward likewise.
FORWARD, BACKWARD, FORWARD_LONG, FORWARD_ENDS, BACKWARD_LONG, BACKWARD_ENDS = range(6)


def _word(kind: int, half: int, written: str) -> str:
    if kind in (FORWARD_ENDS, BACKWARD_ENDS):
        written = written[:half] + written[half:][::-1]
    return written[::-1] if kind in (BACKWARD, BACKWARD_LONG, BACKWARD_ENDS) else written


def group_neighbours(kinds: np.ndarray, halves: np.ndarray, written: list[str], counts: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, list[str]]:
    """For postings sorted by (kind, half, written): words that have neighbours, their number, and the most frequent's count and word."""
    rows, long = matrix(written, list(zip((kinds + 1).tolist(), (halves + 1).tolist())))
    exact = halves + 2 + np.where(kinds > BACKWARD, halves // 2, 0)
    q, k = Automaton(rows, long).near(rows, long, exact)
    words = [_word(a, b, c) for a, b, c in zip(kinds.tolist(), halves.tolist(), written)]
    size = long - 2
    own = np.minimum(size[q], size[k]) // 2 == halves[q]
    q, k = q[own], k[own]

    def owned(i: int, j: int) -> bool:  # by no other posting that comes before
        kind, half, a, b = kinds[i], halves[i], words[i], words[j]
        if kind in (BACKWARD, BACKWARD_LONG, BACKWARD_ENDS) and a[:half] == b[:half]:
            return False
        more = half + half // 2
        return not (kind == FORWARD_ENDS and a[:more] == b[:more] or kind == BACKWARD_ENDS and a[-more:] == b[-more:])

    mine = np.fromiter((kinds[i] in (FORWARD, FORWARD_LONG) or owned(i, j) for i, j in zip(q.tolist(), k.tolist())), bool, len(q))
    q, k = q[mine], k[mine]
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[k], -counts[k], q))
    q, k = q[order], k[order]
    first = np.flatnonzero(np.diff(q, prepend=-1))
    return [words[i] for i in q[first]], np.diff(np.append(first, len(q))), counts[k[first]], [words[i] for i in k[first]]


def _neighbours(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, str, str, int]] = []

        def answer() -> Iterator[pa.RecordBatch]:
            # groups of one have no neighbours
            group = [r[:3] for r in held]
            rows = [r for k, r in enumerate(held) if (k and group[k - 1] == group[k]) or (k + 1 < len(held) and group[k + 1] == group[k])]
            held.clear()
            if rows:
                kind, half, _, written, n = zip(*rows)
                words, near, best_n, best = group_neighbours(np.array(kind), np.array(half), list(written), np.array(n))
                if words:
                    yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(near), pa.array(best_n), pa.array(best)], names=["word", "n_near", "form_n", "form"])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("kind", "half", "shared", "written", "n"))):
                # whole groups at a time, as many as the cells allow
                if held and row[:3] != held[-1][:3] and (len(held) + 1) * (2 * row[1] + 4) > cells:
                    yield from answer()
                held.append(row)
        yield from answer()

    return run


def _posted(words: DataFrame, least_letters: int) -> DataFrame:
    """Each word under its halves as the shorter of a pair and as the longer one, in both directions."""
    long = F.length("word")
    halves = F.array_distinct(F.filter(F.array(F.floor(long / 2).cast("int"), F.floor((long - 1) / 2).cast("int")), lambda h: h >= F.lit(least_letters // 2)))
    posted = words.select("word", "n", F.explode(halves).alias("half"))
    both = F.array(F.struct(F.lit(FORWARD).alias("kind"), F.col("word").alias("written")), F.struct(F.lit(BACKWARD).alias("kind"), F.reverse("word").alias("written")))
    return posted.select("n", "half", F.explode(both).alias("x")).select("n", "half", "x.kind", "x.written", F.substring("x.written", F.lit(1), F.col("half")).alias("shared"))


def _split(posted: DataFrame) -> DataFrame:
    """Postings of large groups under half as many letters more: of what follows, or of the other end."""
    more = F.floor(F.col("half") / 2).cast("int")
    rest = F.substring("written", F.col("half") + 1, F.length("written"))
    ends = F.concat(F.substring("written", F.lit(1), F.col("half")), F.reverse(rest))
    forward = F.col("kind") == FORWARD
    both = F.array(
        F.struct(F.when(forward, FORWARD_LONG).otherwise(BACKWARD_LONG).alias("kind"), F.col("written").alias("written")),
        F.struct(F.when(forward, FORWARD_ENDS).otherwise(BACKWARD_ENDS).alias("kind"), ends.alias("written")),
    )
    return posted.select("n", "half", (F.col("half") + more).alias("long"), F.explode(both).alias("x")).select("n", "half", "x.kind", "x.written", F.substring("x.written", F.lit(1), F.col("long")).alias("shared"))


def near_words(spark: SparkSession, words: DataFrame, least_letters: int = 7, group_words: int = 100_000, cells: int = 500_000, broadcast_rows: int = 100_000) -> DataFrame:
    """(word, n_near, form_n, form): parts of each word's neighbours, to be combined: a number, and the most frequent one of them.

    A group of more than ``group_words`` words that share a half is dealt out anew by half as many letters more, so that no
    automaton of one half grows with the vocabulary; tasks take several small groups in one automaton, up to ``cells`` letters.
    """
    posted = _posted(words, least_letters)
    large = posted.groupBy("kind", "half", "shared").agg(F.count("*").alias("words")).filter(F.col("words") > group_words).drop("words")
    n = large.count()
    if n:
        large = F.broadcast(large) if n <= broadcast_rows else large
        key = ["kind", "half", "shared"]
        posted = posted.join(large, key, "left_anti").select("n", "half", "kind", "written", "shared").unionByName(_split(posted.join(large, key, "left_semi")))
    dealt = posted.repartition("kind", "half", "shared").sortWithinPartitions("kind", "half", "shared", "written")
    return dealt.select("kind", "half", "shared", "written", "n").mapInArrow(released(_neighbours(cells)), "word string, n_near long, form_n long, form string")


def _roots(shared: Shared, words: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: pointers are doubled until none moves, each time over the words that still can."""
    linked = shared.keep(words.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "root0")
    for k in range(1, 64):
        onward = linked.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = shared.keep(linked.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moves")), f"root{k}")
        shared.drop(f"root{k - 1}")
        linked = moved.select("word", "root")
        if moved.filter("moves").isEmpty():
            return linked
    raise ValueError("forms lead in a circle")


def spelling_variants(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 7, least_count: int = 2, times: int = 10, every: int = 31, group_words: int = 100_000) -> DataFrame:
    """One row for each word of at least ``least_letters`` letters and ``least_count`` occurrences: word, form, root, n, n_near, form_n.

    ``form`` is the most frequent word one letter apart (ties: the first in code-point order) where it is at least ``times`` as
    frequent, else null; ``root`` is where forms lead to, the word itself without one.  Null and empty texts have no words, repeated
    rows count again, a null id counts as the text ''.  Only the id and the text are read, so other columns can't clash;
    an empty table gives no rows.  Words of any length are compared whole.
    """
    shared = Shared(spark, "spelling")
    words = shared.keep(count_words(docs, id_col, text_col, least_letters, every).filter(F.col("n") >= least_count), "words")
    none = [F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form")]
    parts = words.select("word", "n", *none).unionByName(near_words(spark, words, least_letters, group_words).withColumn("n", F.lit(None).cast("long")))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))))
    found = parts.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= times * F.col("n")
    found = shared.keep(found.select("word", "n", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    shared.drop("words")
    linked = _roots(shared, found)
    return found.join(linked, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE_SQL = r"""
WITH RECURSIVE tab AS (SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t FROM (SELECT unnest(range(256)) AS b)),
runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents),
coded AS (SELECT run, hex(encode(id || ':' || run)) AS code FROM runs),
hashed AS (
    SELECT run, xor(list_reduce(list_concat([4294967295], list_transform(range(length(code) // 2), lambda i: CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT))), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS h
    FROM coded, tab),
slipped AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
    FROM words w LEFT JOIN best b USING (word)),
chain AS (
    SELECT word, word AS root, form AS onward FROM forms
    UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.onward = f.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON f.word = c.word AND c.onward IS NULL
"""
