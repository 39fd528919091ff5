"""Fill-in-middle: a text cut twice at unit boundaries, its pieces put in another order between marks.

A text is decoded to an array of code points.  Each has a class, and a table
says which pairs of neighbouring classes end a unit; so all boundaries come
from one comparison of the array with itself.  A hash of the document's id
chooses two of their ranks, and the pieces between them are encoded again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import released

#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
_BLANK = np.array([0x20, *range(0x09, 0x0E)], dtype=np.uint32)
#: For each kind of unit: the class (0 or 1) of code points, and by the classes of two neighbours whether a unit ends between them.
UNITS = {
    "line": (lambda points: points == 10, np.array([[False, False], [True, True]])),
    "word": (lambda points: np.isin(points, _BLANK), np.array([[False, False], [True, False]])),
    "character": (lambda points: np.zeros(len(points), dtype=bool), np.array([[True, True], [True, True]])),
}


def points_of(data: bytes) -> np.ndarray:
    """Code points of UTF-8 bytes; a byte that belongs to none is one of its own."""
    return np.frombuffer(data.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), dtype="<u4")


def bytes_of(points: np.ndarray) -> bytes:
    """The bytes that ``points_of`` was given."""
    return points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogateescape")


def boundaries(points: np.ndarray, unit: str = "line") -> np.ndarray:
    """Where units begin, and the end of the last: one more than there are units; for an empty text only 0."""
    if not len(points):
        return np.zeros(1, dtype=np.int64)
    kind, ends = UNITS[unit]
    of = kind(points).astype(np.uint8)
    inner = np.flatnonzero(ends.ravel()[2 * of[:-1] + of[1:]]) + 1
    return np.concatenate(([0], inner, [len(points)]))


def _checked(marks: tuple[str, str, str]) -> tuple[bytes, ...]:
    """The marks as bytes, if the pieces between them can always be told apart."""
    for a in marks:
        for b in marks:
            if not a or (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError(f"marks {a!r} and {b!r} are empty or can overlap")
    if len(set(marks)) < 3:
        raise ValueError("the three marks must differ")
    return tuple(m.encode() for m in marks)


def _transform(unit: str, percent: int, spm_percent: int, seed: int, marks: tuple[str, str, str], step: int):
    before, after, between = _checked(marks)

    def one(doc_id: int | None, data: bytes) -> tuple:
        points = points_of(data)
        edge = boundaries(points, unit)
        n = len(edge) - 1
        digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
        if not n or h3 % 100 >= percent or any(m in data for m in (before, after, between)):
            return doc_id, n, "plain", None, None, data
        a, b = sorted((int(edge[h1 % (n + 1)]), int(edge[h2 % (n + 1)])))
        prefix, middle, suffix = bytes_of(points[:a]), bytes_of(points[a:b]), bytes_of(points[b:])
        spm = h4 % 100 < spm_percent
        pieces = (after, suffix, before, prefix, between, middle) if spm else (before, prefix, after, suffix, between, middle)
        return doc_id, n, "spm" if spm else "psm", a, b - a, b"".join(pieces)

    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_binary())
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)][:5] + [pa.array([r[5] for r in rows], pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, size = [], 0
            for doc_id, text in zip(b.column(0), b.column(1)):
                rows.append(one(doc_id.as_py(), text.as_py()))
                size += len(rows[-1][5])
                if size >= step:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)

    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", percent: int = 100, spm_percent: int = 50, seed: int = 7, marks: tuple[str, str, str] = MARKS, step: int = 1 << 23) -> DataFrame:
    """One row for each document: doc_id, n (units), form, prefix_chars, middle_chars, output.

    ``percent`` of the documents are transformed, ``spm_percent`` of these with the suffix first; the rest, texts
    without a unit and texts that hold a mark stay ``plain`` (then the lengths are null).  Everything hangs on the
    seed and the id, so reruns agree and repeated rows give repeated results; a null id counts as the text ''.
    A null text is empty.  Bytes that aren't UTF-8 are kept as they are, one code point each.  Other columns of
    ``docs`` are not read, so their names can't clash; an empty table gives no rows.  A text is held whole by its
    task, at about ten times its size; nothing is shuffled.  Results are sent in batches of about ``step`` bytes.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    out = rows.mapInArrow(released(_transform(unit, percent, spm_percent, seed, marks, step)), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from: its pieces stand between the marks, which no piece holds. (Splitting is the JVM's, so texts must be UTF-8.)"""
    piece = F.split(output, "|".join(re.escape(m) for m in marks), -1)
    psm = F.concat(piece[1], piece[3], piece[2])
    spm = F.concat(piece[2], piece[3], piece[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(transformed: DataFrame) -> DataFrame:
    """Outputs and the texts restored from them by their SHA-256."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH own AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
counted AS (
    SELECT *, string_split(text, chr(10)) AS lines, length(text) - length(replace(text, chr(10), '')) + CAST(text <> '' AND NOT ends_with(text, chr(10)) AS BIGINT) AS n,
           CAST('0x' || substr(h, 1, 8) AS UBIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS UBIGINT) AS h2, CAST('0x' || substr(h, 25, 8) AS UBIGINT) AS h4
    FROM own),
chosen AS (
    SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
           CAST(least(h1 % CAST(n + 1 AS UBIGINT), h2 % CAST(n + 1 AS UBIGINT)) AS BIGINT) AS a, CAST(greatest(h1 % CAST(n + 1 AS UBIGINT), h2 % CAST(n + 1 AS UBIGINT)) AS BIGINT) AS b
    FROM counted),
placed AS (
    SELECT *, CASE WHEN a >= n THEN length(text) WHEN a = 0 THEN 0 ELSE length(array_to_string(lines[1:a], chr(10))) + 1 END AS x,
           CASE WHEN b >= n THEN length(text) WHEN b = 0 THEN 0 ELSE length(array_to_string(lines[1:b], chr(10))) + 1 END AS y
    FROM chosen),
cut AS (SELECT *, substr(text, 1, x) AS p, substr(text, x + 1, y - x) AS m, substr(text, y + 1) AS s FROM placed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(x AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(y - x AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
FROM cut
"""
