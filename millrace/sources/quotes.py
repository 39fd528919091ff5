"""CSV records that span lines, from files that are read in many parts.

A line either ends inside a quoted value or not, and which of both hangs on
whether it began inside one.  So a line is a map of two states, and so is a
part of a file: the maps of its lines, composed.  One scan finds the maps of
all parts, the driver composes them in order (a few bytes for each part), and
then every part can cut its own records.  Only what is open at an edge of a
part meets its other pieces, by a group of at most one piece for each part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _value(comma: str, lazy: bool) -> tuple[str, str]:
    """Patterns of a whole value and of a quoted one that isn't closed; all repeats are possessive, so long values need no stack."""
    sep = re.escape(comma)
    inner = rf'"[^"]*+(?:(?:""|"(?!["{sep}]|\z))[^"]*+)*+' if lazy else r'"[^"]*+(?:""[^"]*+)*+'
    bare = rf'(?!")[^{sep}]*+' if lazy else rf'[^"{sep}]*+'
    return rf'(?:{inner}"|{bare})', inner


def whole(comma: str) -> str:
    """A record whose quotes all enclose whole values."""
    value, _ = _value(comma, False)
    return rf"\A{value}(?:{re.escape(comma)}{value})*+\z"


def ends_open(comma: str, lazy: bool) -> str:
    """A line that ends inside a quoted value; any error in it ends its record, and the next line begins another."""
    value, inner = _value(comma, lazy)
    return rf"\A(?:{value}{re.escape(comma)})*+{inner}\z"


def states(after_out: np.ndarray, after_in: np.ndarray, start: bool) -> np.ndarray:
    """The state before each line and after the last, of lines given as maps of the states out (False) and in (True) of quotes."""
    after_out, after_in = np.asarray(after_out, bool), np.asarray(after_in, bool)
    fixed = np.where(after_out == after_in, np.arange(1, len(after_out) + 1), 0)
    last = np.maximum.accumulate(np.append(0, fixed))  # the last line up to here that gives one state whatever came before
    flips = np.append(0, np.cumsum(after_out & ~after_in))
    base = np.append(start, after_out)[last]
    return base ^ ((flips - flips[last]) % 2).astype(bool)


@dataclass(frozen=True)
class Edges:
    """For each file (by hash): where its parts with quotes begin, the state behind each, where the record that is open there began, and where one begins that is never closed."""

    files: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, int | None]]

    def before(self, file: int, block: int) -> tuple[bool, int | None]:
        begin, state, origin, _ = self.files.get(file, (np.zeros(0), None, None, None))
        k = int(np.searchsorted(begin, block)) - 1
        return (bool(state[k]), int(origin[k])) if k >= 0 and state[k] else (False, None)

    def crossed(self) -> list[int]:
        """Files in which a record is open behind some part with quotes, and so may go on in the next part."""
        return sorted(f for f, (_, state, _, _) in self.files.items() if state.any())

    def knows(self, file: int, block: int) -> bool:
        begin = self.files[file][0] if file in self.files else ()
        return len(begin) > 0 and begin[min(int(np.searchsorted(begin, block)), len(begin) - 1)] == block

    def unclosed(self, file: int) -> int | None:
        return self.files[file][3] if file in self.files else None


def _runs(file: np.ndarray, block: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(file):
        cut = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        yield from zip([0, *cut.tolist()], [*cut.tolist(), len(file)])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each part that has quotes: its states behind either start, whether a line opens a quote, whether an open one is closed."""
    now: list | None = None

    def row(r: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in r], names=["file", "block", "from_out", "from_in", "opens", "closes"])

    for b in batches:
        file, block, out, in_ = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        for x, y in _runs(file, block):
            if now is None or now[:2] != [int(file[x]), int(block[x])]:
                if now is not None:
                    yield row(now)
                now = [int(file[x]), int(block[x]), False, True, False, False]
            both = states(out[x:y], in_[x:y], False), states(out[x:y], in_[x:y], True)
            from_in = both[now[3]]
            now[4] = now[4] or bool(out[x:y].any())
            now[5] = now[5] or not from_in.all()
            now[2], now[3] = bool(both[now[2]][-1]), bool(from_in[-1])
    if now is not None:
        yield row(now)


def find_edges(lines: DataFrame, lazy: bool) -> Edges | None:
    """One scan of lines (file, block, value, out, in); None if no quoted value spans lines.  As many rows as there are parts with quotes reach the driver."""
    found = lines.filter(F.contains("value", F.lit('"'))).select("file", "block", "out", "in").mapInArrow(_scan, "file long, block long, from_out boolean, from_in boolean, opens boolean, closes boolean").collect()
    if not any(r["opens"] for r in found):
        return None
    parts: dict[int, list] = {}
    for r in sorted(found):
        parts.setdefault(r["file"], []).append(r)
    files = {}
    for file, rows in parts.items():
        state, origin, behind = False, -1, []
        for r in rows:
            inside = state
            state = r["from_in"] if inside else r["from_out"]
            if state and not (inside and not r["closes"]):
                origin = r["block"]
            behind.append((r["block"], state, origin))
        begin, after, origins = zip(*behind)
        files[file] = np.array(begin), np.array(after), np.array(origins), origin if state and not lazy else None
    return Edges(files)


def _cut(edges: Edges, has_header: bool, pieces: bool):
    """Records of each part, or of those open at an edge the pieces, with the part where they began."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, skip = None, False, False
        held: list[str] = []  # lines of an open record
        origin: int | None = None  # the part it began in, if another one
        out: list[tuple] = []
        place = 0  # of a record among those of its part

        def put(text: str, unclosed: bool = False, of: int | None = None) -> None:
            nonlocal skip, place
            place += of is None or of == at[1]
            if skip:
                skip = False
            elif pieces == (of is not None):
                out.append((text, unclosed, at[0], at[1] if of is None else of, at[1], place if of is None or of == at[1] else 0))

        def leave() -> None:
            """At a part's end an open record is a piece, unless none closes it: then its first line stands for it."""
            nonlocal held, origin
            if held:
                never = edges.unclosed(at[0])
                began = at[1] if origin is None else origin
                if never is None or never != began:
                    put("\n".join(held), of=began)
                elif origin is None:
                    put(held[0], unclosed=True)
            held, origin = [], None

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.bool_(), *[pa.int64()] * 4))], names=["value", "unclosed", "file", "origin", "block", "place"])
            out.clear()
            return made

        for b in batches:
            file, block, after_out, after_in = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            value = b.column(4)
            for x, y in _runs(file, block):
                here = int(file[x]), int(block[x])
                if at != here:
                    if at is not None:
                        leave()
                    at, skip, place = here, has_header and here[1] == 0, 0
                    state, origin = edges.before(*here)
                if not edges.knows(*here) and (after_out[x:y] | ~after_in[x:y]).any():
                    raise ValueError("a csv file is split in other places than when it was scanned; read it again with unchanged settings")
                before = states(after_out[x:y], after_in[x:y], state)
                state = bool(before[-1])
                lines = value.slice(x, y - x)
                blank = pc.equal(pc.utf8_trim_whitespace(lines), "").to_numpy(zero_copy_only=False)
                for line, inside, goes_on, empty in zip(lines.to_pylist(), before[:-1].tolist(), before[1:].tolist(), blank.tolist()):
                    if goes_on or inside:
                        held.append(line)
                        if not goes_on:
                            put("\n".join(held), of=origin)
                            held, origin = [], None
                    elif not empty:
                        put(line)
            if out:
                yield batch()
        if at is not None:
            leave()
        if out:
            yield batch()

    return run


def spanning_records(lines: DataFrame, edges: Edges, has_header: bool) -> DataFrame:
    """(value, unclosed, line): records without each file's first if that is a header; blank lines between records don't count.

    Where a record is open at the edge of a part, its file is read once more for the pieces, which are grouped.
    """
    schema = "value string, unclosed boolean, file long, origin long, block long, place long"
    cut = lambda rows, pieces: rows.select("file", "block", "out", "in", "value").mapInArrow(_cut(edges, has_header, pieces), schema)
    line = F.struct("file", F.col("origin").alias("block"), "place").alias("line")
    records = cut(lines, False).select("value", "unclosed", line)
    crossed = edges.crossed()
    if not crossed:
        return records
    pieces = cut(lines.filter(F.col("file").isin(crossed)) if len(crossed) <= 1000 else lines, True)
    joined = pieces.groupBy("file", "origin").agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("all"), F.max("place").alias("place"))
    return records.unionByName(joined.select(F.array_join("all.value", "\n").alias("value"), F.lit(False).alias("unclosed"), line))


def quoted_lines(spark: SparkSession, path: str, mend: Column, comma: str, lazy: bool) -> DataFrame:
    """(file, block, value, out, in): mended lines and whether each ends inside quotes, having begun outside or inside."""
    rows = spark.read.option("lineSep", "\n").text(path).select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), mend.alias("value"))
    has, end = F.contains("value", F.lit('"')), F.lit(ends_open(comma, lazy))
    return rows.select("*", (has & F.rlike("value", end)).alias("out"), (~has | F.rlike(F.concat(F.lit('"'), F.col("value")), end)).alias("in"))
