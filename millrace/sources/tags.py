"""Records of XML files by their element's name, from files that are read in many parts, and their fields.

Spark's line reader cuts a file behind every ``NAME>``.  What a piece means
hangs on whether it begins in a comment, a CDATA section, a processing
instruction or a quoted attribute of a record's own tag, and on how many
elements of the name are open.  A part of a file is a map of all that; one
scan finds the maps of the parts of large files, the driver composes them, and
every part then cuts its own outermost records.  A record open at an edge of
parts is put together from at most one piece of each part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT, COMMENT, CDATA, INSTRUCTION, TAG, DOUBLE, SINGLE = range(7)
_ENDS = {COMMENT: "-->", CDATA: "]]>", INSTRUCTION: "?>", DOUBLE: '"', SINGLE: "'"}
_BEGINS = {"<!--": COMMENT, "<![CDATA[": CDATA, "<?": INSTRUCTION}
_IN_TAG = re.compile("[>\"']")


def marks(tag: str) -> re.Pattern:
    """Where something begins that decides about records: a tag of the local name, or what may hide one."""
    return re.compile(rf"<!--|<!\[CDATA\[|<\?|<(/?)(?:[^\s<>/:=\"']+:)?{re.escape(tag)}(?=[\s/>])")


def walk(text: str, state: int, mark: re.Pattern) -> tuple[list[tuple[int, int]], int]:
    """The record tags of a piece, as (1, where it begins) or (-1, behind its end), and the state at the end."""
    found, at = [], 0
    while True:
        if state == TEXT:
            m = mark.search(text, at)
            if m is None:
                return found, TEXT
            at = m.end()
            if m[0] in _BEGINS:
                state = _BEGINS[m[0]]
            elif m[1]:
                end = text.find(">", at)
                if end < 0:
                    return found, TEXT
                at = end + 1
                found.append((-1, at))
            else:
                found.append((1, m.start()))
                state = TAG
        elif state == TAG:
            m = _IN_TAG.search(text, at)
            if m is None:
                return found, TAG
            at = m.end()
            if m[0] == ">":
                if text[at - 2 : at - 1] == "/":
                    found.append((-1, at))
                state = TEXT
            else:
                state = DOUBLE if m[0] == '"' else SINGLE
        else:
            end = text.find(_ENDS[state], at)
            if end < 0:
                return found, state
            at = end + len(_ENDS[state])
            state = TAG if state in (DOUBLE, SINGLE) else TEXT


@dataclass
class Course:
    """What a part does from one state: the state behind it, and to the number of open elements: ``max(d + up, least)``, falling by up to ``fall`` on the way."""

    state: int
    up: int = 0
    least: int = 0
    fall: int = 0

    def go(self, tags: list[tuple[int, int]], state: int) -> None:
        for k, _ in tags:
            self.fall = max(self.fall, -(self.up + k))
            self.up, self.least = self.up + k, max(self.least + k, 0)
        self.state = state


def _scan(mark: re.Pattern, separator: str):
    """One row for each part and state it may begin in; pieces are walked once for each state that is still different."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        courses: list[Course] = []

        def rows() -> pa.RecordBatch:
            cells = [(at[0], at[1], k, c.state, c.up, c.least, c.fall) for k, c in enumerate(courses)]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*cells)], names=["file", "block", "start", "state", "up", "least", "fall"])

        for b in batches:
            for file, block, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if at != (file, block):
                    if at is not None:
                        yield rows()
                    at, courses = (file, block), [Course(s) for s in range(7)]
                done: dict[int, tuple[list, int]] = {}
                text = value + separator
                for c in courses:
                    if c.state not in done:
                        done[c.state] = walk(text, c.state, mark)
                    c.go(*done[c.state])
        if at is not None:
            yield rows()

    return run


@dataclass(frozen=True)
class Edges:
    """For each part of a large file: the state and number of open elements it begins with, the part where the open record began; and for each such file where a record begins that nothing closes."""

    begin: dict[tuple[int, int], tuple[int, int, int | None]]
    unclosed: dict[int, int]


def find_edges(parts: DataFrame, mark: re.Pattern, separator: str) -> Edges:
    """One scan of the parts (file, block, value) of files that have several; seven small rows for each reach the driver."""
    found = parts.filter("NOT single").select("file", "block", "value").mapInArrow(_scan(mark, separator), "file long, block long, start long, state long, up long, least long, fall long").collect()
    by_part: dict[tuple[int, int], dict[int, tuple]] = {}
    for r in found:
        by_part.setdefault((r["file"], r["block"]), {})[r["start"]] = tuple(r)[3:]
    begin: dict = {}
    unclosed: dict[int, int] = {}
    last, state, depth, origin = None, TEXT, 0, None
    for key in sorted(by_part):
        if key[0] != last:
            last, state, depth, origin = key[0], TEXT, 0, None
        begin[key] = state, depth, origin
        after, up, least, fall = by_part[key][state]
        ends = max(depth + up, least)
        if ends and not (depth and depth - fall > 0):
            origin = key[1]
        state, depth, origin = after, ends, origin if ends else None
        unclosed.pop(last, None)
        if depth:
            unclosed[last] = origin
    return Edges(begin, unclosed)


def cut(edges: Edges, mark: re.Pattern, separator: str, pieces: bool):
    """(value, line, file, origin, block, error) of the outermost records of each part, or of those open at an edge the pieces.

    ``line`` is the part's first byte plus the record's number in it: it grows along a file, since a record has several bytes.
    A record that nothing closes has an error instead of a text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        state, depth, origin, number, known, last = TEXT, 0, None, 0, True, True
        held: list[str] = []
        out: list[tuple] = []

        def put(text: str, of: int | None, line: int, error: str | None = None) -> None:
            if pieces == (of is not None):
                out.append((text, line, at[0], of, at[1], error))

        def leave() -> None:
            if depth:
                never = at[1] if last else edges.unclosed.get(at[0])
                began = at[1] if origin is None else origin
                if never != began:
                    put("".join(held), began, at[1] + number if origin is None else 0)
                elif origin is None:
                    put("", None, at[1] + number, "the record is never closed")

        def batch() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["value", "line", "file", "origin", "block", "error"])
            out.clear()
            return made

        for b in batches:
            for file, block, value, single in zip(*(b.column(k).to_pylist() for k in range(4))):
                if at != (file, block):
                    if at is not None:
                        leave()
                    at, held, number, last = (file, block), [], 0, single
                    if not single and at not in edges.begin:
                        raise ValueError("a file is split in other places than when it was scanned; read it again with unchanged settings")
                    state, depth, origin = (TEXT, 0, None) if single else edges.begin[at]
                text = value + separator
                tags, state = walk(text, state, mark)
                begin = 0
                for k, place in tags:
                    if k > 0 and depth == 0:
                        begin, number, origin, held = place, number + 1, None, []
                    open_, depth = depth, max(0, depth + k)
                    if open_ and not depth:
                        put("".join(held) + text[begin:place], origin, at[1] + number if origin is None else 0)
                        held, origin, begin = [], None, place
                if depth:
                    held.append(text[begin:])
            if out:
                yield batch()
        if at is not None:
            leave()
        if out:
            yield batch()

    return run


def shards(text: str, tag: str) -> Iterator[str]:
    """Each outermost element of the name in a whole text; a truncated last one is left out."""
    depth = begin = 0
    for k, place in walk(text, TEXT, marks(tag))[0]:
        begin = place if k > 0 and not depth else begin
        open_, depth = depth, max(0, depth + k)
        if open_ and not depth:
            yield text[begin:place]


def parts_of(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, value, single): pieces of files in their order; ``single``: the file is read in one part."""
    m = F.col("_metadata")
    rows = spark.read.option("lineSep", separator).text(path)
    return rows.select(F.xxhash64(m.file_path).alias("file"), m.file_block_start.alias("block"), "value", (m.file_block_length >= m.file_size).alias("single"))


def records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """(value, line, error): each outermost element of the local name, under any prefix, as text."""
    mark, separator = marks(tag), f"{tag}>"
    parts = parts_of(spark, path, separator)
    edges = find_edges(parts, mark, separator)
    schema = "value string, line long, file long, origin long, block long, error string"
    of = lambda rows, pieces: rows.select("file", "block", "value", "single").mapInArrow(cut(edges, mark, separator, pieces), schema)
    found = of(parts, False).select("value", "line", "error")
    crossed = sorted({key[0] for key, (_, depth, _) in edges.begin.items() if depth})
    if not crossed:
        return found
    some = parts.filter("NOT single")
    pieces = of(some.filter(F.col("file").isin(crossed)) if len(crossed) <= 1000 else some, True)
    joined = pieces.groupBy("file", "origin").agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("all"), F.max("line").alias("line"))
    return found.unionByName(joined.select(F.array_join("all.value", "").alias("value"), "line", F.lit(None).cast("string").alias("error")))


# ---- one record -------------------------------------------------------------

_TOKEN = re.compile(r"<!--.*?-->|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<\?.*?\?>|<![A-Za-z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|<(?P<end>/?)(?P<name>[^\s<>/=\"'!?&]+)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*?)(?P<empty>/?)>|<", re.S)
_ATTR = re.compile(r"([^\s=<>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_ENTITY = re.compile(r"&(?:(lt|gt|amp|quot|apos)|#([0-9]{1,7})|#x([0-9A-Fa-f]{1,6}));")
#: The entities that every XML reader knows; fixed values.
_NAMED = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}


def decoded(text: str) -> str:
    """Known entities and character references as characters; anything else behind an ``&`` stays as it is."""

    def one(m: re.Match) -> str:
        code = int(m[2]) if m[2] else int(m[3], 16) if m[3] else -1
        return _NAMED[m[1]] if m[1] else chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else m[0]

    return _ENTITY.sub(one, text) if "&" in text else text


def local(name: str) -> str:
    return name.rsplit(":", 1)[-1]


def attributes(text: str) -> dict[str, str]:
    """By local name; values may be unquoted or absent."""
    return {local(m[1]): decoded(next((g for g in m.groups()[1:] if g is not None), "")) for m in _ATTR.finditer(text)}


class Malformed(ValueError):
    """A record that even a lenient reader can't read."""


def nodes(text: str) -> Iterator[tuple[str, tuple[str, ...], str]]:
    """A record as ("open", path, attributes as written), ("text", path, characters), ("close", path, "").

    Names are local.  An end tag closes what is open inside its element; one that no open element has is an error.
    """
    path: tuple[str, ...] = ()
    at = 0
    for m in _TOKEN.finditer(text):
        if m.start() > at:
            yield "text", path, decoded(text[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            yield "text", path, m["cdata"]
        elif m["name"] and not m["end"]:
            path = (*path, local(m["name"]))
            yield "open", path, m["attrs"]
            if m["empty"]:
                yield "close", path, ""
                path = path[:-1]
        elif m["name"]:
            name = local(m["name"])
            if name not in path:
                raise Malformed(f"unexpected end element </{m['name']}>")
            while True:
                yield "close", path, ""
                path, closed = path[:-1], path[-1]
                if closed == name:
                    break
        elif m[0] == "<":
            raise Malformed("expected an element's name after <")
        if not path and at > 0 and m["name"]:
            return
