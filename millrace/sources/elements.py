"""Records of JSON files, from files that are read in many parts and in bounded memory.

Spark's line reader cuts a file behind every ``}``.  What a piece means hangs
on whether it begins inside a string and how many brackets are open.  One scan
of the files that have several parts finds what each part does to both, the
driver composes these, and every part then cuts its own records: the objects
of a top-level array, or top-level objects.  Where an object at the top is
larger than a part, it is an envelope: another scan counts the objects in each
of its arrays, and the objects of the largest one are its records.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|[{}\[\]"]', re.S)
_REST = re.compile(r'(?:[^"\\]|\\.)*+"', re.S)
SEPARATORS = " \t\r\n,﻿"
Part = tuple[int, int]


def brackets(text: str, inside: bool) -> tuple[list[tuple[str, int, str]], bool]:
    """Brackets with their places, each with the last string before it in the piece, and whether the piece ends inside a string."""
    found, at, word = [], 0, ""
    if inside:
        m = _REST.match(text)
        if m is None:
            return [], True
        at = m.end()
    for m in _TOKEN.finditer(text, at):
        c = m[0]
        if c == '"':
            return found, True
        if len(c) > 1:
            word = c
        else:
            found.append((c, m.start(), word))
    return found, False


@dataclass
class Course:
    """What a part does, beginning outside or inside a string: by how much the open brackets grow and fall on the way, and the first bracket behind the last lowest point."""

    inside: bool
    up: int = 0
    fall: int = 0
    opener: str = ""

    def go(self, found: list[tuple[str, int, str]], inside: bool) -> None:
        for c, _, _ in found:
            if c in "{[":
                self.opener = c if self.up == -self.fall else self.opener
                self.up += 1
            else:
                self.up -= 1
                self.fall = max(self.fall, -self.up)
        self.inside = inside


@dataclass
class Start:
    """How a part begins: inside a string, open brackets, the outermost of them, the part where the open record began, the bytes before it, the open array's key."""

    inside: bool = False
    depth: int = 0
    outer: str = ""
    origin: int | None = None
    bytes: int = 0
    key: str | None = None


@dataclass
class Edges:
    """The starts of the parts of files that have several, and of those that are a large envelope the key of their records."""

    begin: dict[Part, Start] = field(default_factory=dict)
    envelopes: dict[int, str] = field(default_factory=dict)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Part, bool, int, str, int, bool]]:
    """(part, read alone, file's size, piece, its bytes, whether it is the part's last)."""
    held = None
    for b in batches:
        for file, block, single, size, value, n in zip(*(b.column(k).to_pylist() for k in range(6))):
            if held is not None:
                yield *held, held[0] != (file, block)
            held = ((file, block), single, size, value, n + 1)
    if held is not None:
        yield *held, True


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two rows for each part, for either start."""
    courses, total = [Course(False), Course(True)], 0
    for at, _, _, value, n, last in _by_part(batches):
        text, total = value + "}", total + n
        done = {s: brackets(text, s) for s in {c.inside for c in courses}}
        for c in courses:
            c.go(*done[c.inside])
        if last:
            cells = [(*at, bool(k), c.inside, c.up, c.fall, c.opener, total) for k, c in enumerate(courses)]
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*cells), kinds)], names=["file", "block", "start", "inside", "up", "fall", "opener", "bytes"])
            courses, total = [Course(False), Course(True)], 0


def _composed(rows: list, large: set[int], whole_bytes: int) -> tuple[dict[Part, Start], set[int]]:
    """The starts of all parts, and the files that hold an object which fills parts of more than ``whole_bytes`` together."""
    begin, found, filled = {}, set(), 0
    by_part: dict[Part, dict[bool, tuple]] = {}
    for r in rows:
        by_part.setdefault((r["file"], r["block"]), {})[r["start"]] = tuple(r)[3:]
    now, file = Start(), None
    for part in sorted(by_part):
        now, filled = (Start(), 0) if part[0] != file else (now, filled)
        begin[part], file = now, part[0]
        inside, up, fall, opener, n = by_part[part][now.inside]
        stays, depth = now.depth > fall, now.depth + up
        outer = now.outer if stays else opener
        filled = filled + n if stays and outer == "{" else 0
        if filled > whole_bytes:
            found.add(file)
        unit = _level(outer, file in large)
        origin = (now.origin if stays and now.depth - fall > unit else part[1]) if depth > unit else None
        now = Start(inside, depth, outer if depth else "", origin, now.bytes + n)
    return begin, found


def _level(outer: str, large: bool) -> int:
    """How many brackets are open where a record begins."""
    return 1 if outer == "[" else 2 if large else 0


_UNKNOWN = object()  # the key of an array that was opened in an earlier part


class Cutter:
    """Walks the pieces of one part after the other and collects its records, or those pieces of records that are open at its edges.

    A record's line is the byte it begins at, about: it grows along a file, by no less than there are records in one.
    """

    def __init__(self, edges: Edges, strict: bool = False, pieces: bool = False, counting: bool = False):
        self.edges, self.strict, self.pieces, self.counting = edges, strict, pieces, counting
        self.out: list[tuple] = []

    def begin(self, at: Part, single: bool) -> None:
        if not single and at not in self.edges.begin:
            raise ValueError("a file is split in other places than when it was scanned; read it again with unchanged settings")
        s = Start() if single else self.edges.begin[at]
        self.at, self.inside, self.depth, self.outer, self.origin, self.total = at, s.inside, s.depth, s.outer, s.origin, s.bytes
        self.large, self.chosen = at[0] in self.edges.envelopes, self.edges.envelopes.get(at[0])
        in_envelope = self.large and s.outer == "{"
        self.key = _UNKNOWN if self.counting and in_envelope and s.depth > 1 else s.key
        if in_envelope and self.key is None:
            self.origin = None
        self.unit = None if self.origin is None else _level(self.outer, self.large)  # brackets open outside the open record
        self.line = self.records = self.others = 0
        self.skipped, self.held, self.counts = False, [], {}

    def between(self) -> bool:
        """Whether what isn't a bracket is a value among records."""
        return self.unit is None and self.depth in (0, *((1,) if self.outer == "[" else ()), *((2,) if self.in_array() else ()))

    def in_array(self) -> bool:
        return self.large and self.outer == "{" and self.key is not None

    def alone(self, gap: str) -> None:
        """What stands between records must be separators, in an envelope also null; else it is a value that is no record."""
        if not gap.strip(SEPARATORS) or self.depth == 2 and not gap.replace("null", "").strip(SEPARATORS):
            return
        if self.depth == 0:
            raise ValueError("the JSON input holds no records")
        self.other()

    def other(self) -> None:
        self.others += 1
        if self.in_array():
            self.counts.setdefault(self.key, [0, 0])[1] += 1
        elif self.strict:
            raise ValueError("the JSON input holds no records")

    def piece(self, text: str) -> None:
        found, inside = brackets(text, self.inside)
        begin = gap = 0
        for c, place, word in found:
            if self.between():
                self.alone(text[gap:place])
            gap = place + 1
            if c in "{[":
                if self.depth == 0:
                    self.outer = c
                if self.unit is None and self.large and self.outer == "{" and self.depth == 1:
                    self.key = (json.loads(word) if word else "") if c == "[" else None
                elif self.unit is None and self.depth == _level(self.outer, self.large) and (self.depth < 2 or self.key is not None):
                    self.unit, self.origin, self.held, begin, self.skipped = self.depth, None, [], place, c == "["
                    if self.skipped:
                        self.other()
                    else:
                        self.line = self.total + place + 1
                        if self.in_array():
                            self.counts.setdefault(self.key, [0, 0])[0] += 1
                self.depth += 1
            else:
                self.depth -= 1
                if self.depth < 0:
                    raise ValueError("the JSON input closes what was never opened")
                if self.unit is not None and self.unit == self.depth:
                    self.put(text[begin : place + 1])
                    self.unit, self.origin, self.held, self.skipped = None, None, [], False
                if self.depth == 1 and self.outer == "{":
                    self.key = None
        if self.between() and not inside:
            self.alone(text[gap:])
        if self.unit is not None and not self.skipped:
            self.held.append(text[begin:])
        self.inside = inside

    def put(self, end: str, edge: bool = False) -> None:
        """A record's end, or with ``edge`` what the part has of a record that goes on."""
        here = self.origin is None
        self.records += not self.skipped and not edge
        if self.counting or self.skipped and not edge or self.pieces != (edge or not here) or self.in_array() and self.key != self.chosen:
            return
        text = "[" if self.skipped else "".join(self.held) + end  # what goes on in other parts is known by it as no record
        self.out.append((text, self.unit == 0, self.line if here else 0, self.at[0], self.at[1] if here else self.origin, self.at[1]))

    def leave(self, size: int) -> None:
        if self.total >= size and (self.depth or self.inside):
            raise ValueError("the JSON input ends inside a value")
        if self.at[1] == 0 and self.others and not self.records and not self.large:
            raise ValueError("the JSON input holds no records")
        if self.unit is not None:
            self.put("", edge=True)
        if self.counting:
            same = self.key is _UNKNOWN
            self.out = [(*self.at, None if k is _UNKNOWN else k, a, b, None if same else self.key, same) for k, (a, b) in (self.counts or {_UNKNOWN: (0, 0)}).items()]

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        at = None
        for part, single, size, value, n, last in _by_part(batches):
            if part != at:
                at = part
                self.begin(part, single)
            # behind the last piece of a file that doesn't end with the separator there is none (a byte-order mark isn't counted)
            bare = last and self.total + n - size in (1, -2)
            self.piece(value if bare else value + "}")
            self.total += n
            if last:
                self.leave(size)
            if self.out and (last or len(self.out) >= 1000):
                yield self.out
                self.out = []


def _counts(edges: Edges):
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in Cutter(edges, counting=True).run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["file", "block", "key", "objects", "others", "open", "same"])

    return run


def find_edges(parts: DataFrame, whole_bytes: int) -> Edges:
    """One scan of the files that have several parts, and another of those that are a large envelope; a few rows for each part reach the driver."""
    several = parts.filter("NOT single")
    rows = several.mapInArrow(_scan, "file long, block long, start boolean, inside boolean, up long, fall long, opener string, bytes long").collect()
    begin, large = _composed(rows, set(), whole_bytes)
    if not large:
        return Edges(begin)
    edges = Edges(_composed(rows, large, whole_bytes)[0], dict.fromkeys(large, ""))
    counted = several.filter(F.col("file").isin(sorted(large))).mapInArrow(_counts(edges), "file long, block long, key string, objects long, others long, open string, same boolean").collect()
    total: dict[int, dict[str, list[int]]] = {f: {} for f in large}
    behind: dict[int, str | None] = {}
    before: dict[Part, str | None] = {}
    for r in sorted(counted, key=lambda r: (r["file"], r["block"])):
        file, part = r["file"], (r["file"], r["block"])
        if part not in before:
            edges.begin[part].key = before[part] = behind.get(file)
        key = before[part] if r["key"] is None else r["key"]
        if key is not None:
            got = total[file].setdefault(key, [0, 0])
            got[0], got[1] = got[0] + r["objects"], got[1] + r["others"]
        behind[file] = before[part] if r["same"] else r["open"]
    for file, arrays in total.items():
        good = {k: n for k, (n, bad) in arrays.items() if n and not bad}
        if not good:
            raise ValueError(f"an object of more than {whole_bytes} bytes holds no array of records")
        edges.envelopes[file] = min(good, key=lambda k: (-good[k], k))
    return edges


def parts_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, single, size, value, n): pieces of files in their order, with their bytes."""
    m = F.col("_metadata")
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(F.xxhash64(m.file_path).alias("file"), m.file_block_start.alias("block"), (m.file_block_length >= m.file_size).alias("single"), m.file_size.alias("size"), "value", F.octet_length("value").alias("n"))


def crossed(edges: Edges) -> list[int]:
    """Files in which a record is open at an edge of parts."""
    return sorted({part[0] for part, s in edges.begin.items() if s.origin is not None})
