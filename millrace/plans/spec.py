"""Pipeline specifications, their options, and the lint."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from ..functions.checks import Field

ERROR, WARNING = "error", "warning"


class Options(dict):
    """Options with typed getters; a value of another type gives the default."""

    def string(self, key: str, default: str = "") -> str:
        v = self.get(key)
        return v if isinstance(v, str) else default

    def boolean(self, key: str, default: bool = False) -> bool:
        v = self.get(key)
        return v if isinstance(v, bool) else default

    def integer(self, key: str, default: int = 0) -> int:
        v = self.get(key)
        return int(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else default

    def character(self, key: str, default: str = ",") -> str:
        return self.string(key)[:1] or default

    def strings(self, key: str) -> list[str]:
        v = self.get(key)
        return [x for x in v if isinstance(x, str)] if isinstance(v, list) else []

    def string_map(self, key: str) -> dict[str, str]:
        v = self.get(key)
        return {k: x for k, x in v.items() if isinstance(x, str)} if isinstance(v, dict) else {}


@dataclass(frozen=True)
class Step:
    kind: str = ""
    options: Options = field(default_factory=Options)


@dataclass(frozen=True)
class Storage:
    kind: str = ""
    dsn: str = ""
    table: str = ""
    columns: tuple[str, ...] = ()
    key_columns: tuple[str, ...] = ()
    date_column: str = ""
    auto_create_table: bool = False
    upsert: bool = False


#: Runtime settings: environment variable and default of each; fixed values.
RUNTIME = {
    "reader_workers": ("ETL_READER_WORKERS", 1),
    "transform_workers": ("ETL_TRANSFORM_WORKERS", 4),
    "loader_workers": ("ETL_LOADER_WORKERS", 1),
    "batch_size": ("ETL_BATCH_SIZE", 10_000),
    "channel_buffer": ("ETL_CH_BUFFER", 4096),
}


@dataclass(frozen=True)
class Pipeline:
    job: str = ""
    source_kind: str = ""
    path: str = ""
    parser: Step = Step()
    transform: tuple[Step, ...] = ()
    storage: Storage = Storage()
    runtime: dict[str, int] = field(default_factory=dict)

    @staticmethod
    def of(d: dict[str, Any]) -> "Pipeline":
        """From a decoded specification; absent parts are empty."""
        part = lambda *keys: _dig(d, *keys) or {}
        step = lambda x: Step(x.get("kind") or "", Options(x.get("options") or {}))
        db = part("storage", "db")
        return Pipeline(
            d.get("job") or "",
            part("source").get("kind") or "",
            part("source", "file").get("path") or "",
            step(part("parser")),
            tuple(step(x) for x in d.get("transform") or ()),
            Storage(part("storage").get("kind") or "", db.get("dsn") or "", db.get("table") or "", tuple(db.get("columns") or ()), tuple(db.get("key_columns") or ()), db.get("date_column") or "", bool(db.get("auto_create_table")), bool(db.get("upsert"))),
            {k: int(v) for k, v in part("runtime").items() if isinstance(v, (int, float))},
        )

    @staticmethod
    def load(path: str) -> "Pipeline":
        with open(path, encoding="utf-8") as f:
            return Pipeline.of(json.load(f))

    def given(self, name: str) -> int:
        """The specification's value if positive, else the environment's, else 0."""
        if self.runtime.get(name, 0) > 0:
            return self.runtime[name]
        try:
            return max(0, int(os.environ[RUNTIME[name][0]]))
        except (KeyError, ValueError):
            return 0

    def setting(self, name: str) -> int:
        """The given value, else the default."""
        return self.given(name) or RUNTIME[name][1]

    def contract(self) -> list[Field]:
        """Fields of the first contract in the chain."""
        for s in self.transform:
            if s.kind == "validate" and isinstance(s.options.get("contract"), dict):
                return [Field.of(f) for f in s.options["contract"].get("fields") or ()]
        return []

    def types(self) -> dict[str, str]:
        """Type names by column: those of all coercions, overlaid by the contract's."""
        out: dict[str, str] = {}
        for s in self.transform:
            if s.kind == "coerce":
                out |= s.options.string_map("types")
        return out | {f.name: f.type for f in self.contract() if f.type}


def _dig(d: Any, *keys: str) -> Any:
    for k in keys:
        d = d.get(k) if isinstance(d, dict) else None
    return d


@dataclass(frozen=True)
class Issue:
    severity: str
    path: str
    message: str


def _kind(path: str, value: str, known: tuple[str, ...]) -> list[Issue]:
    if not value.strip():
        return [Issue(ERROR, path, f"{path} must not be empty")]
    return [] if value in known else [Issue(WARNING, path, f"unknown kind {value!r}: an implementation must be registered")]


def _lint_source(p: Pipeline) -> list[Issue]:
    out = _kind("source.kind", p.source_kind, ("file",))
    if p.source_kind == "file" and not p.path.strip():
        out.append(Issue(ERROR, "source.file.path", "a file source needs a path"))
    return out


def _lint_parser(p: Pipeline) -> list[Issue]:
    out = _kind("parser.kind", p.parser.kind, ("csv", "xml", "json"))
    if p.parser.kind == "csv" and not p.parser.options.integer("expected_fields") and p.parser.options.get("header_map") is None:
        out.append(Issue(WARNING, "parser.options", "neither expected_fields nor header_map constrain the csv input"))
    return out


def _lint_transform(p: Pipeline) -> list[Issue]:
    if not p.transform:
        return [Issue(WARNING, "transform", "no transforms: parsed records are written as they are")]
    out = []
    for i, s in enumerate(p.transform):
        out += _kind(f"transform[{i}].kind", s.kind, ("normalize", "coerce", "dedup", "dedupe", "require", "validate"))
        if s.kind != "validate":
            continue
        where, contract = f"transform[{i}].options.contract", s.options.get("contract")
        if contract is None:
            out.append(Issue(WARNING, where, "without a contract nothing is enforced"))
        elif not isinstance(contract, dict) or not isinstance(contract.get("fields") or [], list) or not all(isinstance(f, dict) for f in contract.get("fields") or []):
            out.append(Issue(ERROR, where, "this is not a contract"))
        elif not contract.get("fields"):
            out.append(Issue(WARNING, where, "a contract without fields enforces nothing"))
    return out


def _lint_storage(p: Pipeline) -> list[Issue]:
    s = p.storage
    out = _kind("storage.kind", s.kind, ("postgres", "mysql", "mssql", "sqlite", "parquet", "json", "table", "text", "none"))
    if not s.kind.strip():
        return out
    out += [Issue(ERROR, f"storage.db.{k}", f"{k} must not be empty") for k, v in (("dsn", s.dsn.strip()), ("table", s.table.strip()), ("columns", s.columns)) if not v]
    if s.auto_create_table and not s.columns:
        out.append(Issue(ERROR, "storage.db.auto_create_table", "a table can't be created without columns"))
    return out


def _lint_runtime(p: Pipeline) -> list[Issue]:
    out = [Issue(WARNING, "runtime.batch_size", "the batch size isn't positive")] if p.runtime.get("batch_size", 0) <= 0 else []
    return out + [Issue(ERROR, f"runtime.{k}", f"{k} must not be negative") for k in ("reader_workers", "transform_workers", "loader_workers", "channel_buffer") if p.runtime.get(k, 0) < 0]


RULES: tuple[Callable[[Pipeline], list[Issue]], ...] = (_lint_source, _lint_parser, _lint_transform, _lint_storage, _lint_runtime)


def lint(p: Pipeline) -> list[Issue]:
    """All issues, in the order of the specification's parts."""
    out = [] if p.job.strip() else [Issue(ERROR, "job", "job must not be empty: it labels metrics and runs")]
    return out + [i for rule in RULES for i in rule(p)]
