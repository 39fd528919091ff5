"""Runs a declared pipeline as one plan: read, project, transform, split, write, count."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import contract_kind, contract_reason, require, stream_reason
from ..functions.coerce import CZ, KINDS, Coercion, prepared, quoted, where
from ..functions.text import normalize
from ..operators.dedup import KEEP_LAST, dedup
from ..operators.sets import project, realign
from ..sinks.ddl import infer_table
from ..sinks.metrics import Metrics
from ..sinks.statsd import Statsd
from ..sinks.writers import writer
from ..sources.csv import ERROR, CsvOptions, read_csv
from ..sources.json import read_json
from ..sources.xml import XmlOptions, read_xml
from .spec import ERROR as SEVERE
from .spec import Pipeline, Step, lint

LINE = "_line"


@dataclass
class Run:
    """What a pipeline gives.  ``rows``: all, with stage and reason; ``rejected``: columns as text, stage, reason."""

    accepted: DataFrame
    rejected: DataFrame
    rows: DataFrame
    counts: dict[str, int] = field(default_factory=dict)
    metrics: Metrics = field(default_factory=Metrics)


def chain(*steps: Callable[[DataFrame], DataFrame] | None) -> Callable[[DataFrame], DataFrame]:
    """Steps in order; None is skipped."""
    return lambda df: reduce(lambda d, f: d.transform(f), filter(None, steps), df)


def read(spark: SparkSession, p: Pipeline) -> DataFrame:
    """The source's declared columns as text, ``_line`` for its order and ``_parse_error``."""
    if p.source_kind != "file":
        raise ValueError(f"no source of kind {p.source_kind!r}")
    o, columns = p.parser.options, list(p.storage.columns)
    if p.parser.kind == "csv":
        options = CsvOptions(o.boolean("has_header", True), o.character("comma"), o.boolean("trim_space", True), o.integer("expected_fields"), max(0, o.integer("fields_per_record")), o.string_map("header_map"), o.boolean("lazy_quotes"), o.boolean("stream_scrub_likvidaci"))
        return read_csv(spark, p.path, options, columns, line=True)
    if p.parser.kind == "json":
        df = read_json(spark, p.path, columns, o.string_map("header_map"))
    elif p.parser.kind == "xml":
        df = read_xml(spark, p.path, XmlOptions(o.string("record_tag"), o.string_map("fields"), o.string_map("lists"), o.string("encoding", "UTF-8")), columns)
    else:
        raise ValueError(f"no parser of kind {p.parser.kind!r}")
    return df if ERROR in df.columns else df.withColumn(ERROR, F.lit(None).cast("string"))


def _plan(p: Pipeline, s: Step) -> dict[str, Coercion]:
    contract = {f.name: f for f in p.contract()}
    out = {}
    for name, kind in s.options.string_map("types").items():
        f = contract.get(name)
        layout = (f.layout if f else "") or s.options.string("layout", CZ)
        out[name] = Coercion(KINDS.get(kind.lower(), "text"), layout, f.truthy if f else (), f.falsy if f else ())
    return out


def transform(p: Pipeline, df: DataFrame) -> DataFrame:
    """All steps in order, with ``_stage`` and ``_reason`` of rejected rows; a rejected row keeps its values and skips later steps."""
    columns = [c for c in df.columns if c not in (LINE, ERROR)]
    unknown = [n for s in p.transform if s.kind == "coerce" for n in s.options.string_map("types") if n not in columns]
    if unknown:
        raise ValueError(f"coerced but not declared: {', '.join(unknown)}")
    raw = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])) if columns else F.lit("{}")
    state = ["_raw", LINE, "_stage", "_reason"]
    df = df.withColumn("_raw", raw).withColumn("_stage", F.when(F.col(ERROR).isNotNull(), "parse")).withColumnRenamed(ERROR, "_reason").select(*columns, *state)

    def reject(df: DataFrame, stage: str, reason) -> DataFrame:
        fresh = F.col("_reason").isNull() & reason.isNotNull()
        return df.withColumns({"_stage": F.when(fresh, stage).otherwise(F.col("_stage")), "_reason": F.coalesce("_reason", reason)})

    for s in p.transform:
        o = s.options
        if s.kind == "normalize":
            df = df.withColumns({c: normalize(F.col(f"`{c}`")) for c, t in df.dtypes if t == "string" and c in columns})
        elif s.kind == "coerce":
            anchor = o.get("realign") or o.get("anchor")
            if isinstance(anchor, dict) and anchor.get("field") in columns:
                df = realign(df, anchor["field"], anchor.get("value", ""), columns)
            df = _coerced(df, columns, _plan(p, s), reject)
        elif s.kind == "validate":
            fields = p.contract()
            reason = contract_reason(df.select(*columns), fields, o.string("date_layout", CZ))
            df = reject(df, "validate", reason)
        elif s.kind == "require":
            fields = o.strings("fields")
            bad = F.lit(any(f not in columns for f in fields))
            for f in fields:
                if f in columns:
                    bad = bad | F.col(f"`{f}`").isNull() | (F.col(f"`{f}`").cast("string") == "")
            df = reject(df, "require", F.when(bad, "required field empty"))
        elif s.kind in ("dedup", "dedupe"):
            good = dedup(where(df, F.col("_reason").isNull()), o.strings("keys") or list(p.storage.key_columns), o.string("policy", KEEP_LAST), (LINE,), o.strings("prefer_fields"))
            df = good.unionByName(where(df, F.col("_reason").isNotNull()))
        else:
            raise ValueError(f"no transform of kind {s.kind!r}")
    return df


def _coerced(df: DataFrame, columns: list[str], plan: dict[str, Coercion], reject: Callable) -> DataFrame:
    """Types the text columns, a projection for each step, and rejects rows with a value that can't be typed."""
    texts = [c for c, t in df.dtypes if t == "string" and c in columns]
    typed = [c for c in texts if plan.get(c, Coercion()).kind != "text"]
    df = df.withColumns({c: prepared(F.col(f"`{c}`")) for c in texts})
    df = df.withColumns({f"_typed {c}": plan[c].apply(F.col(f"`{c}`")) for c in typed})
    reasons = [F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`_typed {c}`").isNull(), F.concat(F.lit(f'field "{c}": cannot coerce '), quoted(F.col(f"`{c}`")))) for c in typed]
    if reasons:
        df = reject(df.withColumn("_why", F.coalesce(*reasons)), "coerce", F.col("_why")).drop("_why")
    return df.withColumns({c: F.col(f"`_typed {c}`") for c in typed}).drop(*[f"_typed {c}" for c in typed])


def plan(spark: SparkSession, p: Pipeline) -> Run:
    """The accepted and rejected rows, lazily."""
    issues = [i for i in lint(p) if i.severity == SEVERE]
    if issues:
        raise ValueError("; ".join(f"{i.path}: {i.message}" for i in issues))
    done = transform(p, read(spark, p))
    accepted = project(where(done, F.col("_reason").isNull()), p.storage.columns)
    rejected = where(done, F.col("_reason").isNotNull()).select(F.col("_raw").alias("raw"), F.col("_stage").alias("stage"), F.col("_reason").alias("reason"))
    return Run(accepted, rejected, done)


@contextmanager
def _reading(spark: SparkSession, p: Pipeline) -> Iterator[None]:
    """Reads in as many parts at least as the readers and transformers that the specification or the environment asks for."""
    parts, name = max(p.given("reader_workers"), p.given("transform_workers")), "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    if parts:
        spark.conf.set(name, str(parts))
    try:
        yield
    finally:
        if parts and before is None:
            spark.conf.unset(name)
        elif parts:
            spark.conf.set(name, before)


def run(spark: SparkSession, p: Pipeline, gateway: str = "", statsd: str = "") -> Run:
    """Plans, writes and counts.  Errors are raised; counts come from an observation of the run that writes.

    Of the runtime settings, readers and transformers give the least number of
    parts to read in, loaders (if given) the tasks that write at once, and the batch size that of inserts; Spark has no
    channel to set a buffer for.  Metrics go to a push gateway and, as datagrams, to a statsd agent (host:port), where given.
    """
    metrics = Metrics(p.job)
    with metrics.step("plan"):
        with _reading(spark, p):
            out = plan(spark, p)
    seen = Observation("rows")
    count = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))
    of = lambda stage: count(F.col("_stage") == stage)
    observed = out.rows.observe(seen, F.count(F.lit(1)).alias("seen"), of("parse").alias("parse_errors"), of("coerce").alias("transform_rejected"), (of("validate") + of("require")).alias("validate_dropped"), count(F.col("_reason").isNull()).alias("inserted"))
    accepted = project(where(observed, F.col("_reason").isNull()), p.storage.columns)
    s = p.storage
    ddl = infer_table(s.table, s.columns, s.kind if s.kind in ("postgres", "mssql", "sqlite", "mysql") else "generic", p.contract(), p.types()) if s.auto_create_table else None
    with metrics.step("load"), _reading(spark, p):
        batches = writer(s.kind)(accepted.coalesce(p.given("loader_workers")) if p.given("loader_workers") else accepted, s.dsn, s.table, p.setting("batch_size"), ddl, **({"keys": s.key_columns} if s.upsert else {}))
    got = dict(seen.get)
    counts = {"processed": got.pop("seen"), **got}
    counts["transform_dropped"] = counts["processed"] - counts["parse_errors"] - counts["validate_dropped"] - counts["inserted"]
    counts["batches"] = batches or -(-counts["inserted"] // p.setting("batch_size"))
    for k, v in counts.items():
        if k != "batches":
            metrics.records(k, v)
    metrics.batches(counts["batches"])
    if gateway:
        metrics.push(gateway)
    if statsd:
        Statsd(statsd).push(metrics)
    return Run(out.accepted, out.rejected, out.rows, counts, metrics)


def stream_verdict(df: DataFrame, required: list[str], kinds: dict[str, str]) -> DataFrame:
    """Rows with the reason for which the live check would drop them, else null."""
    return df.withColumn("_reason", stream_reason(df, required, {k: contract_kind(v) for k, v in kinds.items()}))


__all__ = ["Run", "chain", "plan", "read", "require", "run", "stream_verdict", "transform"]
