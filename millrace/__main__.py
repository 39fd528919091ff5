"""Command line: ``run`` a pipeline, ``probe`` a file, or one of the set tools on text files."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("run", help="run a pipeline specification")
    p.add_argument("--config", required=True)
    p.add_argument("--validate", action="store_true", help="lint only")
    p.add_argument("--metrics-backend", choices=("none", "pushgateway", "statsd"), default="none")
    p.add_argument("--pushgateway-url", default="")
    p.add_argument("--statsd-address", default="", help="host:port")
    p.add_argument("-v", action="store_true", help="print error buckets")
    p = sub.add_parser("probe", help="infer a specification")
    p.add_argument("--url", required=True)
    p.add_argument("--bytes", type=int, default=20_000)
    p.add_argument("--name", required=True)
    p.add_argument("--job", default="")
    p.add_argument("--backend", default="postgres")
    p.add_argument("--save", action="store_true")
    p.add_argument("--pretty", action="store_true")
    p.add_argument("--allow-insecure", action="store_true", help="don't check certificates")
    p = sub.add_parser("ids", help="different valid ids of a csv file's first column")
    p.add_argument("path")
    p.add_argument("out")
    p.add_argument("--max-id", type=int, default=150_000_000)
    p = sub.add_parser("keep", help="lines that hold a known id")
    p.add_argument("ids")
    p.add_argument("lines")
    p.add_argument("out")
    p.add_argument("--max-id", type=int, default=150_000_000)
    p = sub.add_parser("diff", help="lines of the second file that the first hasn't")
    p.add_argument("old")
    p.add_argument("new")
    p.add_argument("out")
    p = sub.add_parser("strip-html", help="clean lines between two markers")
    p.add_argument("path")
    p.add_argument("out")
    p.add_argument("--start", default="")
    p.add_argument("--end", default="")
    p = sub.add_parser("download", help="fetch a list of urls")
    p.add_argument("list")
    p.add_argument("folder")
    p.add_argument("--workers", type=int, default=4)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    from .operators import dedup, profile, sets
    from .plans import probe as probes
    from .plans import runner, spec
    from .sources import csv, http, text

    if args.command == "run":
        p = spec.Pipeline.load(args.config)
        issues = spec.lint(p)
        for i in issues:
            print(f"{i.severity}: {i.path}: {i.message}", file=sys.stderr)
        if any(i.severity == spec.ERROR for i in issues):
            return 1
        if args.validate:
            return 0
    spark = spark or SparkSession.builder.appName("millrace").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "run":
        done = runner.run(spark, p, args.pushgateway_url if args.metrics_backend == "pushgateway" else "", args.statsd_address if args.metrics_backend == "statsd" else "")
        print(json.dumps(done.counts))
        if args.v:
            profile.error_buckets(done.rejected, "reason", ("raw",)).show(50, truncate=False)
    elif args.command == "probe":
        sample = probes.sample_of(spark, args.url, args.bytes, verify=not args.allow_insecure)
        found = probes.probe_sample(spark, sample, args.name, job=args.job, backend=args.backend)
        if args.save:
            probes.save_sample(sample, args.name)
        print(json.dumps(found, ensure_ascii=False, indent=2 if args.pretty else None))
    elif args.command == "ids":
        fields = [f"f{i}" for i in range(5)]
        rows = csv.read_csv(spark, args.path, csv.CsvOptions(has_header=False, lazy_quotes=True), fields).select(F.col("f0").alias("id"), F.col("f4").alias("check"), F.monotonically_increasing_id().alias("line"))
        dedup.distinct_first(rows, "id", "check", ["line"], args.max_id).select("text").write.text(args.out)
    elif args.command == "keep":
        ids = sets.id_set(sets.parse_ids(spark.read.text(args.ids)), "id", args.max_id)
        sets.keep_known(spark.read.text(args.lines), ids).write.text(args.out)
    elif args.command == "diff":
        new = spark.read.text(args.new)
        head = new.head()
        if head is not None:
            # the header is the first part of the union and so of the output
            sets.snapshot_diff_files(new, spark.read.text(args.old), head["value"].rstrip("\r")).select("value").write.text(args.out)
    elif args.command == "strip-html":
        pages = spark.read.text(args.path, wholetext=True).withColumn("file", F.monotonically_increasing_id())
        profile.html_window(pages, "file", "value", args.start, args.end).orderBy("file", "pos").select("line").write.text(args.out)
    elif args.command == "download":
        for r in http.download(spark, text.read_list(spark, args.list), args.folder, workers=args.workers).toLocalIterator():
            print(json.dumps(r.asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
