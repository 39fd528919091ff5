"""Set-style operators: snapshot differences, id sets, keyed upserts, realignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import extract_ints, strip_line_end


def snapshot_diff(new: DataFrame, old: DataFrame, col: str = "value") -> DataFrame:
    """Lines of ``new`` that ``old`` hasn't, repeated ones included; blank lines and final carriage returns are dropped.

    A left anti join, so Spark picks broadcast or sort-merge by size.
    """
    line = strip_line_end(F.col(col)).alias(col)
    return new.select(line).filter(F.col(col) != "").join(old.select(line).distinct(), col, "left_anti")


def snapshot_diff_files(new: DataFrame, old: DataFrame, header: str, col: str = "value") -> DataFrame:
    """``snapshot_diff`` of files whose first line is ``header``: it comes first, flagged, whatever the old file has."""
    body = snapshot_diff(new.filter(strip_line_end(F.col(col)) != header), old, col)
    first = new.sparkSession.createDataFrame([(header, True)], f"{col} string, is_header boolean")
    return first.unionByName(body.withColumn("is_header", F.lit(False)))


def id_set(df: DataFrame, col: str, max_id: int) -> DataFrame:
    """Different ids that a bitmap for ``max_id`` holds: from 0, below the next multiple of 64."""
    limit = 64 * -(-max_id // 64)
    return df.select(F.col(col).cast("bigint").alias("id")).filter(F.col("id").between(0, limit - 1)).distinct()


def id_bitmaps(ids: DataFrame) -> DataFrame:
    """The set as bitmaps of 32 768 bits: (bucket, bitmap, n), one row for each bucket with ids."""
    grouped = ids.groupBy(F.bitmap_bucket_number("id").alias("bucket"))
    return grouped.agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap")).withColumn("n", F.bitmap_count("bitmap"))


def keep_known(lines: DataFrame, ids: DataFrame, col: str = "value", id_col: str = "id") -> DataFrame:
    """Lines with an integer of the id set in them, each once for each time it stands in ``lines``.

    The integers are joined by equality, so a line's cost is its digits, not
    the set; Spark broadcasts the ids if their size allows.
    """
    found = lines.select(F.monotonically_increasing_id().alias("_row"), F.col(col)).withColumn("_int", F.explode(F.array_distinct(extract_ints(F.col(col)))))
    ids = ids.select(F.col(id_col).cast("bigint").alias("_int")).distinct()
    kept = found.join(ids, "_int", "left_semi")
    return kept.groupBy("_row").agg(F.first(col).alias(col)).select(col)


def parse_ids(lines: DataFrame, col: str = "value") -> DataFrame:
    """Ids from lines that hold one integer each, untrimmed; others are skipped."""
    return lines.select(F.when(F.rlike(F.col(col), F.lit(r"\A[+-]?[0-9]+\z")), F.col(col).try_cast("bigint")).alias("id")).filter("id is not null")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target whose key the source hasn't, and all rows of the source."""
    keys_of = source.select(*keys).distinct()
    return target.join(keys_of, list(keys), "left_anti").select(*target.columns).unionByName(source, allowMissingColumns=True)


def union_streams(*parts: DataFrame) -> DataFrame:
    """All records of several streams; fields that one lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def realign(df: DataFrame, field: str, value: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Shifts the tail of a row left when ``value`` stands right of ``field`` instead of in it.

    From ``field`` on, columns are those from the value's first place on, then
    nulls.  Rows where it is in place, to the left or missing stay as they are.  The ``columns`` (all by default) are
    taken as text; others are carried behind them.
    """
    names = list(columns or df.columns)
    rest, k, n = [c for c in df.columns if c not in names], names.index(field), len(names)
    # a projection for each step, so no expression is repeated for each column
    rows = df.select(F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in rest]).alias("rest"), F.array(*[F.col(f"`{c}`").cast("string") for c in names]).alias("a"))
    rows = rows.withColumn("at", F.coalesce(F.array_position("a", F.lit(value)), F.lit(0)).cast("int"))
    tail = F.concat(F.slice("a", 1, k) if k else F.array().cast("array<string>"), F.slice("a", F.greatest("at", F.lit(1)), n), F.array_repeat(F.lit(None).cast("string"), F.greatest(F.col("at") - k - 1, F.lit(0))))
    moved = F.when((F.col("at") > k + 1) & ~F.coalesce(F.get("a", F.lit(k)) == value, F.lit(False)), tail).otherwise(F.col("a"))
    return rows.select("rest", moved.alias("a")).select(*[F.get("a", F.lit(i)).alias(c) for i, c in enumerate(names)], *[F.col(f"rest.`{c}`") for c in rest])


def fit_width(a: Column, width: int) -> Column:
    """An array cut or padded with '' to a width."""
    return F.concat(F.slice(a, 1, width), F.array_repeat(F.lit(""), F.greatest(F.lit(0), width - F.size(a))))


def project(df: DataFrame, columns: Sequence[str], header_map: dict[str, str] | None = None) -> DataFrame:
    """Declared columns in order; what the source lacks is a null text.  With several sources for one name the last wins."""
    found = {(header_map or {}).get(c, c): c for c in df.columns}
    return df.select([F.col(f"`{found[c]}`").alias(c) if c in found else F.lit(None).cast("string").alias(c) for c in columns])


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs as columns with dotted names; arrays stay whole."""
    from pyspark.sql import types as T

    def walk(kind: T.StructType, path: tuple[str, ...]):
        for f in kind.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, here)
            else:
                yield here

    return df.select(*[F.col(".".join(f"`{p}`" for p in here)).alias(".".join(here)) for here in sorted(walk(df.schema, ()))])
